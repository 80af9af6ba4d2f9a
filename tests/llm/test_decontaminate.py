import hashlib
import random
import re

import pytest

from threadlake.llm import decontaminate
from threadlake.llm.decontaminate import keep_clean, report, scan_documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(documents, items, size):
    out = []
    for doc_id, text in documents:
        own, hit, found = words(text), set(), set()
        for item, item_text in items:
            all_words = words(item_text)
            if not all_words:
                continue
            for i in range(max(1, len(all_words) - size + 1)):
                window = all_words[i : i + size]
                for at in range(len(own) - len(window) + 1):
                    if own[at : at + len(window)] == window:
                        hit.update(range(at, at + len(window)))
                        found.add(str(item))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(own), len(hit), len(found), digest, bool(hit)))
    return out


@pytest.fixture(scope="module")
def data():
    rng = random.Random(3)
    some = ["a", "b", "Ab", "c1", "ä", "Ä", "日本", "x"]

    def text(n):
        return "".join(rng.choice(some) + rng.choice([" ", ", ", "\n", "_", "-"]) for _ in range(n))

    items = [(i, text(rng.randint(3, 9))) for i in range(12)] + [(12, None), (13, ""), (14, "?!"), (15, "c1"), (2, "x x")]
    documents = [(i, text(rng.randint(0, 60))) for i in range(60)]
    documents += [(60, None), (61, ""), (62, " .. "), (63, "pre " + items[0][1] + " post" * 50), (63, "C1"), (None, "c1 x")]
    return documents, items


@pytest.mark.parametrize("most", [8_000_000, 40])
def test_equals_trying_every_window(spark, data, monkeypatch, most):
    monkeypatch.setattr(decontaminate.slices, "__defaults__", (most,))
    documents, items = data
    docs = spark.createDataFrame([(*d, 1) for d in documents], "doc_id long, text string, n_words int").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = report(scan_documents(docs, bench, window=4))
    want = brute(documents, items, 4)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    clean = keep_clean(docs, bench, window=4)
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(w[0]) for w in want if not w[5])
    assert clean.schema == docs.schema


def test_spans_are_places_in_the_original(spark):
    bench = spark.createDataFrame([("q", "Two  words")], "item_id string, text string")
    docs = spark.createDataFrame([(1, "Äh, TWO--words! 日本 two, words")], "doc_id int, text string")
    row = scan_documents(docs, bench, window=10).first()
    text = "Äh, TWO--words! 日本 two, words"
    assert [text[s.start : s.end] for s in row.spans] == ["TWO--words", "two, words"]
    assert row["items"] == ["q"]


def test_empty_tables(spark, data):
    docs = spark.createDataFrame(data[0], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.contaminated for r in report(scan_documents(docs, none)).collect()} == {False}
    assert scan_documents(docs.limit(0), none).count() == 0
