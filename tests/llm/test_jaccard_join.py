import random
import re

import pytest

from threadlake.llm import jaccard_join
from threadlake.llm.components import components
from threadlake.llm.jaccard_join import keep_one, similar_classes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(rows, size, percent):
    sets = [shingles(text, size) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        members = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), (min(members) if members else None) if sets[i] else doc))
    return sorted(out, key=repr)


def corpus(seed):
    """Near copies in chains, one passage in many documents, very short and very long texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    passage = " ".join(rng.choices(vocabulary, k=40))
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.choice([5, 12, 30, 90, 200]))
        for _ in range(rng.choice([1, 2, 9])):
            texts.append(" ".join(base))
            base = list(base)
            base[rng.randrange(len(base))] = rng.choice(vocabulary)
    texts += [passage + " " + " ".join(rng.choices(vocabulary, k=rng.choice([3, 8, 60]))) for _ in range(25)]
    texts += [passage] * 3 + ["a b", "A  B", "a b c d", "a b c", "", "  \n", None, "x", " ", "É é", "é É"]
    texts += ["long " + " ".join(vocabulary * 20), "longer " + " ".join(vocabulary * 20)]
    rng.shuffle(texts)
    rows = [(i * 3 % 1000, text) for i, text in enumerate(texts)]
    return rows + [(rows[0][0], "another text under an id that is there"), rows[1], (None, "a b"), (None, "lone text only here x")]


@pytest.mark.parametrize("common", [32, 3])
@pytest.mark.parametrize("size, percent", [(4, 85), (2, 60)])
def test_equals_comparing_all_pairs(spark, common, size, percent):
    rows = corpus(size)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, component_id string").repartition(4)
    got = similar_classes(df, size, percent, common=common).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, size, percent)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert similar_classes(df).count() == 0
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, similar_classes(blank).collect())) == [(1, 0, 1), (2, 0, 2)]


def test_one_of_each_class_stays(spark):
    text = " ".join(f"t{i}" for i in range(60))
    rows = [(5, text), (3, text + " end"), (3, text + " end"), (9, "other words that stand here"), (None, text), (7, None), (8, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = keep_one(df, similar_classes(df, 5, 80))
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [3, 7, 8, 9]
    assert kept.columns == df.columns


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    df = spark.createDataFrame(links, "a long, b long")
    got = dict(map(tuple, components(df).collect()))
    assert {got[i] for i in range(41)} == {0}
    assert {got[100 + i] for i in range(30)} == {100}
    assert {got[i] for i in (200, 201, 202)} == {200} and got[300] == 300


def test_a_group_of_near_copies_is_not_compared_pair_by_pair(spark, monkeypatch):
    # Copies of two edits are linked with the text itself only, those of one edit with each other too.
    base = [f"b{i}" for i in range(150)]
    rng, rows = random.Random(5), [(0, " ".join(base))]
    for doc in range(1, 301):
        words = list(base)
        for place in rng.sample(range(8, 140, 9), 1 + (doc % 2)):
            words[place] = f"new{doc}x{place}"
        rows.append((doc, " ".join(words)))
    counts, plain = [], jaccard_join.written

    def counted(df, label):
        out = plain(df, label)
        if label == "likely":
            counts.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "written", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in similar_classes(df).collect()), key=repr)
    assert got == brute(rows, 4, 85)
    assert {c for _, _, c in got} == {0}
    assert 0 < sum(counts) < 4 * len(rows)
