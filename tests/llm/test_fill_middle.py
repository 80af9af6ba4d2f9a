import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from threadlake.llm.fill_middle import Rates, SkipList, digests, fill_in_middle, line_widths

LINES = re.compile(r"[^\n]*\n|[^\n]+")


def brute(doc_id, text, seed, rates):
    text = text or ""
    lines = LINES.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    one, two, three, four = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    if not text or re.search("<[PSM]>", text) or three % 100 >= rates.cut:
        return doc_id, len(lines), "plain", None, None, sha(text), sha(text)
    low, high = sorted((one % (len(lines) + 1), two % (len(lines) + 1)))
    p, m, s = ("".join(part) for part in (lines[:low], lines[low:high], lines[high:]))
    form = "spm" if four % 100 < rates.spm else "psm"
    output = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, len(lines), form, len(p), len(m), sha(output), sha(text)


@given(st.text(st.sampled_from("a\nä\r 😀<S>"), max_size=60))
def test_lines_are_those_of_the_expression(text):
    assert list(line_widths(text)) == [len(line) for line in LINES.findall(text)]


@settings(max_examples=60)
@given(st.lists(st.integers(0, 9), max_size=400))
def test_every_rank_is_reached_exactly(widths):
    units = SkipList(np.array(widths, np.int64))
    for rank in range(len(widths) + 1):
        assert units.points_before(rank) == sum(widths[:rank])


def test_lanes_thin_out_and_are_short_to_walk():
    units = SkipList(np.ones(100_000, np.int64))
    sizes = [len(lane.units) for lane in units.lanes]
    assert 6 <= len(sizes) <= 12 and sizes[-1] <= 8
    for lane in units.lanes[1:]:
        assert lane.units.sum() <= units.size and np.diff(lane.below).max(initial=0) <= 8
    with pytest.raises(IndexError):
        units.points_before(100_001)


@pytest.mark.parametrize("rates", [Rates(), Rates(40, 70), Rates(0, 0)])
def test_rows_equal_brute_force(spark, rates):
    texts = [None, "", "\n", "a", "a\nb", "\n\n\n", "x <P> y", "x\n<M>", "<S", "<\n<", "é\n日本\n😀\r\nz", "line\n" * 30_000, "no end " * 20_000]
    texts += [f"row {i}\nof\n{'x' * i}\n" for i in range(60)]
    rows = [(i, t, f"n{i}", "form") for i, t in enumerate(texts)]
    rows += rows[3:5] + [(None, "a\nb\n", "n", "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n string, form string").repartition(3)
    got = digests(fill_in_middle(df, seed=11, rates=rates))
    want = [brute(i, t, 11, rates) for i, t, _, _ in rows]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert fill_in_middle(df.limit(0)).count() == 0


def test_ids_of_any_type_and_the_output_itself(spark):
    df = spark.createDataFrame([("k1", "a\nb\nc\n")], "key string, body string")
    row = fill_in_middle(df, "key", "body").first()
    assert row.doc_id == "k1" and row.n == 3
    parts = dict(re.findall("<([PSM])>([^<]*)", row.output))
    assert parts["P"] + parts["M"] + parts["S"] == "a\nb\nc\n"
    assert (len(parts["P"]), len(parts["M"])) == (row.prefix_chars, row.middle_chars)
