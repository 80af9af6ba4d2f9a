import hashlib
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from threadlake.llm import suffix_dedup
from threadlake.llm.deep_shallow import padded, sort_suffixes
from threadlake.llm.suffix_dedup import Plan, digests, remove_repeats, window_anchors


@settings(max_examples=150, deadline=None)
@given(st.binary(min_size=1, max_size=300), st.integers(1, 60), st.sampled_from([1, 5, 8, 16, 64]), st.booleans())
def test_order_is_that_of_the_strings(data, length, shallow, narrow):
    if narrow:
        data = bytes(b & 1 for b in data) * 3
    starts = np.arange(max(0, len(data) - length + 1))
    order, fresh = sort_suffixes(padded(np.frombuffer(data, np.uint8)), starts, length, shallow)
    strings = [data[s : s + length] for s in starts]
    got = [strings[i] for i in order]
    assert got == sorted(strings) and sorted(order) == list(range(len(starts)))
    assert list(fresh) == [i == 0 or got[i] != got[i - 1] for i in range(len(got))]


@pytest.mark.parametrize("length", [1, 2, 7, 50, 128])
def test_equal_windows_have_equal_anchors(length):
    rng = np.random.default_rng(length)
    plan, shared = Plan(length, 4), rng.integers(0, 256, length + 30, np.uint8)
    one, two = (np.concatenate([rng.integers(0, 4, n, np.uint8), shared, rng.integers(0, 4, n, np.uint8)]) for n in (9, 40))
    assert (window_anchors(one, plan)[9 : 9 + 31] == window_anchors(two, plan)[40 : 40 + 31]).all()
    assert len(window_anchors(one, plan)) == len(one) - length + 1


def brute(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, t in texts:
        for p in range(len(t) - length + 1):
            w = t[p : p + length]
            first[w] = min(first.get(w, float("inf")), float("inf") if i is None else i)
    out = []
    for i, t in texts:
        gone = [False] * len(t)
        for p in range(len(t) - length + 1):
            if first[t[p : p + length]] < (float("inf") if i is None else i):
                gone[p : p + length] = [True] * length
        spans = sum(g and not (p and gone[p - 1]) for p, g in enumerate(gone))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)

    def text(n):
        return "".join(rng.choice("abc é日\n\0") for _ in range(n))

    passages = [text(n) for n in (49, 50, 51, 80, 300)]
    rows = [(i, text(rng.randint(0, 200)) + rng.choice(passages) + text(rng.randint(0, 9)) + rng.choice(passages)) for i in range(60)]
    rows += [(100 + i, rows[i][1]) for i in range(20)] + [(5, rows[7][1]), (5, rows[5][1]), rows[3], rows[3]]
    rows += [(200, None), (201, ""), (202, "a" * 49), (203, "a" * 50), (204, "a" * 400), (205, "ab" * 200), (206, "ab" * 30)]
    rows += [(None, rows[0][1]), (None, "only without id " * 9), (None, "only without id " * 9), (-4, passages[4]), (207, passages[4][:-1] + "x")]
    return rows


@pytest.mark.parametrize("length, block_bytes, hot", [(50, 16_000_000, 256), (50, 3_000, 256), (50, 2_000, 2), (7, 2_000, 3), (80, 5_000, 0)])
def test_rows_equal_brute_force(spark, length, block_bytes, hot):
    rows = corpus(length + hot)
    df = spark.createDataFrame([(i, t, "b", 1) for i, t in rows], "doc_id long, text string, block string, rid int").repartition(5)
    got = remove_repeats(df, length=length, finish=digests, block_bytes=block_bytes, hot_blocks=hot)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, length)


def test_long_documents_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 97)
    rng = random.Random(1)
    long = "".join(rng.choice("abcdefgh ") for _ in range(5_000))
    rows = [(1, long), (2, long[1_000:3_000] + "!" + long[4_000:]), (3, "z" * 3_000), (4, "z" * 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, remove_repeats(df, finish=digests).collect()), key=repr) == brute(rows, 50)


def test_empty_table_kept_bytes_and_nothing_left_behind(spark):
    df = spark.createDataFrame([(1, "x" * 60), (2, "pre " + "x" * 60 + " post")], "doc_id long, text string")
    assert remove_repeats(df.limit(0)).count() == 0
    kept = {r.doc_id: bytes(r.kept) for r in remove_repeats(df).collect()}
    assert kept == {1: b"x" * 60, 2: b"pre  post"}
    assert not [t for t in spark.catalog.listTables() if "suffix" in t.name]
    with pytest.raises(ValueError):
        remove_repeats(df, length=0)
    with pytest.raises(ValueError):
        remove_repeats(df, length=129)


def blocks_of(documents, plan):
    """A block of each list of texts."""
    schema = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("text", pa.binary())])
    return [
        suffix_dedup.Block(pa.table([range(len(texts)), [1_000 * i + j for j in range(len(texts))], texts], schema=schema), plan)
        for i, texts in enumerate(documents)
    ]


def pieces_of(blocks, plan):
    """The pieces that each block sends."""
    sent = pa.concat_tables([block.keys().sent(i) for i, block in enumerate(blocks)])
    bits = [{} for _ in blocks]
    for bucket in range(plan.buckets):
        rows = sent.filter(pc.equal(sent["bucket"], bucket))
        if rows.num_rows:
            for row in suffix_dedup._answer_keys(plan)(rows).to_pylist():
                bits[row["block"]][bucket] = row["payload"]
    return [block.pieces(mine) for block, mine in zip(blocks, bits)]


def test_a_passage_of_many_blocks_goes_in_pieces():
    rng = np.random.default_rng(3)
    passage, plan = rng.bytes(400), Plan(50, 8)
    blocks = blocks_of([[rng.bytes(60) + passage + rng.bytes(60)] for _ in range(300)], plan)
    for pieces in pieces_of(blocks, plan):
        # 351 windows, each with its text, if they went by themselves.
        assert 10 < len(pieces.values) < 60
        assert sum(len(row.as_py()) for row in pieces.sent(0)["keys"]) < 8_000


def test_an_anchor_is_spread_for_the_pieces_that_differ():
    rng = np.random.default_rng(4)
    data = np.frombuffer(rng.bytes(2_000_000), np.uint8)
    least = np.argmin(suffix_dedup.gram_hashes(data, 16))
    common = data[least : least + 16].tobytes()  # the anchor wherever it stands

    def text():
        return rng.bytes(33) + common + rng.bytes(33)

    plan, one = Plan(50, 4, 100), text()
    single = pieces_of(blocks_of([[one] * 60, [one] * 60], plan), plan)
    assert [len(pieces.values) for pieces in single] == [1, 1]
    many = pieces_of(blocks_of([[text() for _ in range(60)] for _ in range(2)], plan), plan)
    assert [len(pieces.values) for pieces in many] == [60 * 33] * 2
    assert [len(p.values) for p in pieces_of(blocks_of([[text() for _ in range(49)] for _ in range(2)], plan), plan)] == [49] * 2


@pytest.mark.parametrize("values", [np.array([3, -1, 1 << 40], "<i8"), np.array([], "<u4"), np.array([b"ab", b"c\0d", b""], "S5")])
def test_what_is_sent_is_read_back(values):
    got = suffix_dedup.opened(suffix_dedup.squeezed(values), values.dtype.str.replace("|", ""))
    assert got.dtype == values.dtype and list(got) == list(values)


def test_shuffle_files_go_with_their_step(spark, monkeypatch):
    name, kinds = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", []
    before = spark.conf.get(name)
    for step in ("stage", "stage_bucketed"):
        monkeypatch.setattr(
            suffix_dedup, step, lambda *a, run=getattr(suffix_dedup, step): (kinds.append(spark.conf.get(name)), run(*a))[1]
        )
    rows = [(1, "x" * 60), (2, "pre " + "x" * 60)]
    remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert kinds == ["true"] * 3 and spark.conf.get(name) == before
    with pytest.raises(ZeroDivisionError):
        remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), finish=lambda out: 1 // 0)
    assert spark.conf.get(name) == before
