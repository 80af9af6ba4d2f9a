import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from threadlake.llm.packing import id_encoder, pack_documents, plan_packing, plan_rows

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODE = id_encoder(PATH)


def want(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=80, deadline=None)
@given(st.text(max_size=80))
def test_ids_are_the_librarys(text):
    assert np.frombuffer(ENCODE([text])[0], "<u4").tolist() == want(text)


def test_odd_ids():
    texts = [
        "", "Don't WE'LL 's 12,34.", "<|startoftext|>a <|endoftext|>", "x\x1cy \x1f z", "e\u0301 é ß ÀÉ", "日本 ١٢ Ⅷ⁵",
        "a\xa0b\x85c", "İI ΣΑΣ", "..., !?", "²³ ½ ª", "𝔸𝔹 🏽👩‍👧", "a" * 3000,
    ]
    for encoded, text in zip(ENCODE(texts), texts):
        assert np.frombuffer(encoded, "<u4").tolist() == want(text), text


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 60), max_size=30))
def test_plan_uses_every_length_as_often_as_it_occurs(counts):
    runs = plan_packing(counts, 64)
    used = {}
    for repeat, lengths in runs:
        assert repeat > 0 and sum(lengths) <= 64
        for length in lengths:
            used[length] = used.get(length, 0) + repeat
    assert used == counts
    total = sum(length * count for length, count in counts.items())
    number = sum(run.repeat for run in runs)
    # Best fit never leaves two sequences that are both at most half full.
    assert -(-total // 64) <= number <= 2 * (total // 64) + 1
    assert (plan_rows(runs)[:, 3] > 0).all()


def test_plan_is_close_to_the_least_number():
    rng = np.random.default_rng(1)
    lengths = np.clip(rng.lognormal(6, 1, 30_000).astype(int), 1, 2048)
    counts = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
    number = sum(run.repeat for run in plan_packing(counts))
    assert number <= -(-int(lengths.sum()) // 2048) * 1.005 + 1


def test_every_piece_has_its_place(spark):
    texts = [None, "", "a b c", "a b c", "word " * 150, "and " * 31 + "x", *[f"t{i} " * (i % 40) for i in range(120)]]
    rows = [(i, t, 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, offset int").repartition(5)
    got = pack_documents(df, PATH, capacity=64).collect()
    by_document, by_sequence = {}, {}
    for r in got:
        by_document.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for i, text in enumerate(texts):
        ids = np.array([*want(text or ""), 0], "<u4")
        pieces = sorted(by_document[i], key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(-(-len(ids) // 64)))
        for p in pieces:
            part = ids[64 * p.piece : 64 * p.piece + 64]
            assert (p.start, p.length, p.ids_crc32) == (64 * p.piece, len(part), zlib.crc32(part.tobytes()))
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda r: r.offset):
            assert p.offset == at
            at += p.length
        assert at <= 64
    assert len(by_sequence) <= -(-sum(r.length for r in got) // 64) + 3
    assert pack_documents(df.limit(0), PATH).count() == 0
