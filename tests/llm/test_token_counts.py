import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from threadlake.llm import token_counts
from threadlake.llm.token_counts import MergeTable, count_tokens, text_counter

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "a", "aaaaaaaaa", "don't we'll 'S", "  two\n\n lines \t", "<|endoftext|>", "x<|endoftext|><|endoftext|> y",
    "日本語 テスト ١٢٣ ½", "🏽👩‍👩‍👧", "a\x85b\xa0c \x1c \u200b", "x" * 5000, "ab" * 3000, "!" * 777 + " " * 99,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    return text_counter(PATH)


def expected(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_odd_texts_count_as_in_the_library(library, counter):
    assert counter(ODD) == expected(library, ODD)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_any_text_counts_as_in_the_library(texts):
    counter = test_any_text_counts_as_in_the_library.counter
    assert counter(texts) == expected(test_any_text_counts_as_in_the_library.library, texts)


test_any_text_counts_as_in_the_library.library = Tokenizer.from_file(PATH)
test_any_text_counts_as_in_the_library.counter = text_counter(PATH)


def test_a_full_cache_changes_nothing(library):
    small = text_counter(PATH, cache_entries=3)
    for text in ODD:
        assert small([text]) == expected(library, [text])


def test_ids_are_those_of_the_library(library):
    words = [w.encode() for w in ("hello", "Ġ", "inanon", "aaaa", "")]
    ids, counts = MergeTable(PATH).merge(words)
    at = np.r_[0, np.cumsum(counts)]
    for i, word in enumerate(words):
        want = library.encode(word.decode(), add_special_tokens=False).ids if word else []
        assert ids[at[i] : at[i + 1]].tolist() == want


def test_rows(spark, library):
    texts = [None, "", "hello world", "hello world", "x y " * 400]
    df = spark.createDataFrame(
        [(i if i else None, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int"
    )
    got = sorted(count_tokens(df, PATH).collect(), key=lambda r: r.doc_id or 0)
    want = expected(library, [t or "" for t in texts])
    assert [r.n_tokens for r in got] == want
    assert [r.n_bytes for r in got] == [len(t or "") for t in texts]
    assert [r.over_limit for r in got] == [n > 512 for n in want]
    assert got[0].doc_id is None
    assert count_tokens(df.limit(0), PATH).count() == 0


def test_words_are_cut_into_batches():
    parts = list(token_counts.in_batches([b"abc", b"d" * 50, b"", b"e"], 10))
    assert [w for part in parts for w in part] == [b"abc", b"d" * 50, b"", b"e"]
    assert len(parts) > 1
