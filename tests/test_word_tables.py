import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from threadlake.functions import word_tables
from threadlake.functions.word_tables import KNOWN, ROW, word_lookup
from threadlake.operators import sentiment, topics
from threadlake.operators.sentiment import add_lexicon_sum, add_sentiment

LEXICON = {"good": 2.0, "bad": -2.0, "to die for": 3.0, "fine": 1.0, "no": -1.0, "word7": 0.5}


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(2)
    some = ["good", "bad", "to", "die", "for", "fine", "not", "very", "GOOD!", "no", "but"] + [f"word{i}" for i in range(30)]
    made = [" ".join(rng.choices(some, k=rng.randint(0, 60))) for _ in range(80)] + [None, "", "zzz"]
    return spark.createDataFrame([(i % 70, t, i) for i, t in enumerate(made)], "id int, text string, term int")


@pytest.fixture(scope="module")
def million(spark):
    """A lexicon of a million entries: those above, and words that occur nowhere."""
    own = spark.createDataFrame(list(LEXICON.items()), "w string, v double")
    other = spark.range(1_000_000).select(F.concat(F.lit("unused"), F.col("id").cast("string")).alias("w"), F.lit(9.0).alias("v"))
    return own.unionByName(other)


@pytest.mark.parametrize("most", [200_000, 3])
def test_a_million_entries_give_what_the_constant_gives(spark, texts, million, monkeypatch, most):
    want = rows(add_sentiment(texts, "text", LEXICON))
    sums = rows(texts.select("id", "text", "term", sentiment.lexicon_sum(F.col("text"), LEXICON).alias("valence")))
    monkeypatch.setattr(word_tables, "CONSTANT_WORDS", most)
    scored = add_sentiment(texts, "text", million)
    assert scored.columns == [*texts.columns, "sentiment_score", "sentiment_label"] and rows(scored) == want
    assert rows(add_lexicon_sum(texts, "text", million)) == sums


def test_a_large_mapping_is_joined_too(spark, texts, monkeypatch):
    want = rows(add_sentiment(texts, "text", LEXICON))
    monkeypatch.setattr(word_tables, "CONSTANT_WORDS", 4)
    assert rows(add_sentiment(texts, "text", LEXICON)) == want


def test_top_terms_of_a_large_vocabulary(spark, texts, monkeypatch):
    want = rows(topics.top_terms(texts, "text", max_features=30, stop_words=["bad"]))
    monkeypatch.setattr(word_tables, "CONSTANT_WORDS", 5)
    assert rows(topics.top_terms(texts, "text", max_features=30, stop_words=["bad"])) == want


def test_frequent_words_meet_the_table_once(spark, monkeypatch):
    monkeypatch.setattr(word_tables, "CONSTANT_WORDS", 1)
    df = spark.range(3000).select("id", F.array(F.lit("hot"), F.col("id").cast("string")).alias("words"))
    found = word_lookup(df, F.col("words"), spark.createDataFrame([("hot", 1.0), ("7", 2.0), ("hot", 3.0), (None, 1.0)], "a string, b double"))
    values = found.rows.select("id", F.transform("words", found.value_of).alias("v"), ROW, KNOWN)
    got = {r.id: r.v for r in values.collect()}
    assert got[7] == [3.0, 2.0] and got[8] == [3.0, None] and len(got) == 3000
    assert found.without_helpers(found.rows).columns == ["id", "words"]


def test_no_words_at_all(spark, million):
    empty = spark.createDataFrame([], "text string")
    assert add_sentiment(empty, "text", million).count() == 0
    assert [r.valence for r in add_lexicon_sum(spark.createDataFrame([(None,)], "text string"), "text", million).collect()] == [0.0]
