import random

import pytest
from pyspark.sql import functions as F

from helpers import plan
from threadlake.functions.emoji import emoji_names, spell_emoji
from threadlake.functions.phrases import PhraseTrie, merge_phrases


def merged(spark, texts, phrases):
    df = spark.createDataFrame([(i, t.split(" ")) for i, t in enumerate(texts)], "i int, words array<string>")
    return [r[0] for r in df.orderBy("i").select(merge_phrases(F.col("words"), phrases)).collect()]


def brute(words, phrases):
    known = {tuple(p.split()) for p in phrases if len(p.split()) > 1}
    out, at = [], 0
    while at < len(words):
        sizes = [n for n in range(2, min(6, len(words) - at + 1)) if tuple(w.lower() for w in words[at : at + n]) in known]
        size = max(sizes, default=1)
        out.append(" ".join(words[at : at + size]))
        at += size
    return out


def test_longest_phrase_from_the_left(spark):
    phrases = ["to die for", "to die", "die for you now", "x", "for you"]
    texts = ["it is To DIE for you now", "to die", "to be", "die for you", "to die die for you now to", "to", ""]
    assert merged(spark, texts, phrases) == [brute(t.split(" "), phrases) for t in texts]


def test_any_words_and_phrases(spark):
    rng = random.Random(4)
    phrases = [" ".join(rng.choices("abc", k=rng.randint(1, 4))) for _ in range(12)]
    texts = [" ".join(rng.choices("abcA", k=rng.randint(1, 40))) for _ in range(150)] + ["a b " * 4000 + "c"]
    assert merged(spark, texts, phrases) == [brute(t.split(" "), phrases) for t in texts]


def test_without_phrases_nothing_changes(spark):
    assert merged(spark, ["a b"], ["a", "b"]) == [["a", "b"]]
    assert PhraseTrie(["a b", "A  B", "a b c"]).steps == {"0 a": 2, "1 b": 5, "2 c": 7}


def test_words_stay_in_their_row(spark):
    df = spark.createDataFrame([(["a", "b"],)], "words array<string>")
    assert "Exchange" not in plan(df.select(merge_phrases(F.col("words"), ["a b"])))
    null = spark.createDataFrame([(None,)], "words array<string>").select(merge_phrases(F.col("words"), ["a b"]))
    assert null.first()[0] is None


@pytest.mark.parametrize(
    "text, want",
    [
        ("fine", "fine"), ("", ""), (None, None), ("so\U0001f600good", "so grinning face good"),
        ("\U0001f494\U0001f494", " broken heart  broken heart "), ("☃", " snowman "),
    ],
)
def test_emoji_are_spelled(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(spell_emoji(F.col("t"), emoji_names())).first()[0] == want


def test_emoji_of_several_characters(spark):
    names = {"\U0001f44d": "thumb", "\U0001f44d\U0001f3fb": "light thumb", ":)": "smile"}
    df = spark.createDataFrame([("a\U0001f44d\U0001f3fb\U0001f44d :)",)], "t string")
    assert df.select(spell_emoji(F.col("t"), names)).first()[0] == "a light thumb  thumb   smile "
    assert df.select(spell_emoji(F.col("t"), {})).first()[0] == "a\U0001f44d\U0001f3fb\U0001f44d :)"
