import html
import html.entities
import math
import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import rows, value
from threadlake.functions import casts, labels, lookup, numbers, text


@pytest.mark.parametrize(
    "given, expected",
    [
        ("7", 7), (" 7 ", 7), ("-12", -12), ("1e3", 1000), ("7.0", 7), ("12.5", None),
        ("x", None), ("", None), (None, None), ("7d", None), ("NaN", None), ("inf", None),
        ("9007199254740993", 9007199254740993), ("99999999999999999999", None), ("1e30", None),
    ],
)
def test_lenient_long(spark, given, expected):
    assert value(spark, casts.lenient_long(F.lit(given).cast("string"))) == expected


@pytest.mark.parametrize(
    "given, expected", [("1.5", 1.5), (".5", 0.5), ("5.", 5.0), ("1f", None), ("a", None)]
)
def test_lenient_double(spark, given, expected):
    assert value(spark, casts.lenient_double(F.lit(given))) == expected


@pytest.mark.parametrize(
    "given, expected",
    [("true", True), ("FALSE", False), ("1", True), ("0", False), ("yes", None), (None, None)],
)
def test_lenient_boolean(spark, given, expected):
    assert value(spark, casts.lenient_boolean(F.lit(given).cast("string"))) is expected


@pytest.mark.parametrize(
    "given, expected",
    [
        ("1706745600", "2024-02-01 00:00:00"), ("0", "1970-01-01 00:00:00"), ("x", None),
        ("1e18", None),
    ],
)
def test_epoch_timestamp(spark, given, expected):
    assert value(spark, casts.epoch_timestamp(F.lit(given)).cast("string")) == expected


def test_epoch_timestamp_keeps_fractions(spark):
    micros = value(spark, F.unix_micros(casts.epoch_timestamp(F.lit("1.25"))))
    assert micros == 1_250_000


def test_lenient_kids(spark):
    df = spark.createDataFrame([(["1", "x", "3"],)], "kids array<string>")
    kind = T.ArrayType(T.LongType())
    assert df.select(casts.lenient(F.col("kids"), kind, df.schema["kids"].dataType)).first()[0] == [
        1, None, 3,
    ]
    assert value(spark, casts.lenient(F.lit("[4,5]"), kind, T.StringType())) == [4, 5]


def test_round_half_even_agrees_with_numpy(spark):
    draw = random.Random(7)
    numbers_ = [draw.randint(-400000, 400000) / 200 for _ in range(500)]
    numbers_ += [draw.uniform(-100, 100) for _ in range(500)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(numbers_)], "i int, x double")
    got = df.orderBy("i").select(numbers.round_half_even(F.col("x"), 2)).collect()
    assert [row[0] for row in got] == list(np.round(np.array(numbers_), 2))


def test_not_below_zero_keeps_null(spark):
    df = spark.createDataFrame([(1, -3.0), (2, None), (3, 2.5)], "i int, x double")
    assert rows(df.select("i", numbers.not_below_zero(F.col("x")))) == [(1, 0.0), (2, None), (3, 2.5)]


def test_hours_between_keeps_microseconds(spark):
    later, earlier = F.lit("2026-01-01 01:30:00.0036").cast("timestamp"), F.lit("2026-01-01").cast("timestamp")
    assert value(spark, numbers.hours_between(later, earlier)) == pytest.approx(1.500001, abs=1e-12)


@pytest.mark.parametrize(
    "given, expected",
    [
        ("Tom &amp; Jerry &lt;3", "Tom & Jerry <3"),
        ("hello   <br>   world   ", "hello world"),
        ("", ""), (None, ""),
        ("<div><p>a<b>b</b></p></div>", "a b"),
        ("&amp;lt;", "&lt;"), ("&amp;amp;", "&amp;"), ("&#x27;q&#x2F;&quot;", "'q/\""),
        ("&copy &notit; &#8364; &eacute;", "© ¬it; € é"),
        ("a b　c\x85d", "a b c d"),
        ("1 < 2 and 3 > 2", "1 2"),
        ("AT&T", "AT&T"), ("&", "&"),
    ],
)
def test_clean_html(spark, given, expected):
    assert value(spark, text.clean_html(F.lit(given).cast("string"))) == expected


def test_squeeze_spaces_knows_what_python_calls_space(spark):
    spaces = [chr(c) for c in range(sys.maxunicode) if chr(c).isspace()]
    df = spark.createDataFrame([(f"a{s}{s}b{s}",) for s in spaces], "t string")
    assert {row[0] for row in df.select(text.squeeze_spaces(F.col("t"))).collect()} == {"a b"}


def test_word_tokens(spark):
    found = value(spark, text.word_tokens(F.lit("Été: C++ is a_b, x 42nd, naïve I")))
    assert found == ["été", "is", "a_b", "42nd", "naïve"]
    assert value(spark, text.word_tokens(F.lit(None).cast("string"))) == []


def test_csv_terms(spark):
    assert value(spark, text.csv_terms(F.lit("a, b ,,c"))) == ["a", "b", "", "c"]


def test_labels(spark):
    df = spark.createDataFrame(
        [(1, 0.05), (2, -0.05), (3, 0.0499), (4, 0.0)], "i int, x double"
    )
    assert rows(df.select("i", labels.sentiment_label(F.col("x")))) == [
        (1, "positive"), (2, "negative"), (3, "neutral"), (4, "neutral"),
    ]
    hours = spark.createDataFrame([(1, 6.0), (2, 6.01), (3, 24.0), (4, 24.5), (5, None)], "i int, h double")
    assert [row[1] for row in rows(hours.select("i", labels.speed_category(F.col("h"))))] == [
        "fast (<=6h)", "medium (6-24h)", "medium (6-24h)", "slow (>24h)", "slow (>24h)",
    ]


def test_literal_lookup_finds_every_word(spark):
    table = {f"wörd{i}": i / 4 for i in range(3000)}
    find = lookup.literal_lookup(table)
    df = spark.createDataFrame([(word,) for word in table] + [("other",), (None,)], "w string")
    got = {row[0]: row[1] for row in df.select("w", find(F.col("w"))).collect()}
    assert {word: got[word] for word in table} == table
    assert got["other"] is None and got[None] is None


def test_literal_lookup_refuses_a_table_that_is_data(spark, monkeypatch):
    monkeypatch.setattr(lookup, "MAX_TABLE_WORDS", 2)
    with pytest.raises(ValueError):
        lookup.literal_lookup({"a": 1, "b": 2, "c": 3})


def test_empty_lookup(spark):
    assert value(spark, lookup.literal_lookup({})(F.lit("a"))) is None


def test_let_evaluates_in_place(spark):
    assert value(spark, lookup.let(F.lit(3), lambda x: x * x + x)) == 12
    assert math.isclose(value(spark, lookup.let(F.lit(2.0), lambda x: F.sqrt(x) * F.sqrt(x))), 2.0)


def unescaped(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [row[0] for row in df.orderBy("i").select(text.decode_entities(F.col("t"))).collect()]


def test_every_named_reference(spark):
    texts = [f"a &{name} b" for name in html.entities.html5]
    assert unescaped(spark, texts) == [html.unescape(t) for t in texts]


def test_numbered_references(spark):
    numbers_ = [*range(0x180), *range(0xD7F0, 0xE010), *range(0xFDC0, 0xFE00), *range(0xFEF0, 0x10010)]
    numbers_ += [0x1F600, 0x10FFFD, 0x10FFFE, 0x10FFFF, 0x110000, 10**7, 10**25]
    texts = [f"&#{n};" for n in numbers_] + [f"x&#x{n:X}y" for n in numbers_] + [f"&#X000{n:x};" for n in numbers_]
    assert unescaped(spark, texts) == [html.unescape(t) for t in texts]


def test_random_references(spark):
    draw = random.Random(3)
    parts = [
        "&", "amp", ";", "lt", "&lt", "gt;", "&copy", "not", "it;", "#", "x", "41", "0", "&#", "&#x", "é",
        " ", "\n", "\t", "quot", "&quot;", "&notin;", "CounterClockwiseContourIntegral;", "q" * 33, "<", "&&",
    ]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(1, 12))) for _ in range(3000)]
    assert unescaped(spark, texts) == [html.unescape(t) for t in texts]
