"""Top terms per title by TF-IDF over one day's titles.

Done in two steps. ``fit_vocabulary`` counts words over all titles in Spark and
keeps the most frequent, at most ``max_features`` rows. ``top_terms`` then
scores each title by itself with the vocabulary as a constant, so the titles
are not shuffled.

``stage_top_terms`` gives the same for rows that are staged anyway: only the frequency of
words is counted over all titles, and in how many titles a term is follows from the
counts staged with each row. So no title's words are made distinct, and few are exploded
a second time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlake.functions import word_tables
from threadlake.functions.lookup import let, literal_lookup
from threadlake.functions.text import word_tokens
from threadlake.session import stage

MAX_FEATURES = 100  # fixed value
TOP_N = 3  # fixed value
# Up to so many terms are a list of the plan, which finds a word faster than a table does.
LISTED_TERMS = 1_000
_COUNTS = "_threadlake_term_counts"


def default_stop_words(spark: SparkSession) -> list[str]:
    """Spark's own English stop words."""
    return StopWordsRemover.loadDefaultStopWords("english")


def fit_vocabulary(
    df: DataFrame,
    column: str = "title",
    stop_words: Iterable[str] | None = None,
    max_features: int = MAX_FEATURES,
) -> DataFrame:
    """The ``max_features`` most frequent terms with their inverse document frequency.

    Columns ``term, tf, df, n, idf``; ``n`` counts every row, also blank ones,
    and ``idf = ln((1 + n) / (1 + df)) + 1``. Equal counts go in term order.
    The shuffle carries one row per term and map task.
    """
    total = df.agg(F.count(F.lit(1)).alias("n"))

    # Two lists per title: its words for tf, its distinct words for df. Both are
    # counts by term then, which map tasks combine before the shuffle.
    def listing(repeats: bool, words: Column) -> Column:
        return F.struct(F.lit(repeats).alias("repeats"), words.alias("words"))

    lists = F.array(
        listing(True, F.col("tokens")), listing(False, F.array_distinct("tokens"))
    )
    words = (
        df.select(word_tokens(F.col(column)).alias("tokens"))
        .select(F.explode(lists).alias("list"))
        .select("list.repeats", F.explode("list.words").alias("term"))
    )
    counted = _without_stop_words(words, stop_words).groupBy("term").agg(
        F.count_if("repeats").alias("tf"), F.count_if(~F.col("repeats")).alias("df")
    )
    n = total.scalar()
    return (
        counted.orderBy(F.desc("tf"), F.asc("term"))
        .limit(max_features)
        .select(
            "term",
            "tf",
            "df",
            n.alias("n"),
            _idf(n, F.col("df")).alias("idf"),
        )
    )


def _idf(n: Column, df: Column) -> Column:
    return F.log((F.lit(1) + n) / (F.lit(1) + df)) + F.lit(1.0)


def _without_stop_words(words: DataFrame, stop_words: Iterable[str] | None) -> DataFrame:
    stop = default_stop_words(words.sparkSession) if stop_words is None else list(stop_words)
    return words.where(~F.col("term").isin(stop)) if stop else words


def frequent_terms(
    df: DataFrame,
    column: str = "title",
    stop_words: Iterable[str] | None = None,
    max_features: int = MAX_FEATURES,
) -> DataFrame:
    """The terms of ``fit_vocabulary`` and their frequency: ``term, tf``, without ``df``."""
    words = df.select(F.explode(word_tokens(F.col(column))).alias("term"))
    counted = _without_stop_words(words, stop_words).groupBy("term").agg(F.count(F.lit(1)).alias("tf"))
    return counted.orderBy(F.desc("tf"), F.asc("term")).limit(max_features)


def _counts(hits: Column) -> Column:
    """The distinct terms of an array with their number in it, in term order."""

    # Sorted, equal terms stand in one run, from the place where the term differs from
    # the one before it to the place of the next such term.
    def starts(terms: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(terms) - 1)
        return F.filter(
            places, lambda i: (i == 0) | (F.get(terms, i) != F.get(terms, F.greatest(i - 1, F.lit(0))))
        )

    def runs(terms: Column) -> Column:
        def of(first: Column) -> Column:
            nexts = F.concat(F.slice(first, 2, F.size(first)), F.array(F.size(terms)))
            return F.zip_with(
                first, nexts, lambda a, b: F.struct(F.get(terms, a).alias("term"), (b - a).alias("tf"))
            )

        return let(starts(terms), of)

    found = F.when(F.size(hits) > 0, let(F.sort_array(hits), runs))
    return F.coalesce(found, F.array().cast("array<struct<term:string,tf:int>>"))


def _heaviest(counts: Column, idf: Callable[[Column], Column], top_n: int) -> Column:
    weights = F.transform(
        counts, lambda c: F.struct((c["tf"] * idf(c["term"])).alias("weight"), c["term"].alias("term"))
    )
    ranked = F.sort_array(weights, asc=False)
    return F.transform(F.slice(ranked, 1, top_n), lambda entry: entry["term"])


def score_terms(
    df: DataFrame,
    vocabulary: DataFrame,
    column: str = "title",
    output: str = "dominant_topics",
    top_n: int = TOP_N,
) -> DataFrame:
    """Adds the heaviest terms of each row as an array, heaviest first.

    The weight is ``tf * idf``; dividing by the row's norm would not change the
    order and is left out. Equal weights go in reverse term order.
    ``vocabulary`` is a result of ``fit_vocabulary``. One of up to ``CONSTANT_WORDS`` terms
    becomes a constant; a larger one is joined, with the words of each row counted once.
    """
    terms = vocabulary.select("term", "idf")
    first = terms.limit(word_tables.CONSTANT_WORDS + 1).collect()
    if not first:
        return df.withColumn(output, F.array().cast("array<string>"))
    small = len(first) <= word_tables.CONSTANT_WORDS
    table = {row["term"]: row["idf"] for row in first} if small else terms
    found = word_tables.word_lookup(df, word_tokens(F.col(column)), table)
    idf = found.value_of

    def hit(token: Column) -> Column:
        listed = small and len(table) <= LISTED_TERMS
        return token.isin(list(table)) if listed else idf(token).isNotNull()

    hits = F.filter(word_tokens(F.col(column)), hit)
    heaviest = let(hits, lambda terms: _heaviest(_counts(terms), idf, top_n))
    return found.without_helpers(found.rows.withColumn(output, heaviest))


def top_terms(
    df: DataFrame,
    column: str = "title",
    output: str = "dominant_topics",
    top_n: int = TOP_N,
    max_features: int = MAX_FEATURES,
    stop_words: Iterable[str] | None = None,
) -> DataFrame:
    """Adds the top terms of each row, comma-separated; null where there are none."""
    vocabulary = fit_vocabulary(df, column, stop_words, max_features)
    return _joined(score_terms(df, vocabulary, column, output, top_n), output)


def _joined(scored: DataFrame, output: str) -> DataFrame:
    return scored.withColumn(
        output, F.when(F.size(output) > 0, F.array_join(output, ","))
    )


def stage_top_terms(
    df: DataFrame,
    label: str,
    column: str = "title",
    output: str = "dominant_topics",
    top_n: int = TOP_N,
    max_features: int = MAX_FEATURES,
    stop_words: Iterable[str] | None = None,
) -> tuple[DataFrame, int]:
    """The rows of ``top_terms``, staged as ``label``, and their number.

    Each row is staged with the counts of its frequent terms, from which the inverse
    document frequencies follow; the terms are weighed when the rows are read.
    """
    if max_features > LISTED_TERMS:
        return stage(top_terms(df, column, output, top_n, max_features, stop_words), label)
    terms = [row["term"] for row in frequent_terms(df, column, stop_words, max_features).collect()]
    hits = F.filter(word_tokens(F.col(column)), lambda token: token.isin(terms))
    rows, n = stage(df.withColumn(_COUNTS, let(hits, _counts)), label)
    held = rows.select(F.explode(_COUNTS).alias("held")).groupBy("held.term").agg(F.count(F.lit(1)).alias("df"))
    weights = held.select("term", _idf(F.lit(n).cast("bigint"), F.col("df")).alias("idf")).collect()
    idf = literal_lookup({row["term"]: row["idf"] for row in weights})
    return _joined(rows.withColumn(output, _heaviest(F.col(_COUNTS), idf, top_n)), output).drop(_COUNTS), n
