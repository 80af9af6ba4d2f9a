"""Word tables of any size.

A table that fits is a constant of the plan (``literal_lookup``) and costs no shuffle. For a
larger one the words are looked up by a join, once each however often they occur:

1. the distinct words of all rows meet the table, which leaves the entries that occur; map
   tasks combine a frequent word before the shuffle;
2. if those fit, they are the constant after all, and the rows are not touched;
3. if not, each row's distinct words meet them, and each row gets what it knows as a map of
   its own. The entries are staged, so Spark knows their size and broadcasts them or shuffles
   both sides, where adaptive execution splits a word that most rows have.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlake.functions import lookup
from threadlake.session import stage

# Up to so many entries a table is a constant of the plan.
CONSTANT_WORDS = lookup.MAX_TABLE_WORDS
ROW, KNOWN = "_threadlake_row", "_threadlake_words"
WordTable = Mapping[str, float] | DataFrame


@dataclass(frozen=True)
class Lookup:
    """Rows, and a function from a word column to its value in the table or null."""

    rows: DataFrame
    value_of: Callable[[Column], Column]

    def without_helpers(self, df: DataFrame) -> DataFrame:
        return df.drop(ROW, KNOWN)


def word_rows(df: DataFrame, table: WordTable) -> DataFrame:
    """``term, value`` of a table; of terms listed more than once the largest value counts."""
    if isinstance(table, DataFrame):
        term, value = table.columns
        listed = table.select(F.col(term).alias("term"), F.col(value).cast("double").alias("value"))
        return listed.where("term IS NOT NULL AND value IS NOT NULL").groupBy("term").agg(F.max("value").alias("value"))
    return df.sparkSession.createDataFrame(list(table.items()), "term string, value double")


def fits(table: WordTable) -> bool:
    return not isinstance(table, DataFrame) and len(table) <= CONSTANT_WORDS


def word_lookup(df: DataFrame, words: Column, table: WordTable) -> Lookup:
    """How the ``words`` (an array column of ``df``) are looked up in ``table``.

    ``table`` is a mapping or a frame of two columns, term and value. Rows may come back with
    helper columns, which ``without_helpers`` takes out again.
    """
    if fits(table):
        return Lookup(df, lookup.literal_lookup(table))
    occurring = df.select(F.explode(words).alias("term")).distinct()
    known, count = stage(word_rows(df, table).join(occurring, "term"), "known-words")
    if count <= CONSTANT_WORDS:
        return Lookup(df, lookup.literal_lookup({r.term: r.value for r in known.collect()}))
    rows, _ = stage(df.withColumn(ROW, F.monotonically_increasing_id()), "rows-with-words")
    own = rows.select(ROW, F.explode(F.array_distinct(words)).alias("term")).join(known, "term")
    maps = own.groupBy(ROW).agg(F.map_from_entries(F.collect_list(F.struct("term", "value"))).alias(KNOWN))
    return Lookup(rows.join(maps, ROW, "left"), lambda word: F.try_element_at(F.col(KNOWN), word))
