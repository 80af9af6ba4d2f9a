"""Key membership: which rows refer to a key that exists.

Rows may be skewed: one parent may have a third of all replies. Two ways are
used, and neither brings the rows of a hot key to one task.

- Against a list of keys (``rows_in``, ``rows_not_in``): the list is made distinct
  and staged. Spark then knows its size, and broadcasts it or shuffles both sides;
  in a shuffle, adaptive execution splits the rows of a hot key over tasks. (It
  would not if the distinct list were joined as it comes from its aggregation.)
- Against the keys of whole tables (``split_orphans``, ``flag_known_parents``,
  ``rows_with_key``, ``rows_without_key``): membership is decided on the distinct
  keys of both sides, each of which a map-side combine leaves once (dense whole numbers
  as bitmaps of 32,768 ids each, see ``key_bitmaps``). The rows only
  meet the shorter of the two lists that result. Usually few parents are missing,
  so the rows are not shuffled at all.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from threadlake.operators import key_bitmaps
from threadlake.session import stage, staged_path

_KEY = "_threadlake_key"
_KNOWN = "_threadlake_known"


def key_set(*frames: DataFrame, key: str = "id") -> DataFrame:
    """The distinct non-null keys of all frames, as one column ``key``."""
    keys = frames[0].select(key)
    for frame in frames[1:]:
        keys = keys.union(frame.select(key))
    return keys.where(F.col(key).isNotNull()).distinct()


def _renamed(keys: DataFrame) -> DataFrame:
    (column,) = keys.columns
    return keys.select(F.col(column).alias(_KEY))


def rows_in(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows whose ``column`` is one of ``keys`` (a one-column frame)."""
    listed, _ = stage(_renamed(keys).distinct(), "keys")
    return df.join(listed, df[column] == listed[_KEY], "left_semi")


def rows_not_in(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows whose ``column`` is none of ``keys``; a null counts as absent."""
    listed, _ = stage(_renamed(keys).distinct(), "keys")
    return df.join(listed, df[column] == listed[_KEY], "left_anti")


def active_rows(df: DataFrame, active_ids: DataFrame, column: str = "id") -> DataFrame:
    """Rows whose id is in the active set."""
    return rows_in(df, column, active_ids)


def new_ids(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """Distinct candidate ids that are not known yet."""
    (column,) = candidates.columns
    ids, other = key_set(candidates, key=column), _renamed(known)
    return ids.join(other, ids[column] == other[_KEY], "left_anti")


@dataclass(frozen=True)
class Membership:
    """The distinct keys of some rows, parted by whether they exist."""

    known: DataFrame
    unknown: DataFrame
    known_count: int
    unknown_count: int


def membership(df: DataFrame, column: str, keys: DataFrame) -> Membership:
    """Look up each distinct non-null key of ``df`` once. Written to the shared folder.

    Dense whole numbers meet as bitmaps, all other keys as lists; the result is the same.
    """
    spark = df.sparkSession
    ours = df.select(F.col(column).alias(_KEY))
    if key_bitmaps.are_dense(ours, keys):
        parted = key_bitmaps.parted(ours, keys, _KEY, _KNOWN)
    else:
        wanted = key_set(ours, key=_KEY)
        existing = keys.select(F.col(keys.columns[0]).alias("_existing")).distinct()
        parted = wanted.join(existing, F.col(_KEY) == F.col("_existing"), "left").select(
            _KEY, F.col("_existing").isNotNull().alias(_KNOWN)
        )
    seen = Observation(f"membership-{uuid.uuid4().hex}")
    path = staged_path(spark, "membership")
    parted.observe(
        seen,
        F.count_if(_KNOWN).alias("known"),
        F.count_if(~F.col(_KNOWN)).alias("unknown"),
    ).write.partitionBy(_KNOWN).parquet(path)
    counts = seen.get

    def part(flag: str, count: int) -> DataFrame:
        # A folder of its own, so that Spark knows the size of this part alone.
        if not count:
            return spark.createDataFrame([], ours.schema)
        return spark.read.schema(ours.schema).parquet(f"{path}/{_KNOWN}={flag}")

    return Membership(
        part("true", counts["known"]),
        part("false", counts["unknown"]),
        counts["known"],
        counts["unknown"],
    )


def _with_key(df: DataFrame, column: str, found: Membership) -> DataFrame:
    if found.unknown_count <= found.known_count:
        present = df.where(F.col(column).isNotNull())
        return present.join(found.unknown, F.col(column) == F.col(_KEY), "left_anti")
    return df.join(found.known, F.col(column) == F.col(_KEY), "left_semi")


def _flagged(df: DataFrame, column: str, found: Membership, flag: str) -> DataFrame:
    shorter_is_unknown = found.unknown_count <= found.known_count
    listed = (found.unknown if shorter_is_unknown else found.known).withColumn(
        _KNOWN, F.lit(True)
    )
    on_list = F.coalesce(F.col(_KNOWN), F.lit(False))
    known = ~on_list & F.col(column).isNotNull() if shorter_is_unknown else on_list
    return (
        df.join(listed, F.col(column) == F.col(_KEY), "left")
        .withColumn(flag, known)
        .drop(_KEY, _KNOWN)
    )


def _without_key(df: DataFrame, column: str, found: Membership) -> DataFrame:
    if found.unknown_count <= found.known_count:
        flag = "_threadlake_has_key"
        return _flagged(df, column, found, flag).where(~F.col(flag)).drop(flag)
    return df.join(found.known, F.col(column) == F.col(_KEY), "left_anti")


def rows_with_key(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows whose ``column`` is among the keys of a whole table."""
    return _with_key(df, column, membership(df, column, keys))


def rows_without_key(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """The other rows; a null counts as absent."""
    return _without_key(df, column, membership(df, column, keys))


def flag_known_parents(
    comments: DataFrame, keys: DataFrame, parent: str = "parent", flag: str = "has_parent"
) -> DataFrame:
    """``comments`` with a flag telling whether the parent is among ``keys``."""
    return _flagged(comments, parent, membership(comments, parent, keys), flag)


def split_orphans(
    stories: DataFrame, comments: DataFrame, comment_ids: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Comments whose parent is a known story or comment, and the others.

    The comment ids are those before the split: a reply to a dropped orphan
    stays. ``comment_ids`` may give them from a cheaper source.
    """
    keys = key_set(stories.select("id"), (comment_ids or comments).select("id"))
    found = membership(comments, "parent", keys)
    return _with_key(comments, "parent", found), _without_key(comments, "parent", found)


def count_unmatched(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """One row: child rows without a parent, all child rows, distinct parents.

    Child keys are counted before the join, so the join meets each key once.
    Null child keys count as unmatched.
    """
    counted = child.groupBy(F.col(child_key).alias("_child")).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    parents = _renamed(key_set(parent, key=parent_key)).withColumn(_KNOWN, F.lit(True))
    joined = counted.join(parents, F.col("_child") == F.col(_KEY), "full")
    known = F.coalesce(F.col(_KNOWN), F.lit(False))
    rows = F.coalesce(F.col("_rows"), F.lit(0))
    return joined.agg(
        F.coalesce(F.sum(F.when(~known, rows)), F.lit(0)).cast("bigint").alias("unmatched"),
        F.coalesce(F.sum(rows), F.lit(0)).cast("bigint").alias("child_rows"),
        F.count(F.col(_KEY)).alias("parents"),
    )
