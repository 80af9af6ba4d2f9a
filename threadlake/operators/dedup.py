"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_threadlake_rank"
_PRIORITY = "_threadlake_priority"


def keep_last(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """The row with the greatest ``order`` in each group of equal ``keys``.

    Spark applies the rank limit before the shuffle as well as after it
    (WindowGroupLimit), so each map task sends at most one row per key and a
    key that holds much of the table does not gather in one task.
    """
    latest_first = [
        (F.col(column) if isinstance(column, str) else column).desc_nulls_last()
        for column in order
    ]
    window = Window.partitionBy(*keys).orderBy(*latest_first)
    return (
        df.withColumn(_RANK, F.row_number().over(window))
        .where(F.col(_RANK) == 1)
        .drop(_RANK)
    )


def merge_prefer(
    base: DataFrame,
    preferred: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column] = (),
) -> DataFrame:
    """Rows of both inputs, one per key; ``preferred`` wins, then ``order``."""
    both = base.withColumn(_PRIORITY, F.lit(0)).unionByName(
        preferred.withColumn(_PRIORITY, F.lit(1)), allowMissingColumns=True
    )
    return keep_last(both, keys, [_PRIORITY, *order]).drop(_PRIORITY)
