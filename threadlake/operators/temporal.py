"""Engagement over time from daily observations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlake.functions.casts import lenient
from threadlake.functions.numbers import (
    hours_between,
    midnight,
    not_below_zero,
    round_half_even,
)
from threadlake.operators.dedup import merge_prefer

LONG_TAIL_HOURS = 48  # fixed value

# All an earlier observation contributes. Reading no more of it lets the scan
# of the look-back window skip titles, texts and the rest.
HISTORY_COLUMNS = ["id", "ingestion_date", "score", "descendants"]


def engagement_metrics(
    target: DataFrame,
    history: DataFrame,
    date: str,
    order: Sequence[str | Column] = (),
) -> DataFrame:
    """Rows of ``date`` with their development over the observations given.

    Adds ``score_velocity`` and ``comment_velocity`` (change since the previous
    observation, 0 for the first), ``observations_in_window``,
    ``hours_to_peak`` (from ``time`` to midnight of the first day with the
    highest score, never negative) and ``is_long_tail`` (comments still growing
    more than 48 hours after ``time``).

    Where both inputs hold an (id, ingestion_date), ``target`` wins; ``order``
    settles duplicates within one input. After that a window holds at most one
    row per id and day, however hot an id is.
    """
    observations = merge_prefer(history, target, ["id", "ingestion_date"], order)
    for column in ("score", "descendants"):
        number = lenient(F.col(column), T.LongType(), observations.schema[column].dataType)
        observations = observations.withColumn(column, F.coalesce(number, F.lit(0)))

    by_date = Window.partitionBy("id").orderBy("ingestion_date")
    whole = by_date.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def change(column: str) -> Column:
        current = F.col(column)
        return F.coalesce(current - F.lag(current).over(by_date), F.lit(0))

    first_peak = F.min(
        F.struct((-F.col("score")).alias("low_first"), F.col("ingestion_date").alias("day"))
    ).over(whole)

    created = F.col("time").cast("timestamp")
    age = hours_between(midnight(F.col("ingestion_date")), created)
    to_peak = hours_between(midnight(F.col("_peak.day")), created)

    return (
        observations.withColumns(
            {
                "score_velocity": change("score"),
                "comment_velocity": change("descendants"),
                "observations_in_window": F.count(F.lit(1)).over(whole),
                "_peak": first_peak,
            }
        )
        .where(F.col("ingestion_date") == date)
        .withColumns(
            {
                "hours_to_peak": not_below_zero(round_half_even(to_peak, 2)),
                "is_long_tail": F.coalesce(age > LONG_TAIL_HOURS, F.lit(False))
                & (F.col("comment_velocity") > 0),
            }
        )
        .drop("_peak")
    )
