"""Which stories to follow, and what is known of them, from day to day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlake.functions.casts import lenient, lenient_double
from threadlake.operators.integrity import rows_in

# Fixed values.
NEW_COMMENTS_THAT_COUNT = 5
RECENT_DAYS = 7
MAX_STORIES = 20
TRACKING_DAYS = 7


def has_changed(
    score: Column, descendants: Column, last_score: Column, last_descendants: Column
) -> Column:
    """Another score, or at least five more comments. Missing counts as 0."""

    def known(column: Column) -> Column:
        return F.coalesce(column, F.lit(0))

    return (known(score) != known(last_score)) | (
        known(descendants) - known(last_descendants) >= NEW_COMMENTS_THAT_COUNT
    )


def days_since(date: Column, as_of: str) -> Column:
    return F.datediff(F.to_date(F.lit(as_of)), F.to_date(date, "yyyy-MM-dd"))


def keeps_interest(last_updated: Column, as_of: str, tracking_days: int = TRACKING_DAYS) -> Column:
    """Updated less than ``tracking_days`` ago, or never."""
    unknown = last_updated.isNull() | (last_updated == "")
    return F.when(unknown, True).otherwise(days_since(last_updated, as_of) < tracking_days)


def story_metrics(stories: DataFrame) -> DataFrame:
    """``story_id, score, descendants`` with 0 for what is missing."""
    def number(column: str) -> Column:
        value = lenient(F.col(column), T.LongType(), stories.schema[column].dataType)
        return F.coalesce(value, F.lit(0)).alias(column)

    return stories.select(F.col("id").alias("story_id"), number("score"), number("descendants"))


def tracked_ids(state: DataFrame) -> DataFrame:
    return state.select("story_id")


def merge_state(
    state: DataFrame,
    metrics: DataFrame,
    new_ids: DataFrame,
    as_of: str,
    tracking_days: int = TRACKING_DAYS,
) -> DataFrame:
    """The tracking state after a day.

    A tracked story with metrics is updated when they changed, kept as it is
    while its last change is recent, and dropped otherwise; without metrics it
    is dropped. An id in ``new_ids`` (a one-column frame) that is not in the
    result by then is added.

    The three inputs are stacked and grouped by id, so they are shuffled once
    instead of once per join. Each input should hold an id once.
    """
    (new_id,) = new_ids.columns
    stacked = (
        state.select(
            "story_id", "first_seen", "last_updated", "last_score", "last_descendants",
            F.lit(True).alias("tracked"),
        )
        .unionByName(
            metrics.select("story_id", "score", "descendants", F.lit(True).alias("measured")),
            allowMissingColumns=True,
        )
        .unionByName(
            new_ids.select(F.col(new_id).alias("story_id"), F.lit(True).alias("new")),
            allowMissingColumns=True,
        )
    )
    names = [name for name in stacked.columns if name != "story_id"]
    merged = stacked.groupBy("story_id").agg(*[F.max(name).alias(name) for name in names])

    changed = has_changed(
        F.col("score"), F.col("descendants"), F.col("last_score"), F.col("last_descendants")
    )
    followed = F.coalesce(F.col("tracked") & F.col("measured"), F.lit(False))
    flagged = merged.select(
        "*",
        (followed & changed).alias("_updated"),
        F.when(followed & ~changed, keeps_interest(F.col("last_updated"), as_of, tracking_days))
        .otherwise(False)
        .alias("_same"),
        F.coalesce(F.col("new"), F.lit(False)).alias("_new"),
    ).where("_updated or _same or _new")

    today = F.lit(as_of)
    return flagged.select(
        "story_id",
        F.when(F.col("_updated") | F.col("_same"), F.col("first_seen"))
        .otherwise(today)
        .alias("first_seen"),
        F.when(F.col("_same"), F.col("last_updated")).otherwise(today).alias("last_updated"),
        F.when(F.col("_same"), F.col("last_score"))
        .otherwise(F.coalesce("score", F.lit(0)))
        .alias("last_score"),
        F.when(F.col("_same"), F.col("last_descendants"))
        .otherwise(F.coalesce("descendants", F.lit(0)))
        .alias("last_descendants"),
    )


def epoch_seconds(df: DataFrame, column: str) -> Column:
    """Seconds since the epoch of a timestamp, number or text column; missing is 0."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        seconds = F.unix_micros(F.col(column).cast("timestamp")) / F.lit(1e6)
    else:
        seconds = lenient_double(F.col(column))
    return F.coalesce(seconds, F.lit(0.0))


def discover(
    ranked: DataFrame,
    items: DataFrame,
    as_of: str,
    max_stories: int = MAX_STORIES,
    recent_days: int = RECENT_DAYS,
) -> DataFrame:
    """Stories of the last week among the first ``max_stories`` of a ranking.

    ``ranked`` holds ``rank`` (from 1) and ``id``. All ids whose rank is at most
    ``max_stories`` count, also several of one rank. The limit comes before the
    filter, so fewer may be left. An empty ranking means the source failed.
    """
    if ranked.isEmpty():
        raise RuntimeError("the ranking is empty; the source gave no ids")
    top = ranked.where(F.col("rank") <= max_stories).select(F.col("id").alias("_id"))
    since = F.unix_timestamp(F.to_timestamp(F.lit(as_of))) - recent_days * 86400
    return items.where(
        (F.col("type") == "story") & (epoch_seconds(items, "time") >= since)
    ).join(top, F.col("id") == F.col("_id"), "left_semi")


def tracked_stories(items: DataFrame, state: DataFrame) -> DataFrame:
    """Current items of the stories in the state."""
    return rows_in(items.where(F.col("type") == "story"), "id", tracked_ids(state))
