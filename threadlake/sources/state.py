"""The tracking state: one snapshot per day, never overwritten while read."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlake.schemas import TRACKING_STATE
from threadlake.session import rows_frame
from threadlake.sources.layout import Lake

SAVED = T.StructType(
    [
        T.StructField("as_of", T.StringType()),
        T.StructField("stories", T.LongType()),
        T.StructField("saved_at", T.StringType()),
    ]
)


def saved_states(spark: SparkSession, lake: Lake) -> DataFrame:
    """``as_of, stories, saved_at`` of every save; a day saved twice has two rows."""
    try:
        return spark.read.schema(SAVED).json(lake.tracking_log)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SAVED)


def snapshot_dates(spark: SparkSession, lake: Lake) -> list[str]:
    """The days that have a snapshot, also an empty one."""
    days = saved_states(spark, lake).select("as_of").distinct().orderBy("as_of")
    return [row["as_of"] for row in days.collect()]


def load_state(spark: SparkSession, lake: Lake, before: str) -> DataFrame:
    """The latest snapshot of a day before ``before``; empty if there is none.

    A day's own snapshot is left out, so a re-run starts where the first run
    did. A snapshot that cannot be read is an error, not an empty state.
    """
    earlier = saved_states(spark, lake).where(F.col("as_of") < before)
    day = earlier.agg(F.max("as_of")).first()[0]
    if day is None:
        return spark.createDataFrame([], TRACKING_STATE)
    return read_snapshot(spark, lake, day)


def read_snapshot(spark: SparkSession, lake: Lake, as_of: str) -> DataFrame:
    """The snapshot of exactly this day."""
    return spark.read.schema(TRACKING_STATE).parquet(f"{lake.tracking}/as_of={as_of}")


def save_state(state: DataFrame, lake: Lake, as_of: str) -> int:
    """The snapshot of one day, replaced on a re-run, also by an empty one; its count.

    The log names the day after its rows are written, so a save that broke off
    is not taken for a state.
    """
    seen = Observation(f"state-{uuid.uuid4().hex}")
    rows = state.observe(seen, F.count(F.lit(1)).alias("rows"))
    rows.write.mode("overwrite").parquet(f"{lake.tracking}/as_of={as_of}")
    count = seen.get["rows"]
    now = datetime.now(UTC).replace(tzinfo=None).isoformat()
    row = {"as_of": as_of, "stories": count, "saved_at": now}
    rows_frame(state.sparkSession, [row], SAVED).coalesce(1).write.mode("append").json(lake.tracking_log)
    return count
