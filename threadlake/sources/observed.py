"""The state of recent observations: a table a day, trusted day by day.

A log row names what each day's table was made from: for every day in it the time
of the write that was read, as the manifest tells it. A day that has been written
again since, that no write is known of, or that the state does not hold is read from
the processed rows instead; so a re-run of an earlier day, a gap or a lost state change
what is read and never the result.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import UTC, datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlake.schemas import MANIFEST, OBSERVED_LOG, OBSERVED_STATE
from threadlake.session import rows_frame
from threadlake.sources.layout import Lake
from threadlake.sources.readers import days_before


def _log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_times(
    spark: SparkSession, lake: Lake, layer: str, entity: str, dates: Sequence[str]
) -> dict[str, str]:
    """The time of each day's last recorded write; days without a record are left out."""
    written = _log(spark, lake.manifest, MANIFEST).where(
        (F.col("layer") == layer) & (F.col("entity") == entity) & F.col("partition_date").isin(list(dates))
    )
    last = written.groupBy("partition_date").agg(F.max("ingestion_timestamp").alias("at"))
    return {row["partition_date"]: row["at"] for row in last.collect()}


def load_observed(
    spark: SparkSession, lake: Lake, date: str, days: int, times: Mapping[str, str]
) -> tuple[DataFrame | None, list[str], list[str]]:
    """The state to start ``date`` from, its days that still hold, and the days to read.

    The latest state before ``date`` is taken, so a re-run starts where the first
    run did. A state whose files are missing or cannot be opened, or hold another
    number of rows than the log tells, is not used.
    """
    window = days_before(date, days)
    earlier = _log(spark, lake.observed_log, OBSERVED_LOG).where(F.col("as_of") < date)
    latest = earlier.orderBy(F.desc("as_of"), F.desc("saved_at")).first()
    if latest is None:
        return None, [], window
    held = [d for d in window if d in times and (latest["made_from"] or {}).get(d) == times[d]]
    if not held:
        return None, [], window
    try:
        state = spark.read.schema(OBSERVED_STATE).parquet(f"{lake.observed}/as_of={latest['as_of']}")
        whole = state.count() == latest["ids"]  # reads footers only
    except (PySparkException, Py4JJavaError):
        whole = False
    if not whole:
        return None, [], window
    return state, held, [d for d in window if d not in held]


def save_observed(
    state: DataFrame, lake: Lake, as_of: str, days: int, times: Mapping[str, str]
) -> int:
    """The state after ``as_of``, replaced on a re-run; its number of ids.

    ``times`` are the write times taken before the rows were read.
    """
    needed = {*days_before(as_of, days)[1:], as_of}
    seen = Observation(f"observed-{uuid.uuid4().hex}")
    rows = state.observe(seen, F.count(F.lit(1)).alias("rows"))
    rows.write.mode("overwrite").parquet(f"{lake.observed}/as_of={as_of}")
    row = {
        "as_of": as_of,
        "made_from": {d: at for d, at in times.items() if d in needed},
        "ids": seen.get["rows"],
        "saved_at": datetime.now(UTC).replace(tzinfo=None).isoformat(timespec="microseconds"),
    }
    rows_frame(state.sparkSession, [row], OBSERVED_LOG).coalesce(1).write.mode("append").json(
        lake.observed_log
    )
    return row["ids"]
