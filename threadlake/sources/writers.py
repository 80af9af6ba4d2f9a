"""Writing daily partitions."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from threadlake.schemas import MANIFEST, PARTITION_COLUMN
from threadlake.session import rows_frame
from threadlake.sources.layout import FORMATS, LAYERS, Lake, require

# Landing files are bounded. A thousand comments, as a single-machine landing
# takes, would leave a large table in far too many files.
RECORDS_PER_FILE = 1_000_000


class NothingToWrite(ValueError):
    """The frame had no rows. What was there before is untouched, unless it was to be replaced."""


def write_partition(
    df: DataFrame,
    lake: Lake,
    layer: str,
    entity: str,
    date: str,
    fmt: str = "parquet",
    extras: Mapping[str, object] | None = None,
    max_records_per_file: int | None = None,
    replace_empty: bool = False,
) -> int:
    """Write one day of a table and return its row count.

    The raw layer appends, since a landing adds to a day. Every other layer
    replaces exactly that day, so a re-run leaves the same rows. The rows are
    counted while they are written, and the count goes to the manifest.

    A frame without rows raises ``NothingToWrite``. With ``replace_empty`` the day is
    emptied first, as a job that is run again for a day must do.
    """
    require(layer, LAYERS, "layer")
    require(fmt, FORMATS, "format")
    seen = Observation(f"written-{uuid.uuid4().hex}")
    rows = df.withColumn(PARTITION_COLUMN, F.lit(date)).observe(
        seen, F.count(F.lit(1)).alias("rows")
    )
    writer = (
        rows.write.mode("append" if layer == "raw" else "overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION_COLUMN)
    )
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if fmt == "csv":
        writer = writer.option("header", True)
    if fmt == "parquet":
        writer = writer.option("compression", "snappy")
    writer.format(fmt).save(lake.table(layer, entity))

    count = seen.get["rows"]
    if not count:
        if replace_empty and layer != "raw":
            folder = f"{lake.table(layer, entity)}/{PARTITION_COLUMN}={date}"
            df.limit(0).coalesce(1).write.mode("overwrite").format(fmt).save(folder)
            record_write(df, lake, layer, entity, date, fmt, 0, extras)
        raise NothingToWrite(f"no rows for {layer}/{entity} of {date}")
    record_write(df, lake, layer, entity, date, fmt, count, extras)
    return count


def record_write(
    df: DataFrame,
    lake: Lake,
    layer: str,
    entity: str,
    date: str,
    fmt: str,
    count: int,
    extras: Mapping[str, object] | None,
) -> None:
    """One manifest row about a write."""
    row = {
        "layer": layer,
        "entity": entity,
        "partition_date": date,
        "format": "jsonl" if fmt == "json" else fmt,
        "compression": "snappy" if fmt == "parquet" else None,
        "record_count": count,
        "column_count": len(df.columns),
        "ingestion_timestamp": datetime.now(UTC).replace(tzinfo=None).isoformat(),
        "extras": {key: str(value) for key, value in (extras or {}).items()},
    }
    rows_frame(df.sparkSession, [row], MANIFEST).coalesce(1).write.mode("append").json(lake.manifest)
