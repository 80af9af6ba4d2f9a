"""Reading daily partitions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date as Date
from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlake.schemas import PARTITION_COLUMN, with_partition
from threadlake.session import stage
from threadlake.sources.layout import READABLE_LAYERS, Lake, require

ARRIVAL = "_arrival"
_CORRUPT = "_corrupt_record"
_FILE = "_file"


def days_before(date: str, days: int) -> list[str]:
    """The ``days`` dates before ``date``, oldest first."""
    day = Date.fromisoformat(date)
    return [(day - timedelta(days=back)).isoformat() for back in range(days, 0, -1)]


def _load(
    spark: SparkSession,
    lake: Lake,
    layer: str,
    entity: str,
    dates: Sequence[str] | None,
    schema: T.StructType,
    fmt: str,
    columns: Sequence[str],
    past_damage: bool = False,
) -> DataFrame:
    """Only the folders of ``dates`` are listed; dates without one are skipped."""
    require(layer, READABLE_LAYERS, "layer")
    require(fmt, ("json", "parquet"), "format")
    base = lake.table(layer, entity)
    wanted = with_partition(
        T.StructType([f for f in schema.fields if f.name != PARTITION_COLUMN])
    )
    reader = (
        spark.read.schema(wanted)
        .option("basePath", base)
        .option("pathGlobFilter", f"*.{fmt}")
    )
    if fmt == "json":
        corrupt = T.StructField(_CORRUPT, T.StringType())
        reader = reader.schema(T.StructType([*wanted.fields, corrupt])).option(
            "columnNameOfCorruptRecord", _CORRUPT
        )
    elif past_damage:
        reader = reader.option("ignoreCorruptFiles", "true")
    path = base if dates is None else f"{base}/{PARTITION_COLUMN}={{{','.join(dates)}}}"
    try:
        return reader.format(fmt).load(path).select("*", *columns)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        empty = spark.createDataFrame([], reader_schema(wanted, fmt))
        return empty.select("*", *[F.lit(None).cast("string").alias(_FILE)] * bool(columns))


def reader_schema(schema: T.StructType, fmt: str) -> T.StructType:
    if fmt != "json":
        return schema
    return T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])


def _readable(df: DataFrame) -> Column:
    """Always true, and reads a column besides the one for bad lines.

    Spark refuses to scan JSON for the bad-line column alone, as a count would.
    """
    first = F.col(df.columns[0]).cast("string")
    return F.length(F.concat(F.coalesce(first, F.lit("")), F.lit("."))) > 0


def _json_rows(df: DataFrame, bad: str) -> DataFrame:
    """Rows that parsed. ``bad="file"`` also drops the other rows of a file with a bad line."""
    readable = _readable(df)
    good = df.where(F.col(_CORRUPT).isNull() & readable)
    if bad == "row":
        return good.drop(_CORRUPT)
    files = df.where(F.col(_CORRUPT).isNotNull() & readable).select(_FILE).distinct()
    # Staged, so that its size is known: few bad files are broadcast, many are not.
    staged, _ = stage(files, "bad-files")
    return good.join(staged, _FILE, "left_anti").drop(_CORRUPT)


def _whole_files(df: DataFrame) -> DataFrame:
    """Rows of the Parquet files that can be read from end to end.

    Read past damage, a file gives the rows before it. So all columns are decoded
    once, and a file stays if that gave as many rows as its footer tells.
    """
    columns = [c for c in df.columns if c != _FILE]
    # The largest hash is there so that every column is decoded; a count alone reads none.
    decoded = df.groupBy(_FILE).agg(
        F.count(F.lit(1)).alias("decoded"), F.max(F.xxhash64(*columns)).alias("_hash")
    ).where("_hash IS NOT NULL")
    told = df.groupBy(_FILE).agg(F.count(F.lit(1)).alias("told"))
    whole = decoded.join(told, _FILE).where("decoded = told").select(_FILE)
    staged, _ = stage(whole, "whole-files")
    return df.join(staged, _FILE, "left_semi")


def read_lines(
    spark: SparkSession, lake: Lake, layer: str, entity: str, date: str, schema: T.StructType
) -> DataFrame:
    """All JSON lines of a day, with ``bad_line`` (null where it parsed) and ``file``."""
    columns = [F.col("_metadata.file_path").alias(_FILE)]
    df = _load(spark, lake, layer, entity, [date], schema, "json", columns)
    return df.where(_readable(df)).withColumnsRenamed({_CORRUPT: "bad_line", _FILE: "file"})


def read_partition(
    spark: SparkSession,
    lake: Lake,
    layer: str,
    entity: str,
    date: str,
    schema: T.StructType,
    fmt: str = "json",
    bad: str = "row",
    with_arrival: bool = False,
) -> DataFrame:
    """One day of a table; no rows when there is no such day.

    Files of another format in the folder are passed over. A JSON line that
    does not parse is dropped (``bad="row"``) or takes its file with it
    (``bad="file"``). A damaged Parquet file is an error, or with ``bad="file"`` left out
    as a whole, never read in part.

    ``with_arrival`` adds ``_arrival``, which orders rows by file time, file
    name and place in the file, for "the last one wins".
    """
    require(bad, ("row", "file"), "bad")
    columns = []
    if bad == "file" or (fmt == "json" and with_arrival):
        columns = [F.col("_metadata.file_path").alias(_FILE)]
    if with_arrival:
        columns.append(
            F.struct(
                F.col("_metadata.file_modification_time").alias("written"),
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("row"),
            ).alias(ARRIVAL)
        )
    df = _load(spark, lake, layer, entity, [date], schema, fmt, columns, bad == "file")
    if fmt == "parquet" and bad == "file":
        df = _whole_files(df)
    if with_arrival and ARRIVAL not in df.columns:
        df = df.withColumn(ARRIVAL, F.lit(None).cast("string"))
    if fmt == "json":
        df = _json_rows(df, bad)
    return df.drop(_FILE)


def read_dates(
    spark: SparkSession,
    lake: Lake,
    layer: str,
    entity: str,
    dates: Sequence[str],
    schema: T.StructType,
    fmt: str = "parquet",
) -> DataFrame:
    """Several days in one scan; days that do not exist add nothing."""
    df = _load(spark, lake, layer, entity, list(dates), schema, fmt, [])
    return _json_rows(df, "row") if fmt == "json" else df


def read_window(
    spark: SparkSession, lake: Lake, entity: str, date: str, days: int, schema: T.StructType
) -> DataFrame:
    """The processed rows of the ``days`` days before ``date``."""
    return read_dates(spark, lake, "processed", entity, days_before(date, days), schema)


def read_table(
    spark: SparkSession,
    lake: Lake,
    layer: str,
    entity: str,
    schema: T.StructType,
    date: str | None = None,
) -> DataFrame:
    """A Parquet table, all days or one."""
    dates = None if date is None else [date]
    return _load(spark, lake, layer, entity, dates, schema, "parquet", [])


def spread(df: DataFrame) -> DataFrame:
    """``df``, as read from files, over at least as many tasks as there are cores.

    A row group is the least a task can read, so a few large ones leave most
    cores idle in work that is dear per row, as on texts. A table of many files
    has more splits than cores and is left as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() > cores else df.repartition(2 * cores)


def register_views(
    spark: SparkSession, lake: Lake, layer: str, schemas: dict[str, T.StructType], date: str | None = None
) -> None:
    """Temporary views for SQL, named like the entities."""
    for entity, schema in schemas.items():
        read_table(spark, lake, layer, entity, schema, date).createOrReplaceTempView(entity)
