"""Session construction and the shared folder used to cut lineage."""

from __future__ import annotations

import functools
import json
import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app_name: str = "threadlake", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators rely on.

    Extra settings are given with underscores for dots, e.g.
    ``spark_sql_shuffle_partitions="8"``, or through ``conf_map``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(REQUIRED_CONF)
    settings.update(conf.pop("conf_map", {}))
    settings.update({key.replace("_", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    """Set the run-time settings the operators rely on in a session made elsewhere."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which all executors can reach.

    A machine-local folder is chosen only for a local master (tests), and only
    when the setting is absent.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="threadlake-ck-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir().rstrip("/")


def rows_frame(
    spark: SparkSession, rows: Sequence[Mapping[str, object]], schema: T.StructType
) -> DataFrame:
    """A few rows of the driver's own (results, manifest) as a constant of the plan."""
    array = F.from_json(F.lit(json.dumps(list(rows))), T.ArrayType(schema))
    return spark.range(1).select(F.inline(array))


_RUN: ContextVar[str] = ContextVar("threadlake_run", default="")


def staged_path(spark: SparkSession, label: str) -> str:
    """A new place below the shared folder, and below that of the run, if there is one."""
    return f"{shared_folder(spark)}/staged/{_RUN.get()}{label}-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[None]:
    """What is staged inside goes at the end, also after a failure.

    Nothing that reads staged rows may be used after that.
    """
    name = f"{_RUN.get()}run-{uuid.uuid4().hex}/"
    token = _RUN.set(name)
    try:
        yield
    finally:
        _RUN.reset(token)
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/staged/{name}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def staging_run(job: Callable) -> Callable:
    """A job, whose first argument is the session, in a run folder of its own."""

    @functools.wraps(job)
    def run(spark: SparkSession, *args, **kwargs):
        with run_folder(spark):
            return job(spark, *args, **kwargs)

    return run


def stage(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Write ``df`` once to the shared folder and read it back, with its row count.

    The count is observed on the stage that writes, so it needs no second pass
    and is not inflated when an upstream shuffle stage is run again. Columnar
    files keep column pruning and pushdown for the readers that follow, and a
    lost executor costs a re-read instead of the whole lineage.
    """
    spark = df.sparkSession
    path = staged_path(spark, label)
    seen = Observation(f"staged-{uuid.uuid4().hex}")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen.get["rows"]


def stage_bucketed(df: DataFrame, key: str, label: str, buckets: int) -> tuple[DataFrame, str]:
    """Stage ``df`` hash-bucketed and sorted on ``key``; returns it with its table name.

    Repeated joins on ``key`` then read the buckets in place: only the other
    side is shuffled. Drop the table name when done.
    """
    spark = df.sparkSession
    table = f"threadlake_{label}_{uuid.uuid4().hex}"
    (
        df.repartition(buckets, key)
        .write.bucketBy(buckets, key)
        .sortBy(key)
        .option("path", staged_path(spark, table))
        .format("parquet")
        .saveAsTable(table)
    )
    return spark.table(table), table
