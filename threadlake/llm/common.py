"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlake.session import run_folder, staged_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str):
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, which cuts its lineage.

    Inside of ``kept`` it goes when that ends; else it is the caller's to clean.
    """
    spark = df.sparkSession
    path = staged_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def kept(spark: SparkSession, label: str, body: Callable[[], DataFrame]) -> DataFrame:
    """What ``body`` returns, written; all that it wrote on the way is deleted.

    Spark deletes the shuffle files of a plan when nothing refers to it any more, so what
    ``body`` held on both sides is let go of here.
    """
    path = staged_path(spark, label)
    with run_folder(spark):
        result = body()
        result.write.parquet(path)
        schema = result.schema
    del result, body
    gc.collect()
    spark._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Arrow batches of at most ``rows`` rows for what runs inside, where rows are large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """For what runs inside, Spark deletes a query's shuffle files as soon as it ends.

    Without that they stay until the driver happens to collect its garbage. A frame that is
    run twice inside is shuffled twice.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def map_columns(
    df: DataFrame, schema: str, body: Callable[[], Callable[[pa.RecordBatch], list]]
) -> DataFrame:
    """Map Arrow batches to the columns of ``schema``.

    ``body`` runs once in each task and returns the function for its batches, so
    that models and caches are made once and die with the task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = body()
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(one(batch), names=names)

    names = [field.split()[0] for field in _fields(schema)]
    return df.mapInArrow(run, schema)


def _fields(schema: str) -> list[str]:
    """The top-level fields of a DDL schema."""
    fields, depth, part = [], 0, ""
    for char in schema:
        depth += (char in "<(") - (char in ">)")
        if char == "," and depth == 0:
            fields.append(part.strip())
            part = ""
        else:
            part += char
    return [*fields, part.strip()]
