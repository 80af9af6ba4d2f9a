"""Bring loosely typed items to a fixed schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlake.functions.casts import lenient
from threadlake.schemas import COMMENT, PARTITION_COLUMN, STORY


def conform(
    df: DataFrame,
    schema: T.StructType,
    defaults: Mapping[str, object] | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Exactly the columns of ``schema``, in its order and types.

    Absent columns are added as null and others dropped, except those named in
    ``keep``. Values that do not fit the type become null, or the default.
    """
    defaults = defaults or {}
    present = {field.name: field.dataType for field in df.schema.fields}

    def settle(field: T.StructField) -> Column:
        if field.name in present:
            value = lenient(F.col(field.name), field.dataType, present[field.name])
        else:
            value = F.lit(None).cast(field.dataType)
        if field.name in defaults:
            value = F.coalesce(value, F.lit(defaults[field.name]).cast(field.dataType))
        return value.alias(field.name)

    return df.select(*[settle(field) for field in schema.fields], *keep)


def drop_incomplete(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key columns are all present."""
    return df.dropna(subset=keys)


def incomplete_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: all rows, rows lacking each key, and rows lacking any."""
    lacking = [F.col(key).isNull() for key in keys]
    any_lacking = lacking[0]
    for condition in lacking[1:]:
        any_lacking = any_lacking | condition
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(key).isNull()).alias(f"null_{key}") for key in keys],
        F.count_if(any_lacking).alias("dropped"),
    )


def add_ingestion_date(df: DataFrame, date: str) -> DataFrame:
    return df.withColumn(PARTITION_COLUMN, F.lit(date))


STORY_KEYS = ["id"]
COMMENT_KEYS = ["id", "parent"]
STORY_DEFAULTS = {"score": 0, "descendants": 0}


def conform_stories(df: DataFrame, date: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed stories of one day; those without a usable id are dropped."""
    typed = conform(df, STORY, STORY_DEFAULTS, keep)
    return add_ingestion_date(drop_incomplete(typed, STORY_KEYS), date)


def conform_comments(df: DataFrame, date: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed comments of one day; those without a usable id or parent are dropped."""
    typed = conform(df, COMMENT, keep=keep)
    return add_ingestion_date(drop_incomplete(typed, COMMENT_KEYS), date)
