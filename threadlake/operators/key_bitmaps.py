"""Membership of dense whole-number keys by bitmaps.

A bitmap holds 32,768 neighbouring ids in 4 KB, however many rows have them, so a
shuffle moves one row per task and bucket of ids instead of every distinct key. That is
less only where ids are dense: ``are_dense`` measures it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

IDS = 32_768  # of a bitmap, fixed by Spark
BYTES = IDS // 8
# A key costs 8 bytes by itself and one bit for each id between the smallest and the largest.
LARGEST_SPREAD = 64


def are_dense(*keys: DataFrame) -> bool:
    """Whether bitmaps of all ``keys`` (one-column frames) are smaller than the keys themselves.

    One pass over the columns. Only whole numbers have bitmaps; without any key there is
    nothing to gain.
    """
    if not all(isinstance(k.schema[0].dataType, T.IntegralType) for k in keys):
        return False
    stacked = _stacked(*keys)
    low, high, distinct = stacked.agg(
        F.min("key"), F.max("key"), F.approx_count_distinct("key")
    ).first()
    return low is not None and high - low < LARGEST_SPREAD * distinct


def _stacked(*keys: DataFrame) -> DataFrame:
    """All keys that are not null as ``key, side``, the number of the frame each comes from."""
    sides = [
        k.select(F.col(k.columns[0]).cast("bigint").alias("key"), F.lit(n).alias("side"))
        for n, k in enumerate(keys)
    ]
    stacked = sides[0]
    for more in sides[1:]:
        stacked = stacked.unionAll(more)
    return stacked.where(F.col("key").isNotNull())


def _byte(bitmap: str, place: Column) -> Column:
    """A byte of a bitmap as a number."""
    digits = F.hex(F.substring(F.col(bitmap), place + 1, F.lit(1)))
    return F.conv(digits, 16, 10).cast("int")


def _bit(byte: str, bit: Column) -> Column:
    return F.getbit(F.col(byte), bit) == 1


def parted(wanted: DataFrame, existing: DataFrame, key: str, known: str) -> DataFrame:
    """Each distinct key of ``wanted`` and whether it is in ``existing``.

    Both sides are grouped to bitmaps in one shuffle, a row a task and bucket of ids, so
    a key of a third of all rows is one bit there.
    """
    position = F.expr("bitmap_bit_position(key)")
    both = (
        _stacked(wanted, existing)
        .groupBy(F.expr("bitmap_bucket_number(key)").alias("bucket"))
        .agg(
            # A null sets no bit.
            F.bitmap_construct_agg(F.when(F.col("side") == 0, position)).alias("wanted"),
            F.bitmap_construct_agg(F.when(F.col("side") == 1, position)).alias("existing"),
        )
    )
    places = F.sequence(F.lit(0), F.lit(BYTES - 1))
    listed = (
        both.where(F.bitmap_count("wanted") > 0)
        .select("bucket", "wanted", "existing", F.explode(places).alias("place"))
        .select(
            "bucket",
            "place",
            _byte("wanted", F.col("place")).alias("ours"),
            _byte("existing", F.col("place")).alias("theirs"),
        )
        .where(F.col("ours") != 0)
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("bit"))
        .where(_bit("ours", F.col("bit")))
    )
    position = F.col("place") * 8 + F.col("bit")
    bucket = F.col("bucket")
    value = F.when(bucket > 0, (bucket - 1) * IDS + position + 1).otherwise(bucket * IDS - position)
    of_key = wanted.schema[0].dataType
    return listed.select(value.cast(of_key).alias(key), _bit("theirs", F.col("bit")).alias(known))
