"""Dense keys meet as bitmaps, others as lists, with the same result."""

import pytest
from pyspark.sql import functions as F

from threadlake.operators import integrity, key_bitmaps


def both_ways(spark, wanted, existing, kind="bigint"):
    ours = spark.createDataFrame([(k,) for k in wanted], f"parent {kind}")
    keys = spark.createDataFrame([(k,) for k in existing], f"id {kind}")
    rows = key_bitmaps.parted(ours, keys, "k", "known")
    assert rows.schema["k"].dataType == ours.schema["parent"].dataType
    return sorted(map(tuple, rows.collect()))


@pytest.mark.parametrize("kind", ["bigint", "int", "smallint"])
def test_bits_at_all_edges(spark, kind):
    most = 32_767 if kind == "smallint" else 98_305
    wanted = [*range(-20, 20), 7, 7, None, -32_767, 32_767, most, most - 1]
    if kind != "smallint":
        wanted += [-32_769, -65_536, -65_537, 32_768, 32_769, 65_535, 65_536, 65_537]
    existing = [k for k in wanted if k is None or k % 3] + [100, None, -7]
    want = sorted({(k, k in existing) for k in wanted if k is not None})
    assert both_ways(spark, wanted, existing, kind) == want


def test_no_keys(spark):
    assert both_ways(spark, [], [1]) == both_ways(spark, [None], [None]) == []
    assert both_ways(spark, [1], []) == [(1, False)]


def test_density_decides(spark):
    dense = spark.range(1000)
    assert key_bitmaps.are_dense(dense, dense)
    assert not key_bitmaps.are_dense(dense.selectExpr("id * 1000"), dense)
    ends = spark.createDataFrame([(-(2**63),), (2**63 - 1,)], "id bigint")
    assert not key_bitmaps.are_dense(dense, ends)
    assert not key_bitmaps.are_dense(dense.selectExpr("string(id)"), dense)
    assert not key_bitmaps.are_dense(dense.limit(0), dense.limit(0))


@pytest.mark.parametrize("stretch", [1, 1000])
def test_membership_is_the_same_either_way(spark, stretch):
    rows = spark.range(0, 60_000, 1, 8).select(
        "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("at")
    ).select("id", F.when(F.col("id") % 11 != 0, F.col("at") * stretch).alias("parent"))
    keys = spark.range(2500).selectExpr(f"id * {stretch} AS id")
    assert key_bitmaps.are_dense(rows.select("parent"), keys) == (stretch == 1)
    found = integrity.membership(rows, "parent", keys)
    assert (found.known_count, found.unknown_count) == (2500, 2500)
    assert {r[0] for r in found.known.collect()} == {n * stretch for n in range(2500)}
    assert {r[0] for r in found.unknown.collect()} == {n * stretch for n in range(2500, 5000)}


def test_one_shuffle_of_bitmaps(spark):
    rows = spark.range(0, 300_000, 1, 8)
    rows = rows.select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("parent"))
    found = key_bitmaps.parted(rows.select("parent"), spark.range(200_000), "k", "known")
    text = found._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(") == text.count("Exchange") == 1
    assert "Join" not in text and "partial_bitmap_construct_agg" in text
    counts = found.groupBy("known").count().orderBy("known").collect()
    assert list(map(tuple, counts)) == [(False, 66_667), (True, 133_333)]
