"""Conforming, deduplication and key membership."""

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from threadlake.operators import conform, dedup, integrity
from threadlake.schemas import COMMENT, STORY

RAW_STORY_COLUMNS = (
    "id string, type string, by string, time string, title string, url string, text string, "
    "score string, descendants string, kids array<bigint>, dead string, deleted string"
)


def raw_stories(spark, *changes):
    base = {
        "id": "6021", "type": "story", "by": "orla", "time": "1709251199", "title": "Leap seconds explained",
        "url": "https://clocks.example/leap", "text": None, "score": "31", "descendants": "8",
        "kids": [6030, 6044], "dead": None, "deleted": None,
    }
    data = [{**base, **change} for change in changes or ({},)]
    return spark.createDataFrame(data, RAW_STORY_COLUMNS)


def test_conform_stories(spark):
    df = conform.conform_stories(raw_stories(spark), "2026-02-01")
    assert df.columns == [*STORY.fieldNames(), "ingestion_date"]
    assert [f.dataType for f in df.schema.fields][:-1] == [f.dataType for f in STORY.fields]
    row = df.withColumn("time", F.col("time").cast("string")).first()
    assert (row.id, row.time, row.score, row.descendants, row.kids) == (
        6021, "2024-02-29 23:59:59", 31, 8, [6030, 6044],
    )
    assert row.ingestion_date == "2026-02-01"


def test_conform_settles_bad_values(spark):
    df = conform.conform_stories(
        raw_stories(
            spark, {"id": "invalid"}, {"id": None}, {"id": "1", "score": None, "descendants": "x"},
            {"id": "2", "dead": "true"}, {"id": "3", "time": "never"},
        ),
        "2026-02-01",
    )
    assert rows(df, "id", "score", "descendants", "dead") == [
        (1, 0, 0, None), (2, 31, 8, True), (3, 31, 8, None),
    ]
    assert df.where("id = 3").first().time is None


def test_conform_adds_and_drops_columns(spark):
    df = spark.createDataFrame([("1", "x")], "id string, surplus string")
    typed = conform.conform(df, COMMENT)
    assert typed.columns == COMMENT.fieldNames()
    assert typed.first().parent is None
    assert "surplus" in conform.conform(df, COMMENT, keep=("surplus",)).columns


def test_conform_comments_needs_id_and_parent(spark):
    df = spark.createDataFrame(
        [("201", "100"), ("bad", "100"), ("202", None), ("203", "x")], "id string, parent string"
    )
    assert rows(conform.conform_comments(df, "2026-02-01"), "id", "parent") == [(201, 100)]
    counts = conform.incomplete_counts(conform.conform(df, COMMENT), ["id", "parent"]).first()
    assert counts.asDict() == {"rows": 4, "null_id": 1, "null_parent": 2, "dropped": 3}


DAYS = [(7, "2026-02-01", 12, 1), (7, "2026-02-01", 4, 2), (8, "2026-02-01", 66, 3), (7, "2026-02-02", 9, 4)]
DAY_COLUMNS = "id bigint, ingestion_date string, score bigint, place int"


def test_keep_last(spark):
    df = spark.createDataFrame(DAYS, DAY_COLUMNS)
    kept = dedup.keep_last(df, ["id", "ingestion_date"], ["place"])
    assert rows(kept, "id", "ingestion_date", "score") == [
        (7, "2026-02-01", 4), (7, "2026-02-02", 9), (8, "2026-02-01", 66),
    ]
    assert kept.columns == df.columns


@pytest.mark.parametrize("partitions", [1, 7])
def test_keep_last_does_not_depend_on_partitions(spark, partitions):
    df = spark.range(2000).select(
        (F.col("id") % 13).alias("k"), F.hash("id").alias("o"), "id"
    ).repartition(partitions)
    best = {}
    for row in df.collect():
        best[row.k] = max(best.get(row.k, (-(2**40), 0)), (row.o, row.id))
    got = {row.k: (row.o, row.id) for row in dedup.keep_last(df, ["k"], ["o", "id"]).collect()}
    assert got == best


def test_keep_last_limits_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), "id").repartition(2)
    text = plan(dedup.keep_last(df, ["k"], ["id"]))
    assert text.index("Final") < text.index("hashpartitioning(k") < text.index("Partial")


def test_merge_prefers_the_second(spark):
    new = spark.createDataFrame([(100, 150), (300, 1)], "id bigint, score bigint")
    updated = spark.createDataFrame([(100, 200), (200, 5)], "id bigint, score bigint")
    assert rows(dedup.merge_prefer(new, updated, ["id"])) == [(100, 200), (200, 5), (300, 1)]


def test_merge_aligns_columns_by_name(spark):
    left = spark.createDataFrame([(1, "a")], "id bigint, x string")
    right = spark.createDataFrame([("b", 2)], "y string, id bigint")
    assert rows(dedup.merge_prefer(left, right, ["id"]), "id", "x", "y") == [(1, "a", None), (2, None, "b")]


def comments(spark, pairs):
    return spark.createDataFrame(pairs, "id bigint, parent bigint")


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id bigint")


def test_split_orphans(spark):
    stories = ids(spark, 11, 12)
    valid, orphans = integrity.split_orphans(
        stories, comments(spark, [(40, 12), (41, 5), (42, 40), (43, 6), (44, 5)])
    )
    assert rows(valid, "id") == [(40,), (42,)] and rows(orphans, "id") == [(41,), (43,), (44,)]
    valid, orphans = integrity.split_orphans(stories, comments(spark, [(50, 11), (51, 50), (52, 51)]))
    assert valid.count() == 3 and orphans.count() == 0


def test_split_is_one_pass(spark):
    """A reply to a dropped comment stays."""
    valid, orphans = integrity.split_orphans(ids(spark, 11), comments(spark, [(41, 5), (60, 41)]))
    assert rows(valid) == [(60, 41)] and rows(orphans) == [(41, 5)]


def test_flag_keeps_every_row(spark):
    df = comments(spark, [(1, 100), (2, 888), (3, None), (1, 100)])
    flagged = integrity.flag_known_parents(df, integrity.key_set(ids(spark, 100, 100)))
    assert rows(flagged) == [(1, 100, True), (1, 100, True), (2, 888, False), (3, None, False)]


def test_null_keys(spark):
    df = comments(spark, [(1, 100), (2, None)])
    keys = integrity.key_set(spark.createDataFrame([(100,), (None,)], "id bigint"))
    assert rows(integrity.rows_not_in(df, "parent", keys)) == [(2, None)]
    assert rows(integrity.rows_in(df, "parent", keys)) == [(1, 100)]
    counts = integrity.count_unmatched(df, "parent", keys, "id").first()
    assert counts.asDict() == {"unmatched": 1, "child_rows": 2, "parents": 1}


def test_new_and_active_ids(spark):
    assert rows(integrity.new_ids(ids(spark, 100, 200, 200), ids(spark, 100))) == [(200,)]
    assert rows(integrity.active_rows(ids(spark, 1, 2, 2), ids(spark, 2))) == [(2,), (2,)]


def test_count_unmatched_of_nothing(spark):
    empty = comments(spark, []).where("false")
    counts = integrity.count_unmatched(empty, "parent", ids(spark, 1), "id").first()
    assert counts.asDict() == {"unmatched": 0, "child_rows": 0, "parents": 1}
