"""What the plans must look like, and what happens when one key is hot."""

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from threadlake.operators import dedup, integrity, quality, topics, tracking
from threadlake.schemas import TRACKING_STATE
from workload import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture
def small_joins(spark):
    """Settings under which a small input behaves like a large one."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def final_plan(df):
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def hot_comments(spark, rows_=60_000):
    """A third of all rows answer one parent; the rest are spread."""
    hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000)
    return spark.range(0, rows_, 1, 8).select(
        "id", hot.alias("parent"), F.repeat(F.lit("x"), 20).alias("text")
    )


def ids(spark, comments, most):
    """Keys as they come from whole tables: aggregated over a shuffle."""
    return integrity.key_set(
        spark.range(0, most).select("id"), comments.where("false").select("id")
    )


@pytest.mark.parametrize("most", [4000, 1000, 0])
@pytest.mark.parametrize(
    "operator",
    [
        integrity.rows_in, integrity.rows_not_in, integrity.rows_with_key,
        integrity.rows_without_key, lambda df, column, keys: integrity.flag_known_parents(df, keys),
    ],
)
def test_hot_parent_is_split_over_tasks(spark, small_joins, operator, most):
    """``most`` decides which of the lists is the shorter one."""
    comments = hot_comments(spark)
    df = operator(comments, "parent", ids(spark, comments, most))
    text = final_plan(df)
    assert "skew=true" in text or "SortMergeJoin" not in text


def test_few_missing_parents_spare_the_rows_a_shuffle(spark):
    comments = hot_comments(spark)
    keys = ids(spark, comments, 4990)
    for df in integrity.split_orphans(keys, comments, keys):
        text = final_plan(df)
        assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


@pytest.mark.parametrize("most", [0, 7, 8, 4000, 6000])
def test_hot_parent_gives_whole_results(spark, small_joins, most):
    comments = hot_comments(spark, 30_000).withColumn(
        "parent", F.when(F.col("id") % 11 != 0, F.col("parent"))
    )
    keys = ids(spark, comments, most)
    expected = comments.where(F.col("parent") < most).count()
    valid, orphans = integrity.split_orphans(keys, comments, keys)
    assert valid.count() == expected
    assert orphans.count() == 30_000 - expected
    assert integrity.rows_in(comments, "parent", keys).count() == expected
    assert integrity.rows_not_in(comments, "parent", keys).count() == 30_000 - expected
    flagged = integrity.flag_known_parents(comments, keys)
    assert flagged.where("has_parent").count() == expected and flagged.count() == 30_000
    counts = integrity.count_unmatched(comments, "parent", keys, "id").first()
    assert counts.unmatched == 30_000 - expected


def test_counting_meets_each_key_once(spark, small_joins):
    text = plan(integrity.count_unmatched(hot_comments(spark), "parent", spark.range(5), "id"))
    below = text[text.index("SortMergeJoin"):]
    assert "HashAggregate(keys=[parent" in below and "partial_count" in below


def test_hot_key_reaches_the_shuffle_once_per_task(spark):
    df = hot_comments(spark).select(F.col("parent").alias("k"), "id")
    kept = dedup.keep_last(df, ["k"], ["id"])
    text = final_plan(kept)
    shuffle = text.index("Exchange hashpartitioning(k")
    assert text.index("Partial", shuffle) > shuffle
    assert kept.count() == df.select("k").distinct().count()


def test_repeated_keys_are_counted_with_a_map_side_combine(spark):
    text = plan(quality.Unique(["parent"]).query(hot_comments(spark)))
    assert text.count("HashAggregate") >= 4 and "partial_count" in text


def test_state_merge_shuffles_once(spark, small_joins):
    state = spark.createDataFrame([(1, "a", "2026-01-01", 1, 1)], TRACKING_STATE)
    metrics = spark.createDataFrame([(1, 1, 1)], "story_id bigint, score bigint, descendants bigint")
    merged = tracking.merge_state(state, metrics, metrics.select("story_id"), "2026-01-02")
    text = plan(merged)
    assert text.count("Exchange") == 1 and "Join" not in text


def test_vocabulary_combines_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, "a title here")], "id int, title string")
    text = plan(topics.fit_vocabulary(df))
    assert "TakeOrderedAndProject" in text and "partial_count" in text
    assert "Cartesian" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - {"threads"}))
def test_no_query_multiplies_rows(spark, name):
    if name.startswith(("job_", "check_", "quality_")):
        pytest.skip("result rows of finished jobs")
    text = plan(queries.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_scans_read_the_needed_columns_only(spark):
    text = plan(queries.QUERIES["engagement"](spark, SF))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in text
    text = plan(queries.QUERIES["new_ids"](spark, SF))
    assert "ReadSchema: struct<conv_id:bigint>" in text
    text = plan(queries.QUERIES["orphan_rows"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,lang:string,source:string,n_chars:bigint>" in text


@pytest.mark.parametrize("partitions", ["1", "13"])
@pytest.mark.parametrize("name", ["engagement", "track_merge", "top_terms", "report_sentiment", "threads"])
def test_results_do_not_depend_on_shuffle_partitions(spark, name, partitions):
    want = rows(queries.QUERIES[name](spark, SF))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert rows(queries.QUERIES[name](spark, SF)) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
