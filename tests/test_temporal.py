import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from threadlake.operators.temporal import engagement_metrics

COLUMNS = "id bigint, title string, score string, descendants string, time timestamp, ingestion_date string"
DAY = "2026-02-07"


def observed(spark, *data):
    """(id, time, ingestion_date, score, descendants)"""
    df = spark.createDataFrame(
        [(i, f"t{i}", s, d, t, day) for i, t, day, s, d in data],
        COLUMNS.replace("time timestamp", "time string"),
    )
    return df.withColumn("time", F.col("time").cast("timestamp"))


def measure(spark, target, history=()):
    empty = observed(spark, (0, None, "x", None, None)).where("false")
    return engagement_metrics(
        observed(spark, *target), observed(spark, *history) if history else empty, DAY
    )


def one(df, id):
    return df.where(F.col("id") == id).first()


BORN = "2026-02-05 10:00:00"


def test_development_over_the_window(spark):
    df = measure(
        spark,
        [(100, BORN, DAY, "150", "45"), (200, "2026-02-06 08:00:00", DAY, "80", "20")],
        [(100, BORN, "2026-02-05", "50", "10"), (100, BORN, "2026-02-06", "100", "30")],
    )
    assert df.count() == 2
    row = one(df, 100)
    assert (row.score_velocity, row.comment_velocity, row.observations_in_window) == (50, 15, 3)
    assert row.hours_to_peak == 38.0 and row.is_long_tail is False
    row = one(df, 200)
    assert (row.score_velocity, row.comment_velocity, row.observations_in_window) == (0, 0, 1)
    assert row.hours_to_peak == 16.0


def test_long_tail(spark):
    before = "2026-02-06"
    df = measure(
        spark,
        [
            (500, "2026-02-04 08:00:00", DAY, "1", "60"),
            (600, "2026-02-04 08:00:00", DAY, "1", "50"),
            (700, "2026-02-06 20:00:00", DAY, "1", "30"),
            (800, None, DAY, "1", "30"),
        ],
        [
            (500, "2026-02-04 08:00:00", before, "1", "50"),
            (600, "2026-02-04 08:00:00", before, "1", "50"),
            (700, "2026-02-06 20:00:00", before, "1", "10"),
            (800, None, before, "1", "10"),
        ],
    )
    assert rows(df, "id", "is_long_tail") == [(500, True), (600, False), (700, False), (800, False)]
    assert one(df, 800).hours_to_peak is None


def test_exactly_two_days_is_not_long_tail(spark):
    df = measure(
        spark, [(1, "2026-02-05 00:00:00", DAY, "1", "9")], [(1, "2026-02-05 00:00:00", "2026-02-06", "1", "1")]
    )
    assert one(df, 1).is_long_tail is False


def test_target_wins_over_history_of_the_same_day(spark):
    df = measure(spark, [(800, BORN, DAY, "100", "1")], [(800, BORN, DAY, "90", "1")])
    assert rows(df, "score", "observations_in_window") == [(100, 1)]


def test_history_only_rows_of_the_day_are_kept(spark):
    df = measure(spark, [(1, BORN, DAY, "5", "1")], [(2, BORN, DAY, "7", "1")])
    assert rows(df, "id", "score") == [(1, 5), (2, 7)]


def test_bad_numbers_count_as_zero(spark):
    df = measure(spark, [(1, BORN, DAY, "invalid", None)])
    assert rows(df, "score", "descendants", "score_velocity") == [(0, 0, 0)]


def test_first_of_equal_peaks_and_clip_at_zero(spark):
    history = [(1, BORN, "2026-02-06", "50", "1"), (2, "2026-02-06 09:00:00", "2026-02-06", "9", "1")]
    df = measure(spark, [(1, BORN, DAY, "50", "1"), (2, "2026-02-06 09:00:00", DAY, "3", "1")], history)
    assert one(df, 1).hours_to_peak == 14.0  # midnight of the 6th, not the 7th
    assert one(df, 2).hours_to_peak == 0.0  # peaked on its first day
    assert one(df, 2).score_velocity == -6


def test_previous_observation_may_be_days_back(spark):
    df = measure(spark, [(1, BORN, DAY, "50", "9")], [(1, BORN, "2026-02-01", "20", "4")])
    assert rows(df, "score_velocity", "comment_velocity") == [(30, 5)]


def test_history_needs_four_columns_only(spark):
    history = observed(spark, (1, BORN, "2026-02-06", "1", "1")).select(
        "id", "ingestion_date", "score", "descendants"
    )
    df = engagement_metrics(observed(spark, (1, BORN, DAY, "4", "1")), history, DAY)
    assert rows(df, "title", "score_velocity") == [("t1", 3)]


@pytest.mark.parametrize("partitions", [1, 5])
def test_same_result_under_any_partitioning(spark, partitions):
    data = [
        (i % 40, BORN, f"2026-02-0{1 + (i * 7) % 7}", str((i * 37) % 101), str((i * 11) % 17))
        for i in range(400)
    ]
    data = list({(d[0], d[2]): d for d in data}.values())
    target = [d for d in data if d[2] == DAY]
    history = [d for d in data if d[2] != DAY]
    base = rows(measure(spark, target, history))
    again = engagement_metrics(
        observed(spark, *target).repartition(partitions), observed(spark, *history).repartition(partitions), DAY
    )
    assert rows(again) == base


def test_windows_share_one_exchange_per_key(spark):
    df = measure(spark, [(1, BORN, DAY, "4", "1")], [(1, BORN, "2026-02-06", "1", "1")])
    text = plan(df)
    assert "Cartesian" not in text and "NestedLoop" not in text
    # one for the row per id and day, one for the windows by id
    assert text.count("Exchange hashpartitioning") == 2
    assert text.count("Window [lag") == 1
