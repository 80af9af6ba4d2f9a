import pytest
from pyspark.sql import functions as F

from helpers import rows
from threadlake.operators import tracking
from threadlake.schemas import TRACKING_STATE

TODAY = "2026-02-10"
METRICS = "story_id bigint, score bigint, descendants bigint"


def merge(spark, state, metrics, new):
    return rows(
        tracking.merge_state(
            spark.createDataFrame(state, TRACKING_STATE),
            spark.createDataFrame(metrics, METRICS),
            spark.createDataFrame([(n,) for n in new], "id bigint"),
            TODAY,
            tracking_days=7,
        )
    )


def entry(id=1, updated="2026-02-09", score=50, descendants=10):
    return (id, "2026-01-30", updated, score, descendants)


def test_new_ids_are_added(spark):
    assert merge(spark, [], [(100, 50, 10), (200, 75, 20)], [100, 200]) == [
        (100, TODAY, TODAY, 50, 10), (200, TODAY, TODAY, 75, 20),
    ]


@pytest.mark.parametrize(
    "state, metrics, new, outcome",
    [
        # changed: updated, first_seen kept
        (entry(updated="2026-01-31"), (1, 75, 10), [], (1, "2026-01-30", TODAY, 75, 10)),
        # five more comments
        (entry(), (1, 50, 15), [], (1, "2026-01-30", TODAY, 50, 15)),
        # unchanged and recent: as it was, also the comments
        (entry(), (1, 50, 14), [], entry()),
        # unchanged for too long
        (entry(updated="2026-01-31"), (1, 50, 10), [], None),
        # seven days is too long, six is not
        (entry(updated="2026-02-03"), (1, 50, 10), [], None),
        (entry(updated="2026-02-04"), (1, 50, 10), [], entry(updated="2026-02-04")),
        # never updated: kept
        (entry(updated=None), (1, 50, 10), [], entry(updated=None)),
        (entry(updated=""), (1, 50, 10), [], entry(updated="")),
        # dropped, but new again
        (entry(updated="2026-01-31"), (1, 50, 10), [1], (1, TODAY, TODAY, 50, 10)),
        # no metrics
        (entry(), None, [], None),
        (entry(), None, [1], (1, TODAY, TODAY, 0, 0)),
        # kept and new: stays as it is
        (entry(), (1, 50, 10), [1], entry()),
        # metrics only
        (None, (1, 50, 10), [], None),
    ],
)
def test_decisions(spark, state, metrics, new, outcome):
    got = merge(spark, [state] if state else [], [metrics] if metrics else [], new)
    assert got == ([outcome] if outcome else [])


def test_change_of_missing_values(spark):
    df = spark.createDataFrame(
        [(1, None, None, None, None), (2, 1, None, None, None), (3, None, 5, None, None), (4, 5, 3, 5, 9)],
        "id int, score bigint, descendants bigint, last_score bigint, last_descendants bigint",
    )
    changed = tracking.has_changed(*[F.col(c) for c in df.columns[1:]])
    assert rows(df.select("id", changed)) == [(1, False), (2, True), (3, True), (4, False)]


ITEMS = "id bigint, type string, time string"


def test_discover(spark):
    now, old = "1770681600", "1769817600"  # 2026-02-10 and 2026-01-31
    items = spark.createDataFrame(
        [(1, "story", now), (2, "story", old), (3, "story", now), (4, "comment", now), (5, "story", None), (9, "story", now)],
        ITEMS,
    )
    ranked = spark.createDataFrame([(r, r) for r in range(1, 7)] + [(7, 9)], "rank int, id bigint")
    assert rows(tracking.discover(ranked, items, TODAY, 6), "id") == [(1,), (3,)]
    # the limit comes first
    assert rows(tracking.discover(ranked, items, TODAY, 2), "id") == [(1,)]
    with pytest.raises(RuntimeError):
        tracking.discover(ranked.where("false"), items, TODAY)


def test_discover_takes_timestamps_and_the_edge(spark):
    items = spark.createDataFrame(
        [(1, "story", "2026-02-03 00:00:00"), (2, "story", "2026-02-02 23:59:59")], ITEMS
    ).withColumn("time", F.col("time").cast("timestamp"))
    ranked = spark.createDataFrame([(1, 1), (2, 2)], "rank int, id bigint")
    assert rows(tracking.discover(ranked, items, TODAY), "id") == [(1,)]


def test_metrics_and_tracked_stories(spark):
    items = spark.createDataFrame(
        [("1", "story", "5", None), ("2", "comment", "5", "1"), ("3", "story", "x", "2")],
        "id string, type string, score string, descendants string",
    ).withColumn("id", F.col("id").cast("bigint"))
    assert rows(tracking.story_metrics(items)) == [(1, 5, 0), (2, 5, 1), (3, 0, 2)]
    state = spark.createDataFrame([entry(1), entry(2)], TRACKING_STATE)
    assert rows(tracking.tracked_stories(items, state), "id") == [(1,)]
    assert rows(tracking.tracked_ids(state)) == [(1,), (2,)]
