import pytest

from helpers import plan, rows
from threadlake.plans import reports

STORIES = (
    "id bigint, title string, score bigint, descendants bigint, score_velocity bigint, "
    "comment_velocity bigint, observations_in_window bigint, hours_to_peak double, "
    "is_long_tail boolean, dominant_topics string"
)


@pytest.fixture
def stories(spark):
    return spark.createDataFrame(
        [
            (1, "a", 10, 4, 5, 1, 2, 3.0, False, "rust,python"),
            (2, "b", 20, 6, 9, 7, 2, 6.0, True, "python, go,"),
            (3, "c", 25, 1, 5, 2, 1, 12.0, True, None),
            (4, "d", 40, 1, None, 0, 1, None, None, "go"),
        ],
        STORIES,
    )


def ordered(df, *columns):
    return [tuple(row) for row in df.select(*(columns or df.columns)).collect()]


def test_top_velocity(stories):
    df = reports.top_stories_by_score_velocity(stories)
    assert ordered(df, "id") == [(2,), (1,), (3,), (4,)]
    assert df.columns == [
        "id", "title", "score", "score_velocity", "comment_velocity", "hours_to_peak",
        "is_long_tail", "dominant_topics",
    ]
    assert ordered(reports.top_stories_by_score_velocity(stories, 1), "id") == [(2,)]
    assert "TakeOrderedAndProject" in plan(df)


def test_engagement_speed(stories):
    assert ordered(reports.engagement_speed(stories)) == [
        ("fast (<=6h)", 2, 15.0, 5.0), ("medium (6-24h)", 1, 25.0, 1.0), ("slow (>24h)", 1, 40.0, 1.0),
    ]


def test_buckets_add_up(stories):
    total = sum(row.story_count for row in reports.engagement_speed(stories).collect())
    assert total == stories.count()


def test_long_tail(stories):
    assert ordered(reports.long_tail_stories(stories), "id", "comment_velocity") == [(2, 7), (3, 2)]


def test_sentiment_by_story(spark, stories):
    comments = spark.createDataFrame(
        [
            (11, 1, 0.5, "positive"), (12, 1, -0.25, "negative"), (13, 1, 0.0, "neutral"),
            (14, 11, 0.9, "positive"), (15, 2, 0.1234, "positive"), (16, 2, 0.1235, "positive"),
            (17, None, 0.1, "positive"),
        ],
        "id bigint, parent bigint, sentiment_score double, sentiment_label string",
    )
    df = reports.sentiment_by_story(stories, comments)
    # direct replies only; 0.12345 rounds away from zero
    assert ordered(df) == [(1, "a", 3, 0.0833, 1, 1, 1), (2, "b", 2, 0.1235, 2, 0, 0)]


def test_comments_are_counted_before_the_join(spark, stories):
    comments = spark.createDataFrame(
        [(11, 1, 0.5, "positive")], "id bigint, parent bigint, sentiment_score double, sentiment_label string"
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(reports.sentiment_by_story(stories, comments))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = text.index("SortMergeJoin")
    assert "partial_count" in text[join:]


def test_topic_trends(stories):
    assert ordered(reports.topic_trends(stories)) == [("go", 2, 30.0), ("python", 2, 15.0), ("rust", 1, 10.0)]
    assert ordered(reports.topic_trends(stories, 1), "topic") == [("go",)]


def test_nothing_to_report(stories):
    nothing = stories.where("false")
    for df in (
        reports.top_stories_by_score_velocity(nothing), reports.engagement_speed(nothing),
        reports.long_tail_stories(nothing), reports.topic_trends(nothing),
    ):
        assert rows(df) == []
