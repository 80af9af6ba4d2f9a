"""The daily reports over enriched stories and comments."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlake.functions.labels import speed_category
from threadlake.functions.text import csv_terms
from threadlake.schemas import OUTPUT_COMMENT, OUTPUT_STORY
from threadlake.sources.layout import Lake
from threadlake.sources.readers import read_table
from threadlake.sources.writers import NothingToWrite, write_partition

log = logging.getLogger(__name__)

TOP_STORIES = 20  # fixed value
TOP_TOPICS = 30  # fixed value


def top_stories_by_score_velocity(stories: DataFrame, limit: int = TOP_STORIES) -> DataFrame:
    """The stories whose score grew most; ties by id."""
    return (
        stories.select(
            "id", "title", "score", "score_velocity", "comment_velocity",
            "hours_to_peak", "is_long_tail", "dominant_topics",
        )
        .orderBy(F.desc("score_velocity"), F.asc("id"))
        .limit(limit)
    )


def engagement_speed(stories: DataFrame) -> DataFrame:
    """Stories by how soon they peaked: count and average score and comments."""
    return (
        stories.groupBy(speed_category(F.col("hours_to_peak")).alias("speed_category"))
        .agg(
            F.count(F.lit(1)).alias("story_count"),
            F.round(F.avg("score"), 1).alias("avg_score"),
            F.round(F.avg("descendants"), 1).alias("avg_comments"),
        )
        .orderBy(F.desc("story_count"), F.asc("speed_category"))
    )


def long_tail_stories(stories: DataFrame) -> DataFrame:
    """Stories that still gain comments after two days, fastest first."""
    return (
        stories.where("is_long_tail")
        .select(
            "id", "title", "score", "descendants", "hours_to_peak",
            "comment_velocity", "observations_in_window",
        )
        .orderBy(F.desc("comment_velocity"), F.asc("id"))
    )


def sentiment_by_story(stories: DataFrame, comments: DataFrame) -> DataFrame:
    """Sentiment of the direct replies of each story that has any.

    Comments are counted per parent before the join, so a parent with much of
    the table reaches the join as one row. The parts are joined as they are,
    should a story id occur more than once, and summed again per id and title.
    """
    scored = F.col("sentiment_score").isNotNull()
    per_parent = (
        comments.where(F.col("parent").isNotNull())
        .groupBy("parent")
        .agg(
            F.count("id").alias("total_comments"),
            F.sum(F.round(F.col("sentiment_score") * 10000.0).cast("bigint")).alias("units"),
            F.count_if(scored).alias("scored"),
            *[
                F.count_if(F.col("sentiment_label") == label).alias(label)
                for label in ("positive", "negative", "neutral")
            ],
        )
    )
    # Sums of whole ten-thousandths: no last digit depends on the order of rows.
    return (
        stories.select("id", "title")
        .join(per_parent, F.col("id") == F.col("parent"))
        .groupBy("id", "title")
        .agg(
            F.sum("total_comments").alias("total_comments"),
            (F.round(F.sum("units") / F.sum("scored")) / F.lit(10000.0)).alias("avg_sentiment"),
            F.sum("positive").alias("positive"),
            F.sum("negative").alias("negative"),
            F.sum("neutral").alias("neutral"),
        )
        .orderBy(F.desc("total_comments"), F.asc("id"))
    )


def topic_trends(stories: DataFrame, limit: int = TOP_TOPICS) -> DataFrame:
    """The most frequent dominant topics with the average score of their stories."""
    return (
        stories.where(F.col("dominant_topics").isNotNull())
        .select(F.explode(csv_terms(F.col("dominant_topics"))).alias("topic"), "score")
        .where(F.col("topic") != "")
        .groupBy("topic")
        .agg(
            F.count(F.lit(1)).alias("frequency"),
            F.round(F.avg("score"), 1).alias("avg_score"),
        )
        .orderBy(F.desc("frequency"), F.asc("topic"))
        .limit(limit)
    )


@dataclass(frozen=True)
class Report:
    name: str
    build: Callable[[DataFrame, DataFrame], DataFrame]


REPORTS = [
    Report(
        "top_stories_by_score_velocity",
        lambda stories, comments: top_stories_by_score_velocity(stories),
    ),
    Report("engagement_speed", lambda stories, comments: engagement_speed(stories)),
    Report("long_tail_stories", lambda stories, comments: long_tail_stories(stories)),
    Report("sentiment_by_story", sentiment_by_story),
    Report("topic_trends", lambda stories, comments: topic_trends(stories)),
]


def run_reports(
    spark: SparkSession, lake: Lake, date: str, reports: list[Report] | None = None
) -> dict[str, int]:
    """Write each report as CSV. An empty one empties its day, and one that fails
    is counted and does not stop the others."""
    stats = {"reports_generated": 0, "reports_empty": 0, "reports_failed": 0}
    for report in REPORTS if reports is None else reports:
        try:
            stories = read_table(spark, lake, "output", "stories", OUTPUT_STORY, date)
            comments = read_table(spark, lake, "output", "comments", OUTPUT_COMMENT, date)
            write_partition(
                report.build(stories, comments), lake, "reports", report.name, date, "csv",
                replace_empty=True,
            )
            stats["reports_generated"] += 1
        except NothingToWrite:
            log.warning("report %s has no rows", report.name)
            stats["reports_empty"] += 1
        except Exception:
            log.exception("report %s failed", report.name)
            stats["reports_failed"] += 1
    return stats
