"""The daily jobs: ingest, process, transform, report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlake.functions.casts import lenient_long
from threadlake.operators import quality, tracking
from threadlake.operators.conform import (
    COMMENT_KEYS,
    STORY_KEYS,
    conform,
    conform_comments,
    conform_stories,
)
from threadlake.operators.dedup import keep_last, merge_prefer
from threadlake.operators.integrity import (
    active_rows,
    key_set,
    new_ids,
    rows_with_key,
    rows_without_key,
)
from threadlake.operators.observations import (
    engagement_of,
    merge_observations,
    past_count,
    state_of,
)
from threadlake.operators.sentiment import SentimentRules, add_sentiment
from threadlake.operators.temporal import HISTORY_COLUMNS
from threadlake.operators.threads import MAX_DEPTH, expand_threads
from threadlake.operators.topics import MAX_FEATURES, TOP_N, stage_top_terms
from threadlake.plans.reports import run_reports
from threadlake.schemas import (
    COMMENT,
    OUTPUT_COMMENT,
    OUTPUT_STORY,
    PARTITION_COLUMN,
    PROCESSED_COMMENT,
    PROCESSED_STORY,
    RANKED_IDS,
    RAW_COMMENT,
    RAW_ITEM,
    RAW_STORY,
    STORY,
)
from threadlake.session import rows_frame, stage, staging_run
from threadlake.sources.layout import Lake
from threadlake.sources.observed import load_observed, save_observed, write_times
from threadlake.sources.readers import (
    ARRIVAL,
    days_before,
    read_dates,
    read_lines,
    read_partition,
)
from threadlake.sources.state import load_state, read_snapshot, save_state
from threadlake.sources.writers import RECORDS_PER_FILE, NothingToWrite, write_partition

ROW_KEY = ["id", PARTITION_COLUMN]
TOPICS = "dominant_topics"


@dataclass(frozen=True)
class JobConfig:
    window_days: int = 7
    top_n_topics: int = TOP_N
    max_features: int = MAX_FEATURES
    stop_words: Sequence[str] | None = None
    lexicon: Mapping[str, float] | None = None
    sentiment_rules: SentimentRules = field(default_factory=SentimentRules)
    max_stories: int = tracking.MAX_STORIES
    tracking_days: int = tracking.TRACKING_DAYS
    recent_days: int = tracking.RECENT_DAYS
    max_depth: int = MAX_DEPTH
    max_records_per_file: int | None = RECORDS_PER_FILE
    bad_input: str = "row"
    cascade_orphans: bool = False


def _now() -> str:
    return datetime.now(UTC).replace(tzinfo=None).isoformat()


def _check(
    df: DataFrame, specs: list, lake: Lake, layer: str, entity: str, date: str
) -> list[quality.CheckResult]:
    """Run a suite, save its report, then stop the day if a critical check failed."""
    results = quality.run_suite(df, specs)
    checks = quality.check_table(df.sparkSession, results)
    report = quality.build_report(checks, date, _now())
    write_partition(
        report, lake, layer, f"quality_reports_{entity}", date, "json",
        extras={"report_type": "quality", "entity": entity},
    )
    quality.gate(results, f"{layer}/{entity} of {date}")
    return results


def _publish(df: DataFrame, lake: Lake, layer: str, entity: str, date: str, source: str) -> int:
    try:
        return write_partition(
            df.drop(PARTITION_COLUMN), lake, layer, entity, date, "parquet",
            extras={"entity_type": entity, "source_layer": source}, replace_empty=True,
        )
    except NothingToWrite:
        return 0


# Ingest.


@staging_run
def ingest_day(
    spark: SparkSession,
    lake: Lake,
    date: str,
    items: DataFrame,
    ranked: DataFrame,
    config: JobConfig = JobConfig(),
) -> dict[str, int]:
    """Land the day's stories and comments and carry the tracking state on.

    ``items`` are the items of the source as of the day, one row per id, and
    ``ranked`` its ranking. Tracked stories are taken again whatever their rank.
    """
    state = load_state(spark, lake, before=date)
    updated, updated_count = stage(tracking.tracked_stories(items, state), "tracked")
    discovered, _ = stage(
        tracking.discover(ranked, items, date, config.max_stories, config.recent_days),
        "discovered",
    )
    merged, total = stage(merge_prefer(discovered, updated, ["id"]), "landing")
    fresh, fresh_count = stage(
        new_ids(discovered.select("id"), tracking.tracked_ids(state)), "fresh"
    )
    following = tracking.merge_state(
        state, tracking.story_metrics(merged), fresh, date, config.tracking_days
    )
    active_count = save_state(following, lake, date)
    following = read_snapshot(spark, lake, date)

    if total:
        write_partition(
            merged.select(*RAW_STORY.fieldNames()), lake, "raw", "stories", date, "json",
            extras={"entity_type": "story"},
        )
    active = active_rows(merged, tracking.tracked_ids(following))
    comments = expand_threads(active, items, config.max_depth)
    try:
        comment_count = write_partition(
            comments.select(*RAW_COMMENT.fieldNames()), lake, "raw", "comments", date, "json",
            extras={"entity_type": "comment"},
            max_records_per_file=config.max_records_per_file,
        )
    except NothingToWrite:
        comment_count = 0
    return {
        "total_stories": total,
        "new_stories": fresh_count,
        "updated_stories": updated_count,
        "total_comments": comment_count,
        "active_tracked_stories": active_count,
    }


def read_source(
    spark: SparkSession, lake: Lake, date: str, config: JobConfig = JobConfig()
) -> tuple[DataFrame, DataFrame]:
    """The landed ``raw/items`` and ``raw/ranked_ids`` of a day, as ``ingest_day`` takes them.

    An item landed more than once counts as it was landed last, and so does a rank.
    Ids may come as numbers or as text, also with a fraction of zero.
    """
    landed = read_partition(
        spark, lake, "raw", "items", date, RAW_ITEM, bad=config.bad_input, with_arrival=True
    )
    items = (
        landed.withColumn("id", lenient_long(F.col("id")))
        .where(F.col("id").isNotNull())
        .withColumn("kids", F.transform("kids", lenient_long))
    )
    items = keep_last(items, ["id"], [ARRIVAL]).drop(ARRIVAL, PARTITION_COLUMN)
    ranked = read_partition(
        spark, lake, "raw", "ranked_ids", date, RANKED_IDS, bad=config.bad_input, with_arrival=True
    )
    ranked = keep_last(ranked, ["rank"], [ARRIVAL]).drop(ARRIVAL, PARTITION_COLUMN)
    return items, ranked


# Process.


@staging_run
def process_day(
    spark: SparkSession, lake: Lake, date: str, config: JobConfig = JobConfig()
) -> dict[str, object]:
    """Raw to processed: conform, deduplicate, drop orphans, check, publish.

    Nothing is published unless both suites pass. Without stories the orphan
    filter is skipped, but the reference check still runs.
    """

    def raw(entity, schema):
        return read_partition(
            spark, lake, "raw", entity, date, schema, bad=config.bad_input, with_arrival=True
        )

    raw_stories, raw_comments = raw("stories", RAW_STORY), raw("comments", RAW_COMMENT)
    all_stories = conform_stories(raw_stories, date, keep=(ARRIVAL,))
    all_comments = conform_comments(raw_comments, date, keep=(ARRIVAL,))

    stories, story_count = stage(
        keep_last(all_stories, ROW_KEY, [ARRIVAL]).drop(ARRIVAL), "stories"
    )
    unique_comments, unique_count = stage(
        keep_last(all_comments, ROW_KEY, [ARRIVAL]).drop(ARRIVAL), "comments"
    )
    if story_count:
        comments, comment_count = _drop_orphans(
            stories, unique_comments, config.cascade_orphans
        )
    else:
        comments, comment_count = unique_comments, unique_count

    stats = {
        **_input_stats(spark, lake, date, "stories", RAW_STORY, STORY, STORY_KEYS, story_count),
        **_input_stats(spark, lake, date, "comments", RAW_COMMENT, COMMENT, COMMENT_KEYS, unique_count),
        "stories_processed": story_count,
        "comments_processed": comment_count,
        "comments_orphaned": unique_count - comment_count,
        "quality_stories": None,
        "quality_comments": None,
    }
    if story_count:
        stats["quality_stories"] = _check(
            stories, quality.story_suite(), lake, "processed", "stories", date
        )
    if comment_count:
        parents = key_set(stories.select("id"), comments.select("id"))
        stats["quality_comments"] = _check(
            comments, quality.comment_suite(parents), lake, "processed", "comments", date
        )
    # A day that has become empty is emptied, so that no older rows stay beside new ones.
    _publish(stories, lake, "processed", "stories", date, "raw")
    _publish(comments, lake, "processed", "comments", date, "raw")
    return stats


def _drop_orphans(
    stories: DataFrame, comments: DataFrame, cascade: bool
) -> tuple[DataFrame, int]:
    """Comments with a known parent; with ``cascade``, also none below a dropped one.

    A cascade follows each comment's parent, then its parent's, then four steps up and
    so on, on ids and parents only: rounds grow with the logarithm of the depth.
    The rows themselves are taken once, at the end.
    """
    keys = key_set(stories.select("id"), comments.select("id"))
    if not cascade:
        return stage(rows_with_key(comments, "parent", keys), "with-parent")
    lost = rows_without_key(comments.select("id", "parent"), "parent", keys).select("id")
    lost, count = stage(lost, "orphans")
    if not count:
        return stage(comments, "with-parent")
    # An id that is also a story's stands for the story: nothing above it matters.
    own = comments.select("id", "parent").join(
        stories.select(F.col("id").alias("parent"), F.lit(True).alias("_top")), "parent", "left"
    )
    marked = own.join(lost.withColumn("_lost", F.lit(True)), "id", "left").select(
        "id",
        F.when(F.col("_top").isNull() & F.col("_lost").isNull(), F.col("parent")).alias("up"),
        F.col("_lost").isNotNull().alias("lost"),
    )
    chains, links = stage(marked.dropDuplicates(["id"]), "chains")
    reach = 1
    # A loop never ends; after as many steps as there are links it has lost nothing.
    while reach < links and not chains.where("up IS NOT NULL AND NOT lost").isEmpty():
        above = chains.select(
            F.col("id").alias("up"), F.col("up").alias("_up"), F.col("lost").alias("_lost")
        )
        further = chains.join(above, "up", "left").select(
            "id", F.col("_up").alias("up"), (F.col("lost") | F.coalesce("_lost", F.lit(False))).alias("lost")
        )
        chains, _ = stage(further, "chains")
        reach *= 2
    gone = chains.where("lost").select("id")
    return stage(comments.join(gone, "id", "left_anti"), "with-ancestors")


def _input_stats(
    spark: SparkSession,
    lake: Lake,
    date: str,
    entity: str,
    raw_schema: T.StructType,
    schema: T.StructType,
    keys: list[str],
    unique: int,
) -> dict[str, int]:
    """Counts of what came in, every line of it; lines that do not parse are kept aside.

    One more pass over the raw files: counting inside the first job instead would count
    rows twice where a lost executor makes Spark run a shuffle stage again. What
    ``bad_input="file"`` leaves out with a bad line counts as removed, too.
    """
    lines = read_lines(spark, lake, "raw", entity, date, raw_schema)
    good = F.col("bad_line").isNull()
    key_schema = T.StructType([schema[key] for key in keys])
    typed = conform(lines, key_schema, keep=("bad_line",))
    complete = reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in keys])
    counts = typed.agg(
        F.count_if(good).alias("rows"),
        F.count_if(good & ~complete).alias("dropped"),
        F.count_if(~good).alias("bad"),
    ).first()
    if counts["bad"]:
        kept = lines.where(~good).select("file", "bad_line")
        kept.write.mode("overwrite").json(f"{lake.quarantine(entity)}/{PARTITION_COLUMN}={date}")
    return {
        f"{entity}_raw": counts["rows"],
        f"{entity}_bad_lines": counts["bad"],
        f"{entity}_dropped": counts["dropped"],
        f"{entity}_duplicates_removed": counts["rows"] - counts["dropped"] - unique,
    }


# Transform.


@staging_run
def transform_day(
    spark: SparkSession, lake: Lake, date: str, config: JobConfig = JobConfig()
) -> dict[str, object]:
    """Processed to output: engagement, topics, sentiment, check, publish.

    Earlier observations come from the state of the last day transformed, except
    for days written since, which are read from their processed rows.
    """
    window = [*days_before(date, config.window_days), date]
    times = write_times(spark, lake, "processed", "stories", window)
    stories = read_partition(spark, lake, "processed", "stories", date, PROCESSED_STORY, "parquet")
    comments = read_partition(
        spark, lake, "processed", "comments", date, PROCESSED_COMMENT, "parquet"
    )
    story_count, comment_count = stories.count(), comments.count()
    stats = {
        "stories_input": story_count,
        "stories_enriched": 0,
        "comments_input": comment_count,
        "comments_enriched": 0,
        "historical_observations_loaded": 0,
        "quality_stories": None,
        "quality_comments": None,
    }
    if story_count:
        state, held, unread = load_observed(spark, lake, date, config.window_days, times)
        history = None
        if unread:
            past = read_dates(spark, lake, "processed", "stories", unread, PROCESSED_STORY)
            history = past.select(*HISTORY_COLUMNS)
        merged, _ = stage(
            merge_observations(stories, history, state, date, config.window_days, held),
            "observations",
        )
        stats["historical_observations_loaded"] = past_count(merged)
        save_observed(state_of(merged, date, config.window_days), lake, date, config.window_days, times)
        measured = engagement_of(merged)
        with_topics, stats["stories_enriched"] = stage_top_terms(
            measured.select(*[name for name in OUTPUT_STORY.fieldNames() if name != TOPICS]),
            "stories-out",
            output=TOPICS,
            top_n=config.top_n_topics,
            max_features=config.max_features,
            stop_words=config.stop_words,
        )
        stories_out = with_topics.select(*OUTPUT_STORY.fieldNames())
    if comment_count:
        scored = add_sentiment(comments, "text", config.lexicon, config.sentiment_rules)
        comments_out, stats["comments_enriched"] = stage(
            scored.select(*OUTPUT_COMMENT.fieldNames()), "comments-out"
        )
    if stats["stories_enriched"]:
        stats["quality_stories"] = _check(
            stories_out, quality.enriched_story_suite(), lake, "output", "stories", date
        )
    if stats["comments_enriched"]:
        stats["quality_comments"] = _check(
            comments_out, quality.enriched_comment_suite(), lake, "output", "comments", date
        )
    if stats["stories_enriched"]:
        _publish(stories_out, lake, "output", "stories", date, "processed")
    if stats["comments_enriched"]:
        _publish(comments_out, lake, "output", "comments", date, "processed")
    return stats


# Report and chain.


def report_day(spark: SparkSession, lake: Lake, date: str) -> dict[str, int]:
    return run_reports(spark, lake, date)


@staging_run
def run_day(
    spark: SparkSession, lake: Lake, date: str, config: JobConfig = JobConfig()
) -> dict[str, dict]:
    """The four jobs in order over a landed day; a failure stops the chain."""
    items, ranked = read_source(spark, lake, date, config)
    items, _ = stage(items, "items")
    return {
        "ingest": ingest_day(spark, lake, date, items, ranked, config),
        "process": process_day(spark, lake, date, config),
        "transform": transform_day(spark, lake, date, config),
        "report": report_day(spark, lake, date),
    }


def stats_frame(spark: SparkSession, stats: Mapping[str, object]) -> DataFrame:
    """The counts of a job as a one-row frame."""
    counts = {name: value for name, value in stats.items() if isinstance(value, int)}
    schema = T.StructType([T.StructField(name, T.LongType()) for name in counts])
    return rows_frame(spark, [counts], schema)


__all__ = [
    "JobConfig",
    "ingest_day",
    "process_day",
    "read_source",
    "report_day",
    "run_day",
    "stats_frame",
    "transform_day",
]
