"""One query per operator, over the whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlake.functions.text import clean_html
from threadlake.operators import integrity, quality, sentiment, topics, tracking
from threadlake.operators.conform import conform_comments, conform_stories, incomplete_counts
from threadlake.operators.dedup import keep_last, merge_prefer
from threadlake.operators.observations import engagement_of, merge_observations, state_of
from threadlake.operators.temporal import engagement_metrics
from threadlake.operators.threads import expand_threads
from threadlake.plans import jobs, reports
from threadlake.schemas import OUTPUT_COMMENT, OUTPUT_STORY, PROCESSED_COMMENT, PROCESSED_STORY
from threadlake.session import apply_runtime_conf, shared_folder, stage
from threadlake.sources import state
from threadlake.sources.layout import Lake
from threadlake.sources.readers import days_before, read_table, spread
from threadlake.sources.writers import write_partition
from workload import views
from workload.views import TARGET_DATE, WINDOW_DAYS, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(apply_runtime_conf(spark), sf_dir)

    QUERIES[function.__name__] = run
    return run


RULES = sentiment.SentimentRules(
    degrees=views.DEGREES, negations=views.NEGATIONS, contrast=views.CONTRAST
)


# Temporal.


def _engagement(spark, sf_dir):
    seen = views.observations(spark, sf_dir)
    first, last = days_before(TARGET_DATE, WINDOW_DAYS)[0], days_before(TARGET_DATE, 1)[0]
    return engagement_metrics(
        seen.where(F.col("ingestion_date") == TARGET_DATE),
        seen.where(F.col("ingestion_date").between(first, last)),
        TARGET_DATE,
    )


METRICS = [
    "id", "ingestion_date", "score", "descendants", "score_velocity", "comment_velocity",
    "observations_in_window", "hours_to_peak", "is_long_tail",
]


@query
def engagement(spark, sf_dir):
    return _engagement(spark, sf_dir).select(*METRICS)


def _observed_before(spark, sf_dir):
    """The state after the day before the target, of all rows of the window up to it."""
    seen = views.observations(spark, sf_dir)
    before = days_before(TARGET_DATE, 1)[0]
    merged = merge_observations(seen, seen, None, before, WINDOW_DAYS)
    return state_of(merged, before, WINDOW_DAYS)


@query
def observation_state(spark, sf_dir):
    entry = F.explode("seen").alias("o")
    return _observed_before(spark, sf_dir).select("id", entry).select(
        "id", F.col("o.day").alias("ingestion_date"), "o.score", "o.descendants"
    )


@query
def engagement_by_state(spark, sf_dir):
    """The target day by the state; two of its days count as written again and are read."""
    state, _ = stage(_observed_before(spark, sf_dir), "observed")
    seen = views.observations(spark, sf_dir)
    window = days_before(TARGET_DATE, WINDOW_DAYS)
    again = [window[1], window[4]]
    merged = merge_observations(
        seen, seen.where(F.col("ingestion_date").isin([window[0], *again])), state, TARGET_DATE,
        WINDOW_DAYS, [d for d in window[1:] if d not in again],
    )
    return engagement_of(merged).select(*METRICS)


# Dedup and merge.


@query
def keep_last_rows(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    order = ["l_shipdate"] + [c for c in lines.columns if c not in [*keys, "l_shipdate"]]
    return keep_last(lines, keys, order).withColumn(
        "l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd")
    )


@query
def merge_preferring_labels(spark, sf_dir):
    base = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("n_chars").alias("value"), F.lit("base").alias("origin")
    )
    preferred = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"),
        F.col("quality").cast("bigint").alias("value"),
        F.lit("preferred").alias("origin"),
    )
    return merge_prefer(base, preferred, ["id"])


# Conforming.


def _loose_events(spark, sf_dir):
    """Events as loosely typed items: all text, some of it no number."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.lit("comment").alias("type"),
        F.unix_seconds(F.col("ts").cast("timestamp")).cast("string").alias("time"),
        F.col("value").cast("string").alias("score"),
        F.col("props").alias("descendants"),
        F.col("value").cast("string").alias("parent"),
        F.col("event_type").alias("dead"),
        F.col("user_id").cast("string").alias("extra"),
    )


def _epoch(df):
    return df.withColumn("time", F.unix_seconds("time"))


@query
def conform_loose_stories(spark, sf_dir):
    typed = conform_stories(_loose_events(spark, sf_dir), TARGET_DATE)
    return _epoch(typed).select(
        "id", "type", "by", "time", "title", "score", "descendants", "dead", "ingestion_date"
    )


@query
def conform_loose_comments(spark, sf_dir):
    typed = conform_comments(_loose_events(spark, sf_dir), TARGET_DATE)
    return _epoch(typed).select("id", "type", "text", "time", "parent", "ingestion_date")


# Key membership.


@query
def flag_orphans(spark, sf_dir):
    comments = views.replies(spark, sf_dir).select("id", "parent")
    keys = integrity.key_set(views.labelled_ids(spark, sf_dir), comments.select("id"))
    return integrity.flag_known_parents(comments, keys)


@query
def split_orphans_valid(spark, sf_dir):
    comments = views.replies(spark, sf_dir).select("id", "parent", "text")
    return integrity.split_orphans(views.labelled_ids(spark, sf_dir), comments)[0]


@query
def split_orphans_dropped(spark, sf_dir):
    comments = views.replies(spark, sf_dir).select("id", "parent", "text")
    return integrity.split_orphans(views.labelled_ids(spark, sf_dir), comments)[1]


@query
def orphan_rows(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return integrity.rows_without_key(documents, "doc_id", views.labelled_ids(spark, sf_dir))


@query
def active_rows(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return integrity.active_rows(documents, views.labelled_ids(spark, sf_dir), "doc_id")


@query
def rows_not_listed(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return integrity.rows_not_in(documents, "doc_id", views.labelled_ids(spark, sf_dir))


@query
def rows_with_parent(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return integrity.rows_with_key(turns, "conv_id", views.labelled_ids(spark, sf_dir))


@query
def new_ids(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id")
    return integrity.new_ids(turns, views.labelled_ids(spark, sf_dir))


@query
def unmatched_counts(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return integrity.count_unmatched(turns, "conv_id", table(spark, sf_dir, "labels"), "doc_id")


@query
def valid_parents(spark, sf_dir):
    return integrity.key_set(
        views.labelled_ids(spark, sf_dir), views.replies(spark, sf_dir).select("id")
    )


# Change tracking.


def _tracking_inputs(spark, sf_dir):
    seen = views.observations(spark, sf_dir)
    last = F.struct("ingestion_date", "score", "descendants")
    state = (
        seen.where(F.col("ingestion_date") < TARGET_DATE)
        .groupBy(F.col("id").alias("story_id"))
        .agg(F.min("ingestion_date").alias("first_seen"), F.max(last).alias("last"))
        .select(
            "story_id",
            "first_seen",
            F.col("last.ingestion_date").alias("last_updated"),
            F.col("last.score").alias("last_score"),
            F.col("last.descendants").alias("last_descendants"),
        )
    )
    today = seen.where(F.col("ingestion_date") == TARGET_DATE)
    return state, tracking.story_metrics(today)


@query
def track_merge(spark, sf_dir):
    state, metrics = _tracking_inputs(spark, sf_dir)
    fresh = integrity.new_ids(views.labelled_ids(spark, sf_dir), tracking.tracked_ids(state))
    return tracking.merge_state(state, metrics, fresh, TARGET_DATE, tracking_days=7)


@query
def track_changed(spark, sf_dir):
    state, metrics = _tracking_inputs(spark, sf_dir)
    return state.join(metrics, "story_id").select(
        "story_id",
        tracking.has_changed(
            F.col("score"), F.col("descendants"), F.col("last_score"), F.col("last_descendants")
        ).alias("changed"),
    )


@query
def track_interest(spark, sf_dir):
    state, _ = _tracking_inputs(spark, sf_dir)
    return state.select(
        "story_id",
        tracking.days_since(F.col("last_updated"), TARGET_DATE).cast("bigint").alias("days"),
        tracking.keeps_interest(F.col("last_updated"), TARGET_DATE, 2).alias("keep"),
    )


def _event_items(spark, sf_dir):
    kind = F.when(F.col("event_type") == "view", "story").otherwise(F.col("event_type"))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), kind.alias("type"), F.col("ts").alias("time")
    )


@query
def discover(spark, sf_dir):
    ranked = table(spark, sf_dir, "labels").select(
        (F.col("doc_id") + 1).alias("rank"), F.col("doc_id").alias("id")
    )
    found = tracking.discover(
        ranked, _event_items(spark, sf_dir), "2024-01-08", max_stories=500
    )
    return found.select("id", "type")


@query
def tracked_stories(spark, sf_dir):
    state = views.labelled_ids(spark, sf_dir).select(F.col("id").alias("story_id"))
    return tracking.tracked_stories(_event_items(spark, sf_dir), state).select("id", "type")


# Threads.


@query
def threads(spark, sf_dir):
    turns = views.replies(spark, sf_dir)
    roots = turns.where("turn = 0").select(
        F.col("conv_id").alias("id"), F.array("id").alias("kids")
    )
    found = expand_threads(roots, turns.select("id", "type", "by", "kids"), max_depth=5)
    return found.select(
        "root_id", "id", "by", F.col("depth").cast("bigint").alias("depth"),
        F.array_join("path", ".").alias("path"),
    )


# Quality.


def _checks(df, specs):
    found = quality.check_table(df.sparkSession, quality.run_suite(df, specs))
    return found.select(
        "name", "passed", "severity", "affected_records",
        F.array_join("sample_ids", ",").alias("sample_ids"),
    )


def _with_labels(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang")
    labels = table(spark, sf_dir, "labels")
    return documents.join(labels, "doc_id", "left").withColumnRenamed("doc_id", "id")


@query
def check_not_null(spark, sf_dir):
    return _checks(_with_labels(spark, sf_dir), [quality.NotNull(["id", "quality"])])


@query
def check_unique(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "id")
    return _checks(lines, [quality.Unique(["id", "l_linenumber"])])


@query
def check_range(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "id")
    return _checks(customers, [quality.InRange("c_acctbal", min_value=0, max_value=9000)])


@query
def check_reference(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").withColumnRenamed("conv_id", "id")
    labels = table(spark, sf_dir, "labels")
    return _checks(turns, [quality.RefersTo(labels, "id", "doc_id")])


@query
def check_volume(spark, sf_dir):
    return _checks(
        table(spark, sf_dir, "lineitem"), [quality.Volume("lineitem", 1_000_000_000)]
    )


def _suite(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "id")
    return lines, [
        quality.NotNull(["id", "l_linenumber", "l_shipdate"]),
        quality.Unique(["id", "l_linenumber"]),
        quality.InRange("l_quantity", min_value=1, max_value=50),
        quality.InRange("l_discount", max_value=0.05),
        quality.RefersTo(table(spark, sf_dir, "orders"), "id", "o_orderkey"),
        quality.NotNull(["l_comment"], severity=quality.WARNING),
        quality.Volume("lineitem", 1),
    ]


@query
def quality_suite(spark, sf_dir):
    lines, specs = _suite(spark, sf_dir)
    return _checks(lines, specs)


@query
def quality_report(spark, sf_dir):
    lines, specs = _suite(spark, sf_dir)
    checks = quality.check_table(spark, quality.run_suite(lines, specs))
    report = quality.build_report(checks, TARGET_DATE, TARGET_DATE)
    return report.select(
        "ingestion_date", "total_checks", "passed_checks", "failed_checks",
        "has_critical_failures",
        F.col("entities")["lineitem"]["passed"].alias("lineitem_passed"),
        F.col("entities")["unknown"]["failed"].alias("unknown_failed"),
    )


@query
def suite_of_stories(spark, sf_dir):
    stories = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("type"),
        F.when(F.col("n_chars") > 100, F.col("n_chars")).alias("time"),
        (F.col("n_chars") - 500).alias("score"),
        (F.length("text") - 200).alias("descendants"),
        F.col("lang").alias("ingestion_date"),
    )
    return _checks(stories, quality.story_suite())


@query
def suite_of_comments(spark, sf_dir):
    comments = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("id"),
        F.col("role").alias("type"),
        F.col("turn").alias("time"),
        F.col("conv_id").alias("parent"),
        F.col("role").alias("ingestion_date"),
    )
    return _checks(comments, quality.comment_suite(views.labelled_ids(spark, sf_dir)))


@query
def suite_of_enriched_stories(spark, sf_dir):
    return _checks(_engagement(spark, sf_dir), quality.enriched_story_suite())


@query
def suite_of_enriched_comments(spark, sf_dir):
    scored = sentiment.add_sentiment(
        spread(views.replies(spark, sf_dir).select("id", "text")), "text", views.LEXICON, RULES
    )
    return _checks(scored, quality.enriched_comment_suite())


@query
def incomplete_counts_of_comments(spark, sf_dir):
    loose = _loose_events(spark, sf_dir)
    number = F.col("parent").try_cast("double")
    typed = loose.select("id", F.when(number == F.floor(number), number).alias("parent"))
    return incomplete_counts(typed, ["id", "parent"])


# Text.


@query
def clean_pages(spark, sf_dir):
    return spread(table(spark, sf_dir, "pages").select("page_id", "html")).select(
        "page_id", clean_html(F.col("html")).alias("clean")
    )


@query
def vocabulary(spark, sf_dir):
    fitted = topics.fit_vocabulary(
        spread(table(spark, sf_dir, "documents").select("text")), "text", views.STOP_WORDS, max_features=100
    )
    return fitted.withColumn("idf", F.round("idf", 9))


@query
def top_terms(spark, sf_dir):
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return topics.top_terms(documents, "text", stop_words=views.STOP_WORDS).select(
        "doc_id", "dominant_topics"
    )


@query
def lexicon_sums(spark, sf_dir):
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", sentiment.lexicon_sum(F.col("text"), views.LEXICON).alias("valence")
    )


@query
def sentiment_of_replies(spark, sf_dir):
    return sentiment.add_sentiment(
        spread(views.replies(spark, sf_dir).select("id", "text")), "text", views.LEXICON, RULES
    ).select("id", "sentiment_score", "sentiment_label")


@query
def sentiment_of_documents(spark, sf_dir):
    return sentiment.add_sentiment(
        spread(table(spark, sf_dir, "documents").select("doc_id", "text")),
        "text",
        views.LEXICON,
        RULES,
    ).select("doc_id", "sentiment_score", "sentiment_label")


@query
def sentiment_of_phrases(spark, sf_dir):
    rules = sentiment.SentimentRules(
        degrees=views.DEGREES, negations=views.NEGATIONS, contrast=views.CONTRAST, emoji=views.EMOJI
    )
    return sentiment.add_sentiment(
        spread(views.planted_replies(spark, sf_dir)), "text", {**views.LEXICON, **views.PHRASES}, rules
    ).select("id", "sentiment_score", "sentiment_label")


@query
def sentiment_histogram(spark, sf_dir):
    scored = sentiment.add_sentiment(
        spread(views.replies(spark, sf_dir).select("id", "text")), "text", views.LEXICON, RULES
    )
    return sentiment.label_histogram(scored)


# Reports.


def _enriched_stories(spark, sf_dir):
    """The target day's engagement, with the documents of the same ids as texts."""
    documents = spread(
        table(spark, sf_dir, "documents").select(
            F.col("doc_id").alias("id"), F.concat_ws(" ", "source", "lang").alias("title"), "text"
        )
    )
    # Staged as the daily job does it: terms are counted and scored over these
    # rows, and reports read the finished ones.
    stories, _ = stage(_engagement(spark, sf_dir).join(documents, "id", "left"), "day-stories")
    enriched = topics.top_terms(stories, "text", stop_words=views.STOP_WORDS)
    return stage(enriched.drop("text"), "enriched")[0]


@query
def report_top_velocity(spark, sf_dir):
    return reports.top_stories_by_score_velocity(_enriched_stories(spark, sf_dir))


@query
def report_engagement_speed(spark, sf_dir):
    return reports.engagement_speed(_engagement(spark, sf_dir))


@query
def report_long_tail(spark, sf_dir):
    stories = _engagement(spark, sf_dir).withColumn("title", F.col("id").cast("string"))
    return reports.long_tail_stories(stories)


@query
def report_sentiment(spark, sf_dir):
    stories = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.concat_ws(" ", "source", "lang").alias("title")
    )
    turns = spread(
        views.replies(spark, sf_dir).select("id", "text", F.col("conv_id").alias("parent"))
    )
    comments = sentiment.add_sentiment(turns, "text", views.LEXICON, RULES)
    return reports.sentiment_by_story(stories, comments)


@query
def report_topic_trends(spark, sf_dir):
    return reports.topic_trends(_enriched_stories(spark, sf_dir))


# Jobs, through files.


def _landed(spark, sf_dir):
    """All documents landed as stories and all conversation turns as comments.

    Documents without a label get ids that no turn answers to.
    """
    lake = Lake(f"{shared_folder(spark)}/lakes/{uuid.uuid4().hex}")
    labels = table(spark, sf_dir, "labels")
    documents = table(spark, sf_dir, "documents")
    stories = documents.join(labels, "doc_id", "left").select(
        F.when(F.col("quality").isNotNull(), F.col("doc_id")).otherwise(F.col("doc_id") + 10**12).alias("id"),
        F.lit("story").alias("type"),
        F.lit(1705700000).alias("time"),
        F.col("text").alias("title"),
        F.col("n_chars").alias("score"),
        F.col("quality").alias("descendants"),
    )
    comments = views.replies(spark, sf_dir).select(
        "id", "type", "by", F.lit(1705700000).alias("time"), "text", "parent", "kids"
    )
    for entity, rows in (("stories", stories), ("comments", comments)):
        write_partition(rows, lake, "raw", entity, TARGET_DATE, "json")
    return lake


_JOBS = jobs.JobConfig(
    cascade_orphans=True, lexicon=views.LEXICON, sentiment_rules=RULES
)


@query
def job_process_day(spark, sf_dir):
    lake = _landed(spark, sf_dir)
    jobs.process_day(spark, lake, TARGET_DATE, _JOBS)
    saved = read_table(spark, lake, "processed", "comments", PROCESSED_COMMENT, TARGET_DATE)
    return _epoch(saved).select("id", "by", "time", "text", "parent", "ingestion_date")


@query
def job_process_stats(spark, sf_dir):
    lake = _landed(spark, sf_dir)
    return jobs.stats_frame(spark, jobs.process_day(spark, lake, TARGET_DATE, _JOBS))


@query
def job_transform_day(spark, sf_dir):
    lake = _landed(spark, sf_dir)
    jobs.process_day(spark, lake, TARGET_DATE, _JOBS)
    jobs.transform_day(spark, lake, TARGET_DATE, _JOBS)
    saved = read_table(spark, lake, "output", "comments", OUTPUT_COMMENT, TARGET_DATE)
    return saved.select("id", "parent", "sentiment_score", "sentiment_label", "ingestion_date")


@query
def job_transform_stories(spark, sf_dir):
    """Stories of a week through the job: a day by its state, later days read, output read back."""
    lake = Lake(f"{shared_folder(spark)}/lakes/{uuid.uuid4().hex}")
    seen = views.observations(spark, sf_dir).withColumns(
        {"title": F.col("id").cast("string"), "type": F.lit("story"), "by": F.lit("u"), "text": F.lit("")}
    )
    seen, _ = stage(seen, "observations")
    for day in [*days_before(TARGET_DATE, WINDOW_DAYS), TARGET_DATE]:
        rows = seen.where(F.col("ingestion_date") == day)
        columns = [
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in PROCESSED_STORY.fields if f.name != "ingestion_date"
        ]
        write_partition(rows.select(*columns), lake, "processed", "stories", day)
    for day in (days_before(TARGET_DATE, 3)[0], TARGET_DATE):
        jobs.transform_day(spark, lake, day, jobs.JobConfig(window_days=WINDOW_DAYS))
    return read_table(spark, lake, "output", "stories", OUTPUT_STORY, TARGET_DATE).select(*METRICS)


@query
def job_process_stories(spark, sf_dir):
    lake = _landed(spark, sf_dir)
    jobs.process_day(spark, lake, TARGET_DATE, _JOBS)
    saved = read_table(spark, lake, "processed", "stories", PROCESSED_STORY, TARGET_DATE)
    return saved.select("id", "title", "score", "descendants", "ingestion_date")


@query
def discover_repeated_ranks(spark, sf_dir):
    """Two documents of each rank, ranked by length: all of the first ranks count."""
    items = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.lit("story").alias("type"), F.lit(1705700000).alias("time")
    )
    ranked = items.select((F.col("id").cast("bigint") % 500 + 1).alias("rank"), "id")
    found = tracking.discover(ranked, items, TARGET_DATE, max_stories=40, recent_days=10_000)
    return found.select("id")


@query
def state_after_all_lapse(spark, sf_dir):
    """Every story of an old state is dropped: the state saved is empty, and is the one read."""
    lake = Lake(f"{shared_folder(spark)}/lakes/{uuid.uuid4().hex}")
    old = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("story_id"),
        F.lit("2023-01-01").alias("first_seen"),
        F.lit("2023-01-01").alias("last_updated"),
        F.col("n_chars").alias("last_score"),
        F.lit(0).cast("bigint").alias("last_descendants"),
    )
    saved = state.save_state(old, lake, "2024-01-01")
    metrics = old.select("story_id", F.col("last_score").alias("score"), F.lit(0).cast("bigint").alias("descendants"))
    before = state.load_state(spark, lake, "2024-01-02")
    after = tracking.merge_state(before, metrics, before.select("story_id").where("false"), "2024-01-02")
    state.save_state(after, lake, "2024-01-02")
    left = state.load_state(spark, lake, "2024-01-03").agg(F.count(F.lit(1)).alias("left_over"))
    return left.select(F.lit(saved).cast("bigint").alias("saved"), "left_over")
