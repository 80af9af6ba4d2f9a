"""The rolling state of observations gives what a scan of the window gives."""

import random
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from threadlake.operators.observations import (
    engagement_of,
    merge_observations,
    past_count,
    state_of,
)
from threadlake.operators.temporal import engagement_metrics
from threadlake.plans import jobs
from threadlake.schemas import OUTPUT_STORY, PROCESSED_STORY
from threadlake.session import stage
from threadlake.sources.observed import load_observed, write_times
from threadlake.sources.readers import days_before, read_table
from threadlake.sources.writers import write_partition

COLUMNS = "id bigint, title string, score string, descendants string, time string, ingestion_date string"
METRICS = [
    "id", "title", "score", "descendants", "score_velocity", "comment_velocity",
    "observations_in_window", "hours_to_peak", "is_long_tail", "ingestion_date",
]
DAYS = days_before("2026-03-06", 10)
WINDOW = 3


def frame(spark, data):
    return spark.createDataFrame(data, COLUMNS).withColumn("time", F.col("time").cast("timestamp"))


def observed(spark, seed=5):
    """Ids with gaps, numbers that are none, a null id, and one id on every day."""
    rng = random.Random(seed)
    data = []
    for number, day in enumerate(DAYS):
        for id in [None, *range(30)]:
            if id == 0 or rng.random() < 0.5:
                score = rng.choice([None, "bad", *map(str, range(-3, 40))])
                born = rng.choice([None, "2026-02-26 10:11:12.5"])
                data.append((id, f"t{number}", score, str(rng.randrange(9)), born, day))
    return frame(spark, data).cache()


def scanned(seen, day):
    window = days_before(day, WINDOW)
    history = seen.where(F.col("ingestion_date").isin(window))
    return engagement_metrics(seen.where(F.col("ingestion_date") == day), history, day)


def test_a_chain_of_states_equals_scans(spark):
    seen, state = observed(spark), None
    for day in DAYS:
        merged, _ = stage(merge_observations(seen, None, state, day, WINDOW), "merged")
        assert rows(engagement_of(merged), *METRICS) == rows(scanned(seen, day), *METRICS), day
        state = state_of(merged, day, WINDOW)
    kept = [r["day"] for r in state.select(F.explode("seen.day").alias("day")).distinct().collect()]
    assert sorted(kept) == DAYS[-WINDOW:]


def test_days_of_the_state_that_do_not_count_come_from_history(spark):
    seen, day = observed(spark, 6), DAYS[5]
    window = days_before(day, WINDOW)
    old = seen.withColumn("score", F.lit("1000"))  # the middle day was written again since
    state = state_of(merge_observations(old, old, None, DAYS[4], WINDOW), DAYS[4], WINDOW)
    good = seen.where(F.col("ingestion_date").isin(window))
    merged = merge_observations(seen, good, state, day, WINDOW, state_days=[])
    assert rows(engagement_of(merged), *METRICS) == rows(scanned(seen, day), *METRICS)
    assert past_count(merged) == good.count()


def test_repeated_rows_of_a_hot_id(spark):
    day, before = DAYS[3], DAYS[2]
    many = [(1, f"t{i}", str(i), str(i), None, d) for i in range(300) for d in (before, day)]
    data = frame(spark, [*many, (2, "x", "5", "1", None, day)])
    order = ["title"]
    found = engagement_of(merge_observations(data, data, None, day, WINDOW, order=order))
    want = engagement_metrics(
        data.where(F.col("ingestion_date") == day), data.where(F.col("ingestion_date") == before), day, order
    )
    assert rows(found, *METRICS) == rows(want, *METRICS)
    assert rows(found, "id", "title", "score") == [(1, "t99", 99), (2, "x", 5)]


def test_nothing_there(spark):
    none = frame(spark, [(1, "t", "1", "1", None, DAYS[0])]).where("false")
    merged = merge_observations(none, none, None, DAYS[3], WINDOW)
    assert merged.count() == 0 and past_count(merged) == 0
    assert engagement_of(merged).count() == 0 and state_of(merged, DAYS[3], WINDOW).count() == 0


def test_extra_columns_stay_whatever_their_names(spark):
    data = frame(spark, [(1, "t", "4", "1", None, DAYS[3])]).withColumns(
        {"seen": F.lit("a"), "row": F.lit("b"), "today": F.lit("c")}
    )
    found = engagement_of(merge_observations(data, data, None, DAYS[3], WINDOW))
    assert rows(found, "id", "seen", "row", "today") == [(1, "a", "b", "c")]


def test_one_exchange(spark):
    seen = observed(spark)
    state, _ = stage(state_of(merge_observations(seen, seen, None, DAYS[4], WINDOW), DAYS[4], WINDOW), "state")
    merged = merge_observations(seen, seen, state, DAYS[5], WINDOW, [DAYS[4]])
    assert plan(engagement_of(merged)).count("Exchange hashpartitioning") == 1


# The job.


def publish(lake, seen, day):
    day_rows = seen.where((F.col("ingestion_date") == day) & F.col("id").isNotNull())
    typed = day_rows.selectExpr(
        "id", "'story' AS type", "title", "try_cast(score AS bigint) AS score",
        "CAST(descendants AS bigint) AS descendants", "time",
    )
    columns = [f for f in PROCESSED_STORY.fields if f.name != "ingestion_date"]
    full = typed.select(
        *[(F.col(f.name) if f.name in typed.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in columns]
    )
    write_partition(full, lake, "processed", "stories", day, replace_empty=True)


def output(spark, lake, day):
    saved = read_table(spark, lake, "output", "stories", OUTPUT_STORY, day)
    return rows(saved, *METRICS)


def wanted(spark, lake, day):
    return rows(scanned(read_table(spark, lake, "processed", "stories", PROCESSED_STORY), day), *METRICS)


@pytest.fixture
def transform(spark, lake, monkeypatch):
    """``transform_day`` without the suites, which the random numbers would fail."""
    monkeypatch.setattr(jobs, "_check", lambda *a: [])
    config = jobs.JobConfig(window_days=WINDOW)
    return lambda day: jobs.transform_day(spark, lake, day, config)


def test_days_with_gaps_reruns_and_lost_states(spark, lake, transform):
    seen, config_days = observed(spark, 7), DAYS[:7]

    def held(day):
        times = write_times(spark, lake, "processed", "stories", days_before(day, WINDOW))
        return load_observed(spark, lake, day, WINDOW, times)[1:]

    for day in config_days:
        if day == DAYS[2]:
            continue  # a day without rows
        publish(lake, seen, day)
        if day != DAYS[4]:  # processed, and not transformed
            transform(day)
            assert output(spark, lake, day) == wanted(spark, lake, day), day
    assert held(DAYS[4]) == ([DAYS[1], DAYS[3]], [DAYS[2]])
    assert held(DAYS[7]) == (DAYS[4:7], [])

    # An earlier day is written again: it alone is read, the state gives the rest.
    publish(lake, observed(spark, 8), DAYS[4])
    assert held(DAYS[6]) == ([DAYS[3], DAYS[5]], [DAYS[4]])
    stats = transform(DAYS[6])
    assert output(spark, lake, DAYS[6]) == wanted(spark, lake, DAYS[6])
    window = days_before(DAYS[6], WINDOW)
    past = read_table(spark, lake, "processed", "stories", PROCESSED_STORY)
    assert stats["historical_observations_loaded"] == past.where(F.col("ingestion_date").isin(window)).count()

    # A damaged state and a missing one are not used.
    folder = Path(lake.observed) / f"as_of={DAYS[5]}"
    for file in folder.glob("*.parquet"):
        file.write_bytes(file.read_bytes()[:40])
        (folder / f".{file.name}.crc").unlink(missing_ok=True)
    assert held(DAYS[6]) == ([], window)
    shutil.move(folder, Path(lake.root) / "elsewhere")
    assert held(DAYS[6]) == ([], window)
    transform(DAYS[6])
    assert output(spark, lake, DAYS[6]) == wanted(spark, lake, DAYS[6])
