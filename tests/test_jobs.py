"""End to end on a landed day, and what a re-run must leave alone."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from threadlake.operators.quality import QualityError
from threadlake.plans import jobs, reports
from threadlake.schemas import (
    OUTPUT_COMMENT,
    OUTPUT_STORY,
    PROCESSED_COMMENT,
    PROCESSED_STORY,
    TRACKING_STATE,
)
from threadlake.session import shared_folder
from threadlake.sources.readers import read_table
from threadlake.sources.state import load_state, save_state, snapshot_dates

DAY = "2026-02-07"


def land(lake, entity, date, records, name="batch_20260207_100000.json"):
    folder = Path(lake.root) / "raw" / entity / f"ingestion_date={date}"
    folder.mkdir(parents=True, exist_ok=True)
    lines = [r if isinstance(r, str) else json.dumps(r, ensure_ascii=False) for r in records]
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def story(id, **more):
    return {
        "id": id, "type": "story", "by": "u", "time": 1770300000, "title": f"Python story {id}",
        "score": 10, "descendants": 2, **more,
    }


def comment(id, parent, **more):
    return {
        "id": id, "type": "comment", "by": "c", "time": 1770310000, "text": "great work",
        "parent": parent, **more,
    }


def rows(df, *columns):
    return sorted(tuple(row) for row in df.select(*columns).collect())


def land_source(lake, date):
    items = [
        story(1, kids=[11, 12], score=50),
        story(2, kids=[21], score=70, title="Rust &amp; more"),
        story(3, time=1000000000),
        comment(11, 1, kids=[111]),
        comment(12, 1, text="terrible &amp; broken"),
        comment(111, 11),
        comment(21, 2),
        {"id": 4, "type": "poll", "time": 1770300000},
    ]
    land(lake, "items", date, items)
    land(lake, "ranked_ids", date, [{"rank": r, "id": i} for r, i in enumerate([1, 2, 3, 4, 99], 1)])


def test_whole_day_and_rerun(spark, lake):
    land_source(lake, DAY)
    first = jobs.run_day(spark, lake, DAY)
    assert first["ingest"] == {
        "total_stories": 2, "new_stories": 2, "updated_stories": 0,
        "total_comments": 4, "active_tracked_stories": 2,
    }
    assert first["process"]["comments_processed"] == 4
    assert first["process"]["comments_orphaned"] == 0
    assert all(check.passed for check in first["transform"]["quality_stories"])
    assert first["report"]["reports_failed"] == 0
    # no story is old enough for the long tail
    assert first["report"] == {"reports_generated": 4, "reports_empty": 1, "reports_failed": 0}

    before = rows(read_table(spark, lake, "output", "stories", OUTPUT_STORY), "id", "score", "ingestion_date")
    again = jobs.run_day(spark, lake, DAY)
    after = rows(read_table(spark, lake, "output", "stories", OUTPUT_STORY), "id", "score", "ingestion_date")
    assert before == after
    # raw appends, so the second run sees and removes the first one's rows
    assert again["process"]["stories_duplicates_removed"] == 2
    assert again["process"]["stories_processed"] == first["process"]["stories_processed"]
    assert again["ingest"]["new_stories"] == 2
    assert snapshot_dates(spark, lake) == [DAY]

    manifest = spark.read.json(lake.manifest)
    assert manifest.where("layer='output' and entity='stories'").count() == 2
    csv = spark.read.option("header", True).csv(lake.table("reports", "sentiment_by_story"))
    assert rows(csv, "id", "total_comments", "positive", "negative") == [
        ("1", "2", "1", "1"), ("2", "1", "1", "0"),
    ]


def test_second_day_tracks_and_measures(spark, lake):
    land_source(lake, "2026-02-06")
    jobs.run_day(spark, lake, "2026-02-06")
    land(lake, "items", DAY, [story(1, score=65, descendants=9, kids=[11]), story(5), comment(11, 1)])
    land(lake, "ranked_ids", DAY, [{"rank": 1, "id": 5}])
    stats = jobs.run_day(spark, lake, DAY)
    assert stats["ingest"]["updated_stories"] == 1
    assert stats["ingest"]["new_stories"] == 1
    # story 2 has no item any more, so it is no longer followed
    assert rows(load_state(spark, lake, "2026-02-08"), "story_id") == [(1,), (5,)]
    out = read_table(spark, lake, "output", "stories", OUTPUT_STORY, DAY)
    assert rows(out, "id", "score_velocity", "comment_velocity", "observations_in_window") == [
        (1, 15, 7, 2), (5, 0, 0, 1),
    ]
    assert stats["transform"]["historical_observations_loaded"] == 2


def test_process_removes_duplicates_and_orphans(spark, lake):
    land(lake, "stories", DAY, [story(100, score=50), story("bad"), story(200)], "a.json")
    land(lake, "stories", DAY, [story(100, score="75")], "b.json")
    land(
        lake, "comments", DAY,
        [comment(201, 100), comment(301, 201), comment(202, 888), comment(9, None), comment(301, 201)],
    )
    stats = jobs.process_day(spark, lake, DAY)
    assert {k: v for k, v in stats.items() if isinstance(v, int)} == {
        "stories_bad_lines": 0, "comments_bad_lines": 0,
        "stories_raw": 4, "stories_dropped": 1, "stories_duplicates_removed": 1,
        "comments_raw": 5, "comments_dropped": 1, "comments_duplicates_removed": 1,
        "stories_processed": 2, "comments_processed": 2, "comments_orphaned": 1,
    }
    saved = read_table(spark, lake, "processed", "stories", PROCESSED_STORY, DAY)
    assert rows(saved, "id", "score") == [(100, 75), (200, 10)]
    frame = jobs.stats_frame(spark, stats)
    assert frame.first()["comments_orphaned"] == 1


def test_reply_to_an_orphan_blocks_the_day_unless_cascading(spark, lake):
    land(lake, "stories", DAY, [story(100)])
    land(lake, "comments", DAY, [comment(201, 100), comment(202, 888), comment(301, 202)])
    with pytest.raises(QualityError):
        jobs.process_day(spark, lake, DAY)
    # the report was saved, nothing was published
    report = spark.read.json(lake.table("processed", "quality_reports_comments"))
    assert report.first()["has_critical_failures"] is True
    assert read_table(spark, lake, "processed", "stories", PROCESSED_STORY).count() == 0
    stats = jobs.process_day(spark, lake, DAY, jobs.JobConfig(cascade_orphans=True))
    assert stats["comments_processed"] == 1
    assert stats["comments_orphaned"] == 2


def test_cascade_follows_chains_but_not_story_ids(spark, lake):
    land(lake, "stories", DAY, [story(100), story(202)])
    chain = [comment(301, 202), comment(202, 888), comment(400, 999), comment(401, 400), comment(402, 401)]
    circle = [comment(500, 501), comment(501, 500)]
    land(lake, "comments", DAY, [*chain, *circle, comment(201, 100)])
    stats = jobs.process_day(spark, lake, DAY, jobs.JobConfig(cascade_orphans=True))
    saved = read_table(spark, lake, "processed", "comments", PROCESSED_COMMENT, DAY)
    # 301 answers the story 202, not the dropped comment of that id
    assert rows(saved, "id") == [(201,), (301,), (500,), (501,)]
    assert stats["comments_orphaned"] == 4


def test_without_stories_the_orphan_filter_is_skipped(spark, lake):
    land(lake, "comments", DAY, [comment(201, 202), comment(202, 201)])
    stats = jobs.process_day(spark, lake, DAY)
    assert stats["comments_orphaned"] == 0
    assert stats["comments_processed"] == 2
    assert read_table(spark, lake, "processed", "comments", PROCESSED_COMMENT, DAY).count() == 2


def test_empty_day(spark, lake):
    stats = jobs.process_day(spark, lake, DAY)
    assert stats["stories_raw"] == 0 and stats["quality_stories"] is None
    assert jobs.transform_day(spark, lake, DAY)["stories_input"] == 0
    assert jobs.report_day(spark, lake, DAY) == {
        "reports_generated": 0, "reports_empty": 5, "reports_failed": 0,
    }


def test_a_failing_report_does_not_stop_the_others(spark, lake):
    land_source(lake, DAY)
    jobs.run_day(spark, lake, DAY)

    def broken(stories, comments):
        raise RuntimeError("no")

    some = [reports.Report("broken", broken), reports.REPORTS[1]]
    assert reports.run_reports(spark, lake, DAY, some) == {
        "reports_generated": 1, "reports_empty": 0, "reports_failed": 1,
    }


def test_a_job_leaves_nothing_staged(spark, lake):
    land(lake, "stories", DAY, [story(100)], "a.json")
    land(lake, "comments", DAY, [comment(201, 100), comment(202, 888), comment(301, 202)], "a.json")
    staged = Path(shared_folder(spark).removeprefix("file:")) / "staged"
    before = set(staged.glob("*")) if staged.exists() else set()
    jobs.process_day(spark, lake, DAY, jobs.JobConfig(cascade_orphans=True))
    jobs.transform_day(spark, lake, DAY)
    assert set(staged.glob("*")) == before
    assert read_table(spark, lake, "output", "comments", OUTPUT_COMMENT).count() == 1


def test_a_day_run_again_without_rows_is_emptied(spark, lake):
    land(lake, "stories", DAY, [story(100)], "a.json")
    land(lake, "comments", DAY, [comment(201, 100)], "a.json")
    jobs.process_day(spark, lake, DAY)
    folder = Path(lake.root) / "raw" / "comments" / f"ingestion_date={DAY}"
    (folder / "a.json").write_text(json.dumps(comment(202, 888)))
    jobs.process_day(spark, lake, DAY)
    assert read_table(spark, lake, "processed", "comments", PROCESSED_COMMENT, DAY).count() == 0
    assert read_table(spark, lake, "processed", "stories", PROCESSED_STORY, DAY).count() == 1


def test_stories_that_lapse_leave_an_empty_state(spark, lake):
    old = spark.createDataFrame([(3, "2026-01-01", "2026-01-01", 10, 2)], TRACKING_STATE)
    save_state(old, lake, "2026-02-06")
    land_source(lake, DAY)
    items, ranked = jobs.read_source(spark, lake, DAY)
    stats = jobs.ingest_day(spark, lake, DAY, items, ranked.where("id = 99"))
    assert stats["active_tracked_stories"] == 0 and stats["total_comments"] == 0
    assert snapshot_dates(spark, lake) == ["2026-02-06", DAY]
    assert load_state(spark, lake, "2026-02-08").count() == 0


def test_source_ids_with_a_zero_fraction(spark, lake):
    land(lake, "items", DAY, [story("7.0", kids=["8.0", 9]), story(8.0), story("x")])
    land(lake, "ranked_ids", DAY, [{"rank": 1, "id": 7}], "a.json")
    land(lake, "ranked_ids", DAY, [{"rank": 1, "id": 8}], "b.json")
    items, ranked = jobs.read_source(spark, lake, DAY)
    assert rows(items, "id") == [(7,), (8,)]
    assert items.where("id = 7").first().kids == [8, 9]
    assert rows(ranked, "rank", "id") == [(1, 8)]
