import pytest

from helpers import rows
from threadlake.operators import quality as q
from threadlake.operators.quality import CRITICAL, WARNING


def only(df, spec, **more):
    (result,) = q.run_suite(df, [spec], **more)
    return result


def summary(result):
    return result.passed, result.affected_records, result.sample_ids


@pytest.fixture
def pairs(spark):
    def make(data, columns="id bigint, type string"):
        return spark.createDataFrame(data, columns)

    return make


def test_not_null(pairs):
    df = pairs([(100, "story"), (None, "story"), (300, None)])
    assert summary(only(df, q.NotNull(["id", "type"]))) == (False, 2, [300])
    assert summary(only(pairs([(1, "a")]), q.NotNull(["id", "type"]))) == (True, 0, [])


def test_not_null_counts_nan(pairs):
    df = pairs([(1, 1.0), (2, float("nan")), (3, None)], "id bigint, x double")
    assert summary(only(df, q.NotNull(["x"]))) == (False, 2, [2, 3])


def test_absent_column_affects_every_row(pairs):
    df = pairs([(1, "a"), (2, "b")])
    for spec in (q.NotNull(["nope"]), q.Unique(["nope"]), q.InRange("nope", 0)):
        result = only(df, spec)
        assert summary(result) == (False, 2, [])
        assert result.details["missing_columns"] == '["nope"]'


def test_sample_is_bounded_and_ordered(pairs):
    df = pairs([(i, None) for i in range(20, 0, -1)])
    assert only(df, q.NotNull(["type"]), sample_size=5).sample_ids == [1, 2, 3, 4, 5]
    assert len(only(df, q.NotNull(["type"])).sample_ids) == 10


def test_no_id_no_sample(pairs):
    df = pairs([(None,), (None,)], "x string")
    assert summary(only(df, q.NotNull(["x"]))) == (False, 2, [])


def test_empty_passes(pairs):
    df = pairs([(1, "a")]).where("false")
    for spec in (q.NotNull(["id"]), q.Unique(["id"]), q.InRange("id", 0)):
        assert summary(only(df, spec)) == (True, 0, [])


def test_unique(pairs):
    df = pairs([(100, "d"), (100, "d"), (200, "d"), (100, "e")])
    assert summary(only(df, q.Unique(["id", "type"]))) == (False, 2, [100, 100])
    assert only(df, q.Unique(["type", "id"]), sample_size=1).sample_ids == [100]


def test_unique_nulls_are_equal(pairs):
    df = pairs([(None, "a"), (None, "a"), (1, "a")])
    assert summary(only(df, q.Unique(["id", "type"]))) == (False, 2, [])


def test_unique_over_other_columns_than_id(pairs):
    df = pairs([(1, "a"), (2, "a"), (3, "b"), (4, None), (5, None)])
    assert summary(only(df, q.Unique(["type"]))) == (False, 4, [1, 2, 4, 5])


def test_range(pairs):
    numbers = pairs([(1, -5), (2, 10), (3, -1), (4, None)], "id bigint, score bigint")
    assert summary(only(numbers, q.InRange("score", min_value=0))) == (False, 2, [1, 3])
    assert summary(only(pairs([(1, 50), (2, 200)], "id bigint, score bigint"), q.InRange("score", max_value=100))) == (False, 1, [2])
    assert summary(only(pairs([(1, 0), (2, 100)], "id bigint, score bigint"), q.InRange("score", 0, 100))) == (True, 0, [])


def test_range_lets_text_and_nan_pass(pairs):
    text = pairs([(1, "-5"), (2, "x"), (3, "7")], "id bigint, score string")
    assert summary(only(text, q.InRange("score", 0, 6))) == (False, 2, [1, 3])
    nan = pairs([(1, float("nan")), (2, 0.5)], "id bigint, score double")
    assert summary(only(nan, q.InRange("score", 0, 1))) == (True, 0, [])


def test_reference(pairs):
    parents = pairs([(100,)], "id bigint")
    children = pairs([(1, 100), (2, 999), (3, 888)], "id bigint, parent bigint")
    assert summary(only(children, q.RefersTo(parents, "parent", "id"))) == (False, 2, [2, 3])
    assert summary(only(children.where("id = 1"), q.RefersTo(parents, "parent", "id"))) == (True, 0, [])


def test_reference_details_and_null_child(pairs):
    parents = pairs([(100,), (200,), (300,), (300,), (None,)], "id bigint")
    children = pairs([(1, 100), (2, None)], "id bigint, parent bigint")
    result = only(children, q.RefersTo(parents, "parent", "id"))
    assert summary(result) == (False, 1, [2])
    assert result.details["valid_parent_count"] == "3"


def test_reference_with_an_absent_key(pairs):
    parents = pairs([(100,)], "other bigint")
    children = pairs([(1, 100)], "id bigint, parent bigint")
    assert summary(only(children, q.RefersTo(parents, "parent", "id"))) == (False, 1, [])
    assert summary(only(parents, q.RefersTo(children, "parent", "id"))) == (False, 1, [])


def test_volume(pairs):
    result = only(pairs([(1, "a")]), q.Volume("stories", 10))
    assert summary(result) == (False, 9, [])
    assert result.details == {"entity": "stories", "actual_count": "1", "min_expected": "10"}
    assert only(pairs([(1, "a")]), q.Volume("stories", 1)).passed


STORIES = "id bigint, type string, time string, ingestion_date string, score bigint, descendants bigint"


def stories(pairs, *changes):
    base = (100, "story", "t", "2026-02-01", 10, 1)
    return pairs([tuple(change) for change in changes] or [base], STORIES)


def test_story_suite(pairs):
    results = q.run_suite(stories(pairs), q.story_suite())
    assert [r.name for r in results] == [
        "check_not_null", "check_unique", "check_range", "check_range", "check_volume",
    ]
    assert all(r.passed for r in results)


def test_severity_decides_about_the_gate(pairs):
    low = q.run_suite(stories(pairs, (1, "story", "t", "d", -1, 0)), q.story_suite())
    assert [r.severity for r in low if not r.passed] == [WARNING]
    q.gate(low, "stories")
    empty = q.run_suite(stories(pairs).where("false"), q.story_suite())
    assert [(r.name, r.severity) for r in empty if not r.passed] == [("check_volume", WARNING)]
    for change in ((None, "story", "t", "d", 1, 1),), ((1, "s", "t", "d", 1, 1),) * 2:
        bad = q.run_suite(stories(pairs, *change), q.story_suite())
        assert q.has_critical_failures(bad)
        with pytest.raises(q.QualityError):
            q.gate(bad, "stories")


def test_comment_suite(pairs):
    columns = "id bigint, type string, time string, parent bigint, ingestion_date string"
    df = pairs([(201, "comment", "t", 100, "d")], columns)
    good = q.run_suite(df, q.comment_suite(pairs([(100,)], "id bigint")))
    assert len(good) == 4 and all(r.passed for r in good)
    orphan = q.run_suite(df, q.comment_suite(pairs([(1,)], "id bigint")))
    assert [(r.name, r.severity) for r in orphan if not r.passed] == [
        ("check_referential_integrity", CRITICAL)
    ]


def test_enriched_suites(pairs):
    df = pairs(
        [(1, 1, 2, 3.0, True, 1), (2, 1, 2, None, True, 0)],
        "id bigint, score_velocity bigint, comment_velocity bigint, hours_to_peak double, "
        "is_long_tail boolean, observations_in_window bigint",
    )
    results = q.run_suite(df, q.enriched_story_suite())
    assert [r.passed for r in results] == [False, True, False, True]
    scored = pairs(
        [(1, 0.5, "positive"), (2, 1.5, "positive")], "id bigint, sentiment_score double, sentiment_label string"
    )
    assert [r.passed for r in q.run_suite(scored, q.enriched_comment_suite())] == [True, False, True]


def test_report(spark, pairs):
    results = q.run_suite(stories(pairs, (None, "s", "t", "d", -1, 1)), q.story_suite())
    report = q.build_report(q.check_table(spark, results), "2026-02-01", "now").first()
    assert (report.total_checks, report.passed_checks, report.failed_checks) == (5, 3, 2)
    assert report.has_critical_failures is True
    assert {k: tuple(v) for k, v in report.entities.items()} == {"unknown": (2, 2), "stories": (1, 0)}
    assert [c.name for c in report.checks][0] == "check_not_null"
    assert report.checks[0].affected_records == 1


def test_check_table_keeps_types(spark, pairs):
    results = q.run_suite(stories(pairs, (7, "s", "t", "d", -1, 1)), q.story_suite())
    table = q.check_table(spark, results)
    failed = table.where("not passed").first()
    assert failed.sample_ids == [7] and failed.details["column"] == "score"
    assert failed.details["max_value"] is None
    assert rows(table, "name")[0] == ("check_not_null",)


def test_counts_of_a_suite_are_one_query(pairs):
    measured = q.measurements(stories(pairs), q.story_suite())
    assert sorted(measured.columns) == ["m0", "m1", "m2", "m3", "total"]
    assert measured.count() == 1
