import random

import pytest
from pyspark.sql import functions as F

from helpers import plan
from threadlake.operators import quality
from threadlake.operators.quality import InRange, NotNull, RefersTo, Unique, Volume


@pytest.fixture(scope="module")
def frames(spark, tmp_path_factory):
    rng = random.Random(6)
    folder = str(tmp_path_factory.mktemp("keys"))
    # A third of the rows have one parent.
    rows = [
        (rng.choice([None, *range(40)]), rng.choice("abc"), 7 if i % 3 == 0 else rng.choice([None, *range(60)]), rng.choice([-1.0, 5.0, float("nan"), None]))
        for i in range(600)
    ]
    spark.createDataFrame(rows, "id int, kind string, parent int, score double").write.parquet(folder + "/c")
    parents = [(rng.choice([None, *range(0, 60, 2)]), str(i)) for i in range(90)]
    spark.createDataFrame(parents, "key long, name string").write.parquet(folder + "/p")
    return spark.read.parquet(folder + "/c"), spark.read.parquet(folder + "/p")


def specs(parent):
    return [
        NotNull(["id", "kind"]), Unique(["id", "kind"]), RefersTo(parent, "parent", "key"), InRange("score", min_value=0),
        Unique(["parent"]), RefersTo(parent, "id", "key"), Unique(["id"]), Volume("x", 5),
    ]


def test_together_as_one_by_one(spark, frames):
    child, parent = frames
    together = quality.run_suite(child, specs(parent))
    for spec, result in zip(specs(parent), together):
        assert [result] == quality.run_suite(child, [spec])
        if hasattr(spec, "query"):
            measured = child.select(F.lit(1)).limit(1).select(spec.query(child).scalar().alias("m")).first().m
            affected = measured["unmatched"] if isinstance(spec, RefersTo) else measured
            assert result.affected_records == affected
            if isinstance(spec, RefersTo):
                assert result.details["valid_parent_count"] == str(measured["parents"])


def test_rows_are_scanned_and_shuffled_once(frames):
    child, parent = frames
    text = plan(quality.measurements(child, specs(parent)))
    assert text.count("/c]") == 1 and text.count("/p]") == 2
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text


def test_keys_of_unlike_types_go_beside(spark, frames):
    child, parent = frames
    named = parent.where("name <> '3'")
    found = quality.run_suite(child, [RefersTo(named, "parent", "name"), Unique(["id"])])
    known = {int(r.name) for r in named.collect()}
    assert found[0].affected_records == sum(r.parent not in known for r in child.collect())


def test_empty_rows_and_parents(spark, frames):
    child, parent = frames
    none = quality.run_suite(child.limit(0), specs(parent))
    assert [r.affected_records for r in none] == [0, 0, 0, 0, 0, 0, 0, 5]
    orphans = quality.run_suite(child, [RefersTo(parent.limit(0), "parent", "key")])
    assert orphans[0].affected_records == 600 and orphans[0].details["valid_parent_count"] == "0"
