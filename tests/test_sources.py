import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import plan, rows
from threadlake.operators.dedup import keep_last
from threadlake.schemas import RAW_STORY, TRACKING_STATE
from threadlake.session import shared_folder, stage, stage_bucketed
from threadlake.sources import readers, state, writers
from threadlake.sources.readers import ARRIVAL, read_dates, read_partition, read_table, read_window

DAY = "2026-02-07"
NUMBERS = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType())])


def put(lake, entity, date, name, lines, layer="raw"):
    folder = Path(lake.root) / layer / entity / f"ingestion_date={date}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines), encoding="utf-8")
    return folder / name


def numbers(spark, *ids):
    return spark.createDataFrame([(i, f"t{i}") for i in ids], NUMBERS)


def test_json_lines_with_blank_ones(spark, lake):
    put(lake, "stories", DAY, "a.json", ['{"id": 1, "score": 1.0}', "", "   ", '{"id": "x2", "dead": true}'])
    df = read_partition(spark, lake, "raw", "stories", DAY, RAW_STORY)
    assert rows(df, "id", "score", "dead", "ingestion_date") == [
        ("1", "1.0", None, DAY), ("x2", None, "true", DAY),
    ]


def test_missing_day_or_table_is_empty(spark, lake):
    put(lake, "stories", "2026-02-01", "a.json", ['{"id": 1}'])
    for entity in ("stories", "nothing"):
        for with_arrival in (False, True):
            df = read_partition(spark, lake, "raw", entity, DAY, RAW_STORY, with_arrival=with_arrival)
            assert df.count() == 0
            assert set(RAW_STORY.fieldNames()) <= set(df.columns)
    assert read_table(spark, lake, "output", "nothing", NUMBERS).count() == 0


def test_other_formats_are_passed_over(spark, lake):
    put(lake, "stories", DAY, "a.json", ['{"id": 1}'])
    put(lake, "stories", DAY, "b.csv", ["id", "7"])
    assert rows(read_partition(spark, lake, "raw", "stories", DAY, RAW_STORY), "id") == [("1",)]
    assert read_partition(spark, lake, "raw", "stories", DAY, RAW_STORY, "parquet").count() == 0


def test_bad_lines(spark, lake):
    put(lake, "stories", DAY, "a.json", ['{"id": 1}', '{"id": 2', '{"id": 3}'])
    put(lake, "stories", DAY, "b.json", ['{"id": 4}'])
    by_row = read_partition(spark, lake, "raw", "stories", DAY, RAW_STORY)
    assert rows(by_row, "id") == [("1",), ("3",), ("4",)]
    by_file = read_partition(spark, lake, "raw", "stories", DAY, RAW_STORY, bad="file")
    assert rows(by_file, "id") == [("4",)]
    assert by_file.count() == 1
    with pytest.raises(ValueError):
        read_partition(spark, lake, "raw", "stories", DAY, RAW_STORY, bad="ignore")


def test_damaged_parquet_is_an_error_or_left_out_whole(spark, lake):
    writers.write_partition(numbers(spark, 1, 2), lake, "processed", "n", DAY)
    put(lake, "n", DAY, "broken.parquet", ["not parquet at all, but long enough"], "processed")
    big = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    target = str(Path(lake.root) / "big")
    big.coalesce(1).write.option("parquet.block.size", 1 << 20).parquet(target)
    (file,) = Path(target).glob("*.parquet")
    raw = bytearray(file.read_bytes())
    middle = len(raw) * 3 // 4
    raw[middle : middle + 20_000] = b"\xff" * 20_000
    (Path(lake.root) / "processed" / "n" / f"ingestion_date={DAY}" / "half.parquet").write_bytes(raw)
    with pytest.raises(Exception):
        read_partition(spark, lake, "processed", "n", DAY, NUMBERS, "parquet").collect()
    whole = read_partition(spark, lake, "processed", "n", DAY, NUMBERS, "parquet", bad="file")
    assert rows(whole, "id") == [(1,), (2,)]


def test_every_line_is_accounted_for(spark, lake):
    put(lake, "stories", DAY, "a.json", ['{"id": 1}', '{"id": 2', '{"id": 3}'])
    lines = readers.read_lines(spark, lake, "raw", "stories", DAY, RAW_STORY)
    assert rows(lines.where("bad_line IS NOT NULL"), "bad_line") == [('{"id": 2',)]
    assert lines.where("bad_line IS NULL").select("id").count() == 2


def test_arrival_orders_files_then_lines(spark, lake):
    late = put(lake, "stories", DAY, "a.json", ['{"id": 1, "title": "newest"}'])
    early = put(lake, "stories", DAY, "b.json", ['{"id": 1, "title": "x"}', '{"id": 2, "title": "one"}', '{"id": 2, "title": "two"}'])
    os.utime(early, (1000, 1000))
    os.utime(late, (2000, 2000))
    df = read_partition(spark, lake, "raw", "stories", DAY, RAW_STORY, with_arrival=True)
    assert rows(keep_last(df, ["id"], [ARRIVAL]), "id", "title") == [("1", "newest"), ("2", "two")]
    os.utime(late, (1000, 1000))  # same time: the file name decides
    df = read_partition(spark, lake, "raw", "stories", DAY, RAW_STORY, with_arrival=True)
    assert rows(keep_last(df, ["id"], [ARRIVAL]), "id", "title") == [("1", "x"), ("2", "two")]


def test_only_the_wanted_days_are_read(spark, lake):
    for day in ("2026-01-30", "2026-01-31", "2026-02-03", "2026-02-06", DAY, "2026-02-08"):
        writers.write_partition(numbers(spark, int(day[-2:])), lake, "processed", "stories", day)
    window = read_window(spark, lake, "stories", DAY, 7, NUMBERS)
    assert rows(window, "id", "ingestion_date") == [(3, "2026-02-03"), (31, "2026-01-31"), (6, "2026-02-06")]
    assert len(window.inputFiles()) == 3
    assert read_dates(spark, lake, "processed", "stories", ["2020-01-01"], NUMBERS).count() == 0
    assert read_table(spark, lake, "processed", "stories", NUMBERS).count() == 6
    assert readers.days_before("2024-03-01", 2) == ["2024-02-28", "2024-02-29"]


def test_scan_prunes_columns_and_pushes_filters(spark, lake):
    writers.write_partition(numbers(spark, 1, 2), lake, "output", "stories", DAY)
    df = read_table(spark, lake, "output", "stories", NUMBERS).where(
        (F.col("ingestion_date") == DAY) & (F.col("id") > 1)
    ).select("id")
    text = plan(df)
    assert "ReadSchema: struct<id:bigint>" in text
    assert "PartitionFilters: [isnotnull(ingestion_date" in text
    assert "GreaterThan(id,1)" in text


def test_views_for_sql(spark, lake):
    writers.write_partition(numbers(spark, 1, 2), lake, "output", "stories", DAY)
    readers.register_views(spark, lake, "output", {"stories": NUMBERS}, DAY)
    assert spark.sql("SELECT sum(id) FROM stories").first()[0] == 3
    spark.catalog.dropTempView("stories")


def test_rerun_replaces_only_its_day(spark, lake):
    for day, ids in ((DAY, (1, 2)), ("2026-02-08", (3,)), (DAY, (9,))):
        writers.write_partition(numbers(spark, *ids), lake, "processed", "n", day)
    assert rows(read_table(spark, lake, "processed", "n", NUMBERS), "id", "ingestion_date") == [
        (3, "2026-02-08"), (9, DAY),
    ]


def test_raw_appends(spark, lake):
    for ids in ((1,), (2,)):
        writers.write_partition(numbers(spark, *ids), lake, "raw", "n", DAY, "json")
    assert rows(read_partition(spark, lake, "raw", "n", DAY, NUMBERS), "id") == [(1,), (2,)]


def test_guards(spark, lake):
    df = numbers(spark, 1)
    with pytest.raises(ValueError):
        writers.write_partition(df, lake, "attic", "n", DAY)
    with pytest.raises(ValueError):
        writers.write_partition(df, lake, "raw", "n", DAY, "xml")
    with pytest.raises(ValueError):
        read_partition(spark, lake, "reports", "n", DAY, NUMBERS)
    writers.write_partition(df, lake, "processed", "n", DAY)
    with pytest.raises(ValueError):
        writers.write_partition(df.where("false"), lake, "processed", "n", DAY)
    assert read_table(spark, lake, "processed", "n", NUMBERS).count() == 1


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_an_empty_rerun_empties_its_day(spark, lake, fmt):
    df = numbers(spark, 1)
    for day in (DAY, "2026-02-08"):
        writers.write_partition(df, lake, "processed", "n", day, fmt)
    with pytest.raises(writers.NothingToWrite):
        writers.write_partition(df.where("false"), lake, "processed", "n", DAY, fmt, replace_empty=True)
    table = lake.table("processed", "n")
    left = spark.read.option("header", True).format(fmt).load(table)
    assert {str(row.ingestion_date) for row in left.collect()} == {"2026-02-08"}


def test_json_is_utf8_and_bounded(spark, lake):
    df = spark.createDataFrame([(i, "é漢") for i in range(10)], NUMBERS).coalesce(1)
    writers.write_partition(df, lake, "raw", "n", DAY, "json", max_records_per_file=4)
    files = list((Path(lake.root) / "raw" / "n" / f"ingestion_date={DAY}").glob("*.json"))
    lines = [f.read_text(encoding="utf-8").splitlines() for f in files]
    assert sorted(map(len, lines)) == [2, 4, 4]
    assert "é漢" in lines[0][0] and json.loads(lines[0][0])["text"] == "é漢"


def test_csv_has_a_header_and_keeps_order(spark, lake):
    df = numbers(spark, 3, 1, 2).orderBy(F.desc("id"))
    writers.write_partition(df, lake, "reports", "n", DAY, "csv")
    files = sorted((Path(lake.root) / "reports" / "n" / f"ingestion_date={DAY}").glob("*.csv"))
    lines = [line for f in files for line in f.read_text().splitlines() if line != "id,text"]
    assert lines == ["3,t3", "2,t2", "1,t1"]


def test_manifest(spark, lake):
    writers.write_partition(numbers(spark, 1, 2), lake, "processed", "n", DAY, extras={"source_layer": "raw", "n": 5})
    writers.write_partition(numbers(spark, 1), lake, "raw", "n", DAY, "json")
    seen = {row.layer: row for row in spark.read.json(lake.manifest).collect()}
    row = seen["processed"]
    assert (row.entity, row.partition_date, row.format, row.compression) == ("n", DAY, "parquet", "snappy")
    assert (row.record_count, row.column_count) == (2, 2)
    assert row.extras.source_layer == "raw" and row.extras.n == "5"
    assert seen["raw"].format == "jsonl"


STATE = [(1, "2026-02-01", "2026-02-02", 5, 6)]


def test_state_snapshots(spark, lake):
    assert state.load_state(spark, lake, DAY).count() == 0
    first = spark.createDataFrame(STATE, TRACKING_STATE)
    state.save_state(first, lake, "2026-02-05")
    state.save_state(first.withColumn("story_id", F.lit(2).cast("bigint")), lake, "2026-02-06")
    state.save_state(first.withColumn("story_id", F.lit(3).cast("bigint")), lake, DAY)
    assert state.snapshot_dates(spark, lake) == ["2026-02-05", "2026-02-06", DAY]
    # the day's own snapshot is not its starting point
    assert rows(state.load_state(spark, lake, DAY), "story_id") == [(2,)]
    assert rows(state.load_state(spark, lake, "2026-02-06")) == STATE
    assert state.load_state(spark, lake, "2026-02-05").count() == 0


def test_an_empty_state_is_a_state(spark, lake):
    first = spark.createDataFrame(STATE, TRACKING_STATE)
    assert state.save_state(first, lake, "2026-02-05") == 1
    assert state.save_state(first.where("false"), lake, "2026-02-06") == 0
    assert state.load_state(spark, lake, DAY).count() == 0
    assert state.read_snapshot(spark, lake, "2026-02-05").count() == 1
    # A run again that leaves nothing replaces what was there.
    state.save_state(first.where("false"), lake, "2026-02-05")
    assert state.load_state(spark, lake, "2026-02-06").count() == 0
    assert rows(state.saved_states(spark, lake), "as_of", "stories") == [("2026-02-05", 0), ("2026-02-05", 1), ("2026-02-06", 0)]


def test_corrupt_state_is_an_error(spark, lake):
    state.save_state(spark.createDataFrame(STATE, TRACKING_STATE), lake, "2026-02-05")
    for file in (Path(lake.tracking) / "as_of=2026-02-05").glob("*.parquet"):
        file.write_bytes(b"no longer parquet, whatever its name says")
        crc = file.with_name(f".{file.name}.crc")
        crc.unlink(missing_ok=True)
    with pytest.raises(Exception):
        state.load_state(spark, lake, DAY).count()


def test_staging(spark):
    staged, count = stage(numbers(spark, 1, 2, 3).where("id > 1"), "x")
    assert count == 2 and rows(staged, "id") == [(2,), (3,)]
    assert stage(staged.where("false"), "none")[1] == 0
    assert shared_folder(spark).startswith(spark.sparkContext.getConf().get("spark.checkpoint.dir").rstrip("/"))


def test_bucketed_staging_saves_the_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        links, table = stage_bucketed(spark.range(100).withColumn("v", F.col("id") * 2), "id", "t", 4)
        other = spark.range(50).withColumnRenamed("id", "k")
        joined = other.join(links, F.col("k") == links["id"])
        assert plan(joined).count("Exchange hashpartitioning") == 1
        assert joined.count() == 50
        spark.sql(f"DROP TABLE {table}")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_spread_shuffles_only_what_has_few_splits(spark, lake):
    few = numbers(spark, *range(50)).coalesce(1)
    assert readers.spread(few).rdd.getNumPartitions() > spark.sparkContext.defaultParallelism
    assert readers.spread(few).count() == 50
    many = few.repartition(20)
    assert readers.spread(many) is many
