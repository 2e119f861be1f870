"""Idempotent writes."""

import pytest
from pyspark.sql import functions as F
from tests.conftest import day, rows

from cohortia import schemas
from cohortia.errors import InvalidDefinition
from cohortia.plans.segment_tables import read_targets
from cohortia.session import scratch_dir, staged
from cohortia.sources import files, sinks, tables

D1, D2 = day("2021-01-30"), day("2021-01-31")


def targets(spark, *specs):
    data = [(f"u{i}", d, v, s, g, "{}", 1.0) for i, (d, v, s, g) in enumerate(specs)]
    return spark.createDataFrame(data, schemas.TARGETS)


def keys(spark, path):
    return rows(read_targets(spark, path).select(F.col("date").cast("string"), "vendor", "source", "group"))


ODD = "a=b/c d:é[*]{x}%?"


def test_replacing_a_day(spark, folder):
    start = targets(spark, (D1, "x", "s", "001"), (D2, "x", "s", "001"), (D2, "x", "s", ODD), (D2, "x", "t", "9"), (D2, "y", "s", "001"))
    assert sinks.replace_day(start.filter("vendor = 'x' AND source = 's' AND date = '2021-01-30'"), folder, "x", "s", D1)
    sinks.overwrite_partitions(start, folder, sinks.TARGET_KEYS)
    assert keys(spark, folder)[("2021-01-31", "x", "s", ODD)] == 1
    fresh = targets(spark, (D2, "x", "s", "001"), (D2, "x", "s", "001"), (D2, "x", "s", "new"))
    for _ in range(2):
        assert sinks.replace_day(fresh, folder, "x", "s", D2)
        assert keys(spark, folder) == {
            ("2021-01-30", "x", "s", "001"): 1, ("2021-01-31", "x", "s", "001"): 2, ("2021-01-31", "x", "s", "new"): 1,
            ("2021-01-31", "x", "t", "9"): 1, ("2021-01-31", "y", "s", "001"): 1}


def test_replacing_every_source_of_a_day(spark, folder):
    sinks.overwrite_partitions(targets(spark, (D2, "c", "s", "1"), (D2, "c", "t", "1"), (D1, "c", "s", "1")), folder, sinks.TARGET_KEYS)
    assert sinks.replace_day(targets(spark, (D2, "c", "u", "2")), folder, "c", None, D2)
    assert keys(spark, folder) == {("2021-01-30", "c", "s", "1"): 1, ("2021-01-31", "c", "u", "2"): 1}


def test_no_rows_touch_nothing(spark, folder):
    start = targets(spark, (D2, "x", "s", "1"))
    sinks.overwrite_partitions(start, folder, sinks.TARGET_KEYS)
    assert not sinks.replace_day(start.filter("false"), folder, "x", "s", D2)
    assert keys(spark, folder) == {("2021-01-31", "x", "s", "1"): 1}


def test_replacing_listed_groups_only(spark, folder):
    start = targets(spark, (D2, "x", "s", ODD), (D2, "x", "s", "2"), (D2, "x", "s", "3"), (D1, "x", "s", "2"))
    sinks.overwrite_partitions(start, folder, sinks.TARGET_KEYS)
    listed = spark.createDataFrame([("x", "s", D2, ODD), ("x", "s", D2, "2")], "vendor string, source string, date date, group string")
    assert sinks.replace_targets(targets(spark, (D2, "x", "s", "2")), folder, listed)
    assert keys(spark, folder) == {
        ("2021-01-31", "x", "s", "2"): 1, ("2021-01-31", "x", "s", "3"): 1, ("2021-01-30", "x", "s", "2"): 1}


def test_partition_checks(spark, folder):
    columns = ["vendor", "date"]
    assert files.partitions(spark, f"{folder}/none", columns, schemas.TARGETS) is None
    assert not files.any_partition(spark, f"{folder}/none", columns, schemas.TARGETS, F.lit(True))
    sinks.overwrite_partitions(targets(spark, (D2, "x", "s", "1")), folder, sinks.TARGET_KEYS)
    for date, found in ((D2, True), (D1, False)):
        assert files.any_partition(spark, folder, columns, schemas.TARGETS, F.col("date") == F.lit(date)) is found


def test_snapshot_table_shows_the_newest_finished_version(spark, folder):
    table = sinks.SnapshotTable(spark, folder, schemas.ACTIVE_SEGMENTS)
    row = (1, "a", D1, None, None)
    table.create(spark.createDataFrame([row], schemas.ACTIVE_SEGMENTS))
    with pytest.raises(InvalidDefinition):
        table.create(table.read())
    table.write(table.read().withColumn("segment_name", F.lit("b")))
    assert table.read().first().segment_name == "b"
    files.delete(spark, f"{folder}/snapshot=2/_SUCCESS")  # as if the write had broken off
    assert table.read().first().segment_name == "a"


def test_scores_are_rewritten_not_added(spark, folder):
    scores = spark.createDataFrame([("a", 0.5, 1, D2, 7), ("b", 0.4, 2, D2, 7)], schemas.SCORES)
    for _ in range(2):
        sinks.write_scores(scores, folder)
    sinks.write_scores(scores.withColumn("tid", F.lit(8)), folder)
    assert rows(spark.read.parquet(folder).groupBy("tid").count()) == {(7, 2): 1, (8, 2): 1}
    one = tables.load_partition(spark, f"{folder}/date=2021-01-31/tid=8")
    assert one.count() == 2 and {"date", "tid"} <= set(one.columns)
    with pytest.raises(ValueError):
        tables.load_partition(spark, f"{folder}/tid=8/more")


def test_history_is_appended(spark, folder):
    row = sinks.response_row("w", "training", "success", D2, stats={"auc": 0.5}, error=ValueError("it's bad"))
    for _ in range(2):
        sinks.append_history(sinks.history_frame(spark, [row]), folder)
    stored = spark.read.schema(schemas.HISTORY).parquet(folder)
    assert stored.count() == 2 and stored.first().stats == '{"auc": 0.5}' and stored.first().error == "it's bad"


def test_staged_frames_cut_lineage(spark):
    df = spark.range(5).withColumn("x", F.col("id") * 2)
    again = staged(df)
    assert rows(again) == rows(df)
    assert "Range" not in again._jdf.queryExecution().toString()
    assert scratch_dir(spark)
