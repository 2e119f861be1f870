"""Versioned tables: pinned reads, replacement by key, interleaved writers."""

import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tests.conftest import day, rows

from cohortia import schemas
from cohortia.errors import Conflict, InvalidDefinition
from cohortia.plans import postprocessing
from cohortia.plans.workflow import Thresholds, Workflow
from cohortia.sources import files, sinks
from cohortia.sources.versioned import VersionedTable

D, E = day("2021-02-01"), day("2021-02-02")


def scores(spark, values, tid=1, date=D):
    data = [(f"u{i:04d}", v, 1, date, tid) for i, v in enumerate(values)]
    return spark.createDataFrame(data, schemas.SCORES)


def held(frame):
    return rows(frame.groupBy("date", "tid").agg(F.count(F.lit(1)), F.round(F.sum("score"), 4)))


def test_versions_stay_readable_while_partitions_are_replaced(spark, folder):
    table = sinks.score_table(spark, folder)
    assert table.version() == 0 and table.read().count() == 0 and table.partitions().count() == 0
    assert table.replace(scores(spark, [0.1, 0.2]).unionByName(scores(spark, [0.5], 2))) == 1
    old = table.read()
    assert table.replace(scores(spark, [0.4])) == 2
    assert held(old) == {(D, 1, 2, 0.3): 1, (D, 2, 1, 0.5): 1}
    assert held(table.read()) == {(D, 1, 1, 0.4): 1, (D, 2, 1, 0.5): 1}
    assert held(table.read(1)) == held(old)


def test_covered_partitions_vanish(spark, folder):
    table = sinks.score_table(spark, folder)
    table.replace(scores(spark, [0.1]).unionByName(scores(spark, [0.2], 2)).unionByName(scores(spark, [0.3], 3, E)))
    table.replace(scores(spark, [0.9], 2), covered=spark.createDataFrame([(D,)], "date date"))
    assert held(table.read()) == {(D, 2, 1, 0.9): 1, (E, 3, 1, 0.3): 1}
    table.replace(scores(spark, []), covered=spark.createDataFrame([(D, 2)], "date date, tid int"))
    assert held(table.read()) == {(E, 3, 1, 0.3): 1}


def test_odd_and_missing_keys(spark, folder):
    schema = T.StructType([T.StructField("x", T.IntegerType()), T.StructField("group", T.StringType())])
    table = VersionedTable(spark, folder, schema, ["group"])
    table.replace(spark.createDataFrame([(1, "a=b/c %25{[*]}"), (2, None), (3, "007")], schema))
    assert rows(table.read()) == {(1, "a=b/c %25{[*]}"): 1, (2, None): 1, (3, "007"): 1}
    table.replace(spark.createDataFrame([(4, None)], schema))
    assert rows(table.read()) == {(1, "a=b/c %25{[*]}"): 1, (4, None): 1, (3, "007"): 1}


def test_interleaved_replacements_lose_nothing(spark, folder, monkeypatch):
    one, two = sinks.score_table(spark, folder), sinks.score_table(spark, folder)
    publish = VersionedTable._publish

    def late(self, *args):
        if self is one and not two.version():
            two.replace(scores(spark, [0.7], 2))  # comes between reading the version and claiming the next
        return publish(self, *args)

    monkeypatch.setattr(VersionedTable, "_publish", late)
    assert one.replace(scores(spark, [0.1])) == 2
    assert held(one.read()) == {(D, 1, 1, 0.1): 1, (D, 2, 1, 0.7): 1}


def test_an_update_is_made_again_on_the_others_rows(spark, folder):
    table, calls = sinks.score_table(spark, folder), []
    table.replace(scores(spark, [0.25]))

    def doubled(now):
        calls.append(1)
        if len(calls) == 1:
            sinks.score_table(spark, folder).replace(scores(spark, [0.375]))
        return now.withColumn("score", F.col("score") * 2)

    assert table.update(doubled) == 3 and len(calls) == 2
    assert held(table.read()) == {(D, 1, 1, 0.75): 1}

    def always(now):
        sinks.score_table(spark, folder).replace(scores(spark, [0.5]))
        return now

    with pytest.raises(Conflict):
        table.update(always, tries=2)


def test_only_one_claim_succeeds(spark, folder):
    won, start = [], threading.Barrier(8)

    def claim(k):
        start.wait()
        if files.claim(spark, f"{folder}/claims/1", f"writer {k}"):
            won.append(k)

    threads = [threading.Thread(target=claim, args=(k,)) for k in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and files.read_text(spark, f"{folder}/claims/1") == f"writer {won[0]}"
    assert files.list_names(spark, f"{folder}/claims") == ["1"]


def test_vacuum_keeps_what_kept_versions_name(spark, folder):
    table = sinks.score_table(spark, folder)
    for k in range(4):
        table.replace(scores(spark, [k / 8], tid=k % 2))
    assert table.vacuum(older_than_hours=24) == [f"{folder}/versions/{n}" for n in (1, 2)]
    table.vacuum(keep=1, older_than_hours=0)
    assert held(table.read()) == {(D, 0, 1, 0.25): 1, (D, 1, 1, 0.375): 1}
    assert len(files.list_names(spark, f"{folder}/data")) == 2
    assert len(files.list_names(spark, f"{folder}/manifests")) == 1


def test_partitions_are_known_without_data_files(spark, folder):
    table = sinks.score_table(spark, folder)
    table.replace(scores(spark, [0.1]).unionByName(scores(spark, [0.2], 2, E)))
    newest = table.partitions().agg(F.max("date"))
    assert newest.first()[0] == E
    assert "/data" not in newest._jdf.queryExecution().toString()


SEGMENT = (1, "a", D, None, None)


def test_two_writers_of_the_segment_list_lose_no_update(spark, folder):
    table = sinks.SnapshotTable(spark, folder, schemas.ACTIVE_SEGMENTS)
    other = sinks.SnapshotTable(spark, folder, schemas.ACTIVE_SEGMENTS)
    table.create(spark.createDataFrame([SEGMENT], schemas.ACTIVE_SEGMENTS))
    calls = []

    def rename(stored):
        if not calls:  # another writer closes the segment while this one is at work
            other.update(lambda rows_: rows_.withColumn("end_date", F.lit(E)))
        calls.append(1)
        return stored.withColumn("segment_name", F.lit("b"))

    table.update(rename)
    row = table.read().first()
    assert (row.segment_name, row.end_date, len(calls)) == ("b", E, 2) and table.versions() == [1, 2, 3]
    table.expire(keep=1)
    assert table.versions() == [3] and table.read().first().segment_name == "b"


def test_a_writer_that_broke_off_after_its_claim_is_finished_by_the_next(spark, folder, monkeypatch):
    table = sinks.SnapshotTable(spark, folder, schemas.ACTIVE_SEGMENTS)
    table.create(spark.createDataFrame([SEGMENT], schemas.ACTIVE_SEGMENTS))
    with monkeypatch.context() as broken:
        broken.setattr(files, "move", lambda *a: False)
        table.write(table.read().withColumn("segment_name", F.lit("b")))
    assert table.read().first().segment_name == "b"
    with pytest.raises(InvalidDefinition):
        table.create(table.read())


# post-processing over a score table that changes


def flow(tid, *steps):
    cuts = Thresholds(f"p{tid}", "absolute", [0.5], ["low", "high"])
    return Workflow(f"w{tid}", f"wf_x_{tid}", tid, postprocessors=[cuts, *steps])


def deliver(spark, folder, values, tid):
    sinks.write_scores(scores(spark, values, tid), f"{folder}/external")


def ranges(spark, folder):
    table = spark.read.parquet(f"{folder}/thresholds")
    return {(r.tid, r.bucket): (round(r.min_score, 4), round(r.max_score, 4)) for r in table.collect()}


@pytest.mark.parametrize("kind", ["versioned", "folder"])
def test_a_rerun_cuts_from_the_new_external_scores_only(spark, folder, kind):
    to = sinks.score_table(spark, f"{folder}/scores") if kind == "versioned" else f"{folder}/scores"
    sinks.write_scores(scores(spark, [0.1, 0.9]).unionByName(scores(spark, [0.2, 0.3], 2)), to)
    flows = [flow(1), flow(2, postprocessing.ExternalScores("x", folder + "/external/date={date}/tid={tid}", to))]
    for values, expected in (
        ([0.1, 0.3, 0.4], {(2, "low"): (0.1, 0.4)}),
        ([0.6, 0.7, 0.8], {(2, "high"): (0.6, 0.8)}),
        ([0.6, 0.7, 0.8], {(2, "high"): (0.6, 0.8)}),
    ):
        deliver(spark, folder, values, 2)
        given = to if kind == "versioned" else spark.read.parquet(to)  # the frame read from the table itself
        reports = postprocessing.postprocess_all(given, flows, D, f"{folder}/thresholds")
        assert [r["status"] for r in reports] == ["success"] * 3, reports
        assert ranges(spark, folder) == {(1, "low"): (0.1, 0.1), (1, "high"): (0.9, 0.9), **expected}


def test_doubles_next_to_stored_floats_count_once(spark, folder):
    sinks.write_scores(scores(spark, [0.9]), f"{folder}/scores")
    deliver(spark, folder, [0.7], 2)
    frame = spark.createDataFrame([("u0000", 0.9, 1, D, 1)], "xid string, score double, decile int, date date, tid int")
    bring = postprocessing.ExternalScores("x", folder + "/external/date={date}/tid={tid}", f"{folder}/scores")
    postprocessing.postprocess_all(frame, [flow(1), flow(2, bring)], D, f"{folder}/thresholds")
    table = spark.read.parquet(f"{folder}/thresholds")
    assert {(r.tid, round(r.avg_score, 9)) for r in table.collect()} == {(1, 0.9), (2, 0.699999988)}


def test_an_external_file_of_several_traits(spark, folder):
    deliver(spark, folder, [0.7], 1)
    deliver(spark, folder, [0.2], 2)
    bring = postprocessing.ExternalScores("x", folder + "/external/date={date}", f"{folder}/scores")
    given = scores(spark, [0.1]).unionByName(scores(spark, [0.9], 2))
    postprocessing.postprocess_all(given, [flow(1, bring), flow(2)], D, f"{folder}/thresholds")
    assert ranges(spark, folder) == {(1, "high"): (0.7, 0.7), (2, "low"): (0.2, 0.2)}


def test_scores_that_cannot_be_read_fail_their_trait_alone(spark, folder):
    table = sinks.score_table(spark, f"{folder}/scores")
    for tid in (1, 2, 3):
        table.replace(scores(spark, [0.1, 0.9], tid))
    commit = table.partitions().filter("tid = 2").first().commit
    files.delete(spark, f"{folder}/scores/data/commit={commit}/date={D}/tid=2")
    broken = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/scores/data/commit={commit}/date={D}/tid=2/part-0.parquet")
    stream = broken.getFileSystem(spark._jsc.hadoopConfiguration()).create(broken)
    stream.write(bytearray(b"no parquet"))
    stream.close()
    reports = postprocessing.postprocess_all(table, [flow(1), flow(2), flow(3), flow(4)], D, f"{folder}/thresholds")
    assert [r["status"] for r in reports] == ["success", "failed_on_threshold", "success", "failed_on_threshold"]
    assert "no scores of trait 4" in reports[3]["error"] and '"scores_version": 3' in reports[0]["info"]
    assert {tid for tid, _ in ranges(spark, folder)} == {1, 3}
