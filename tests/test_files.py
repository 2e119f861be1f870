"""Segment files: parsing, batch ingest and the stream."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from tests.conftest import day, rows

from cohortia.errors import EmptyInput
from cohortia.operators import segments as seg
from cohortia.plans import segment_tables
from cohortia.sources import segment_files as sf
from cohortia.sources.ledger import Ledger
from cohortia.streaming.segment_ingest import ingest_stream

M1, M2, M3 = "1" * 38, "2" * 38, "3" * 38
DAY = 86400
NOON = 1612180800  # 2021-02-01 12:00 UTC


def drop(folder, kind, epoch, files):
    """One manifest and its data files."""
    name = f"S3_1_2_{kind}_{epoch * 1000}"
    listed = []
    for number, lines in enumerate(files):
        data = f"{name}-{number}.sync"
        Path(folder, data).write_text("\n".join(lines) + "\n")
        listed.append({"FileName": data, "FileByteSize": 1})
    Path(folder, f"{name}.info").write_text(json.dumps({"Files": listed, "Totals": {"n": 1}}, indent=2))


def stored(spark, path):
    table = segment_tables.read_membership(spark, path)
    return {(str(r.ref_date), r.type, r.timestamp, r.mcid): list(r.segment_array) for r in table.collect()}


def test_lines_are_parsed(spark):
    lines = [f"{M1} 1 22 x3", f"{M2}", "12 5", f"x{M1} 4", f"{M3} 7,9 9", ""]
    parsed = sf.parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert {r.mcid: r.segment_array for r in parsed.collect()} == {M1: [1, 22, None], M3: [7]}


def test_file_names(spark):
    names = spark.createDataFrame([("S3_1_2_iter_1612500023000.info",), ("a_full_1612500000000.info",),
                                   ("b_iter_1612411200999.info",)], "name string")
    found = [(r.type, r.timestamp, str(r.date)) for r in sf.described_files(names).orderBy("name").collect()]
    assert found == [("iter", 1612500023, "2021-02-04"), ("full", 1612500000, "2021-02-04"), ("iter", 1612411200, "2021-02-03")]


def test_unprocessed_files_start_at_the_newest_full_file(spark):
    names = [(f"x_{k}_{(NOON + i * DAY) * 1000}.info",) for i, k in enumerate(["full", "iter", "full", "iter"])]
    described = sf.described_files(spark.createDataFrame(names, "name string"))
    assert [r.type for r in sf.unprocessed(described, None).collect()] == ["full", "iter"]
    known = spark.createDataFrame([(NOON + 2 * DAY,)], "timestamp int")
    assert [r.timestamp for r in sf.unprocessed(described, known).collect()] == [NOON + 3 * DAY]


def test_reference_dates(spark):
    data = [("f", "full", 100, day("2021-02-01")), ("i1", "iter", 90, day("2021-01-31")), ("i2", "iter", 110, day("2021-02-01")),
            ("i3", "iter", 500, day("2021-02-05"))]
    files = spark.createDataFrame(data, "name string, type string, timestamp int, date date")
    known = spark.createDataFrame([(day("2021-01-07"),), (day("2021-03-01"),)], "ref_date date")

    def found(refs):
        return {r["name"]: str(r.ref_date) for r in seg.reference_dates(files, refs).collect()}

    assert found(known) == {"f": "2021-02-01", "i1": "2021-01-07", "i2": "2021-02-01", "i3": "2021-02-01"}
    assert found(None)["i1"] == "None"


def test_segment_list_from_one_cell(spark):
    cells = ['[{"SID": "5", "Name": "five, or so"}, {"SID": 6, "Name": "six"}]', '"[{""SID"": ""7"", ""Name"": ""seven""}]"']
    df = spark.createDataFrame([(c,) for c in cells], "value string")
    listed = sf.segment_list(df, day("2021-02-01"))
    assert rows(listed.select("segment_id", "segment_name")) == {(5, "five, or so"): 1, (6, "six"): 1, (7, "seven"): 1}


def test_batch_ingest_in_order_and_once(spark, folder):
    source, table = Path(folder, "in"), f"{folder}/out"
    source.mkdir()
    drop(source, "iter", NOON - 3 * DAY, [[f"{M1} 99"]])  # before the newest full file
    drop(source, "full", NOON, [[f"{M1} 1 2"], [f"{M2} 3"]])
    drop(source, "iter", NOON + DAY, [[f"{M1} 4"]])
    assert segment_tables.ingest_files(spark, str(source), table, 1, 0) == 2
    first = {("2021-02-01", "full", NOON, M1): [1, 2], ("2021-02-01", "full", NOON, M2): [3],
             ("2021-02-01", "iter", NOON + DAY, M1): [4]}
    assert stored(spark, table) == first
    assert segment_tables.ingest_files(spark, str(source), table, 1, 0) == 0
    drop(source, "iter", NOON + 2 * DAY, [[f"{M3} 5"]])
    assert segment_tables.ingest_files(spark, str(source), table, 1, 0) == 1
    assert stored(spark, table) == {**first, ("2021-02-01", "iter", NOON + 2 * DAY, M3): [5]}


def test_ingest_faults(spark, folder):
    only_iter, broken = Path(folder, "a"), Path(folder, "b")
    for path in (only_iter, broken):
        path.mkdir()
    drop(only_iter, "iter", NOON, [[f"{M1} 1"]])
    assert segment_tables.ingest_files(spark, str(only_iter), f"{folder}/ta", 1, 0) == 0  # no full file to start from
    drop(broken, "full", NOON, [[f"{M1} 1"]])
    next(broken.glob("*.sync")).write_text(f"{M1} 1\n")
    listed = next(broken.glob("*.info"))
    listed.write_text(listed.read_text().replace(".sync", "-gone.sync"))
    with pytest.raises(EmptyInput):
        segment_tables.ingest_files(spark, str(broken), f"{folder}/tb", 1, 0)
    with pytest.raises(EmptyInput):
        sf.read_lines(spark, [f"{folder}/nowhere.sync"], tries=2, wait_seconds=0)


def test_stream_equals_batch_over_several_runs(spark, folder):
    source, table, state = Path(folder, "in"), f"{folder}/out", f"{folder}/state"
    source.mkdir()
    drop(source, "iter", NOON - 3 * DAY, [[f"{M1} 99"]])
    drop(source, "full", NOON, [[f"{M1} 1 2"], [f"{M2} 3"]])
    ingest_stream(spark, str(source), table, state, 1, 0)
    first = {("2021-02-01", "full", NOON, M1): [1, 2], ("2021-02-01", "full", NOON, M2): [3]}
    assert stored(spark, table) == first
    # an incremental file refers to the full file that arrives in the same run
    drop(source, "iter", NOON + DAY, [[f"{M1} 4"]])
    drop(source, "full", NOON + 9 * DAY, [[f"{M1} 5"]])
    drop(source, "iter", NOON + 10 * DAY, [[f"{M2} 6"]])
    for _ in range(2):
        ingest_stream(spark, str(source), table, state, 1, 0)
    assert stored(spark, table) == {
        **first, ("2021-02-01", "iter", NOON + DAY, M1): [4],
        ("2021-02-10", "full", NOON + 9 * DAY, M1): [5], ("2021-02-10", "iter", NOON + 10 * DAY, M2): [6]}


def breaking_off(monkeypatch, target, name):
    """Let the target do its work once and then fail, as a driver that is lost."""
    work, calls = getattr(target, name), []

    def once(*args, **kwargs):
        result = work(*args, **kwargs)
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("lost")
        return result

    monkeypatch.setattr(target, name, once)


@pytest.mark.parametrize("where", ["before the write", "after the write", "after the mark"])
def test_a_replayed_batch_leaves_the_same_table(spark, folder, monkeypatch, where):
    source, table, state = Path(folder, "in"), f"{folder}/out", f"{folder}/state"
    source.mkdir()
    drop(source, "iter", NOON - 3 * DAY, [[f"{M1} 99"]])
    drop(source, "full", NOON, [[f"{M1} 1 2"]])
    drop(source, "iter", NOON + DAY, [[f"{M1} 4"]])
    with monkeypatch.context() as patched:
        target, name = {
            "before the write": (Ledger, "add"), "after the write": (segment_tables, "store_manifests"),
            "after the mark": (Ledger, "mark_done"),
        }[where]
        breaking_off(patched, target, name)
        with pytest.raises(Exception):  # noqa: B017
            ingest_stream(spark, str(source), table, state, 1, 0)
        drop(source, "iter", NOON + 2 * DAY, [[f"{M2} 5"]])
        ingest_stream(spark, str(source), table, state, 1, 0)
    ingest_stream(spark, str(source), table, state, 1, 0)
    expected = {("2021-02-01", "full", NOON, M1): [1, 2], ("2021-02-01", "iter", NOON + DAY, M1): [4],
                ("2021-02-01", "iter", NOON + 2 * DAY, M2): [5]}
    assert stored(spark, table) == expected
    assert Ledger(spark, f"{table}_ledger").open_entries() == []


def test_an_old_file_that_comes_late_is_left_out(spark, folder):
    source, table, state = Path(folder, "in"), f"{folder}/out", f"{folder}/state"
    source.mkdir()
    drop(source, "full", NOON, [[f"{M1} 1 2"]])
    ingest_stream(spark, str(source), table, state, 1, 0)
    before = stored(spark, table)
    drop(source, "iter", NOON - 5 * DAY, [[f"{M1} 99"]])
    drop(source, "full", NOON - 2 * DAY, [[f"{M1} 98"]])
    ingest_stream(spark, str(source), table, state, 1, 0)
    assert stored(spark, table) == before
    ingest_stream(spark, str(source), table, f"{folder}/another-state", 1, 0)  # delivers all of them again
    assert stored(spark, table) == before
    assert segment_tables.ingest_files(spark, str(source), table, 1, 0) == 0


def test_files_before_the_first_full_one_wait(spark, folder):
    source, table, state = Path(folder, "in"), f"{folder}/out", f"{folder}/state"
    source.mkdir()
    drop(source, "iter", NOON + DAY, [[f"{M1} 4"]])
    drop(source, "iter", NOON - 3 * DAY, [[f"{M1} 99"]])
    for _ in range(2):
        ingest_stream(spark, str(source), table, state, 1, 0)
    assert segment_tables.read_membership(spark, table) is None
    drop(source, "full", NOON, [[f"{M1} 1 2"]])
    ingest_stream(spark, str(source), table, state, 1, 0)
    assert stored(spark, table) == {
        ("2021-02-01", "full", NOON, M1): [1, 2], ("2021-02-01", "iter", NOON + DAY, M1): [4]}


def test_a_batch_run_finishes_what_a_lost_one_has_decided(spark, folder, monkeypatch):
    source, table = Path(folder, "in"), f"{folder}/out"
    source.mkdir()
    drop(source, "full", NOON, [[f"{M1} 1 2"]])
    with monkeypatch.context() as patched:
        breaking_off(patched, Ledger, "add")
        with pytest.raises(RuntimeError):
            segment_tables.ingest_files(spark, str(source), table, 1, 0)
    assert segment_tables.read_membership(spark, table) is None
    assert segment_tables.ingest_files(spark, str(source), table, 1, 0) == 0  # stored by finishing the open entry
    assert stored(spark, table) == {("2021-02-01", "full", NOON, M1): [1, 2]}


def test_newest_file_and_full_dates_come_from_folder_names(spark, folder):
    source, table = Path(folder, "in"), f"{folder}/out"
    assert segment_tables.membership_partitions(spark, table) is None
    source.mkdir()
    drop(source, "full", NOON, [[f"{M1} 1 2"]])
    drop(source, "iter", NOON + DAY, [[f"{M1} 4"]])
    segment_tables.ingest_files(spark, str(source), table, 1, 0)
    known = segment_tables.membership_partitions(spark, table)
    assert seg.latest_full_date(known) == day("2021-02-01") and seg.latest_file_date(known).first()[0] == day("2021-02-02")
    assert "FileScan" not in seg.latest_file_date(known)._jdf.queryExecution().toString()


def test_manifest_names_ignore_key_case(spark, folder):
    path = Path(folder, "m.info")
    path.write_text('{"Files": [\n {"Filename": "a.sync"}, {"Filename": "b.sync"}]}')
    assert [r.name for r in sf.manifest_names(spark, str(path)).collect()] == ["a.sync", "b.sync"]


def test_local_date_has_no_daylight_saving(spark):
    epochs = [1612500023, 1625112000, 1625115599 - 3600 * 8]
    df = spark.createDataFrame([(e,) for e in epochs], "e int")
    assert [str(r[0]) for r in df.select(sf.local_date(F.col("e"))).collect()] == ["2021-02-04", "2021-06-30", "2021-06-30"]
