"""Segment planning and the id bridge on small worked examples."""

import random

import pytest
from pyspark.sql import functions as F
from tests.conftest import day, rows

from cohortia import schemas
from cohortia.errors import EmptyInput
from cohortia.operators import identity
from cohortia.operators import segments as seg
from cohortia.plans import adobe, segment_tables
from cohortia.sources import sinks

FULL, RUN, BACKFILL = day("2021-02-01"), day("2021-02-04"), 35
X1, X2 = "00000000-0000-0000-0000-000000000001", "00000000-0000-0000-0000-000000000002"


@pytest.fixture(scope="module")
def active(spark):
    start = day("2021-01-31")
    data = [(10, "new", start, None, None), (20, "ahead", start, None, day("2021-02-02")),
            (30, "behind", start, None, day("2021-01-30")), (40, "next", start, None, day("2021-02-01"))]
    return spark.createDataFrame(data, schemas.ACTIVE_SEGMENTS)


@pytest.fixture(scope="module")
def membership(spark):
    full, old = day("2021-02-01"), day("2021-01-07")
    data = [(full, "full", 1612200000, "C", [30, 10]), (full, "iter", 1612300000, "D", [30, 40]),
            (full, "iter", 1612400000, "C", [30, 10]), (full, "iter", 1612500000, "D", []),
            (old, "full", 1610079790, "A", [80, 129])]
    return spark.createDataFrame(data, schemas.MEMBERSHIP)


def test_validity_interval(spark):
    data = [(1, "a", day("2021-02-05"), None, None), (2, "b", day("2021-01-01"), day("2021-02-03"), None),
            (3, "c", day("2021-01-01"), day("2021-02-04"), None), (4, "d", day("2021-02-04"), None, None)]
    table = spark.createDataFrame(data, schemas.ACTIVE_SEGMENTS)
    assert rows(table.filter(seg.valid_on(RUN)).select("segment_id")) == {(3,): 1, (4,): 1}


def test_processing_start(active):
    starts = seg.active_on(active, RUN, FULL).select("segment_id", F.col("processing_start_date").cast("string"))
    assert dict(starts.collect()) == {10: "2021-02-01", 20: "2021-02-03", 30: "2021-02-01", 40: "2021-02-02"}


def test_days_and_running_segments(active):
    started = seg.segments_to_start(seg.active_on(active, RUN, FULL), FULL, RUN, BACKFILL)
    assert {str(d): s for d, s in started.collect()} == {
        "2021-02-01": [10, 30], "2021-02-02": [40], "2021-02-03": [20], "2021-02-04": None}
    assert {str(d): s for d, s in seg.accumulate_segments(started).collect()} == {
        "2021-02-01": [10, 30], "2021-02-02": [10, 30, 40],
        "2021-02-03": [10, 20, 30, 40], "2021-02-04": [10, 20, 30, 40]}


def test_backfill_is_capped_and_empty_spans_fail(active):
    capped = seg.days_and_segments(seg.active_on(active, RUN, FULL), FULL, RUN, 1)
    assert capped.count() == 2
    late = active.filter("segment_id = 20")
    with pytest.raises(EmptyInput):
        seg.days_and_segments(seg.active_on(late, RUN, FULL), FULL, day("2021-02-02"), BACKFILL)


def test_latest_dates(membership):
    assert seg.latest_full_date(membership) == FULL
    assert str(seg.latest_file_date(membership).first()[0]) == "2021-02-04"


def selected(membership, active):
    days = seg.days_and_segments(seg.active_on(active, RUN, FULL), FULL, RUN, BACKFILL)
    return seg.selected_segments(membership, days, FULL)


def test_membership_meets_wanted_segments(membership, active):
    found = {(str(r[0]), r[1]): sorted(r[2]) for r in selected(membership, active).collect()}
    assert found == {("2021-02-01", "C"): [10, 30], ("2021-02-02", "D"): [30, 40], ("2021-02-03", "C"): [10, 30]}


def test_bridge_and_names(spark, membership, active):
    mcid = spark.createDataFrame([("C", "v1"), ("C", "v1"), ("C", "v9"), ("D", "v2")], "mcid string, fullvisitor_id string")
    xid = spark.createDataFrame([(X1, "v1"), (X1, "v9"), (X2, "v2")], "xid string, fullvisitor_id string")
    users = identity.user_segments(selected(membership, active), mcid, xid)
    assert {(str(r[0]), r[1]): r[2] for r in users.collect()} == {
        ("2021-02-01", X1): [10, 30], ("2021-02-02", X2): [30, 40], ("2021-02-03", X1): [10, 30]}
    named = seg.exploded_targets(users, active)
    assert named.count() == 6
    assert (X2, day("2021-02-02"), 40, "next") in rows(named)


def plain_bridge(selected, mcid, xid):
    """The bridge by rows of one segment each."""
    one = selected.select("processing_start_date", "mcid", F.explode("segment_select").alias("group"))
    return one.join(mcid, "mcid").join(xid, "fullvisitor_id").select("processing_start_date", "xid", "group").distinct()


def many_members(spark):
    """300 segments in five words, ids far apart, and one visitor with a third of all rows."""
    rnd = random.Random(3)
    known = sorted(rnd.sample(range(-500, 10**6), 300))
    members = [
        (day(f"2021-02-0{rnd.randrange(1, 5)}"), f"m{i}", rnd.sample(known, rnd.randrange(0, 9)) + known[-1:] * (i % 2))
        for i in range(900)
    ]
    mcid = [(f"m{i}", "hot" if i % 3 == 0 else f"v{i % 50}") for i in range(900)] + [("m1", "v1"), ("m1", "v1")]
    xid = [(f"x{i}", "hot" if i < 200 else f"v{i % 50}") for i in range(600)]
    return (
        spark.createDataFrame(members, "processing_start_date date, mcid string, segment_select array<int>"),
        spark.createDataFrame(mcid, "mcid string, fullvisitor_id string"),
        spark.createDataFrame(xid, "xid string, fullvisitor_id string"),
        known,
    )


def test_bridge_by_bits_equals_rows_of_segments(spark):
    selected, mcid, xid, known = many_members(spark)
    expected = rows(plain_bridge(selected, mcid, xid))
    assert rows(identity.bridge_segments(selected, mcid, xid, known)) == expected
    assert rows(identity.bridge_segments(selected, mcid, xid)) == expected
    users = identity.user_segments(selected, mcid, xid, known).collect()
    assert all(row.segment_select == sorted(row.segment_select) for row in users)
    assert rows(identity.user_segments(selected.limit(0), mcid, xid)) == {}
    with pytest.raises(Exception, match="unknown segment"):
        identity.user_segments(selected, mcid, xid, known[:-1]).collect()


def test_bridge_shuffles_no_rows_of_segments_and_splits_hot_visitors(spark):
    selected, mcid, xid, known = many_members(spark)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    hot = spark.range(20_000).selectExpr("concat('h', id) as xid", "'hot' as fullvisitor_id")
    xid = xid.unionByName(hot)
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        users = identity.user_segments(selected.repartition(4), mcid, xid.repartition(4), known)
        got = {(r[0], r[1]): r[2] for r in users.collect()}
        plan = users._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert "skew=true" in plan and "explode" not in plan
    assert sum(map(len, got.values())) == plain_bridge(selected, mcid, xid).count()


def test_segment_targets_end_to_end(spark, membership, active, folder):
    pairs = [("1" * 38, "v1", "adobe_mcid"), (X1, "v1", "infinity_id"), ("bad", "v1", "infinity_id")]
    ids = spark.createDataFrame([(RUN, v, t, m) for m, v, t in pairs], "dt date, fullvisitor_id string, type string, mapped_id string")
    members = membership.withColumn("mcid", F.when(F.col("mcid") == "C", "1" * 38).otherwise(F.col("mcid")))
    config = adobe.SegmentTargets(RUN, active=active, identity=ids)
    targets = config.targets(members)
    assert targets.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.TARGETS]
    assert rows(targets.select("xid", F.col("date").cast("string"), "group", "aspect", "value")) == {
        (X1, d, g, '{"name":"%s"}' % n, 1.0): 1
        for d in ("2021-02-01", "2021-02-03") for g, n in (("10", "new"), ("30", "behind"))}
    assert config.write(targets, folder)
    assert segment_tables.read_targets(spark, folder).count() == 4
    with pytest.raises(EmptyInput):
        adobe.SegmentTargets(day("2021-05-01"), active=active, identity=ids).transform(members)
    with pytest.raises(EmptyInput):
        adobe.SegmentTargets(RUN, active=active.filter("false"), identity=ids).transform(members)
    with pytest.raises(EmptyInput):
        adobe.SegmentTargets(RUN, active=active, identity=ids.filter("false")).transform(members)


def listing(spark, *ids):
    run = day("2021-02-01")
    return spark.createDataFrame([(i, f"s{i}", run, None, None) for i in ids], schemas.ACTIVE_SEGMENTS)


def test_segment_changes(spark):
    stored = listing(spark, 1, 2, 3).withColumn("last_processed_date", F.lit(day("2021-01-30")))
    run = day("2021-02-01")
    assert rows(seg.segment_changes(stored, listing(spark, 1, 2, 3), run)) == rows(listing(spark, 1, 2, 3))
    assert rows(seg.segment_changes(stored, listing(spark, 1, 2, 3, 4), run)) == rows(listing(spark, 1, 2, 3, 4))
    removed = seg.segment_changes(stored, listing(spark, 1, 2), run).filter("segment_id = 3").first()
    assert (str(removed.end_date), str(removed.last_processed_date)) == ("2021-01-31", "2021-01-30")


def test_upsert_keeps_closed_rows_and_start_dates(spark):
    a, b = day("2021-01-01"), day("2021-01-20")
    stored = spark.createDataFrame(
        [(1, "old", a, None, b), (2, "two", a, None, b), (3, "closed", a, b, b)], schemas.ACTIVE_SEGMENTS)
    changes = spark.createDataFrame(
        [(1, "renamed", b, None, None), (2, "two", a, b, b), (3, "again", b, None, None), (4, "four", b, None, None)],
        schemas.ACTIVE_SEGMENTS)
    assert rows(sinks.upsert_segments(stored, changes)) == {
        (1, "renamed", a, None, b): 1, (2, "two", a, b, b): 1, (3, "closed", a, b, b): 1,
        (3, "again", b, None, None): 1, (4, "four", b, None, None): 1}


def test_upkeep_of_the_segment_table(spark, membership, folder):
    run = day("2021-02-01")
    table = segment_tables.segment_table(spark, folder)
    assert table.read() is None
    targets = spark.createDataFrame(
        [(X1, day("2021-02-02"), "adobe", "mcid", "1", "{}", 1.0), (X1, day("2021-01-02"), "adobe", "mcid", "2", "{}", 1.0)],
        schemas.TARGETS)
    segment_tables.maintain_segments(table, listing(spark, 1, 2), run, targets, membership)
    assert {r.segment_id: str(r.last_processed_date) for r in table.read().collect()} == {1: "2021-02-02", 2: "None"}
    segment_tables.maintain_segments(table, listing(spark, 2, 5), run)
    assert {r.segment_id: str(r.end_date) for r in table.read().collect()} == {1: "2021-01-31", 2: "None", 5: "None"}
    with pytest.raises(EmptyInput):
        segment_tables.advance_processed(table, membership, targets, day("2021-03-01"))
    segment_tables.advance_processed(table, membership, targets, day("2021-02-02"))
    # closed segments advance too
    assert {str(r.last_processed_date) for r in table.read().collect()} == {"2021-02-04"}
