"""A: scans, B: sinks, C: projections and filters."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import functions as F

from checks import views as v
from checks.views import query
from cohortia import schemas
from cohortia.functions import ids
from cohortia.functions.aspects import aspect
from cohortia.operators import latest, reshape, segments
from cohortia.operators.scores import threshold_table
from cohortia.plans import reports, segment_tables
from cohortia.plans.targets import AudienceRatings, CustomTargets
from cohortia.session import scratch_dir
from cohortia.sources import files, identity, segment_files, sinks, tables

DAY = datetime.date(2024, 1, 5)


def scratch(spark, label):
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df, label, *keys, fmt="parquet"):
    """Store a frame in the shared folder, as a vendor would deliver it."""
    path = scratch(df.sparkSession, label)
    df.write.partitionBy(*keys).format(fmt).save(path)
    return path


# ---------------------------------------------------------------- A: scans


@query("a01_vendor_scan", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def _(spark, sf):
    events = tables.load(spark, f"{sf}/events.parquet", "parquet")
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("a02_feature_scan", "SELECT xid, feature_view, feature_click FROM v_features")
def _(spark, sf):
    path = written(v.v_features(spark, sf), "features", fmt="orc")
    return tables.load(spark, path, "orc").select("xid", "feature_view", "feature_click")


SNAPSHOT_DAY = datetime.date(2024, 1, 30)


@query("a03_feature_snapshot", """
SELECT xid, feature_view, coalesce(feature_cents, 0) AS feature_cents FROM v_features
WHERE last_seen_date = DATE '2024-01-30'""")
def _(spark, sf):
    rows = tables.feature_snapshot(v.v_features(spark, sf), SNAPSHOT_DAY)
    return rows.select("xid", "feature_view", "feature_cents")


@query("a04_training_scan", """
SELECT xid, target, coalesce(CASE WHEN feature_0 > 0 THEN feature_0 END, 0.0) AS feature_0,
       round(feature_1, 6) AS feature_1 FROM (
SELECT xid, target, round(feature_0, 6) AS feature_0, feature_1 FROM v_training)""")
def _(spark, sf):
    rows = v.v_training(spark, sf).withColumn("workflow_id", F.lit("w1"))
    rows = rows.withColumn("feature_0", F.when(F.col("feature_0") > 0, F.col("feature_0")))
    path = written(rows.unionByName(rows.withColumn("workflow_id", F.lit("w2"))), "sets", "workflow_id")
    return tables.training_set(spark.read.parquet(path), "w1").select(
        "xid", "target", "feature_0", "feature_1"
    )


LINES_SQL = """
SELECT mcid, array_to_string(segment_array, ' ') || CASE WHEN day(dt) % 10 = 7 THEN ' -' ELSE '' END AS segments
FROM v_membership WHERE day(dt) % 10 NOT IN (3, 9)"""


@query("a05_line_scan", "SELECT value, count(*) AS n FROM v_sync_lines GROUP BY value")
def _(spark, sf):
    lines = v.v_sync_lines(spark, sf).select("value")
    one, two = scratch(spark, "lines"), scratch(spark, "lines")
    lines.filter(F.col("value").startswith("n/a")).write.text(one)
    lines.filter(~F.col("value").startswith("n/a")).write.text(two)
    rows = segment_files.read_lines(spark, [one, two])
    return rows.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query("a06_manifest_names")
def _(spark, sf):
    names = v.v_files(spark, sf).agg(
        F.struct(
            F.collect_list(F.struct(F.regexp_replace("name", "info", "sync").alias("FileName"))).alias(
                "Files"
            )
        ).alias("m")
    )
    path = scratch(spark, "manifest")
    names.select("m.*").write.json(path)
    return segment_files.manifest_names(spark, path).select("name")


@query("a07_segment_list", """
SELECT DISTINCT k AS segment_id, 'seg_' || k AS segment_name, '2024-02-01' AS start_date FROM v_events""")
def _(spark, sf):
    entry = F.struct(F.col("k").cast("string").alias("SID"), F.concat(F.lit("seg_"), "k").alias("Name"))
    cells = v.v_events(spark, sf).groupBy("event_type").agg(
        F.to_json(F.collect_set(entry)).alias("value")
    )
    listed = segment_files.segment_list(cells, datetime.date(2024, 2, 1))
    return listed.select("segment_id", "segment_name", "start_date").distinct()


@query("a08_file_details", """
SELECT name, type, timestamp, CAST(dt AS VARCHAR) AS date FROM v_files""")
def _(spark, sf):
    return segment_files.described_files(v.v_files(spark, sf))


@query("a09_unprocessed_files", """
SELECT name, type, timestamp FROM v_files
WHERE timestamp > (SELECT max(timestamp) FROM v_files WHERE type = 'full') - 3600""")
def _(spark, sf):
    described = segment_files.described_files(v.v_files(spark, sf))
    return segment_files.unprocessed(described, None).drop("date")


@query("a10_days_present", """
SELECT CAST(d AS VARCHAR) AS dt, CAST(CAST(d AS DATE) IN (SELECT dt FROM v_identity) AS INTEGER) AS present
FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '2023-12-30', TIMESTAMP '2024-01-08', INTERVAL 1 DAY)) AS DATE) AS d)""")
def _(spark, sf):
    return identity.days_present(v.v_identity(spark, sf), datetime.date(2024, 1, 8), 10)


@query("a11_id_maps", """
SELECT DISTINCT 'mcid' AS kind, mapped_id AS id, fullvisitor_id FROM v_identity
WHERE type = 'adobe_mcid' AND dt BETWEEN DATE '2024-01-02' AND DATE '2024-01-04'
  AND regexp_matches(mapped_id, '\\b[0-9]{38}')
UNION SELECT DISTINCT 'xid', mapped_id, fullvisitor_id FROM v_identity
WHERE type = 'infinity_id' AND dt BETWEEN DATE '2024-01-02' AND DATE '2024-01-04'""")
def _(spark, sf):
    mcid, xid = identity.id_maps(v.v_identity(spark, sf), datetime.date(2024, 1, 4), 3)
    both = mcid.select(F.lit("mcid").alias("kind"), F.col("mcid").alias("id"), "fullvisitor_id")
    return both.union(xid.select(F.lit("xid"), "xid", "fullvisitor_id"))


@query("a12_ids_since", """
SELECT CAST(dt AS VARCHAR) AS date, type, count(*) AS n FROM v_identity
WHERE dt >= DATE '2024-01-03' GROUP BY dt, type""")
def _(spark, sf):
    rows = identity.ids_since(v.v_identity(spark, sf), datetime.date(2024, 1, 4), 1)
    return rows.groupBy("date", "type").agg(F.count(F.lit(1)).alias("n"))


@query("a13_orc_id_scan", "SELECT universal_id, id FROM v_crm")
def _(spark, sf):
    crm = v.v_crm(spark, sf).select("universal_id", F.col("id").alias("cust_id"))
    path = written(crm, "offline", fmt="orc")
    return tables.with_id(tables.load(spark, path, "orc"), "cust_id").select("universal_id", "id")


@query("a14_partition_scan", """
SELECT xid, round(CAST(score AS DOUBLE), 6) AS score, tid, CAST(date AS VARCHAR) AS date FROM v_scores WHERE tid = 1""")
def _(spark, sf):
    path = written(v.v_scores(spark, sf), "scores", "date", "tid")
    return tables.load_partition(spark, f"{path}/date={v.SCORE_DAY}/tid=1")


@query("a15_day_scan", """
SELECT event_type, count(*) AS n FROM v_events WHERE dt = DATE '2024-01-05' GROUP BY event_type""")
def _(spark, sf):
    path = written(v.v_events(spark, sf), "events", "dt")
    rows = tables.on_date(spark.read.parquet(path), DAY)
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("a16_optional_scan", """
SELECT 'present' AS state, count(*) AS n FROM events UNION ALL SELECT 'absent', 0""")
def _(spark, sf):
    held = tables.load_if_present(spark, f"{sf}/events.parquet")
    gone = tables.load_if_present(spark, f"{sf}/no_such_table.parquet")
    assert gone is None
    counted = held.agg(F.count(F.lit(1)).alias("n")).select(F.lit("present").alias("state"), "n")
    return counted.union(held.groupBy().agg(F.lit("absent"), F.lit(0).cast("bigint")))


@query("a17_score_scan", """
SELECT xid, round(CAST(score AS DOUBLE), 6) AS score FROM v_scores WHERE tid = 2""")
def _(spark, sf):
    return tables.scores_of(v.v_scores(spark, sf), v.SCORE_DAY, 2).select("xid", "score")


@query("a18_active_orders", "SELECT DISTINCT order_id FROM v_orders_dim WHERE active")
def _(spark, sf):
    return tables.active_orders(v.v_orders_dim(spark, sf))


@query("a19_external_score_scan", """
SELECT tid, count(*) AS n, min(xid) AS first_xid FROM v_scores GROUP BY tid HAVING tid = 0""")
def _(spark, sf):
    path = written(v.v_scores(spark, sf), "external", "date", "tid")
    rows = tables.load_partition(spark, f"{path}/date={v.SCORE_DAY}/tid=0")
    return rows.groupBy("tid").agg(F.count(F.lit(1)).alias("n"), F.min("xid").alias("first_xid"))


AS_OF = datetime.datetime(1998, 6, 1)
BEST_RUNS = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY workflow_id, stage
  ORDER BY (status <> 'success'), execution_date DESC) AS rn FROM v_history
  WHERE stage = '{stage}' AND execution_date <= TIMESTAMP '1998-06-01') WHERE rn = 1"""


@query("a20_stage_report", f"""
SELECT h.workflow_id, CAST(w.enabled AS INTEGER) AS enabled, w.trait_id, w.name, w.description AS ui_name, h.stage,
       CAST(h.arg_date AS VARCHAR) AS arg_date, CAST(CAST(h.execution_date AS DATE) AS VARCHAR) AS execution_date,
       h.status, h.info, h.stats, h.warnings, h.error, CAST(NULL AS VARCHAR) AS traceback
FROM ({BEST_RUNS.format(stage='training')}) h JOIN v_workflow w ON h.workflow_id = w.id""")
def _(spark, sf):
    return reports.stage_report(v.v_history(spark, sf), v.v_workflow(spark, sf), "training", as_of=AS_OF)


@query("a21_topic_list", """
SELECT DISTINCT 'feature_admantx_topics_shop_' || event_type || 'x' AS topic FROM v_events""")
def _(spark, sf):
    names = v.v_nested(spark, sf).select(F.explode("feature_admantx.name").alias("name")).distinct()
    path = scratch(spark, "topics")
    names.write.json(path)
    from cohortia.operators.features import topic_slugs

    return topic_slugs(tables.load(spark, path, "json", "name string"))


# ---------------------------------------------------------------- B: sinks


def weekly_targets(spark, sf):
    """All targets, dated by the Monday of their week: fewer, larger partitions."""
    week = F.date_trunc("week", "date").cast("date")
    return v.v_targets(spark, sf).withColumn("date", week)


WEEKLY = """weekly AS (SELECT xid, CAST(date_trunc('week', date) AS DATE) AS date, vendor, source, "group", aspect, value
  FROM v_targets)"""
WEEK = datetime.date(2024, 1, 8)


def stored_targets(spark, sf):
    path = scratch(spark, "targets")
    sinks.overwrite_partitions(weekly_targets(spark, sf), path, sinks.TARGET_KEYS)
    return path


TARGET_COUNTS = 'vendor, source, CAST(date AS VARCHAR) AS date, "group", count(*) AS n, round(sum(CAST(value AS DOUBLE)), 2) AS total'


def target_counts(rows):
    return rows.groupBy("vendor", "source", "date", "group").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("value").cast("double")), 2).alias("total")
    )


@query("b01_replace_day", f"""
WITH {WEEKLY} SELECT {TARGET_COUNTS} FROM weekly
WHERE NOT (vendor = 'dfp' AND source = 'view' AND date = DATE '2024-01-08') OR value > 60
   OR NOT EXISTS (SELECT 1 FROM weekly WHERE vendor = 'dfp' AND source = 'view' AND date = DATE '2024-01-08' AND value > 60)
GROUP BY vendor, source, date, "group" """)
def _(spark, sf):
    """Only high values are delivered again: groups without any must vanish."""
    path = stored_targets(spark, sf)
    fresh = weekly_targets(spark, sf).filter(
        (F.col("vendor") == "dfp") & (F.col("source") == "view") & (F.col("date") == WEEK) & (F.col("value") > 60)
    )
    for _ in range(2):  # a repeated run changes nothing
        sinks.replace_day(fresh, path, "dfp", "view", WEEK)
    return target_counts(segment_tables.read_targets(spark, path))


@query("b02_partitions_exist", """
SELECT vendor, CAST(bool_or(date > DATE '2024-01-29') AS INTEGER) AS found FROM v_targets GROUP BY vendor""")
def _(spark, sf):
    path = written(v.v_targets(spark, sf).select("xid", "vendor", "date"), "keys", "vendor", "date")
    keys = files.partitions(spark, path, ["vendor", "date"], "xid string, vendor string, date date")
    found = keys.groupBy("vendor").agg(F.max(F.col("date") > datetime.date(2024, 1, 29)).alias("found"))
    assert files.any_partition(
        spark, path, ["vendor"], "xid string, vendor string, date date", F.col("vendor") == "dfp"
    )
    return found


@query("b03_drop_vanished_groups", f"""
WITH {WEEKLY} SELECT {TARGET_COUNTS} FROM weekly
WHERE NOT (vendor = 'ncs' AND source = 'purchase' AND date = DATE '2024-01-08') OR "group" IN ('g1', 'g2')
GROUP BY vendor, source, date, "group" """)
def _(spark, sf):
    path = stored_targets(spark, sf)
    fresh = weekly_targets(spark, sf).filter(
        (F.col("vendor") == "ncs") & (F.col("source") == "purchase") & (F.col("date") == WEEK)
        & F.col("group").isin("g1", "g2")
    )
    sinks.replace_day(fresh, path, "ncs", "purchase", WEEK)
    return target_counts(segment_tables.read_targets(spark, path))


@query("b04_replace_dates_and_groups", f"""
WITH {WEEKLY} SELECT {TARGET_COUNTS} FROM (
SELECT * FROM weekly WHERE NOT (vendor = 'adobe' AND source = 'error' AND
  ((date = DATE '2024-01-08' AND "group" IN ('g1', 'g2')) OR (date = DATE '2024-01-15' AND "group" = 'g3')))
UNION ALL SELECT * FROM weekly WHERE vendor = 'adobe' AND source = 'error' AND date = DATE '2024-01-08' AND "group" = 'g1')
GROUP BY vendor, source, date, "group" """)
def _(spark, sf):
    path = stored_targets(spark, sf)
    days = spark.createDataFrame(
        [(WEEK, ["g1", "g2"]), (datetime.date(2024, 1, 15), ["g3"])],
        "processing_start_date date, segs_to_process array<string>",
    )
    fresh = weekly_targets(spark, sf).filter(
        (F.col("vendor") == "adobe") & (F.col("date") == WEEK) & (F.col("group") == "g1")
    )
    sinks.replace_targets(fresh, path, segments.replaced_partitions(days, "adobe", "error"))
    return target_counts(segment_tables.read_targets(spark, path))


@query("b05_write_scores", """
SELECT xid, round(CAST(score AS DOUBLE), 6) AS score, tid, 1 AS decile, CAST(date AS VARCHAR) AS date FROM v_scores""")
def _(spark, sf):
    path = scratch(spark, "scores")
    scores = v.v_scores(spark, sf).withColumn("decile", F.lit(1))
    for _ in range(2):
        sinks.write_scores(scores, path)
    return spark.read.schema(schemas.SCORES).parquet(path)


@query("b06_write_training_sets", """
SELECT workflow_id, count(*) AS n, CAST(sum(target) AS BIGINT) AS positives, round(sum(feature_3), 4) AS total
FROM (SELECT 'w' || target AS workflow_id, * FROM v_training) GROUP BY workflow_id""")
def _(spark, sf):
    path = scratch(spark, "sets")
    rows = v.v_training(spark, sf).withColumn("workflow_id", F.concat(F.lit("w"), "target"))
    for _ in range(2):
        sinks.write_training_sets(rows, path)
    return spark.read.parquet(path).groupBy("workflow_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("target").alias("positives"),
        F.round(F.sum("feature_3"), 4).alias("total"),
    )


CUTS = [0.2, 0.5, 0.9]
NAMES = ["top", "high", "mid", "low"]


@query("b07_write_thresholds", """
SELECT CAST(date AS VARCHAR) AS date, 7 AS tid, 'p1' AS pid, 'absolute' AS strategy,
       CASE WHEN score < 0.2 THEN 'top' WHEN score < 0.5 THEN 'high' WHEN score < 0.9 THEN 'mid' ELSE 'low' END AS bucket,
       round(CAST(min(score) AS DOUBLE), 6) AS min_score, round(CAST(max(score) AS DOUBLE), 6) AS max_score,
       round(avg(CAST(score AS DOUBLE)), 6) AS avg_score FROM v_scores GROUP BY date, bucket""")
def _(spark, sf):
    path = scratch(spark, "thresholds")
    table = threshold_table(v.v_scores(spark, sf), "absolute", CUTS, NAMES)
    table = table.select(
        "*", F.lit(v.SCORE_DAY).alias("date"), F.lit(7).alias("tid"), F.lit("p1").alias("pid")
    )
    for _ in range(2):
        sinks.write_thresholds(table, path)
    return spark.read.parquet(path)


@query("b08_write_membership", """
SELECT CAST(ref_date AS VARCHAR) AS ref_date, type, timestamp, mcid,
       array_to_string(segment_array, ' ') AS segment_array FROM v_membership""")
def _(spark, sf):
    path = scratch(spark, "membership")
    for _ in range(2):
        sinks.write_membership(v.v_membership(spark, sf), path)
    return segment_tables.read_membership(spark, path)


ADDED = 1000


def listed_segments(spark, sf):
    """Segments listed today: those that never end, and new ones, on one date."""
    stored = v.v_active_segments(spark, sf)
    day = F.lit(datetime.date(2024, 2, 1))
    old = stored.filter("last_processed_date IS NULL OR end_date IS NULL")
    new = stored.withColumn("segment_id", F.col("segment_id") + ADDED)
    none = F.lit(None).cast("date")
    return old.unionByName(new).select(
        "segment_id",
        F.concat(F.col("segment_name"), F.lit("_now")).alias("segment_name"),
        day.alias("start_date"),
        none.alias("end_date"),
        none.alias("last_processed_date"),
    )


LISTED_SQL = """
listed AS (SELECT segment_id, segment_name || '_now' AS segment_name, DATE '2024-02-01' AS start_date FROM v_active_segments
  WHERE last_processed_date IS NULL OR end_date IS NULL
  UNION ALL SELECT segment_id + 1000, segment_name || '_now', DATE '2024-02-01' FROM v_active_segments)"""
TEXT_DATES = """CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date,
       CAST(last_processed_date AS VARCHAR) AS last_processed_date"""


@query("b09_upsert_segments", f"""
WITH {LISTED_SQL}
SELECT segment_id, segment_name, {TEXT_DATES} FROM (
SELECT t.segment_id, coalesce(l.segment_name, t.segment_name) AS segment_name, t.start_date,
       CASE WHEN l.segment_id IS NULL AND t.end_date IS NULL THEN DATE '2024-01-31' ELSE t.end_date END AS end_date,
       t.last_processed_date
FROM v_active_segments t LEFT JOIN listed l ON t.segment_id = l.segment_id AND t.end_date IS NULL
UNION ALL SELECT l.segment_id, l.segment_name, l.start_date, NULL, NULL FROM listed l
WHERE NOT EXISTS (SELECT 1 FROM v_active_segments t WHERE t.segment_id = l.segment_id AND t.end_date IS NULL))""")
def _(spark, sf):
    table = segment_tables.segment_table(spark, scratch(spark, "segments"))
    table.create(v.v_active_segments(spark, sf))
    segment_tables.maintain_segments(table, listed_segments(spark, sf), datetime.date(2024, 2, 1))
    return table.read()


@query("b09_interleaved_writers", f"""
WITH {LISTED_SQL}, marked AS (SELECT * REPLACE (CASE WHEN end_date IS NULL THEN DATE '2024-02-03' ELSE last_processed_date END
  AS last_processed_date) FROM v_active_segments)
SELECT segment_id, segment_name, {TEXT_DATES} FROM (
SELECT t.segment_id, coalesce(l.segment_name, t.segment_name) AS segment_name, t.start_date,
       CASE WHEN l.segment_id IS NULL AND t.end_date IS NULL THEN DATE '2024-01-31' ELSE t.end_date END AS end_date,
       t.last_processed_date
FROM marked t LEFT JOIN listed l ON t.segment_id = l.segment_id AND t.end_date IS NULL
UNION ALL SELECT l.segment_id, l.segment_name, l.start_date, NULL, NULL FROM listed l
WHERE NOT EXISTS (SELECT 1 FROM marked t WHERE t.segment_id = l.segment_id AND t.end_date IS NULL))""")
def _(spark, sf):
    """A new listing is merged while another writer marks open segments as processed: both stay."""
    path = scratch(spark, "segments")
    table, other = segment_tables.segment_table(spark, path), segment_tables.segment_table(spark, path)
    table.create(v.v_active_segments(spark, sf))
    listed, day = listed_segments(spark, sf), datetime.date(2024, 2, 3)
    tries = []

    def mark(stored):
        changes = stored.filter("end_date IS NULL").withColumn("last_processed_date", F.lit(day))
        return sinks.mark_processed(stored, changes)

    def merge(stored):
        if not tries:
            other.update(mark)
        tries.append(stored)
        return sinks.upsert_segments(stored, segments.segment_changes(stored, listed, datetime.date(2024, 2, 1)))

    table.update(merge)
    assert len(tries) == 2
    return table.read()


@query("b10_mark_processed", """
SELECT segment_id, CAST(start_date AS VARCHAR) AS start_date,
       CASE WHEN end_date IS NULL THEN '2024-02-03' ELSE CAST(last_processed_date AS VARCHAR) END AS last_processed_date
FROM v_active_segments""")
def _(spark, sf):
    stored = v.v_active_segments(spark, sf)
    changes = stored.filter("end_date IS NULL").withColumn(
        "last_processed_date", F.lit(datetime.date(2024, 2, 3))
    )
    return sinks.mark_processed(stored, changes).select("segment_id", "start_date", "last_processed_date")


@query("b11_create_segments", "SELECT segment_id, segment_name FROM v_active_segments")
def _(spark, sf):
    table = segment_tables.segment_table(spark, scratch(spark, "segments"))
    table.create(v.v_active_segments(spark, sf))
    return table.read().select("segment_id", "segment_name")


@query("b12_append_history", """
SELECT stage, status, count(*) AS n, max(json_extract_string(info, '$.model_uri')) AS last_model
FROM v_history GROUP BY stage, status""")
def _(spark, sf):
    path = scratch(spark, "history")
    history = v.v_history(spark, sf)
    sinks.append_history(history.filter("status = 'success'"), path)
    sinks.append_history(history.filter("status <> 'success'"), path)
    rows = spark.read.schema(schemas.HISTORY).parquet(path)
    return rows.groupBy("stage", "status").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.get_json_object("info", "$.model_uri")).alias("last_model"),
    )


# ------------------------------------------------ C: projections and filters

MAPPED = """xid, CAST(date AS VARCHAR) AS date, 'nielsen' AS vendor, 'dar' AS source, "group", '{}' AS aspect,
       round(CAST(value AS DOUBLE), 6) AS value"""


@query("c01_map_schema", f"""
SELECT {MAPPED} FROM v_targets
WHERE regexp_matches(xid, '\\b[0-9a-f]{{8}}\\b-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-\\b[0-9a-f]{{12}}\\b')""")
def _(spark, sf):
    return AudienceRatings(DAY).targets(v.v_targets(spark, sf))


@query("c02_valid_xids", """
SELECT xid, count(*) AS n FROM (SELECT CASE WHEN source = 'error' THEN 'bad' WHEN source = 'view' THEN 'x ' || xid || ' y'
  ELSE xid END AS xid FROM v_targets)
WHERE regexp_matches(xid, '\\b[0-9a-f]{8}\\b-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-\\b[0-9a-f]{12}\\b') GROUP BY xid""")
def _(spark, sf):
    kind = F.col("source")
    rows = v.v_targets(spark, sf).select(
        F.when(kind == "error", "bad")
        .when(kind == "view", F.concat(F.lit("x "), "xid", F.lit(" y")))
        .otherwise(F.col("xid"))
        .alias("xid")
    )
    return ids.keep_valid_xids(rows).groupBy("xid").agg(F.count(F.lit(1)).alias("n"))


@query("c03_valid_mcids", """
SELECT mcid, count(*) AS n FROM (SELECT CASE WHEN day(dt) = 9 THEN substr(mcid, 2) ELSE mcid END AS mcid FROM v_membership)
WHERE regexp_matches(mcid, '\\b[0-9]{38}') GROUP BY mcid""")
def _(spark, sf):
    day = F.dayofmonth(F.timestamp_seconds("timestamp"))
    rows = v.v_membership(spark, sf).select(
        F.when(day == 9, F.substring("mcid", 2, 99)).otherwise(F.col("mcid")).alias("mcid")
    )
    return ids.keep_valid_mcids(rows).groupBy("mcid").agg(F.count(F.lit(1)).alias("n"))


@query("c04_dates", """
SELECT 'on' AS kind, count(*) AS n FROM v_events WHERE dt = DATE '2024-01-05'
UNION ALL SELECT 'since', count(*) FROM v_events WHERE dt >= DATE '2024-01-03'""")
def _(spark, sf):
    events = v.v_events(spark, sf)

    def counted(rows, kind):
        return rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "n")

    return counted(tables.on_date(events, DAY), "on").union(counted(tables.since(events, DAY, 2), "since"))


@query("c05_valid_on_date", """
SELECT segment_id FROM v_active_segments
WHERE start_date <= DATE '2024-01-05' AND (end_date IS NULL OR end_date >= DATE '2024-01-05')""")
def _(spark, sf):
    return v.v_active_segments(spark, sf).filter(segments.valid_on(DAY)).select("segment_id")


@query("c06_orders_filter", """
SELECT 'frame' AS kind, order_id, count(*) AS n FROM v_ad_events
WHERE order_id IN (SELECT order_id FROM v_orders_dim WHERE active) GROUP BY order_id
UNION ALL SELECT 'list', order_id, count(*) FROM v_ad_events WHERE order_id IN (3, 7, 11) GROUP BY order_id""")
def _(spark, sf):
    events = v.v_ad_events(spark, sf)
    orders = tables.active_orders(v.v_orders_dim(spark, sf))

    def counted(rows, kind):
        return rows.groupBy("order_id").agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(kind).alias("kind"), "order_id", "n"
        )

    return counted(tables.of_orders(events, orders), "frame").union(
        counted(tables.of_orders(events, [3, 7, 11]), "list")
    )


@query("c07_full_length_ids", """
SELECT infinity_id, count(*) AS n FROM v_clicks
WHERE length(infinity_id) = 36 AND content_id IS NOT NULL AND content_id <> '' GROUP BY infinity_id""")
def _(spark, sf):
    rows = ids.keep_full_length_ids(v.v_clicks(spark, sf), "infinity_id", "content_id")
    return rows.groupBy("infinity_id").agg(F.count(F.lit(1)).alias("n"))


@query("c08_array_size", """
SELECT mcid, timestamp, len(segment_array) AS n FROM v_membership WHERE len(segment_array) > 2""")
def _(spark, sf):
    rows = v.v_membership(spark, sf).filter(F.size("segment_array") > 2)
    return rows.select("mcid", "timestamp", F.size("segment_array").cast("bigint").alias("n"))


@query("c09_optional_source", """
SELECT 'one' AS kind, count(*) AS n FROM v_targets WHERE date = DATE '2024-01-05' AND source = 'signup'
UNION ALL SELECT 'all', count(*) FROM v_targets WHERE date = DATE '2024-01-05'""")
def _(spark, sf):
    targets = v.v_targets(spark, sf)

    def counted(source, kind):
        rows = CustomTargets(DAY, source=source).transform(targets)
        return rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "n")

    return counted("signup", "one").union(counted(None, "all"))


@query("c10_conditions", """
SELECT count(*) FILTER (regexp_matches(lower(hits_page_pagepath), 'coronavirus|covid') OR regexp_matches(lower(onsite_keywords), 'coronavirus|covid')) AS keyword,
       count(*) FILTER (lower(hits_eventinfo_eventaction) IN ('affiliate link clicks', 'amp link type: affiliate link', 'amp link type: buy button')) AS affiliate,
       infinity_id FROM v_clicks GROUP BY infinity_id""")
def _(spark, sf):
    from cohortia.plans.targets import affiliate_clickers, keyword_readers

    flags = {"keyword": keyword_readers(), "affiliate": affiliate_clickers()}
    return v.v_clicks(spark, sf).groupBy("infinity_id").agg(
        *[F.sum(F.when(g.condition, 1).otherwise(0)).alias(name) for name, g in flags.items()]
    )


@query("c11_templated_filter", """
SELECT xid, feature_view FROM v_features WHERE last_seen_date >= DATE '2024-01-30' AND feature_view > 5""")
def _(spark, sf):
    rows = tables.matching(
        v.v_features(spark, sf),
        "last_seen_date >= DATE('{date}') AND feature_view > {least}",
        date=datetime.date(2024, 1, 30),
        least=5,
    )
    return rows.select("xid", "feature_view")


@query("c12_prefix_projection", "SELECT xid, feature_view, feature_click, feature_cents FROM v_features")
def _(spark, sf):
    return tables.columns_with_prefix(v.v_features(spark, sf), "feature_", "xid")


@query("c13_rename_drop", """
SELECT xid AS user, feature_view AS feature__my_view, feature_click FROM v_features""")
def _(spark, sf):
    from cohortia.operators.features import tidy_names

    rows = v.v_features(spark, sf).drop("feature_cents", "last_seen_date")
    rows = rows.withColumnsRenamed({"feature_view": "Feature::My View.", "feature_click": "Feature_Click"})
    return reshape.rename(tidy_names(rows), {"xid": "user"})


@query("c14_prefix_rename", """
SELECT workflow_id, count(DISTINCT status) AS run_statuses, count(*) AS run_n FROM v_history GROUP BY workflow_id""")
def _(spark, sf):
    counted = v.v_history(spark, sf).groupBy("workflow_id").agg(
        F.count_distinct("status").alias("statuses"), F.count(F.lit(1)).alias("n")
    )
    return reshape.prefix_others(counted, "run_", ["workflow_id"])


@query("c15_distinct", """
SELECT 'all' AS kind, count(*) AS n FROM (SELECT DISTINCT type, dt FROM v_identity)
UNION ALL SELECT 'key', count(DISTINCT fullvisitor_id) FROM v_identity""")
def _(spark, sf):
    rows = v.v_identity(spark, sf)

    def counted(found, kind):
        return found.agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "n")

    return counted(rows.select("type", "dt").distinct(), "all").union(
        counted(rows.select("fullvisitor_id").dropDuplicates(["fullvisitor_id"]), "key")
    )


@query("c16_null_fill", """
SELECT xid, coalesce(CASE WHEN feature_view > 8 THEN feature_view END, 0) AS feature_view FROM v_features""")
def _(spark, sf):
    rows = v.v_features(spark, sf).select(
        "xid", F.when(F.col("feature_view") > 8, F.col("feature_view")).alias("feature_view")
    )
    return rows.fillna(0)


@query("c17_required_columns", """
SELECT xid, round(CAST(score AS DOUBLE), 6) AS score, CAST(date AS VARCHAR) AS date, tid, 5 AS decile FROM v_scores""")
def _(spark, sf):
    rows = v.v_scores(spark, sf).select("*", F.lit(5).alias("decile"), F.lit("x").alias("extra"))
    return tables.require_columns(rows, schemas.SCORES.names)


@query("c18_non_empty_guard", "SELECT count(*) AS n FROM v_events WHERE dt = DATE '2024-01-05'")
def _(spark, sf):
    rows = tables.require_rows(tables.on_date(v.v_events(spark, sf), DAY), "no events")
    return rows.agg(F.count(F.lit(1)).alias("n"))


@query("c19_literals", """
SELECT xid, '2024-02-01' AS date, 42 AS tid, 'dfp' AS vendor FROM v_scores""")
def _(spark, sf):
    return v.v_scores(spark, sf).select(
        "xid", F.lit(v.SCORE_DAY).alias("date"), F.lit(42).alias("tid"), F.lit("dfp").alias("vendor")
    )


__all__ = ["aspect", "latest", "LINES_SQL", "BEST_RUNS", "LISTED_SQL", "TEXT_DATES", "listed_segments", "written", "scratch"]
