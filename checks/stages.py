"""M: vendor targets, segment upkeep, reports; O: the streaming ingest."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from checks import views as v
from checks.joins import (
    ACTIVE_SQL, AS_OF, BEST_RUNS, BRIDGE_SQL, COUNTS_SQL, FULL, HISTORY_DAY, REPORT, RESOLVED_SQL,
    RUN, SEGMENT_TARGETS, STALE_DAY, STALE_SQL, ids_by_date, offline_tables, segment_targets,
)
from checks.scans import LISTED_SQL, TARGET_COUNTS, TEXT_DATES, listed_segments, scratch, target_counts
from checks.views import query
from cohortia.errors import EmptyInput
from cohortia.operators import segments
from cohortia.plans import adobe, reports, segment_tables
from cohortia.plans import targets as vendors
from cohortia.sources import sinks, tables
from cohortia.sources.ledger import Ledger
from cohortia.streaming.segment_ingest import ingest_stream

DAY = datetime.date(2024, 1, 3)


def segment_run(spark, sf):
    config = adobe.SegmentTargets(RUN, active=v.v_active_segments(spark, sf), identity=v.v_identity(spark, sf))
    return config, config.targets(v.v_membership(spark, sf))


@query("m01_segment_targets", f"""
WITH {BRIDGE_SQL} SELECT b.xid, CAST(b.day AS VARCHAR) AS date, 'adobe' AS vendor, 'mcid' AS source,
  CAST(b.segment_id AS VARCHAR) AS "group", '{{"name":"' || a.segment_name || '"}}' AS aspect, CAST(1 AS DOUBLE) AS value
FROM bridged b JOIN active a USING (segment_id)""")
def _(spark, sf):
    return segment_run(spark, sf)[1]


@query("m02_processing_start", f"""
WITH {ACTIVE_SQL} SELECT segment_id, CAST(start AS VARCHAR) AS processing_start_date FROM active""")
def _(spark, sf):
    rows = segments.active_on(v.v_active_segments(spark, sf), RUN, FULL)
    return rows.select("segment_id", "processing_start_date")


# Drops arrive on the days of v_files; each drop is one manifest and two data files.
DROPS_SQL = """
SELECT CAST(max(CASE WHEN f.type = 'full' THEN f.dt END) OVER (ORDER BY f.timestamp RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS VARCHAR) AS ref_date,
  f.type, f.timestamp, m.mcid, array_to_string(m.segment_array, ' ') AS segment_array
FROM v_files f JOIN v_membership m ON m.timestamp = f.timestamp
WHERE f.timestamp > (SELECT max(timestamp) FROM v_files WHERE type = 'full') - 3600"""


def deliver(spark, sf):
    """Write every drop as a vendor would: two text files and a JSON manifest per day."""
    folder = scratch(spark, "drops")
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    names = v.v_files(spark, sf).select(
        F.regexp_replace("name", r"\\.info$", "").alias("drop"),
        (F.regexp_extract("name", r"_(\d+)\.", 1).cast("bigint") / 1000).cast("int").alias("timestamp"),
    )
    drop = F.regexp_extract("drop", r"^(.*?)(\.info)?$", 1)
    part = F.when(F.col("value").endswith("0"), "a").otherwise("b")
    text = F.concat_ws(" ", "mcid", F.array_join(F.col("segment_array").cast("array<string>"), " "))
    lines = (
        v.v_membership(spark, sf).withColumn("value", text).join(names.withColumn("drop", drop), "timestamp")
        .withColumn("part", part)
        .select(F.concat_ws("_", "drop", "part").alias("file"), "value")
    )
    staging = scratch(spark, "staging")
    lines.repartition("file").write.partitionBy("file").text(f"{staging}/lines")
    manifests = lines.select("file").distinct().select(
        F.regexp_extract("file", "^(.*)_[ab]$", 1).alias("file"),
        F.struct(F.concat("file", F.lit(".sync")).alias("FileName")).alias("entry"),
    ).groupBy("file").agg(F.to_json(F.struct(F.collect_list("entry").alias("Files"))).alias("value"))
    manifests.repartition("file").write.partitionBy("file").text(f"{staging}/manifests")
    fs.mkdirs(fs_path(folder))
    for kind, suffix in (("lines", ".sync"), ("manifests", ".info")):
        for status in fs.globStatus(fs_path(f"{staging}/{kind}/file=*/part-*")):
            name = status.getPath().getParent().getName().split("=", 1)[1]
            fs.rename(status.getPath(), fs_path(f"{folder}/{name}{suffix}"))
    return folder


@query("m03_segment_file_ingest", DROPS_SQL)
def _(spark, sf):
    folder, path = deliver(spark, sf), scratch(spark, "membership")
    segment_tables.ingest_files(spark, folder, path)
    assert segment_tables.ingest_files(spark, folder, path) == 0  # nothing is new any more
    return segment_tables.read_membership(spark, path)


@query("o01_streaming_ingest", DROPS_SQL)
def _(spark, sf):
    """The same drops, delivered to a stream that runs once and once more."""
    folder, path, state = deliver(spark, sf), scratch(spark, "membership"), scratch(spark, "state")
    for _ in range(2):
        ingest_stream(spark, folder, path, state)
    return segment_tables.read_membership(spark, path)


@query("o01_replayed_ingest", DROPS_SQL)
def _(spark, sf):
    """A run is lost after its write, an old file comes late, and another checkpoint delivers all files once more."""
    folder, path, state = deliver(spark, sf), scratch(spark, "membership"), scratch(spark, "state")
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    oldest = sorted(status.getPath().toString() for status in fs.globStatus(fs_path(f"{folder}/*.info")))[0]
    fs.rename(fs_path(oldest), fs_path(oldest + "-held"))  # before the newest full file
    finish, lost = Ledger.mark_done, []

    def lose(self, number):
        if not lost:
            lost.append(number)
            raise RuntimeError("the driver is lost")
        finish(self, number)

    Ledger.mark_done = lose
    try:
        ingest_stream(spark, folder, path, state)
    except Exception as fault:
        assert "driver is lost" in str(fault), fault
    finally:
        Ledger.mark_done = finish
    assert lost
    fs.rename(fs_path(oldest + "-held"), fs_path(oldest))
    for checkpoint in (state, state, scratch(spark, "state")):
        ingest_stream(spark, folder, path, checkpoint)
    return segment_tables.read_membership(spark, path)


@query("o02_targets_written_after_stream", f"""
SELECT segment_id, segment_name, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date,
  (SELECT CAST(max(CAST(to_timestamp(timestamp - 18000) AS DATE)) AS VARCHAR) FROM ({DROPS_SQL})) AS last_processed_date
FROM v_active_segments""")
def _(spark, sf):
    """Segments advance once targets exist, to the newest file that the stream has stored; files are named by folders."""
    path, table = scratch(spark, "membership"), segment_tables.segment_table(spark, scratch(spark, "segments"))
    ingest_stream(spark, deliver(spark, sf), path, scratch(spark, "state"))
    known = segment_tables.membership_partitions(spark, path)
    assert "FileScan" not in segments.latest_file_date(known)._jdf.queryExecution().toString()
    table.create(v.v_active_segments(spark, sf))
    targets = segment_targets(spark, sf).select("*", F.lit("adobe").alias("vendor"), F.lit("mcid").alias("source"))
    try:
        segment_tables.advance_processed(table, known, targets.filter("false"), RUN)
    except EmptyInput:
        segment_tables.advance_processed(table, known, targets, RUN)
    assert len(table.versions()) == 2
    return table.read()


@query("m04_segment_list_upkeep", f"""
WITH {LISTED_SQL}, {SEGMENT_TARGETS},
made AS (SELECT l.segment_id, l.segment_name, least(l.start_date, t.latest_date) AS start_date, l.end_date, t.latest_date AS last_processed_date
  FROM v_active_segments l LEFT JOIN segment_targets t USING (segment_id))
SELECT segment_id, segment_name, {TEXT_DATES} FROM (
SELECT t.segment_id, coalesce(l.segment_name, t.segment_name) AS segment_name, t.start_date,
       CASE WHEN l.segment_id IS NULL AND t.end_date IS NULL THEN DATE '2024-01-31' ELSE t.end_date END AS end_date, t.last_processed_date
FROM made t LEFT JOIN listed l ON t.segment_id = l.segment_id AND t.end_date IS NULL
UNION ALL SELECT l.segment_id, l.segment_name, l.start_date, NULL, NULL FROM listed l
WHERE NOT EXISTS (SELECT 1 FROM made t WHERE t.segment_id = l.segment_id AND t.end_date IS NULL))""")
def _(spark, sf):
    """Create the list from its targets, then merge the next listing into it."""
    table = segment_tables.segment_table(spark, scratch(spark, "segments"))
    targets = segment_targets(spark, sf).select(
        "*", F.lit("adobe").alias("vendor"), F.lit("mcid").alias("source")
    )
    for listed in (v.v_active_segments(spark, sf), listed_segments(spark, sf)):
        segment_tables.maintain_segments(
            table, listed, datetime.date(2024, 2, 1), targets, v.v_membership(spark, sf)
        )
    return table.read()


@query("m05_advance_processed", f"""
SELECT segment_id, segment_name, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date,
  (SELECT CAST(max(dt) AS VARCHAR) FROM v_membership) AS last_processed_date FROM v_active_segments""")
def _(spark, sf):
    table = segment_tables.segment_table(spark, scratch(spark, "segments"))
    table.create(v.v_active_segments(spark, sf))
    targets = segment_targets(spark, sf).select(
        "*", F.lit("adobe").alias("vendor"), F.lit("mcid").alias("source")
    )
    segment_tables.advance_processed(table, v.v_membership(spark, sf), targets, RUN)
    return table.read()


OFFLINE_ARGS = {"ids": ids_by_date, "offline": offline_tables}


def resolved_vendor(kind, spark, sf):
    return kind(DAY, **{name: make(spark, sf) for name, make in OFFLINE_ARGS.items()})


GENDER = """SELECT DISTINCT r.xid, '2024-01-03' AS date, 'cds' AS vendor, '{source}' AS source, '{group}' AS "group",
  '{{"{key}":"' || c.{column} || '"}}' AS aspect, CAST(1 AS DOUBLE) AS value
FROM resolved r JOIN v_crm c USING (universal_id) WHERE r.date = DATE '2024-01-03'"""


@query("m06_gender_targets", f"WITH {RESOLVED_SQL} " + GENDER.format(
    source="alt_individual", group="gender", key="gender", column="gender_cd"))
def _(spark, sf):
    return resolved_vendor(vendors.IndividualGender, spark, sf).targets(v.v_crm(spark, sf))


@query("m07_demographic_targets", f"WITH {RESOLVED_SQL} " + " UNION ALL ".join(
    GENDER.format(source="alt_individual_demo", group=g, key=k, column=c)
    for g, k, c in (("age", "age", "i1_exact_age"), ("gender", "gender", "gender_cd"), ("income", "income_class", "experian_income_cd_v6"))))
def _(spark, sf):
    crm = v.v_crm(spark, sf).withColumnRenamed("gender_cd", "i1_gndr_code")
    return resolved_vendor(vendors.IndividualDemographics, spark, sf).targets(crm)


AD_DAY = datetime.date(2024, 1, 5)
AD_SQL = """SELECT xid, '2024-01-05' AS date, 'dfp' AS vendor, '{source}' AS source, CAST(order_id AS VARCHAR) AS "group",
  {aspect} AS aspect, CAST(1 AS DOUBLE) AS value FROM v_ad_events
WHERE dt = DATE '2024-01-05' AND order_id IN (SELECT order_id FROM v_orders_dim WHERE active)"""
CLICK_ASPECT = """'{"creative_size":"' || creative_size || '","creative_id":"' || creative_id || '","line_item_id":"' || line_item_id
  || '","ad_unit_id":"' || adunit_id || '"}'"""
VIEW_ASPECT = """'{"creative_size":"' || creative_size || '","creative_id":"' || creative_id || '","line_item_id":"' || line_item_id
  || '","referrer_url":' || coalesce('"' || referer_url || '"', 'null') || ',"active_view_eligible_impression":"'
  || CAST(activevieweligibleimpression AS VARCHAR) || '"}'"""


def ads(spark, sf, kind):
    """Targets of the active orders; ids inside the aspect become text."""
    orders = tables.active_orders(v.v_orders_dim(spark, sf))
    return kind(AD_DAY, orders=orders).targets(v.v_ad_events(spark, sf))


@query("m08_ad_click_targets", AD_SQL.format(source="network_clicks", aspect=CLICK_ASPECT))
def _(spark, sf):
    return ads(spark, sf, vendors.AdClicks)


@query("m08_ad_impression_targets", AD_SQL.format(source="network_impressions", aspect=VIEW_ASPECT))
def _(spark, sf):
    return ads(spark, sf, vendors.AdImpressions)


NAMES = [s.lower() for s in v.SEGMENTS]


@query("m09_purchase_category_targets", f"WITH {RESOLVED_SQL} " + " UNION ALL ".join(
    f"""SELECT r.xid, '2024-01-03' AS date, 'ncs' AS vendor, 'syndicated' AS source, '{n}' AS "group",
  '{{"action":"purchase"}}' AS aspect, CAST(max(c.{n}) AS DOUBLE) AS value FROM resolved r JOIN v_crm c USING (universal_id)
WHERE r.date = DATE '2024-01-03' GROUP BY r.xid""" for n in NAMES))
def _(spark, sf):
    return resolved_vendor(vendors.PurchaseCategories, spark, sf).targets(
        v.v_crm(spark, sf).select("universal_id", *NAMES)
    )


@query("m10_campaign_scale_targets", f"""
WITH {RESOLVED_SQL} SELECT r.xid, '2024-01-03' AS date, 'ncs' AS vendor, 'custom' AS source, c.campaign AS "group", '{{}}' AS aspect,
  coalesce(round(avg(c.scale), 6), -1) AS value FROM resolved r JOIN v_crm c USING (universal_id)
WHERE r.date = DATE '2024-01-03' GROUP BY r.xid, c.campaign""")
def _(spark, sf):
    crm = v.v_crm(spark, sf).select("universal_id", "campaign", "scale")
    return resolved_vendor(vendors.CampaignScales, spark, sf).targets(crm).fillna(-1, ["value"])


PLAIN_SQL = """SELECT xid, CAST(date AS VARCHAR) AS date, '{vendor}' AS vendor, {source} AS source, "group", '{{}}' AS aspect,
  round(CAST(value AS DOUBLE), 6) AS value FROM v_targets"""


@query("m11_rating_targets", PLAIN_SQL.format(vendor="nielsen", source="'dar'"))
def _(spark, sf):
    return vendors.AudienceRatings(DAY).targets(v.v_targets(spark, sf))


@query("m12_click_log_targets", f"""
WITH {COUNTS_SQL} SELECT infinity_id AS xid, '2024-01-03' AS date, 'publisher' AS vendor, 'ga' AS source, 'covid_readers' AS "group",
  '{{"corona_articles":' || corona_articles || ',"total_articles":' || total_articles || '}}' AS aspect,
  CAST(CAST(corona_articles >= 1 AS INTEGER) AS DOUBLE) AS value FROM counts WHERE dt = DATE '2024-01-03'
UNION ALL SELECT infinity_id, '2024-01-03', 'publisher', 'ga', 'affiliate_commerce_clicks',
  '{{"affiliate_articles":' || affiliate_articles || ',"total_articles":' || total_articles || '}}',
  CAST(CAST(affiliate_articles >= 1 AS INTEGER) AS DOUBLE) FROM counts WHERE dt = DATE '2024-01-03'""")
def _(spark, sf):
    return vendors.ClickLogGroups(DAY, label="publisher").targets(v.v_clicks(spark, sf))


@query("m13_custom_targets", PLAIN_SQL.format(vendor="custom", source="source") + " WHERE date = DATE '2024-01-03'")
def _(spark, sf):
    return vendors.CustomTargets(DAY).targets(v.v_targets(spark, sf))


@query("m14_load_transform_write", f"""
SELECT {TARGET_COUNTS} FROM (SELECT xid, dt AS date, 'dfp' AS vendor, 'network_clicks' AS source, CAST(order_id AS VARCHAR) AS "group", 1 AS value
  FROM v_ad_events WHERE dt = DATE '2024-01-05' AND order_id IN (SELECT order_id FROM v_orders_dim WHERE active))
GROUP BY vendor, source, date, "group" """)
def _(spark, sf):
    """A whole run: ORC source, transform, map, write; the run date lags by a day."""
    source, path = scratch(spark, "ads"), scratch(spark, "targets")
    v.v_ad_events(spark, sf).write.orc(source)
    orders = tables.active_orders(v.v_orders_dim(spark, sf))
    config = vendors.vendor_for("dfp", "network_clicks", "2024-01-06", orders=orders)
    assert config.run(spark, source, path)
    return target_counts(segment_tables.read_targets(spark, path))


# ------------------------------------------------------------------ reports


@query("m22_latest_report", """
SELECT stage, status, CAST(arg_date AS VARCHAR) AS arg_date, info FROM (SELECT *, row_number() OVER (
  PARTITION BY workflow_id, stage ORDER BY execution_date DESC) AS rn FROM v_history
  WHERE status = 'success' AND workflow_id = '605') WHERE rn = 1""")
def _(spark, sf):
    rows = reports.latest_successes(v.v_history(spark, sf), "605")
    return rows.select("stage", "status", "arg_date", "info")


@query("m23_stage_runs_on_date", """
SELECT h.workflow_id, h.status, CAST(w.enabled AS INTEGER) AS enabled, w.name, w.trait_id FROM (SELECT *, row_number() OVER (
  PARTITION BY workflow_id, stage ORDER BY (status <> 'success'), execution_date DESC) AS rn FROM v_history
  WHERE stage = 'scoring' AND arg_date = DATE '1998-03-06') h JOIN v_workflow w ON h.workflow_id = w.id WHERE rn = 1""")
def _(spark, sf):
    rows = reports.stage_runs(v.v_history(spark, sf), v.v_workflow(spark, sf), "scoring", arg_date=HISTORY_DAY)
    return rows.select("workflow_id", "status", "enabled", "name", "trait_id")


@query("m23_stage_runs_as_of", f"""
SELECT workflow_id, status, CAST(enabled AS INTEGER) AS enabled, name, trait_id FROM ({REPORT.format(BEST_RUNS.format(stage='scoring'))})""")
def _(spark, sf):
    rows = reports.stage_runs(v.v_history(spark, sf), v.v_workflow(spark, sf), "scoring", as_of=AS_OF)
    return rows.select("workflow_id", "status", "enabled", "name", "trait_id")


@query("m24_last_success", """
SELECT workflow_id, CAST(max(arg_date) AS VARCHAR) AS last_date FROM v_history
WHERE status = 'success' AND stage = 'scoring' GROUP BY workflow_id""")
def _(spark, sf):
    return reports.last_success(v.v_history(spark, sf), "scoring")


@query("m24_ran_on_date", """
SELECT workflow_id FROM v_history WHERE status = 'success' AND stage = 'scoring' GROUP BY workflow_id
HAVING max(arg_date) = (SELECT max(arg_date) FROM v_history WHERE status = 'success' AND stage = 'scoring')""")
def _(spark, sf):
    history = v.v_history(spark, sf)
    day = reports.succeeded(history, "scoring").agg(F.max("arg_date")).first()[0]
    ids = v.v_workflow(spark, sf).select(F.col("id").alias("workflow_id"))
    return reports.ran_on(history, "scoring", day, ids)


SINCE = datetime.datetime(2001, 6, 1)


@query("m25_recent_failures", """
SELECT workflow_id, status, CAST(arg_date AS VARCHAR) AS arg_date, error FROM v_history
WHERE status <> 'success' AND stage = 'training' AND arg_date >= TIMESTAMP '2001-06-01' - INTERVAL 864000 SECOND""")
def _(spark, sf):
    rows = reports.failures_since(v.v_history(spark, sf), "training", SINCE, 864000)
    return rows.select("workflow_id", "status", "arg_date", "error")


@query("m26_failed_workflows", """
SELECT workflow_id, status, error FROM (SELECT *, row_number() OVER (PARTITION BY workflow_id, stage
  ORDER BY (status <> 'success'), execution_date DESC) AS rn FROM v_history
  WHERE stage = 'assembly' AND arg_date = DATE '1996-04-28') WHERE rn = 1 AND status <> 'success'""")
def _(spark, sf):
    rows = reports.failed_workflows(v.v_history(spark, sf), "assembly", datetime.date(1996, 4, 28))
    return rows.select("workflow_id", "status", "error")


@query("m27_stage_response", """
SELECT status, CAST(arg_date AS VARCHAR) AS arg_date, info FROM v_history WHERE workflow_id = '605' AND stage = 'training'
  AND status = 'success' AND execution_date <= TIMESTAMP '2001-01-01' ORDER BY execution_date DESC LIMIT 1""")
def _(spark, sf):
    rows = reports.stage_response(
        v.v_history(spark, sf), "605", "training", as_of=datetime.datetime(2001, 1, 1), ignore_failures=True
    )
    return rows.select("status", "arg_date", "info")


@query("m28_stale_workflows", STALE_SQL)
def _(spark, sf):
    return reports.stale_workflows(v.v_history(spark, sf), v.v_workflow(spark, sf), "assembly", STALE_DAY)


SECONDS = 86400 * 365
TARGET = datetime.datetime(2001, 1, 1)


@query("m29_ready_workflows", f"""
WITH facts AS (SELECT w.id AS workflow_id, max(h.arg_date) FILTER (h.status = 'success' AND h.stage = 'training') AS last_run,
  max(h.arg_date) FILTER (h.status = 'success' AND h.stage = 'assembly') AS last_set,
  count(h.status) FILTER (h.status <> 'success' AND h.stage = 'training' AND h.arg_date >= TIMESTAMP '2001-01-01' - INTERVAL {SECONDS} SECOND) AS failures
  FROM v_workflow w LEFT JOIN v_history h ON h.workflow_id = w.id WHERE w.enabled GROUP BY w.id)
SELECT workflow_id, failures FROM facts WHERE failures < 3 AND (last_run IS NULL OR epoch(TIMESTAMP '2001-01-01' - CAST(last_run AS TIMESTAMP)) >= {SECONDS})
  AND last_set IS NOT NULL AND epoch(TIMESTAMP '2001-01-01' - CAST(last_set AS TIMESTAMP)) <= {SECONDS}""")
def _(spark, sf):
    rows = reports.ready_workflows(
        v.v_history(spark, sf), v.v_workflow(spark, sf), "training", TARGET, SECONDS, TARGET
    )
    return rows.select("workflow_id", "failures")


@query("m30_daily_report", """
WITH latest AS (SELECT stage, status, workflow_id FROM (SELECT h.*, row_number() OVER (PARTITION BY workflow_id, stage ORDER BY execution_date DESC) AS rn
  FROM v_history h JOIN v_workflow w ON h.workflow_id = w.id WHERE w.enabled AND h.arg_date = DATE '1998-03-06') WHERE rn = 1)
SELECT stage, 'failures' AS kind, count(*) FILTER (status <> 'success') AS n FROM (SELECT unnest(['assembly', 'training', 'scoring']) AS stage) LEFT JOIN latest USING (stage) GROUP BY stage
UNION ALL SELECT s.stage, 'missing', (SELECT count(*) FROM v_workflow w
  WHERE w.enabled AND EXISTS (SELECT 1 FROM v_history WHERE arg_date = DATE '1998-03-06')
    AND (s.stage = 'scoring' OR w.weekday = dayofweek(DATE '1998-03-06'))
    AND NOT EXISTS (SELECT 1 FROM v_history h WHERE h.workflow_id = w.id AND h.stage = s.stage AND h.arg_date = DATE '1998-03-06'))
FROM (SELECT unnest(['assembly', 'training', 'scoring']) AS stage) s""")
def _(spark, sf):
    found = reports.daily_report(v.v_history(spark, sf), v.v_workflow(spark, sf), HISTORY_DAY)
    parts = [
        rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(stage).alias("stage"), F.lit(kind).alias("kind"), "n")
        for stage, frames in found.items()
        for kind, rows in frames.items()
        if kind != "counts"
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query("m31_training_report", f"""
WITH a AS ({REPORT.format(BEST_RUNS.format(stage='assembly'))}), t AS ({REPORT.format(BEST_RUNS.format(stage='training'))})
SELECT coalesce(a.name, t.name) AS name, coalesce(a.trait_id, t.trait_id) AS trait_id, a.info AS assembly_info, t.info AS training_info,
  a.error AS assembly_error, t.error AS training_error FROM a FULL OUTER JOIN t USING (workflow_id)""")
def _(spark, sf):
    history, workflows = v.v_history(spark, sf), v.v_workflow(spark, sf)
    sides = [reports.stage_report(history, workflows, s, as_of=AS_OF) for s in ("assembly", "training")]
    return reports.training_report(*sides).select(
        "name", "trait_id", "assembly_info", "training_info", "assembly_error", "training_error"
    )


@query("m32_workflow_lookups", """
SELECT 'trait' AS kind, id FROM v_workflow WHERE trait_id = 1042
UNION ALL SELECT 'name', id FROM v_workflow WHERE lower(name) = 'wf_machinery_1'
UNION ALL SELECT 'name_like', id FROM v_workflow WHERE lower(name) LIKE '%_building_%'
UNION ALL SELECT 'description_like', id FROM v_workflow WHERE lower(description) LIKE '%00042%'""")
def _(spark, sf):
    rows = v.v_workflow(spark, sf)
    found = {
        "trait": reports.with_trait(rows, 1042),
        "name": reports.text_is(rows, "name", "wf_machinery_1"),
        "name_like": reports.text_like(rows, "name", "_building_"),
        "description_like": reports.text_like(rows, "description", "00042"),
    }
    parts = [frame.select(F.lit(kind).alias("kind"), "id") for kind, frame in found.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query("m32_counts_by_vendor", """
SELECT regexp_extract(name, '_([^_]+)_', 1) AS vendor, count(*) AS n, count(*) FILTER (enabled) AS enabled FROM v_workflow GROUP BY 1""")
def _(spark, sf):
    rows = v.v_workflow(spark, sf)
    active = reports.counts_by_vendor(reports.enabled(rows)).withColumnRenamed("n", "enabled")
    return reports.counts_by_vendor(rows).join(active, "vendor")


@query("b04_segment_run_replaces_its_days", f"""
WITH {BRIDGE_SQL}, stored AS (SELECT 'x' AS kind, DATE '2024-01-10' AS date, CAST(segment_id AS VARCHAR) AS "group" FROM v_active_segments)
SELECT date, "group", n FROM (
SELECT CAST(day AS VARCHAR) AS date, CAST(segment_id AS VARCHAR) AS "group", count(*) AS n FROM bridged GROUP BY day, segment_id
UNION ALL SELECT CAST(date AS VARCHAR), "group", 1 FROM stored
WHERE ("group", date) NOT IN (SELECT CAST(segment_id AS VARCHAR), day FROM wanted))""")
def _(spark, sf):
    """A run replaces the (date, segment) partitions it covers and no others."""
    path = scratch(spark, "targets")
    old = v.v_active_segments(spark, sf).select(
        v.uid("segment_id").alias("xid"),
        F.lit(datetime.date(2024, 1, 10)).alias("date"),
        F.lit("adobe").alias("vendor"),
        F.lit("mcid").alias("source"),
        F.col("segment_id").cast("string").alias("group"),
        F.lit("{}").alias("aspect"),
        F.lit(0.0).cast("float").alias("value"),
    )
    sinks.overwrite_partitions(old, path, sinks.TARGET_KEYS)
    config, rows = segment_run(spark, sf)
    assert config.write(rows, path)
    return segment_tables.read_targets(spark, path).groupBy("date", "group").agg(
        F.count(F.lit(1)).alias("n")
    )


