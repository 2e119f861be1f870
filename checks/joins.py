"""E: joins, F: aggregates, G: windows, H: order, I: sets."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from checks import views as v
from checks.scans import AS_OF, BEST_RUNS, LISTED_SQL, listed_segments
from checks.views import query
from cohortia.functions import ids as id_functions
from cohortia.operators import features, identity, latest, scores, segments
from cohortia.operators.ranking import with_percent_rank
from cohortia.operators.recipes import Behavior
from cohortia.plans import reports, targets as vendors
from cohortia.plans.scoring import last_trainings
from cohortia.sources import identity as id_scans
from cohortia.session import staged
from cohortia.sources import segment_files

FULL = v.FIRST_DAY
RUN = datetime.date(2024, 1, 20)
BACKFILL = 35
UUID_SQL = "regexp_matches({}, '\\b[0-9a-f]{{8}}\\b-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-\\b[0-9a-f]{{12}}\\b')"


def ids_by_date(spark, sf):
    return v.v_identity(spark, sf).withColumnRenamed("dt", "date")


OFFLINE = ["mdw_id", "amg_user_id", "cds_account_number"]


def offline_tables(spark, sf):
    """Each offline table holds the customers of its own id kind's segments."""
    crm = v.v_crm(spark, sf).select("id", "universal_id")
    return {kind: crm for kind in OFFLINE}


XIDS_SQL = """
xids AS (SELECT DISTINCT x.mapped_id AS xid, o.type, o.mapped_id AS id, x.dt AS date FROM v_identity x
  JOIN v_identity o ON x.dt = o.dt AND x.fullvisitor_id = o.fullvisitor_id
  WHERE x.type = 'infinity_id' AND o.type IN ('mdw_id', 'amg_user_id', 'cds_account_number'))"""
RESOLVED_SQL = XIDS_SQL + """,
resolved AS (SELECT DISTINCT x.xid, c.universal_id, x.date FROM xids x JOIN v_crm c ON x.id = c.id)"""


def resolved(spark, sf):
    return identity.universal_ids(ids_by_date(spark, sf), offline_tables(spark, sf))


@query("e01_universal_id_join", f"""
WITH {RESOLVED_SQL} SELECT r.xid, r.universal_id, CAST(r.date AS VARCHAR) AS date, c.campaign, c.gender_cd
FROM resolved r JOIN v_crm c USING (universal_id)""")
def _(spark, sf):
    crm = v.v_crm(spark, sf).select("universal_id", "campaign", "gender_cd")
    return identity.with_universal_id(resolved(spark, sf), crm).select(
        "xid", "universal_id", "date", "campaign", "gender_cd"
    )


@query("e02_users_with_offline_ids", f"""
WITH {XIDS_SQL} SELECT xid, type, id, CAST(date AS VARCHAR) AS date FROM xids""")
def _(spark, sf):
    return identity.users_with_offline_ids(ids_by_date(spark, sf))


@query("e03_kind_join", f"""
WITH {XIDS_SQL} SELECT x.xid, c.universal_id, CAST(x.date AS VARCHAR) AS date FROM xids x
JOIN v_crm c ON x.id = c.id WHERE x.type = 'mdw_id'""")
def _(spark, sf):
    users = identity.users_with_offline_ids(ids_by_date(spark, sf))
    return identity.join_offline_table(users, "mdw_id", v.v_crm(spark, sf))


@query("e04_resolve_all_kinds", f"""
WITH {RESOLVED_SQL} SELECT xid, universal_id, CAST(date AS VARCHAR) AS date FROM resolved""")
def _(spark, sf):
    return resolved(spark, sf)


def id_pairs(spark, sf):
    return id_scans.id_maps(v.v_identity(spark, sf), RUN, 120)


ACTIVE_SQL = """
active AS (SELECT *, CASE WHEN last_processed_date IS NULL THEN DATE '2024-01-01'
    ELSE greatest(DATE '2024-01-01', last_processed_date + 1) END AS start FROM v_active_segments
  WHERE start_date <= DATE '2024-01-20' AND (end_date IS NULL OR end_date >= DATE '2024-01-20')),
days AS (SELECT CAST(d AS DATE) AS day FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-20', INTERVAL 1 DAY)) AS d)
  WHERE CAST(d AS DATE) >= (SELECT min(start) FROM active)),
wanted AS (SELECT d.day, a.segment_id, a.segment_name FROM days d JOIN active a ON a.start <= d.day)"""
MEMBERS_SQL = ACTIVE_SQL + """,
members AS (SELECT DISTINCT m.dt AS day, m.mcid, w.segment_id FROM v_membership m JOIN wanted w ON w.day = m.dt
  WHERE list_contains(m.segment_array, w.segment_id))"""
BRIDGE_SQL = MEMBERS_SQL + """,
bridged AS (SELECT DISTINCT m.day, x.mapped_id AS xid, m.segment_id FROM members m
  JOIN (SELECT DISTINCT mapped_id, fullvisitor_id FROM v_identity WHERE type = 'adobe_mcid') c ON c.mapped_id = m.mcid
  JOIN (SELECT DISTINCT mapped_id, fullvisitor_id FROM v_identity WHERE type = 'infinity_id') x USING (fullvisitor_id))"""


def active(spark, sf):
    return segments.active_on(v.v_active_segments(spark, sf), RUN, FULL)


def wanted_days(spark, sf):
    return segments.days_and_segments(active(spark, sf), FULL, RUN, BACKFILL)


def selected(spark, sf):
    return segments.selected_segments(v.v_membership(spark, sf), wanted_days(spark, sf), FULL)


@query("e05_id_bridge", f"""
WITH {BRIDGE_SQL} SELECT CAST(day AS VARCHAR) AS processing_start_date, xid,
  array_to_string(list_sort(list(segment_id)), ' ') AS segment_select FROM bridged GROUP BY day, xid""")
def _(spark, sf):
    return identity.user_segments(selected(spark, sf), *id_pairs(spark, sf), segments.known_segments(active(spark, sf)))


@query("e06_membership_on_days", f"""
WITH {MEMBERS_SQL} SELECT CAST(day AS VARCHAR) AS processing_start_date, mcid, count(*) AS n FROM members GROUP BY 1, 2""")
def _(spark, sf):
    rows = selected(spark, sf)
    return rows.select("processing_start_date", "mcid", F.size("segment_select").cast("bigint").alias("n"))


@query("e07_day_spine", f"""
WITH {ACTIVE_SQL} SELECT CAST(d.day AS VARCHAR) AS processing_start_date,
  (SELECT array_to_string(list_sort(list(a.segment_id)), ' ') FROM active a WHERE a.start = d.day) AS select_segs FROM days d""")
def _(spark, sf):
    return segments.segments_to_start(active(spark, sf), FULL, RUN, BACKFILL)


SEGMENT_TARGETS = """
segment_targets AS (SELECT segment_id, max(dt) AS latest_date FROM (SELECT k AS segment_id, dt FROM v_events
  WHERE event_type = 'error') GROUP BY segment_id)"""


def segment_targets(spark, sf):
    rows = v.v_events(spark, sf).filter("event_type = 'error'")
    return rows.select(F.col("k").cast("string").alias("group"), F.col("dt").alias("date"))


@query("e08_first_segment_table", f"""
WITH {SEGMENT_TARGETS} SELECT l.segment_id, l.segment_name, CAST(least(l.start_date, t.latest_date) AS VARCHAR) AS start_date,
  CAST(l.end_date AS VARCHAR) AS end_date, CAST(t.latest_date AS VARCHAR) AS last_processed_date
FROM v_active_segments l LEFT JOIN segment_targets t USING (segment_id)""")
def _(spark, sf):
    listed = v.v_active_segments(spark, sf)
    return segments.new_segment_table(listed, segments.last_target_dates(segment_targets(spark, sf), listed))


@query("e09_segment_changes", f"""
WITH {LISTED_SQL}
SELECT segment_id, segment_name, CAST(start_date AS VARCHAR) AS start_date, NULL AS end_date, NULL AS last_processed_date FROM listed
UNION ALL SELECT segment_id, segment_name, CAST(start_date AS VARCHAR), '2024-01-31', CAST(last_processed_date AS VARCHAR)
FROM v_active_segments WHERE end_date IS NULL AND segment_id NOT IN (SELECT segment_id FROM listed)""")
def _(spark, sf):
    stored = v.v_active_segments(spark, sf)
    return segments.segment_changes(stored, listed_segments(spark, sf), datetime.date(2024, 2, 1))


@query("e10_cast_key_join", """
SELECT s.segment_id, count(*) AS n FROM v_targets t JOIN v_active_segments s
  ON TRY_CAST(replace(t."group", 'g', '') AS INTEGER) = s.segment_id GROUP BY s.segment_id""")
def _(spark, sf):
    rows = v.v_targets(spark, sf).select(F.regexp_replace("group", "g", "").alias("group"))
    listed = v.v_active_segments(spark, sf).select("segment_id")
    joined = rows.join(listed, F.col("group").try_cast("int") == F.col("segment_id"))
    return joined.groupBy("segment_id").agg(F.count(F.lit(1)).alias("n"))


@query("e11_named_segments", f"""
WITH {BRIDGE_SQL} SELECT b.xid, CAST(b.day AS VARCHAR) AS processing_start_date, b.segment_id AS "group", a.segment_name
FROM bridged b JOIN active a USING (segment_id)""")
def _(spark, sf):
    users = identity.user_segments(selected(spark, sf), *id_pairs(spark, sf), segments.known_segments(active(spark, sf)))
    return segments.exploded_targets(users, active(spark, sf))


@query("e14_feature_frames_join", "SELECT xid, feature_view, feature_click, feature_cents FROM v_features")
def _(spark, sf):
    rows = v.v_features(spark, sf)
    frames = [rows.select("xid", c) for c in ("feature_view", "feature_click", "feature_cents")]
    return features.join_frames(frames, "xid")


FAMILIES_SQL = ", ".join(
    f"coalesce(max(n) FILTER (event_type = '{e}'), 0) AS feature_brands_{e}, max(n) FILTER (event_type = '{e}') AS feature_admantx_topics_shop_{e}x"
    for e in v.EVENT_TYPES
)


@query("e14_families_of_one_table", f"""
SELECT xid AS infinity_id, max(last_day) - min(first_day) AS feature_duration_lifespan,
  DATE '2024-01-31' - max(last_day) AS feature_duration_days_since_last_seen, {FAMILIES_SQL} FROM v_kinds GROUP BY xid""")
def _(spark, sf):
    """Three families of the nested table as columns of one projection."""
    nested = staged(v.v_nested(spark, sf), "nested")
    topics = [f"feature_admantx_topics_shop_{e}x" for e in v.EVENT_TYPES]
    wide = features.nested_features(
        nested, ["feature_duration", "feature_brands", "feature_admantx"], topics, {"feature_brands": v.EVENT_TYPES}
    )
    plan = wide._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Exchange", "Join", "Generate")), plan
    return wide


REPORT = """
SELECT h.*, w.enabled, w.trait_id, w.name, w.description FROM ({}) h JOIN v_workflow w ON h.workflow_id = w.id"""


@query("e15_report_full_outer", f"""
WITH a AS ({REPORT.format(BEST_RUNS.format(stage='assembly'))}), t AS ({REPORT.format(BEST_RUNS.format(stage='training'))})
SELECT coalesce(a.workflow_id, t.workflow_id) AS workflow_id, a.status AS assembly_status, t.status AS training_status,
  CAST(a.arg_date AS VARCHAR) AS assembly_arg_date, CAST(t.arg_date AS VARCHAR) AS training_arg_date
FROM a FULL OUTER JOIN t ON a.workflow_id = t.workflow_id AND a.trait_id = t.trait_id AND a.name = t.name AND a.description = t.description""")
def _(spark, sf):
    history, workflows = v.v_history(spark, sf), v.v_workflow(spark, sf)
    sides = [reports.stage_report(history, workflows, s, as_of=AS_OF) for s in ("assembly", "training")]
    return reports.training_report(*sides).select(
        "workflow_id", "assembly_status", "training_status", "assembly_arg_date", "training_arg_date"
    )


@query("e16_history_with_workflow", f"""
SELECT workflow_id, stage, status, CAST(enabled AS INTEGER) AS enabled, trait_id, name
FROM ({REPORT.format(BEST_RUNS.format(stage='scoring'))})""")
def _(spark, sf):
    rows = reports.stage_runs(v.v_history(spark, sf), v.v_workflow(spark, sf), "scoring", as_of=AS_OF)
    return rows.select("workflow_id", "stage", "status", "enabled", "trait_id", "name")


HISTORY_DAY = datetime.date(1998, 3, 6)


@query("e17_unlaunched", """
SELECT id AS workflow_id, trait_id, description FROM v_workflow
WHERE enabled AND weekday = dayofweek(DATE '1998-03-06')
  AND EXISTS (SELECT 1 FROM v_history WHERE arg_date = DATE '1998-03-06')
  AND id NOT IN (SELECT workflow_id FROM v_history WHERE arg_date = DATE '1998-03-06' AND stage = 'training')""")
def _(spark, sf):
    return reports.unlaunched(v.v_history(spark, sf), v.v_workflow(spark, sf), "training", HISTORY_DAY)


@query("e18_as_of_training", """
SELECT workflow_id, CAST(arg_date AS VARCHAR) AS arg_date, info FROM (SELECT *, row_number() OVER (
  PARTITION BY workflow_id ORDER BY arg_date DESC, execution_date DESC) AS rn FROM v_history
  WHERE stage = 'training' AND status = 'success' AND arg_date <= DATE '1998-06-01') WHERE rn = 1""")
def _(spark, sf):
    return last_trainings(v.v_history(spark, sf), AS_OF.date()).select("workflow_id", "arg_date", "info")


@query("e18_file_reference_dates", """
SELECT name, CAST(max(CASE WHEN type = 'full' THEN dt END) OVER (ORDER BY timestamp) AS VARCHAR) AS ref_date FROM v_files""")
def _(spark, sf):
    described = segment_files.described_files(v.v_files(spark, sf))
    return segments.reference_dates(described, None).select("name", "ref_date")


# ------------------------------------------------------------ F: aggregates

COUNTS_SQL = """
counts AS (SELECT infinity_id, dt, sum(corona) AS corona_articles, sum(affiliate) AS affiliate_articles, count(*) AS total_articles
  FROM (SELECT infinity_id, content_id, dt,
      max(CASE WHEN regexp_matches(lower(hits_page_pagepath), 'coronavirus|covid') OR regexp_matches(lower(onsite_keywords), 'coronavirus|covid') THEN 1 ELSE 0 END) AS corona,
      max(CASE WHEN lower(hits_eventinfo_eventaction) IN ('affiliate link clicks', 'amp link type: affiliate link', 'amp link type: buy button') THEN 1 ELSE 0 END) AS affiliate
    FROM v_clicks WHERE length(infinity_id) = 36 AND content_id <> '' GROUP BY 1, 2, 3) GROUP BY 1, 2)"""


@query("f01_two_level_counts", f"""
WITH {COUNTS_SQL} SELECT infinity_id, CAST(dt AS VARCHAR) AS dt, CAST(corona_articles AS BIGINT) AS corona_articles,
  CAST(affiliate_articles AS BIGINT) AS affiliate_articles, total_articles FROM counts""")
def _(spark, sf):
    clicks = id_functions.keep_full_length_ids(v.v_clicks(spark, sf), "infinity_id", "content_id")
    return vendors.article_counts(clicks, [vendors.keyword_readers(), vendors.affiliate_clickers()])


@query("f03_max_per_group", f"""
WITH {RESOLVED_SQL} SELECT r.xid, CAST(r.date AS VARCHAR) AS date, max(c.automobile) AS automobile, max(c.building) AS building,
  max(c.furniture) AS furniture, max(c.household) AS household, max(c.machinery) AS machinery
FROM resolved r JOIN v_crm c USING (universal_id) GROUP BY r.xid, r.date""")
def _(spark, sf):
    names = [s.lower() for s in v.SEGMENTS]
    crm = v.v_crm(spark, sf).select("universal_id", *names)
    users = identity.with_universal_id(resolved(spark, sf), crm)
    return users.groupBy("xid", "date").agg(*[F.max(n).alias(n) for n in names])


@query("f04_average_scale", f"""
WITH {RESOLVED_SQL} SELECT r.xid, CAST(r.date AS VARCHAR) AS date, c.campaign, coalesce(round(avg(c.scale), 6), -1) AS scale
FROM resolved r JOIN v_crm c USING (universal_id) GROUP BY r.xid, r.date, c.campaign""")
def _(spark, sf):
    crm = v.v_crm(spark, sf).select("universal_id", "campaign", "scale")
    users = identity.with_universal_id(resolved(spark, sf), crm)
    averaged = users.groupBy("xid", "date", "campaign").agg(F.avg("scale").alias("scale"))
    return averaged.withColumn("scale", F.coalesce("scale", F.lit(-1.0)))


@query("f05_segments_by_start", f"""
WITH {ACTIVE_SQL} SELECT CAST(start AS VARCHAR) AS processing_start_date,
  array_to_string(list_sort(list(DISTINCT segment_id)), ' ') AS select_segs FROM active GROUP BY start""")
def _(spark, sf):
    return segments.segments_by_start(active(spark, sf))


@query("f06_global_extremes", """
SELECT CAST(CAST(max(make_timestamp(CAST(timestamp - 5 * 3600 AS BIGINT) * 1000000)) AS DATE) AS VARCHAR) AS ts_date FROM v_membership""")
def _(spark, sf):
    return segments.latest_file_date(v.v_membership(spark, sf))


@query("f07_last_date_per_segment", f"""
WITH {SEGMENT_TARGETS} SELECT segment_id, CAST(latest_date AS VARCHAR) AS latest_date FROM segment_targets""")
def _(spark, sf):
    return segments.last_target_dates(segment_targets(spark, sf), v.v_active_segments(spark, sf))


@query("f13_status_counts", """
WITH latest AS (SELECT status FROM (SELECT h.*, row_number() OVER (PARTITION BY workflow_id ORDER BY execution_date DESC) AS rn
  FROM v_history h JOIN v_workflow w ON h.workflow_id = w.id
  WHERE w.enabled AND h.arg_date = DATE '1998-03-06' AND h.stage = 'scoring') WHERE rn = 1),
unlaunched AS (SELECT id FROM v_workflow WHERE enabled AND EXISTS (SELECT 1 FROM v_history WHERE arg_date = DATE '1998-03-06')
  AND id NOT IN (SELECT workflow_id FROM v_history WHERE arg_date = DATE '1998-03-06' AND stage = 'scoring'))
SELECT status, count(*) AS n FROM latest GROUP BY status
UNION ALL SELECT 'num_launched', count(*) FROM latest
UNION ALL SELECT 'num_workflows', count(*) FROM v_workflow WHERE enabled
UNION ALL SELECT 'num_not_launched', count(*) FROM unlaunched""")
def _(spark, sf):
    return reports.status_counts(v.v_history(spark, sf), v.v_workflow(spark, sf), "scoring", HISTORY_DAY)


# --------------------------------------------------------------- G: windows


@query("g01_recent_activity", """
SELECT infinity_id, CAST(last_seen AS VARCHAR) AS last_seen, count(*) AS n FROM (
  SELECT *, max(dt) OVER (PARTITION BY infinity_id) AS last_seen FROM v_clicks)
WHERE dt >= last_seen - 10 GROUP BY 1, 2""")
def _(spark, sf):
    rows = latest.recent_activity(v.v_clicks(spark, sf), "infinity_id", "dt", 10)
    return rows.groupBy("infinity_id", "last_seen").agg(F.count(F.lit(1)).alias("n"))


@query("g02_running_set", f"""
WITH {ACTIVE_SQL} SELECT CAST(day AS VARCHAR) AS processing_start_date,
  array_to_string(list_sort(list(segment_id)), ' ') AS segs_to_process FROM wanted GROUP BY day""")
def _(spark, sf):
    return wanted_days(spark, sf)


@query("g03_row_number_share", """
SELECT xid, count(*) AS n, round(max(ratio), 6) AS top FROM (SELECT xid, row_number() OVER (ORDER BY value, md5(xid), xid)
  / CAST(count(*) OVER () AS DOUBLE) AS ratio FROM v_targets WHERE vendor = 'ncs') GROUP BY xid""")
def _(spark, sf):
    """Share of a class's rows at or before each user's last row, by value."""
    from cohortia.operators.ranking import row_shares

    rows = v.v_targets(spark, sf).filter(Behavior({"vendor": "ncs"}).condition())
    shares = row_shares(rows, "value", "xid")
    return shares.groupBy("xid").agg(F.sum("n_rows").alias("n"), F.max("last_share").alias("top"))


@query("g04_boolean_minimum", """
SELECT DISTINCT xid, CAST(min(value > 0.5) OVER (PARTITION BY xid) AS INTEGER) AS always FROM v_targets""")
def _(spark, sf):
    return v.v_targets(spark, sf).groupBy("xid").agg(F.min(F.col("value") > 0.5).alias("always"))


PERCENT_RANK = "percent_rank() OVER (ORDER BY score DESC NULLS LAST)"
NULLED = "(SELECT xid, tid, CASE WHEN score >= 0.02 THEN score END AS score FROM v_scores)"


def nulled_scores(spark, sf):
    """Scores with the lowest ones missing; the bound has the scores' type, so a score of 0.02 is not one of them."""
    bound = F.lit(0.02).cast("float")
    return v.v_scores(spark, sf).withColumn("score", F.when(F.col("score") >= bound, F.col("score")))


@query("g05_percent_rank", f"""
SELECT xid, round(CASE WHEN score IS NOT NULL THEN {PERCENT_RANK} END, 6) AS raw_percentile FROM {NULLED}""")
def _(spark, sf):
    return with_percent_rank(nulled_scores(spark, sf), "score").select("xid", "raw_percentile")


@query("g05_crowded_doubles", """
SELECT k, round(percent_rank() OVER (ORDER BY x DESC), 6) AS raw_percentile FROM (
  SELECT l_orderkey * 8 + l_linenumber AS k, 0.5 + (l_orderkey * 8 + l_linenumber) * 1e-12 AS x FROM lineitem)""")
def _(spark, sf):
    """Distinct doubles between 0.5 and 0.5001: few order buckets, yet ranges share them out."""
    key = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    rows = v.table(spark, sf, "lineitem").select(key.cast("bigint").alias("k"))
    ranked = with_percent_rank(rows.withColumn("x", F.lit(0.5) + F.col("k") * F.lit(1e-12)), "x")
    return ranked.select("k", "raw_percentile")


@query("g06_latest_per_stage", """
SELECT workflow_id, stage, CAST(arg_date AS VARCHAR) AS arg_date FROM (SELECT *, row_number() OVER (
  PARTITION BY workflow_id, stage ORDER BY execution_date DESC) AS rn FROM v_history WHERE status = 'success') WHERE rn = 1""")
def _(spark, sf):
    return reports.latest_successes(v.v_history(spark, sf)).select("workflow_id", "stage", "arg_date")


@query("g07_best_run", """
SELECT workflow_id, stage, status, CAST(arg_date AS VARCHAR) AS arg_date FROM (SELECT *, row_number() OVER (
  PARTITION BY workflow_id, stage ORDER BY (status <> 'success'), execution_date DESC) AS rn FROM v_history) WHERE rn = 1""")
def _(spark, sf):
    return latest.best_run(v.v_history(spark, sf)).select("workflow_id", "stage", "status", "arg_date")


STALE_DAY = datetime.date(2000, 1, 1)
STALE_SQL = """
SELECT DISTINCT workflow_id, CAST(arg_date AS VARCHAR) AS last_date FROM (SELECT workflow_id, arg_date,
  rank() OVER (PARTITION BY workflow_id ORDER BY arg_date DESC) AS r FROM v_history h JOIN v_workflow w ON h.workflow_id = w.id
  WHERE h.status = 'success' AND h.stage = 'assembly' AND w.enabled) WHERE r = 1 AND arg_date <= DATE '1999-12-25'"""


@query("g08_stale_rank", STALE_SQL)
def _(spark, sf):
    return reports.stale_workflows(v.v_history(spark, sf), v.v_workflow(spark, sf), "assembly", STALE_DAY)


@query("g09_newest_row", """
SELECT workflow_id, stage, status, CAST(arg_date AS VARCHAR) AS arg_date FROM v_history
ORDER BY execution_date DESC, workflow_id DESC LIMIT 1""")
def _(spark, sf):
    rows = latest.newest(v.v_history(spark, sf))
    return rows.select("workflow_id", "stage", "status", "arg_date")


@query("g10_latest_enabled", """
SELECT workflow_id, status FROM (SELECT h.*, row_number() OVER (PARTITION BY workflow_id ORDER BY execution_date DESC) AS rn
  FROM v_history h JOIN v_workflow w ON h.workflow_id = w.id
  WHERE w.enabled AND h.arg_date = DATE '1998-03-06' AND h.stage = 'scoring') WHERE rn = 1""")
def _(spark, sf):
    rows = reports.latest_runs(v.v_history(spark, sf), v.v_workflow(spark, sf), "scoring", HISTORY_DAY)
    return rows.select("workflow_id", "status")


# ----------------------------------------------------------- H: order, I: sets


@query("h01_ordered_deciles", """
SELECT decile, count(*) AS count, round(CAST(max(score) AS DOUBLE), 6) AS max_score, round(CAST(min(score) AS DOUBLE), 6) AS min_score,
  round(avg(CAST(score AS DOUBLE)), 6) AS avg_score
FROM (SELECT score, 10 - least(9, CAST(floor(score * 10) AS INTEGER)) AS decile FROM v_scores) GROUP BY decile ORDER BY decile""")
def _(spark, sf):
    tenth = F.lit(10) - F.least(F.lit(9), F.floor(F.col("score") * 10).cast("int"))
    return scores.score_stats(v.v_scores(spark, sf).withColumn("decile", tenth))


@query("h02_ordered_buckets", """
SELECT 'absolute' AS strategy, CASE WHEN score < 0.3 THEN 'low' WHEN score < 0.7 THEN 'mid' ELSE 'high' END AS bucket,
  round(CAST(min(score) AS DOUBLE), 6) AS min_score, round(CAST(max(score) AS DOUBLE), 6) AS max_score,
  round(avg(CAST(score AS DOUBLE)), 6) AS avg_score FROM v_scores GROUP BY 2 ORDER BY 5 DESC""")
def _(spark, sf):
    return scores.threshold_table(v.v_scores(spark, sf), "absolute", [0.3, 0.7], ["low", "mid", "high"])


@query("h03_latest_success", """
SELECT workflow_id, CAST(max(arg_date) AS VARCHAR) AS last_date FROM v_history
WHERE status = 'success' AND stage = 'training' GROUP BY workflow_id""")
def _(spark, sf):
    return reports.last_success(v.v_history(spark, sf), "training")


@query("h04_files_in_order", """
SELECT name, timestamp FROM v_files WHERE timestamp > (SELECT min(timestamp) FROM v_membership)
ORDER BY timestamp""")
def _(spark, sf):
    described = segment_files.described_files(v.v_files(spark, sf))
    first = v.v_membership(spark, sf).agg(F.min("timestamp").alias("timestamp"))
    return segment_files.unprocessed(described, first).select("name", "timestamp")


@query("i01_union", """
SELECT kind, count(*) AS n FROM (SELECT 'a' AS kind, xid FROM v_targets WHERE vendor = 'ncs'
  UNION ALL SELECT 'b', xid FROM v_targets WHERE vendor = 'adobe') GROUP BY kind""")
def _(spark, sf):
    rows = v.v_targets(spark, sf)
    a = rows.filter("vendor = 'ncs'").select(F.lit("a").alias("kind"), "xid")
    b = rows.filter("vendor = 'adobe'").select("xid", F.lit("b").alias("kind"))
    return a.unionByName(b).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("i02_union_changes", f"""
WITH {LISTED_SQL} SELECT (SELECT count(*) FROM listed) + (SELECT count(*) FROM v_active_segments
  WHERE end_date IS NULL AND segment_id NOT IN (SELECT segment_id FROM listed)) AS n""")
def _(spark, sf):
    changes = segments.segment_changes(
        v.v_active_segments(spark, sf), listed_segments(spark, sf), datetime.date(2024, 2, 1)
    )
    return changes.agg(F.count(F.lit(1)).alias("n"))


@query("i03_union_distinct", f"""
WITH {RESOLVED_SQL} SELECT CAST(date AS VARCHAR) AS date, count(*) AS n FROM resolved GROUP BY date""")
def _(spark, sf):
    return resolved(spark, sf).groupBy("date").agg(F.count(F.lit(1)).alias("n"))


SPINE = "SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-03', TIMESTAMP '2024-01-08', INTERVAL 1 DAY)) AS DATE) AS dt"


@query("i04_day_sets", f"""
SELECT 'found' AS kind, CAST(dt AS VARCHAR) AS dt FROM ({SPINE} INTERSECT SELECT dt FROM v_identity)
UNION ALL SELECT 'missing', CAST(dt AS VARCHAR) FROM ({SPINE} EXCEPT SELECT dt FROM v_identity)""")
def _(spark, sf):
    wanted = id_scans.day_spine(spark, datetime.date(2024, 1, 8), 6)
    held = v.v_identity(spark, sf)
    found = id_scans.days_found(wanted, held).select(F.lit("found").alias("kind"), "dt")
    return found.union(id_scans.days_missing(wanted, held).select(F.lit("missing"), "dt"))


@query("i05_ids_found_and_missing", """
WITH asked AS (SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS id FROM orders)
SELECT 'found' AS kind, count(*) AS n FROM v_workflow WHERE id IN (SELECT id FROM asked)
UNION ALL SELECT 'missing', count(*) FROM asked WHERE id NOT IN (SELECT id FROM v_workflow)""")
def _(spark, sf):
    asked = v.table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("id"))
    workflows = v.v_workflow(spark, sf)

    def counted(rows, kind):
        return rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "n")

    return counted(reports.by_ids(workflows, asked), "found").union(
        counted(reports.missing_ids(workflows, asked), "missing")
    )


