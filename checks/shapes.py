"""K: reshaping and nested data."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from checks import views as v
from checks.joins import MEMBERS_SQL, selected
from checks.scans import LINES_SQL
from checks.views import query
from cohortia.functions import ids
from cohortia.functions.aspects import aspect, aspect_columns, constant_aspect
from cohortia.operators import features, reshape
from cohortia.sources import segment_files

NAMES = [s.lower() for s in v.SEGMENTS]
LONG_SQL = " UNION ALL ".join(
    f"SELECT universal_id, '{n}' AS \"group\", {n} AS value FROM v_crm" for n in NAMES
)


@query("k01_wide_to_long", LONG_SQL)
def _(spark, sf):
    wide = v.v_crm(spark, sf).select("universal_id", *NAMES)
    return reshape.to_long(wide, "group", "value", by=["universal_id"])


@query("k02_melt", """
SELECT xid, 'feature_view' AS variable, feature_view AS value FROM v_features
UNION ALL SELECT xid, 'feature_click', feature_click FROM v_features""")
def _(spark, sf):
    return reshape.melt(v.v_features(spark, sf), ["xid"], ["feature_view", "feature_click"])


@query("k03_aspect_columns", """
SELECT universal_id, '{"gender":"' || gender_cd || '"}' AS gender, '{"age":"' || i1_exact_age || '"}' AS age,
  '{"scale":' || coalesce(CAST(scale AS VARCHAR), 'null') || '}' AS campaign FROM v_crm""")
def _(spark, sf):
    groups = {"gender": {"gender": "gender_cd"}, "age": {"age": "i1_exact_age"}, "campaign": {"scale": "scale"}}
    return aspect_columns(v.v_crm(spark, sf), groups, keys=["universal_id"])


@query("k04_aspect_map", """
SELECT aspect, purchase, nothing, count(*) AS n FROM (SELECT '{"type":"' || event_type || '","k":"' || k || '"}' AS aspect,
  '{"action":"purchase"}' AS purchase, '{}' AS nothing FROM v_events) GROUP BY 1, 2, 3""")
def _(spark, sf):
    rows = v.v_events(spark, sf).select(
        aspect({"type": "event_type", "k": F.col("k").cast("string")}).alias("aspect"),
        constant_aspect(action="purchase").alias("purchase"),
        aspect().alias("nothing"),
    )
    return rows.groupBy("aspect", "purchase", "nothing").agg(F.count(F.lit(1)).alias("n"))


@query("k05_explode", "SELECT xid AS infinity_id, event_type AS name, n AS count FROM v_kinds")
def _(spark, sf):
    items = features.select_and_explode(v.v_nested(spark, sf), "feature_brands")
    return items.select("infinity_id", "feature_brands.*")


@query("k06_struct_columns", """
SELECT xid AS infinity_id, max(last_day) - min(first_day) AS feature_duration_lifespan,
  DATE '2024-01-31' - max(last_day) AS feature_duration_days_since_last_seen FROM v_kinds GROUP BY xid""")
def _(spark, sf):
    return features.nested_features(v.v_nested(spark, sf), ["feature_duration"])


PIVOT_SQL = ", ".join(
    f"coalesce(max(n) FILTER (event_type = '{e}'), 0) AS feature_brands_{e}" for e in v.EVENT_TYPES
)


@query("k07_pivot_array", f"SELECT xid AS infinity_id, {PIVOT_SQL} FROM v_kinds GROUP BY xid")
def _(spark, sf):
    return features.pivot_array(v.v_nested(spark, sf), "feature_brands")


@query("f11_pivot_first", f"SELECT xid AS infinity_id, {PIVOT_SQL.replace('feature_brands_', '')} FROM v_kinds GROUP BY xid")
def _(spark, sf):
    items = features.select_and_explode(v.v_nested(spark, sf), "feature_brands")
    items = items.select("infinity_id", "feature_brands.*")
    return reshape.pivot_first(items, "infinity_id", "name", "count")


KNOWN = ["view", "click"]


@query("f12_pivot_listed", """
SELECT xid AS infinity_id, coalesce(max(n) FILTER (event_type = 'view'), 0) AS view,
  coalesce(max(n) FILTER (event_type = 'click'), 0) AS click FROM v_kinds GROUP BY xid""")
def _(spark, sf):
    items = features.select_and_explode(v.v_nested(spark, sf), "feature_brands")
    items = items.select("infinity_id", "feature_brands.*")
    return reshape.pivot_first(items, "infinity_id", "name", "count", KNOWN)


@query("k08_topic_slugs", "SELECT xid AS infinity_id, " + ", ".join(
    f"coalesce(max(n) FILTER (event_type = '{e}'), -1) AS feature_admantx_topics_shop_{e}x" for e in v.EVENT_TYPES
) + " FROM v_kinds GROUP BY xid")
def _(spark, sf):
    topics = [f"feature_admantx_topics_shop_{e}x" for e in v.EVENT_TYPES]
    return features.pivot_topics(v.v_nested(spark, sf), topics).fillna(-1)


@query("k09_struct_fields", """
SELECT xid AS infinity_id, count(*) AS unique_sessions, CAST(sum(n) AS BIGINT) AS total_pageviews FROM v_kinds GROUP BY xid""")
def _(spark, sf):
    fields = features.struct_fields("feature_session", ["unique_sessions", "total_pageviews"])
    return v.v_nested(spark, sf).select("infinity_id", *fields)


@query("k10_unpack_arrays", """
SELECT xid AS infinity_id, coalesce(max(n) FILTER (event_type = 'view'), 0) AS feature_brands_view,
  coalesce(max(n) FILTER (event_type = 'click'), 0) AS feature_brands_click, 0 AS feature_brands_never FROM v_kinds GROUP BY xid""")
def _(spark, sf):
    rows = features.unpack_arrays(v.v_nested(spark, sf), {"feature_brands": [*KNOWN, "never"]})
    return rows.select("infinity_id", *[f"feature_brands_{n}" for n in [*KNOWN, "never"]])


@query("k11_parse_lines", LINES_SQL)
def _(spark, sf):
    parsed = segment_files.parse_lines(v.v_sync_lines(spark, sf))
    return parsed.select("mcid", F.col("segment_array").alias("segments"))


@query("k12_stamp_lines", """
SELECT '2024-01-01' AS ref_date, 'iter' AS type, timestamp, mcid, len(segment_array) + CASE WHEN day(dt) % 10 = 7 THEN 1 ELSE 0 END AS n
FROM v_membership WHERE day(dt) % 10 NOT IN (3, 9)""")
def _(spark, sf):
    parsed = segment_files.parse_lines(v.v_sync_lines(spark, sf))
    day = F.lit(datetime.date(2024, 1, 1))
    stamped = segment_files.stamp(parsed, day, F.lit("iter"), F.col("timestamp"))
    return stamped.select("ref_date", "type", "timestamp", "mcid", F.size("segment_array").cast("bigint").alias("n"))


@query("k13_array_intersect", f"""
WITH {MEMBERS_SQL} SELECT CAST(day AS VARCHAR) AS processing_start_date, mcid,
  array_to_string(list_sort(list(segment_id)), ' ') AS segment_select FROM members GROUP BY 1, 2""")
def _(spark, sf):
    return selected(spark, sf).withColumn("segment_select", F.sort_array("segment_select"))


@query("s11_name_functions", """
SELECT id, regexp_extract(name, '_([^_]+)_', 1) AS vendor, CAST(regexp_extract(name, '_building_([0-9]*)', 1) AS VARCHAR) AS number,
  regexp_replace(description, '\\W', '', 'g') AS words, lower('t_' || regexp_replace(replace(replace('News::' || description, '::', '_'), ' ', '_'), '[^A-Za-z0-9_]', '', 'g')) AS slug
FROM v_workflow""")
def _(spark, sf):
    number = ids.trailing_number(F.col("name"), "building").cast("string")
    return v.v_workflow(spark, sf).select(
        "id",
        ids.vendor_of(F.col("name")).alias("vendor"),
        F.coalesce(number, F.lit("")).alias("number"),
        ids.word_characters(F.col("description")).alias("words"),
        ids.topic_slug("t", F.concat(F.lit("News::"), "description")).alias("slug"),
    )
