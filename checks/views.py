"""The reference's inputs, derived from the provided tables.

Every view is given twice: as Spark code and as SQL for the check engine.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortia.session import configure

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
FIRST_DAY = datetime.date(2024, 1, 1)
SCORE_DAY = datetime.date(2024, 2, 1)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def uid(column) -> Column:
    text = F.md5(F.col(column).cast("string") if isinstance(column, str) else column)
    return F.regexp_replace(text, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def uid_sql(x: str) -> str:
    pattern = "^(.{8})(.{4})(.{4})(.{4})(.{12})$"
    return rf"regexp_replace(md5(CAST({x} AS VARCHAR)), '{pattern}', '\1-\2-\3-\4-\5')"


def v_events(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", "value",
        uid("user_id").alias("xid"),
        F.col("ts").cast("date").alias("dt"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


SQL = {}
SQL["v_events"] = f"""
SELECT event_id, user_id, event_type, value, {uid_sql('user_id')} AS xid, CAST(ts AS DATE) AS dt,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"""


def v_targets(spark, sf):
    kind = F.col("event_type")
    vendor = (
        F.when(kind.isin("view", "click"), "dfp").when(kind == "purchase", "ncs")
        .when(kind == "signup", "custom").otherwise("adobe")
    )
    return v_events(spark, sf).select(
        "xid",
        F.col("dt").alias("date"),
        vendor.alias("vendor"),
        kind.alias("source"),
        F.concat(F.lit("g"), F.col("k") % 10).alias("group"),
        F.concat(F.lit('{"k":"'), F.col("k"), F.lit('"}')).alias("aspect"),
        F.col("value").cast("float").alias("value"),
    )


SQL["v_targets"] = """
SELECT xid, dt AS date, CASE WHEN event_type IN ('view','click') THEN 'dfp' WHEN event_type='purchase' THEN 'ncs'
       WHEN event_type='signup' THEN 'custom' ELSE 'adobe' END AS vendor, event_type AS source,
       'g' || (k % 10) AS "group", '{"k":"' || k || '"}' AS aspect, CAST(value AS REAL) AS value FROM v_events"""


def v_identity(spark, sf):
    key = F.col("c_custkey")
    kinds = F.array(F.lit("mdw_id"), F.lit("amg_user_id"), F.lit("cds_account_number"))
    entries = [
        (F.lit("infinity_id"), uid("c_custkey")),
        (kinds[(key % 3).cast("int")], F.concat(F.lit("off-"), F.floor(key / 2))),
        (F.lit("adobe_mcid"), F.lpad(key.cast("string"), 38, "0")),
    ]
    rows = F.array(*[F.struct(t.alias("type"), m.alias("mapped_id")) for t, m in entries])
    return table(spark, sf, "customer").select(
        F.date_add(F.lit(FIRST_DAY), (key % 5).cast("int")).alias("dt"),
        key.cast("string").alias("fullvisitor_id"),
        F.inline(rows),
    )


SQL["v_identity"] = f"""
SELECT DATE '2024-01-01' + CAST(c_custkey % 5 AS INTEGER) AS dt, CAST(c_custkey AS VARCHAR) AS fullvisitor_id,
       'infinity_id' AS type, {uid_sql('c_custkey')} AS mapped_id FROM customer
UNION ALL SELECT DATE '2024-01-01' + CAST(c_custkey % 5 AS INTEGER), CAST(c_custkey AS VARCHAR),
       CASE c_custkey % 3 WHEN 0 THEN 'mdw_id' WHEN 1 THEN 'amg_user_id' ELSE 'cds_account_number' END,
       'off-' || (c_custkey // 2) FROM customer
UNION ALL SELECT DATE '2024-01-01' + CAST(c_custkey % 5 AS INTEGER), CAST(c_custkey AS VARCHAR),
       'adobe_mcid', lpad(CAST(c_custkey AS VARCHAR), 38, '0') FROM customer"""


def v_crm(spark, sf):
    key = F.col("c_custkey")
    flags = [(F.col("c_mktsegment") == s).cast("int").alias(s.lower()) for s in SEGMENTS]
    return table(spark, sf, "customer").select(
        key.alias("universal_id"),
        F.concat(F.lit("off-"), F.floor(key / 2)).alias("id"),
        F.when(F.col("c_nationkey") % 2 == 0, "F").otherwise("M").alias("gender_cd"),
        (F.col("c_nationkey") + 20).cast("string").alias("i1_exact_age"),
        F.col("c_mktsegment").alias("experian_income_cd_v6"),
        *flags,
        F.when(key % 4 != 0, key % 2).cast("int").alias("scale"),
        F.concat(F.lit("camp"), F.col("c_nationkey") % 4).alias("campaign"),
    )


_FLAGS_SQL = ", ".join(
    f"CAST(c_mktsegment = '{s}' AS INTEGER) AS {s.lower()}" for s in SEGMENTS
)
SQL["v_crm"] = f"""
SELECT c_custkey AS universal_id, 'off-' || (c_custkey // 2) AS id,
       CASE WHEN c_nationkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender_cd,
       CAST(c_nationkey + 20 AS VARCHAR) AS i1_exact_age, c_mktsegment AS experian_income_cd_v6, {_FLAGS_SQL},
       CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_custkey % 2 AS INTEGER) END AS scale,
       'camp' || (c_nationkey % 4) AS campaign FROM customer"""


def v_membership(spark, sf):
    return (
        v_events(spark, sf)
        .groupBy("dt", "user_id")
        .agg(F.array_sort(F.collect_set("k")).alias("segment_array"))
        .select(
            F.lit(FIRST_DAY).alias("ref_date"),
            F.lit("iter").alias("type"),
            (F.unix_date("dt") * 86400 + 43200).cast("int").alias("timestamp"),
            F.lpad(F.col("user_id").cast("string"), 38, "0").alias("mcid"),
            "segment_array",
        )
    )


SQL["v_membership"] = """
SELECT DATE '2024-01-01' AS ref_date, 'iter' AS type,
       CAST((dt - DATE '1970-01-01') * 86400 + 43200 AS INTEGER) AS timestamp,
       lpad(CAST(user_id AS VARCHAR), 38, '0') AS mcid, list_sort(list(DISTINCT k)) AS segment_array, dt
FROM v_events GROUP BY dt, user_id"""


def v_active_segments(spark, sf):
    k = F.col("k")
    return v_events(spark, sf).select("k").distinct().select(
        k.alias("segment_id"),
        F.concat(F.lit("seg_"), k).alias("segment_name"),
        F.date_add(F.lit(FIRST_DAY), k % 7).alias("start_date"),
        F.when(k % 5 == 0, F.lit(datetime.date(2024, 1, 15))).alias("end_date"),
        F.when(k % 4 != 0, F.date_add(F.lit(datetime.date(2024, 1, 10)), k % 6)).alias(
            "last_processed_date"
        ),
    )


SQL["v_active_segments"] = """
SELECT DISTINCT k AS segment_id, 'seg_' || k AS segment_name, DATE '2024-01-01' + k % 7 AS start_date,
       CASE WHEN k % 5 = 0 THEN DATE '2024-01-15' END AS end_date,
       CASE WHEN k % 4 <> 0 THEN DATE '2024-01-10' + k % 6 END AS last_processed_date FROM v_events"""


def v_clicks(spark, sf):
    k = F.col("k")
    return v_events(spark, sf).select(
        "dt",
        F.col("xid").alias("infinity_id"),
        F.when(k % 11 == 0, "").otherwise(F.concat(F.lit("c"), k)).alias("content_id"),
        F.when(k % 7 == 0, "/Covid-19/x").otherwise("/story/x").alias("hits_page_pagepath"),
        F.when(k % 13 == 0, "CoronaVirus news").when(k % 17 != 0, F.col("event_type")).alias(
            "onsite_keywords"
        ),
        F.when(F.col("event_type") == "purchase", "Affiliate Link Clicks")
        .otherwise(F.col("event_type"))
        .alias("hits_eventinfo_eventaction"),
    )


SQL["v_clicks"] = """
SELECT dt, xid AS infinity_id, CASE WHEN k % 11 = 0 THEN '' ELSE 'c' || k END AS content_id,
       CASE WHEN k % 7 = 0 THEN '/Covid-19/x' ELSE '/story/x' END AS hits_page_pagepath,
       CASE WHEN k % 13 = 0 THEN 'CoronaVirus news' WHEN k % 17 <> 0 THEN event_type END AS onsite_keywords,
       CASE WHEN event_type = 'purchase' THEN 'Affiliate Link Clicks' ELSE event_type END AS hits_eventinfo_eventaction
FROM v_events"""


def v_features(spark, sf):
    kind = F.col("event_type")
    return v_events(spark, sf).groupBy("xid").agg(
        F.max("dt").alias("last_seen_date"),
        F.count_if(kind == "view").alias("feature_view"),
        F.count_if(kind == "click").alias("feature_click"),
        F.sum(F.when(kind != "error", F.round(F.col("value") * 100).cast("bigint"))).alias(
            "feature_cents"
        ),
    )


SQL["v_features"] = """
SELECT xid, max(dt) AS last_seen_date, count(*) FILTER (event_type = 'view') AS feature_view,
       count(*) FILTER (event_type = 'click') AS feature_click,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) FILTER (event_type <> 'error') AS BIGINT) AS feature_cents
FROM v_events GROUP BY xid"""


def v_nested(spark, sf):
    """Nested features per user: two structs and two arrays of named counts."""
    per_kind = v_events(spark, sf).groupBy("xid", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.min("dt").alias("first"), F.max("dt").alias("last")
    )
    topic = F.concat(F.lit("Topics::Shop "), F.initcap("event_type"), F.lit(".x"))
    return per_kind.groupBy("xid").agg(
        F.max("last").alias("last_seen_date"),
        F.struct(
            F.date_diff(F.max("last"), F.min("first")).alias("lifespan"),
            F.date_diff(F.lit(datetime.date(2024, 1, 31)), F.max("last")).alias("days_since_last_seen"),
        ).alias("feature_duration"),
        F.struct(
            F.count(F.lit(1)).alias("unique_sessions"),
            F.max("n").alias("unique_pageviews"),
            F.sum("n").alias("total_pageviews"),
        ).alias("feature_session"),
        F.array_sort(
            F.collect_list(F.struct(F.col("event_type").alias("name"), F.col("n").alias("count")))
        ).alias("feature_brands"),
        F.array_sort(
            F.collect_list(F.struct(topic.alias("name"), F.col("n").alias("score_sum")))
        ).alias("feature_admantx"),
    ).withColumnRenamed("xid", "infinity_id")


SQL["v_kinds"] = """
SELECT xid, event_type, count(*) AS n, min(dt) AS first_day, max(dt) AS last_day FROM v_events
GROUP BY xid, event_type"""


def v_training(spark, sf):
    parts = [F.col("embedding")[i].cast("double").alias(f"feature_{i}") for i in range(64)]
    return table(spark, sf, "embeddings").select(
        uid("vec_id").alias("xid"), *parts, (F.col("label") < 5).cast("int").alias("target")
    )


SQL["v_training"] = f"""
SELECT {uid_sql('vec_id')} AS xid, CAST(label < 5 AS INTEGER) AS target,
       {', '.join(f'CAST(embedding[{i + 1}] AS DOUBLE) AS feature_{i}' for i in range(64))} FROM embeddings"""


def v_scores(spark, sf):
    return table(spark, sf, "customer").select(
        uid("c_custkey").alias("xid"),
        ((F.col("c_acctbal") + 1000) / 11000).cast("float").alias("score"),
        F.lit(SCORE_DAY).alias("date"),
        (F.col("c_custkey") % 3).cast("int").alias("tid"),
    )


SQL["v_scores"] = f"""
SELECT {uid_sql('c_custkey')} AS xid, CAST((c_acctbal + 1000) / 11000 AS REAL) AS score,
       DATE '2024-02-01' AS date, CAST(c_custkey % 3 AS INTEGER) AS tid FROM customer"""


def v_history(spark, sf):
    stage = F.array(F.lit("assembly"), F.lit("training"), F.lit("scoring"))
    status = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("workflow_id"),
        stage[(F.col("o_orderkey") % 3).cast("int")].alias("stage"),
        F.when(status == "F", "success").when(status == "O", "failed").otherwise(
            "MissingFeaturesError"
        ).alias("status"),
        F.col("o_orderdate").cast("date").alias("arg_date"),
        F.timestamp_micros(
            F.unix_date(F.col("o_orderdate").cast("date")).cast("bigint") * 86400000000 + F.col("o_orderkey")
        ).alias("execution_date"),
        F.to_json(F.struct(F.concat(F.lit("m"), F.col("o_orderkey")).alias("model_uri"))).alias("info"),
        F.lit("{}").alias("stats"),
        F.lit("{}").alias("warnings"),
        F.when(status != "F", F.col("o_orderpriority")).alias("error"),
        F.lit(None).cast("string").alias("traceback"),
    )


SQL["v_history"] = """
SELECT CAST(o_custkey AS VARCHAR) AS workflow_id,
       CASE o_orderkey % 3 WHEN 0 THEN 'assembly' WHEN 1 THEN 'training' ELSE 'scoring' END AS stage,
       CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'failed' ELSE 'MissingFeaturesError' END AS status,
       CAST(o_orderdate AS DATE) AS arg_date,
       CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + to_microseconds(o_orderkey) AS execution_date,
       '{"model_uri":"m' || o_orderkey || '"}' AS info, '{}' AS stats, '{}' AS warnings,
       CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS error FROM orders"""


def v_workflow(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.concat_ws("_", F.lit("wf"), F.lower("c_mktsegment"), F.col("c_custkey")).alias("name"),
        F.col("c_name").alias("description"),
        (F.col("c_acctbal") > 0).alias("enabled"),
        (F.col("c_custkey") + 1000).cast("int").alias("trait_id"),
        (F.col("c_nationkey") % 7).cast("int").alias("weekday"),
    )


SQL["v_workflow"] = """
SELECT CAST(c_custkey AS VARCHAR) AS id, 'wf_' || lower(c_mktsegment) || '_' || c_custkey AS name,
       c_name AS description, c_acctbal > 0 AS enabled, CAST(c_custkey + 1000 AS INTEGER) AS trait_id,
       CAST(c_nationkey % 7 AS INTEGER) AS weekday FROM customer"""


def v_orders_dim(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), (F.col("o_orderstatus") != "F").alias("active")
    )


SQL["v_orders_dim"] = "SELECT o_orderkey AS order_id, o_orderstatus <> 'F' AS active FROM orders"


def v_ad_events(spark, sf):
    return v_events(spark, sf).select(
        "dt",
        F.col("k").cast("bigint").alias("order_id"),
        F.create_map(F.lit("user_id"), F.col("xid")).alias("custom_targeting"),
        F.col("event_type").alias("creative_size"),
        F.col("k").alias("creative_id"),
        F.col("user_id").alias("line_item_id"),
        F.concat(F.lit("u"), F.col("k") % 3).alias("adunit_id"),
        F.when(F.col("k") % 4 == 0, F.lit(None)).otherwise("r").alias("referer_url"),
        (F.col("event_type") == "view").alias("activevieweligibleimpression"),
    )


SQL["v_ad_events"] = """
SELECT dt, CAST(k AS BIGINT) AS order_id, xid, event_type AS creative_size, k AS creative_id,
       user_id AS line_item_id, 'u' || (k % 3) AS adunit_id,
       CASE WHEN k % 4 = 0 THEN NULL ELSE 'r' END AS referer_url,
       event_type = 'view' AS activevieweligibleimpression FROM v_events"""


def v_files(spark, sf):
    """One manifest name per day; a full drop on the 1st and 15th."""
    kind = F.when(F.dayofmonth("dt").isin(1, 15), "full").otherwise("iter")
    millis = (F.unix_date("dt").cast("bigint") * 86400 + 43200) * 1000
    return v_events(spark, sf).select("dt").distinct().select(
        F.concat(F.lit("feed_1_2_"), kind, F.lit("_"), millis, F.lit(".info")).alias("name")
    )


SQL["v_files"] = """
SELECT DISTINCT 'feed_1_2_' || CASE WHEN day(dt) IN (1, 15) THEN 'full' ELSE 'iter' END || '_' ||
       (CAST(dt - DATE '1970-01-01' AS BIGINT) * 86400 + 43200) * 1000 || '.info' AS name, dt,
       CASE WHEN day(dt) IN (1, 15) THEN 'full' ELSE 'iter' END AS type,
       CAST((dt - DATE '1970-01-01') * 86400 + 43200 AS INTEGER) AS timestamp FROM v_events"""


def v_sync_lines(spark, sf):
    """Membership as text; some lines lack segments or hold a bad token."""
    day = F.dayofmonth(F.timestamp_seconds("timestamp"))
    text = F.concat_ws(" ", "mcid", F.array_join(F.col("segment_array").cast("array<string>"), " "))
    return v_membership(spark, sf).select(
        "timestamp",
        F.when(day % 10 == 3, F.col("mcid"))
        .when(day % 10 == 7, F.concat(text, F.lit(" x9")))
        .when(day % 10 == 9, F.concat(F.lit("n/a "), text))
        .otherwise(text)
        .alias("value"),
    )


SQL["v_sync_lines"] = """
SELECT timestamp, CASE WHEN day(dt) % 10 = 3 THEN mcid
       WHEN day(dt) % 10 = 7 THEN mcid || ' ' || array_to_string(segment_array, ' ') || ' x9'
       WHEN day(dt) % 10 = 9 THEN 'n/a ' || mcid || ' ' || array_to_string(segment_array, ' ')
       ELSE mcid || ' ' || array_to_string(segment_array, ' ') END AS value FROM v_membership"""

DEPENDS = {
    "v_targets": ["v_events"], "v_membership": ["v_events"], "v_active_segments": ["v_events"],
    "v_clicks": ["v_events"], "v_features": ["v_events"], "v_kinds": ["v_events"],
    "v_ad_events": ["v_events"], "v_files": ["v_events"], "v_sync_lines": ["v_membership"],
}


def with_views(body: str) -> str:
    """Prefix the SQL with the views it names."""
    needed: list[str] = []

    def add(name):
        for inner in DEPENDS.get(name, []):
            add(inner)
        if name not in needed:
            needed.append(name)

    for name in SQL:
        if name in body:
            add(name)
    body = body.strip()
    if not needed:
        return body
    ctes = ", ".join(f"{name} AS ({SQL[name].strip()})" for name in needed)
    if body.upper().startswith("WITH "):
        return f"WITH {ctes}, {body[5:]}"
    return f"WITH {ctes} {body}"


def out(df: DataFrame) -> DataFrame:
    """Comparable output: dates as text, floats rounded, flags as 0/1, arrays as text."""
    columns = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("date", "timestamp", "timestamp_ntz"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") if kind != "date" else c.cast("string")
        elif kind in ("float", "double"):
            c = F.round(c.cast("double"), 6)
        elif kind == "boolean":
            c = c.cast("int")
        elif kind.startswith("array<"):
            c = F.array_join(F.transform(c, lambda x: F.coalesce(x.cast("string"), F.lit("-"))), " ")
        columns.append(c.alias(name))
    return df.select(*columns)


REGISTRY: dict[str, tuple] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can say it, its independent statement."""

    def register(fn):
        if name in REGISTRY:
            raise ValueError(f"{name} is registered twice")

        def run(spark, sf):
            configure(spark)
            return out(fn(spark, sf))

        run.__doc__ = fn.__doc__
        REGISTRY[name] = (run, None if sql is None else with_views(sql))
        return fn

    return register


