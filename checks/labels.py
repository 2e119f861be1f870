"""D: label recipes, and the aggregates and requirements that use them."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as v
from checks.scans import scratch
from checks.views import query
from cohortia.operators import requirements as req
from cohortia.operators.recipe_defaults import by_percentile, dataset_for
from cohortia.operators.recipe_index import label_rows
from cohortia.operators.recipes import (
    Behavior,
    ColumnAsTarget,
    Dataset,
    MatchesAllExcept,
    MatchesAny,
    MatchesAnyWithout,
    MatchesPercentage,
    TargetClass,
    find_keys,
    label_one,
    label_users,
)
from cohortia.plans.assembly import assemble
from cohortia.plans.workflow import Workflow

ROW = 'xid, CAST(date AS VARCHAR) AS date, source, "group", aspect, round(CAST(value AS DOUBLE), 6) AS value'
ROW_COLUMNS = ["xid", "date", "source", "group", "aspect", "value"]
NONE = {"logic": "no_requirements"}


@query("d01_behavior", f"""
SELECT {ROW} FROM v_targets WHERE vendor = 'dfp' AND "group" = 'g3' AND json_extract_string(aspect, '$.k') = '13'
UNION ALL SELECT {ROW} FROM v_targets WHERE vendor IS NULL""")
def _(spark, sf):
    targets = v.v_targets(spark, sf)
    exact = Behavior.from_dict({"vendor": "dfp", "group": "g3", "aspect": {"k": 13}})
    missing = Behavior.from_dict({"vendor": None})
    return targets.filter(exact.condition()).union(targets.filter(missing.condition())).select(*ROW_COLUMNS)


GENERAL = {
    "logic": "general_behavior",
    "vendor": "dfp",
    "value": {"value": 30, "direction": "greater_than"},
    "aspect": {"k": {"value": 40, "direction": "less_than"}},
}
GENERAL_SQL = "vendor = 'dfp' AND value >= 30 AND CAST(json_extract_string(aspect, '$.k') AS REAL) <= 40"


@query("d02_general_behavior", f"SELECT {ROW} FROM v_targets WHERE {GENERAL_SQL}")
def _(spark, sf):
    return v.v_targets(spark, sf).filter(Behavior.from_dict(GENERAL).condition()).select(*ROW_COLUMNS)


NESTED = {
    "logic": "matches_any",
    "args": {
        "behaviors": [{"vendor": "ncs", "group": "g1"}, GENERAL],
        "classes": [
            {"logic": "matches_any", "args": {"behaviors": [{"vendor": "adobe", "group": "g7"}]}}
        ],
    },
}
NESTED_SQL = f"""((vendor = 'ncs' AND "group" = 'g1') OR ({GENERAL_SQL}) OR (vendor = 'adobe' AND "group" = 'g7'))"""


@query("d03_matches_any", f"SELECT {ROW} FROM v_targets WHERE {NESTED_SQL}")
def _(spark, sf):
    targets = v.v_targets(spark, sf)
    return targets.filter(TargetClass.from_dict(NESTED).mask(targets)).select(*ROW_COLUMNS)


@query("d03_wide_recipe", f"""SELECT {ROW} FROM v_targets
WHERE (vendor = 'dfp' AND CAST(substr("group", 2) AS INTEGER) % 3 = 0) OR {NESTED_SQL}""")
def _(spark, sf):
    """Thousands of behaviours next to nested classes."""
    many = [Behavior({"vendor": "dfp", "group": f"g{3 * k}"}) for k in range(5000)]
    targets = v.v_targets(spark, sf)
    recipe = MatchesAny(many, [TargetClass.from_dict(NESTED)])
    return targets.filter(recipe.mask(targets)).select(*ROW_COLUMNS)


@query("d04_matches_any_without", """
SELECT xid, CAST(bool_or(vendor = 'ncs') AND NOT bool_or("group" = 'g3' AND coalesce(value > 900, false)) AS INTEGER) AS matched
FROM v_targets GROUP BY xid""")
def _(spark, sf):
    """Users with a purchase and without a large value in one group."""
    large = {"logic": "general_behavior", "group": "g3", "value": {"value": 900.0000001, "direction": "greater_than"}}
    recipe = MatchesAnyWithout([Behavior({"vendor": "ncs"})], [Behavior.from_dict(large)])
    targets = v.v_targets(spark, sf)
    return targets.groupBy("xid").agg(recipe.compile(targets).user.alias("matched"))


@query("d04_matches_all_except", """
SELECT DISTINCT xid, CAST(min(coalesce(value <= 400, vendor = 'dfp')) OVER (PARTITION BY xid) AS INTEGER) AS matched
FROM v_targets""")
def _(spark, sf):
    """Users all of whose rows satisfy the excluded test."""
    low = {"logic": "general_behavior", "value": {"value": 400, "direction": "less_than"}}
    recipe = MatchesAllExcept([Behavior({"vendor": "dfp"})], [Behavior.from_dict(low)])
    targets = v.v_targets(spark, sf)
    return targets.groupBy("xid").agg(recipe.compile(targets).user.alias("matched"))


@query("d05_matches_percentage", """
WITH ranked AS (SELECT xid, row_number() OVER (ORDER BY value, md5(xid), xid) / CAST(count(*) OVER () AS DOUBLE) AS ratio
  FROM v_targets WHERE vendor = 'dfp' AND "group" = 'g3')
SELECT DISTINCT xid, 'top' AS side FROM ranked WHERE ratio >= 0.95
UNION ALL SELECT DISTINCT xid, 'bottom' FROM ranked WHERE ratio <= 0.1""")
def _(spark, sf):
    targets = v.v_targets(spark, sf)
    group = Behavior({"vendor": "dfp", "group": "g3"})
    sides = {
        "top": MatchesPercentage(group, 0.95),
        "bottom": MatchesPercentage(group, 0.1, direction="less_than"),
    }
    keys = find_keys(targets, list(sides.values()))
    top, bottom = (
        targets.filter(share.compile(targets, keys).row).select("xid", F.lit(side).alias("side")).distinct()
        for side, share in sides.items()
    )
    return top.union(bottom)


def shares_of(targets, column, group):
    """Users in the top twentieth and the bottom tenth of a group's rows by a column."""
    sides = {
        "top": MatchesPercentage(group, 0.95, column),
        "bottom": MatchesPercentage(group, 0.1, column, direction="less_than"),
    }
    keys = find_keys(targets, list(sides.values()))
    top, bottom = (
        targets.filter(share.compile(targets, keys).row).select("xid", F.lit(side).alias("side")).distinct()
        for side, share in sides.items()
    )
    return top.union(bottom)


SHARES_SQL = """
WITH ranked AS (SELECT xid, row_number() OVER (ORDER BY {value} NULLS FIRST, md5(xid), xid) / CAST(count(*) OVER () AS DOUBLE) AS ratio
  FROM v_targets WHERE vendor = 'dfp')
SELECT DISTINCT xid, 'top' AS side FROM ranked WHERE ratio >= 0.95
UNION ALL SELECT DISTINCT xid, 'bottom' FROM ranked WHERE ratio <= 0.1"""


@query("d05_percentage_of_text", SHARES_SQL.format(value="aspect"))
def _(spark, sf):
    return shares_of(v.v_targets(spark, sf), "aspect", Behavior({"vendor": "dfp"}))


@query("d05_percentage_of_long", SHARES_SQL.format(
    value="9007199254740992 + CAST(floor(value) AS BIGINT) * CASE WHEN xid < 'u5' THEN 1 ELSE -1 END"))
def _(spark, sf):
    """Longs above 2^53, of which doubles could not tell neighbours apart."""
    sign = F.when(F.col("xid") < "u5", 1).otherwise(-1)
    big = F.lit(2**53) + F.floor("value").cast("bigint") * sign
    return shares_of(v.v_targets(spark, sf).withColumn("big", big), "big", Behavior({"vendor": "dfp"}))


@query("d06_column_as_target", """
SELECT xid, CASE WHEN vendor = 'dfp' AND "group" = 'g3' THEN source END AS target, count(*) AS n
FROM v_targets GROUP BY 1, 2""")
def _(spark, sf):
    targets = v.v_targets(spark, sf)
    label = ColumnAsTarget(Behavior({"vendor": "dfp", "group": "g3"}), "source")
    return targets.select("xid", label.value(targets).alias("target")).groupBy("xid", "target").agg(
        F.count(F.lit(1)).alias("n")
    )


def recipe(positive, negative=None):
    negative = negative or [{"vendor": "dfp", "source": "view"}]
    return Dataset.from_dict(
        {
            "family": "binary",
            "classes": {
                "positive": {"logic": "matches_any", "args": {"behaviors": positive}},
                "negative": {"logic": "matches_any", "args": {"behaviors": negative}},
            },
            "data_requirements": NONE,
        }
    )


def ad_recipe(group="g3"):
    return recipe([{"vendor": "dfp", "source": "click", "group": group}])


AD_LABEL = """CASE WHEN vendor = 'dfp' AND source = 'click' AND "group" = 'g3' THEN 1
  WHEN vendor = 'dfp' AND source = 'view' THEN 0 END"""


@query("d07_binary_label", f"""
SELECT xid, source, {AD_LABEL} AS target, count(*) AS n FROM v_targets
WHERE {AD_LABEL} IS NOT NULL GROUP BY 1, 2, 3""")
def _(spark, sf):
    targets = v.v_targets(spark, sf)
    rows = targets.select("xid", "source", ad_recipe().target(targets)).filter("target IS NOT NULL")
    return rows.groupBy("xid", "source", "target").agg(F.count(F.lit(1)).alias("n"))


MULTI_LABEL = """CASE WHEN vendor = 'ncs' THEN 'buyer' WHEN value >= 20 THEN 'heavy' WHEN vendor = 'dfp' THEN 'ads' END"""


@query("d08_multi_label", f"""
SELECT 'row' AS kind, xid, {MULTI_LABEL} AS target, count(*) AS n FROM v_targets GROUP BY 1, 2, 3 HAVING {MULTI_LABEL.replace('vendor', 'any_value(vendor)').replace('value >=', 'any_value(value) >=')} IS NOT NULL
UNION ALL SELECT 'user', xid, max({MULTI_LABEL}), 0 FROM v_targets GROUP BY xid HAVING max({MULTI_LABEL}) IS NOT NULL""")
def _(spark, sf):
    heavy = {"logic": "general_behavior", "value": {"value": 20, "direction": "greater_than"}}
    data = Dataset(
        "multiclass",
        {
            "buyer": MatchesAny([Behavior({"vendor": "ncs"})]),
            "heavy": MatchesAny([Behavior.from_dict(heavy)]),
            "ads": MatchesAny([Behavior({"vendor": "dfp"})]),
        },
    )
    targets = v.v_targets(spark, sf)
    rows = targets.select("xid", data.target(targets)).filter("target IS NOT NULL")
    counted = rows.groupBy("xid", "target").agg(F.count(F.lit(1)).alias("n"))
    users = label_one(targets, data).select(
        F.lit("user").alias("kind"), "xid", "target", F.lit(0).cast("bigint").alias("n")
    )
    return counted.select(F.lit("row").alias("kind"), "xid", "target", "n").union(users)


@query("d10_default_recipes", """
SELECT 'adobe' AS recipe, xid, max(CASE WHEN "group" IN ('g1', 'g2') THEN 1 ELSE 0 END) AS target
FROM v_targets WHERE vendor = 'adobe' GROUP BY xid
UNION ALL SELECT 'dfp', xid, max(CASE WHEN source = 'network_clicks' THEN 1 ELSE 0 END)
FROM (SELECT xid, vendor, "group", CASE source WHEN 'click' THEN 'network_clicks' ELSE 'network_impressions' END AS source
      FROM v_targets WHERE vendor = 'dfp') WHERE "group" IN ('g4', 'g5') GROUP BY xid
UNION ALL SELECT 'custom', xid, max(CAST(round(value) % 2 AS INTEGER)) FROM v_targets
WHERE vendor = 'custom' AND source = 'signup' AND "group" = 'g6' GROUP BY xid
UNION ALL SELECT 'ncs', xid, max(CAST(round(value) % 2 AS INTEGER)) FROM v_targets
WHERE vendor = 'ncs' AND "group" = 'g1' GROUP BY xid""")
def _(spark, sf):
    """Default recipes on targets whose sources and values follow the vendors' conventions."""
    targets = v.v_targets(spark, sf)
    source = (
        F.when(F.col("source") == "click", "network_clicks")
        .when(F.col("source") == "view", "network_impressions")
        .otherwise(F.col("source"))
    )
    flag = (F.round("value") % 2).cast("float")
    named = targets.withColumns({"source": source, "value": flag})
    recipes = {
        "adobe": dataset_for("adobe", groups=["g1", "g2"]),
        "dfp": dataset_for("dfp", groups=["g4", "g5"]),
        "custom": dataset_for("custom", source="signup", groups=["g6"]),
        "ncs": dataset_for("ncs", source="syndicated", groups=["g1"]),
    }
    labels = label_users(named, recipes)
    return labels.unpivot("xid", list(recipes), "recipe", "target").filter("target IS NOT NULL")


@query("d10_percentile_recipe", """
WITH ranked AS (SELECT xid, "group", row_number() OVER (PARTITION BY "group" ORDER BY value, md5(xid), xid)
    / CAST(count(*) OVER (PARTITION BY "group") AS DOUBLE) AS ratio
  FROM v_targets WHERE vendor = 'ncs' AND "group" IN ('g1', 'g2'))
SELECT xid, CASE WHEN max(ratio) >= 0.95 THEN 1 ELSE 0 END AS target FROM ranked
GROUP BY xid HAVING max(ratio) >= 0.95 OR min(ratio) <= 0.1""")
def _(spark, sf):
    targets = v.v_targets(spark, sf).withColumn(
        "source", F.when(F.col("vendor") == "ncs", "custom").otherwise(F.col("source"))
    )
    return label_one(targets, by_percentile(["g1", "g2"]))


@query("f02_user_labels", f"""
SELECT xid, max({AD_LABEL}) AS target FROM v_targets GROUP BY xid HAVING max({AD_LABEL}) IS NOT NULL""")
def _(spark, sf):
    """Flagship: label each user from a recipe."""
    return label_one(v.v_targets(spark, sf), ad_recipe())


@query("f10_class_counts", "SELECT target, count(*) AS n FROM v_training GROUP BY target")
def _(spark, sf):
    return req.class_counts(v.v_training(spark, sf))


SPLIT_HASH = "CAST('0x' || substr(md5({}), 1, 8) AS BIGINT) / 4294967296.0"


@query("l10_down_sampling", f"""
WITH sized AS (SELECT target, count(*) AS n FROM v_training GROUP BY target)
SELECT xid, target FROM v_training JOIN sized USING (target)
WHERE {SPLIT_HASH.format('xid')} < CASE target WHEN 1 THEN least(1.0, 100.0 / n) ELSE least(1.0, 400.0 / n) END""")
def _(spark, sf):
    wanted = {"logic": "min_max_provided", "min_positive": 10, "min_negative": 10,
              "max_positive": 100, "max_negative": 400}
    rows = v.v_training(spark, sf).select("xid", "target")
    return req.Requirements.from_dict(wanted, "binary").meet(rows)[0]


@query("l11_no_requirements", "SELECT xid, target FROM v_training")
def _(spark, sf):
    rows = v.v_training(spark, sf).select("xid", "target")
    return req.Requirements.from_dict(NONE, "binary").meet(rows)[0]


GROUP_LABEL = """max(CASE WHEN vendor = 'dfp' AND source = 'click' AND "group" = 'g{0}' THEN 1
  WHEN vendor = 'dfp' AND source = 'view' THEN 0 END)"""


@query("e12_label_frames", f"""
SELECT a.xid, a.g1, a.g2, a.g3 FROM (SELECT xid, {', '.join(GROUP_LABEL.format(i) + f' AS g{i}' for i in (1, 2, 3))}
FROM v_targets GROUP BY xid) a WHERE coalesce(g1, g2, g3) IS NOT NULL""")
def _(spark, sf):
    """One pass labels every workflow: the outer fold of separate label frames."""
    names = ["g1", "g2", "g3"]
    return label_users(v.v_targets(spark, sf), {g: ad_recipe(g) for g in names})


@query("e12_label_index", """
WITH wanted AS (SELECT i, 'w' || i AS name, 'g' || (i % 10) AS grp, (i // 10) AS least FROM range(2000) t(i)),
row_labels AS (SELECT t.xid, w.name, CASE
    WHEN w.i % 2 = 0 AND t.vendor = 'dfp' AND t.source = 'click' AND t."group" = w.grp AND t.value >= w.least THEN 1
    WHEN w.i % 2 = 1 AND t.vendor = 'ncs' AND t."group" = w.grp AND json_extract_string(t.aspect, '$.k') = CAST(w.least AS VARCHAR) THEN 1
    WHEN t.vendor = 'adobe' AND t."group" = w.grp THEN 0 END AS target
  FROM v_targets t JOIN wanted w ON t."group" = w.grp)
SELECT xid, name, max(target) AS target FROM row_labels WHERE target IS NOT NULL GROUP BY ALL""")
def _(spark, sf):
    """Two thousand data sets by an index of their values: bounds and aspects are tested on the rows found."""
    datasets = {}
    for i in range(2000):
        group, least = f"g{i % 10}", i // 10
        bound = {"value": least, "direction": "greater_than"}
        clicks = Behavior({"vendor": "dfp", "source": "click", "group": group, "value": bound}, general=True)
        bought = Behavior({"vendor": "ncs", "group": group}, {"k": str(least)})
        datasets[f"w{i}"] = Dataset("binary", {
            "positive": MatchesAny([bought if i % 2 else clicks]),
            "negative": MatchesAny([Behavior({"vendor": "adobe", "group": group})]),
        })
    return label_rows(v.v_targets(spark, sf), datasets)


@query("e13_features_and_labels", f"""
SELECT f.xid, f.feature_view, f.feature_click, l.target FROM v_features f
JOIN (SELECT xid, max({AD_LABEL}) AS target FROM v_targets GROUP BY xid) l ON f.xid = l.xid
WHERE l.target IS NOT NULL""")
def _(spark, sf):
    labels = label_one(v.v_targets(spark, sf), ad_recipe())
    return v.v_features(spark, sf).join(labels, "xid").select(
        "xid", "feature_view", "feature_click", "target"
    )


@query("m15_assemble_training_sets", f"""
WITH labels AS (SELECT xid, {', '.join(GROUP_LABEL.format(i) + f' AS g{i}' for i in (1, 2))} FROM v_targets GROUP BY xid),
long AS (SELECT 'w1' AS workflow_id, xid, g1 AS target, 40 AS most FROM labels
  UNION ALL SELECT 'w2', xid, g2, 1000 FROM labels),
sized AS (SELECT workflow_id, target, count(*) AS n FROM long JOIN v_features USING (xid) WHERE target IS NOT NULL GROUP BY ALL)
SELECT workflow_id, xid, target, feature_view, feature_click, coalesce(feature_cents, 0) AS feature_cents
FROM long JOIN v_features USING (xid) JOIN sized USING (workflow_id, target)
WHERE target IS NOT NULL AND {SPLIT_HASH.format('xid')} < least(1.0, most / CAST(n AS DOUBLE))""")
def _(spark, sf):
    """Three workflows in one job; the third one's classes are too small and are skipped."""
    targets = v.v_targets(spark, sf)
    features = v.v_features(spark, sf).fillna(0)

    def limits(least, most):
        return {"logic": "min_max_provided", "min_positive": least, "min_negative": least,
                "max_positive": most, "max_negative": most}

    def workflow(name, group, least, most):
        data = ad_recipe(group)
        data.requirements = req.Requirements.from_dict(limits(least, most), "binary")
        return Workflow(name, name, 1, dataset=data)

    path = scratch(spark, "sets")
    too_large = 10**12
    responses = assemble(
        features, targets,
        [workflow("w1", "g1", 1, 40), workflow("w2", "g2", 1, 1000), workflow("w3", "g3", too_large, too_large)],
        v.FIRST_DAY, path,
    )
    assert [r["status"] for r in responses] == ["success", "success", "failed_on_load_target"], responses
    return spark.read.parquet(path)


