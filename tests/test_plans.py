"""What the plans must and must not contain, and how hot keys are handled."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from tests.conftest import rows

from cohortia.operators import latest, ranking, scores
from cohortia.operators.recipes import Behavior, Dataset, MatchesAllExcept, MatchesAny, label_users
from cohortia.operators.requirements import Requirements


def plan(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.fixture
def targets(spark, folder):
    data = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("xid"),
        F.lit("2021-01-01").cast("date").alias("date"),
        F.when(F.col("id") % 2 == 0, "ncs").otherwise("dfp").alias("vendor"),
        F.lit("s").alias("source"),
        F.concat(F.lit("g"), F.col("id") % 5).alias("group"),
        F.lit("{}").alias("aspect"),
        (F.col("id") % 7).cast("float").alias("value"),
    )
    data.write.partitionBy("vendor", "group").parquet(f"{folder}/targets")
    return spark.read.parquet(f"{folder}/targets")


def recipe(group):
    return Dataset("binary", {
        "positive": MatchesAny([Behavior({"vendor": "ncs", "group": group})]),
        "negative": MatchesAny([Behavior({"vendor": "dfp", "group": group})]),
    }, Requirements("binary"))


def test_labels_of_many_recipes_are_one_scan_and_one_shuffle(targets):
    text = plan(label_users(targets, {g: recipe(g) for g in ("g1", "g2", "g3")}))
    assert len(re.findall(r"\) Scan parquet", text)) == 1
    assert len(re.findall(r"\) Exchange", text)) == 1
    assert "Window" not in text
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_recipes_prune_partitions_and_columns(targets):
    text = plan(label_users(targets, {"g1": recipe("g1")}))
    assert re.search(r"PartitionFilters: \[.*group", text)
    schema = re.search(r"ReadSchema: (.*)", text).group(1)
    assert schema == "struct<xid:string>"


def test_all_except_is_an_aggregate_even_for_a_hot_user(targets):
    odd = Dataset("binary", {
        "positive": MatchesAllExcept([Behavior({"vendor": "dfp"})], [Behavior({"vendor": "ncs"})]),
        "negative": MatchesAny([Behavior({"vendor": "dfp"})]),
    }, Requirements("binary"))
    labels = label_users(targets, {"t": odd})
    assert "Window" not in plan(labels)
    assert rows(labels.filter("xid = 'hot'")) == {("hot", 0): 1}


def test_rank_windows_see_values_not_rows(spark):
    """All rows share three scores: every window input has three rows."""
    df = spark.range(20000).select((F.col("id") % 3 / 10).cast("float").alias("score"))
    ranked = ranking.value_ranks(df, "score", descending=True)
    assert rows(ranked.select("n_rows")) == {(6667,): 2, (6666,): 1}
    tree = plan(ranked).split("\n\n")[0]
    assert "HashAggregate" in tree[tree.rindex("Window") :]  # rows are counted before any window


def test_threshold_tables_equal_the_window_form(spark):
    """Ties, a hot score and NULLs; thresholds that fall inside and between buckets."""
    value = F.when(F.col("id") % 3 == 0, 0.5).when(F.col("id") % 11 == 0, None).otherwise(F.rand(5))
    df = spark.range(4000).select((F.col("id") % 2).alias("tid"), value.cast("float").alias("score")).cache()
    cuts, names = [0.0, 0.001, 0.25, 0.5, 0.75], ["a", "b", "c", "d", "e", "f"]
    for strategy in ("percentile", "absolute"):
        rank = F.percent_rank().over(Window.partitionBy("tid").orderBy(F.col("score").desc()))
        by = rank if strategy == "percentile" else F.col("score").cast("double")
        by = F.when(F.col("score").isNotNull(), by)
        label = scores.bucket_label(F.col("by"), F.array(*map(F.lit, cuts)), F.array(*map(F.lit, names)))
        expected = df.withColumn("by", by).groupBy("tid", label.alias("bucket")).agg(
            F.min("score"), F.max("score"), F.round(F.avg("score"), 9))
        got = scores.threshold_table(df, strategy, cuts, names, ["tid"])
        assert rows(got.select("tid", "bucket", "min_score", "max_score", F.round("avg_score", 9))) == rows(expected)


def test_best_run_is_a_partial_aggregate(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("workflow_id"), F.lit("s").alias("stage"),
                                F.lit("success").alias("status"), F.col("id").alias("execution_date"))
    best = latest.best_run(df)
    assert "Window" not in plan(best) and "partial_max_by" in plan(best)
    assert rows(best.select("workflow_id", "execution_date")) == {(0, 8): 1, (1, 9): 1}


def test_hot_users_give_the_same_result_on_any_layout(targets):
    one = label_users(targets.repartition(1), {"g1": recipe("g1")})
    many = label_users(targets.repartition(11), {"g1": recipe("g1")})
    assert rows(one) == rows(many)


def test_a_hot_user_is_split_in_the_recent_activity_join(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        user = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.md5((F.col("id") % 30000).cast("string")))
        clicks = spark.range(0, 300_000, 1, 16).select(
            user.alias("xid"),
            F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 30).cast("int")).alias("dt"),
            F.md5(F.col("id").cast("string")).alias("page"),
        )
        recent = latest.recent_activity(clicks, "xid", "dt", 10)
        found = recent.groupBy("xid", "last_seen").agg(F.max("page").alias("page")).agg(F.count("page"))
        found.collect()
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
