"""L: learning and score operators, and the scoring and post-processing plans."""

from __future__ import annotations

import datetime
import json

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks import views as v
from checks.labels import SPLIT_HASH
from checks.scans import scratch, written
from checks.views import query
from cohortia import schemas
from cohortia.operators import scores as sc
from cohortia.operators.ranking import quantile_cuts
from cohortia.plans import postprocessing, scoring, training
from cohortia.plans.workflow import Thresholds, Workflow
from cohortia.sources import sinks

DAY = v.SCORE_DAY


@query("l01_feature_vector", "SELECT xid, round(" + " + ".join(
    f"feature_{i} * {i}" for i in range(64)) + ", 4) AS total FROM v_training")
def _(spark, sf):
    rows = v.v_training(spark, sf)
    vectors = training.assembler(rows).transform(rows)
    array = vector_to_array("features")
    weighted = F.aggregate(
        F.arrays_zip(array.alias("x"), F.sequence(F.lit(0), F.lit(63)).alias("i")),
        F.lit(0.0),
        lambda total, pair: total + pair["x"] * pair["i"],
    )
    return vectors.select("xid", F.round(weighted, 4).alias("total"))


SPLIT_SQL = SPLIT_HASH.format("'split|' || xid")


@query("l02_hash_split", f"""
SELECT xid, CASE WHEN {SPLIT_SQL} < 0.6 THEN 'train' WHEN {SPLIT_SQL} < 0.8 THEN 'validation' ELSE 'test' END AS split
FROM v_training""")
def _(spark, sf):
    return training.with_split(v.v_training(spark, sf)).select("xid", "split")


@query("l03_tuned_model")
def _(spark, sf):
    """Best of four trials: its training and test measures."""
    rows = v.v_training(spark, sf)
    _, measured = training.fit_best(rows)
    named = F.create_map(*[F.lit(x) for pair in measured.items() for x in pair])
    total = rows.agg(F.count(F.lit(1)).alias("rows_used"))
    return total.select("rows_used", F.explode(named).alias("metric", "value"))


@query("l04_balanced_accuracy", """
SELECT round((count(*) FILTER (l = 1 AND p = 1) / CAST(count(*) FILTER (l = 1) AS DOUBLE)
  + count(*) FILTER (l = 0 AND p = 0) / CAST(count(*) FILTER (l = 0) AS DOUBLE)) / 2, 6) AS balanced_accuracy
FROM (SELECT CAST(score >= 0.5 AS INTEGER) AS l, CAST(tid = 1 AS INTEGER) AS p FROM v_scores)""")
def _(spark, sf):
    rows = v.v_scores(spark, sf).select(
        (F.col("score") >= 0.5).cast("int").alias("target"), (F.col("tid") == 1).cast("int").alias("prediction")
    )
    return training.balanced_accuracy(rows)


@query("l04_roc_auc", """
WITH r AS (SELECT CAST(score >= 0.5 AS INTEGER) AS l, CAST(floor(20 * ((score * 7) % 1)) AS INTEGER) AS p FROM v_scores),
n AS (SELECT l, (rank() OVER (ORDER BY p) + count(*) OVER (PARTITION BY p) / 2.0 - 0.5) AS place FROM r),
c AS (SELECT sum(l) AS pos, count(*) - sum(l) AS neg, sum(place) FILTER (l = 1) AS places, count(*) AS n FROM n)
SELECT n AS rows_used, round((places - pos * (pos + 1) / 2.0) / (CAST(pos AS DOUBLE) * neg), 5) AS auc FROM c""")
def _(spark, sf):
    """The exact area under the ROC curve of a score with many ties, against the rank sum."""
    rows = v.v_scores(spark, sf).select(
        (F.col("score") >= 0.5).cast("int").alias("target"),
        F.floor(20 * ((F.col("score") * 7) % 1)).cast("double").alias("rawPrediction"),
    )
    area = training.roc_auc(rows)
    return rows.agg(F.count(F.lit(1)).alias("rows_used")).withColumn("auc", F.round(F.lit(area), 5))


@query("l05_quality_warnings", """
WITH m AS (SELECT tid, avg(CAST(score AS DOUBLE)) AS train, min(CAST(score AS DOUBLE)) + 0.45 AS test FROM v_scores GROUP BY tid)
SELECT tid, 'overfit_warning' AS warning FROM m WHERE train - test > 0.05
UNION ALL SELECT tid, 'poor_model_warning' FROM m WHERE test < 0.6""")
def _(spark, sf):
    """Warnings of models whose measures come from the score table."""
    measured = v.v_scores(spark, sf).groupBy("tid").agg(
        F.avg(F.col("score").cast("double")).alias("train_roc_auc"),
        (F.min(F.col("score").cast("double")) + 0.45).alias("test_roc_auc"),
    )
    rows = [(r.tid, name) for r in measured.collect() for name in training.quality_warnings(r.asDict())]
    return spark.createDataFrame(rows, "tid int, warning string").join(measured.select("tid"), "tid")


@query("l06_predictions")
def _(spark, sf):
    rows = v.v_training(spark, sf)
    vectors = training.assembler(rows)
    model = LogisticRegression(labelCol="target").fit(vectors.transform(rows))
    scored = scoring.predicted(rows, PipelineModel([vectors, model]), "score")
    return scored.select("xid", "target", "score")


def weights(tid):
    """Coefficients of a model that is made by hand: even features, or all."""
    return {i: ((i * (tid + 3)) % 7 - 3) / 10 for i in range(0, 64, 2 if tid == 1 else 1)}


LINEAR_SQL = " UNION ALL ".join(
    f"SELECT xid, {tid} AS tid, 1 / (1 + exp(-({tid} * 0.125 + " + " + ".join(f"{c} * CAST(feature_{i} AS DOUBLE)" for i, c in weights(tid).items())
    + "))) AS score FROM v_training" for tid in range(3))


@query("l06_linear_models", f"SELECT xid, tid, round(CAST(CAST(score AS FLOAT) AS DOUBLE), 5) AS score FROM ({LINEAR_SQL})")
def _(spark, sf):
    """Three models over two lists of features: two assemblies and one pass."""
    rows = v.v_training(spark, sf).withColumnRenamed("xid", "infinity_id")
    models = {
        tid: scoring.LinearModel(tuple(f"feature_{i}" for i in weights(tid)), tuple(weights(tid).values()), tid * 0.125)
        for tid in range(3)
    }
    scored = scoring.linear_scores(rows, models)
    return scored.withColumn("score", F.round(F.col("score").cast("double"), 5))


JITTERED = f"CAST(score + {SPLIT_HASH.format('xid')} * 0.0001 AS REAL)"


@query("l07_jitter", f"SELECT xid, round(CAST({JITTERED} AS DOUBLE), 5) AS temp_score FROM v_scores")
def _(spark, sf):
    rows = sc.jittered(v.v_scores(spark, sf))
    return rows.select("xid", F.round(F.col("temp_score").cast("double"), 5).alias("temp_score"))


DECILES = """
cuts AS (SELECT {keys} list_distinct(quantile_disc(score, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS c FROM v_scores {group})"""


@query("l08_deciles", f"""
WITH {DECILES.format(keys='', group='')} SELECT xid, 10 - len(list_filter(c, lambda x: x <= score)) AS decile FROM v_scores, cuts""")
def _(spark, sf):
    rows = sc.with_decile(v.v_scores(spark, sf), "score")
    return rows.select("xid", F.col("decile").cast("bigint").alias("decile"))


@query("l08_deciles_per_workflow", f"""
WITH {DECILES.format(keys='tid,', group='GROUP BY tid')} SELECT xid, tid, 10 - len(list_filter(c, lambda x: x <= score)) AS decile
FROM v_scores JOIN cuts USING (tid)""")
def _(spark, sf):
    rows = sc.with_decile(v.v_scores(spark, sf), "score", by=["tid"])
    return rows.select("xid", "tid", F.col("decile").cast("bigint").alias("decile"))


@query("l08_quantile_cuts", """
SELECT tid, array_to_string([round(CAST(x AS DOUBLE), 5) for x in quantile_disc(score, [0.25, 0.5, 0.75])], ' ') AS cuts
FROM v_scores GROUP BY tid""")
def _(spark, sf):
    cuts = quantile_cuts(v.v_scores(spark, sf), "score", 4, ["tid"])
    rounded = F.transform("cuts", lambda x: F.round(x.cast("double"), 5).cast("string"))
    return cuts.select("tid", F.array_join(rounded, " ").alias("cuts"))


RANKED = """(SELECT *, CASE WHEN score IS NOT NULL THEN percent_rank() OVER ({by} ORDER BY score DESC NULLS LAST) END AS p
  FROM (SELECT xid, tid, CASE WHEN score >= 0.02 THEN score END AS score FROM v_scores))"""
CUTS, LABELS = [0.1, 0.4, 0.8], ["best", "good", "fair", "rest"]
LABEL_SQL = "CASE WHEN p < 0.1 THEN 'best' WHEN p < 0.4 THEN 'good' WHEN p < 0.8 THEN 'fair' WHEN p >= 0.8 THEN 'rest' ELSE 'none' END"
RANGES = """coalesce(round(CAST(min(score) AS DOUBLE), 6), -1) AS min_score, coalesce(round(CAST(max(score) AS DOUBLE), 6), -1) AS max_score,
  coalesce(round(avg(CAST(score AS DOUBLE)), 6), -1) AS avg_score"""


def gappy(spark, sf):
    bound = F.lit(0.02).cast("float")  # as a double it is larger than a score of 0.02
    return v.v_scores(spark, sf).withColumn("score", F.when(F.col("score") >= bound, F.col("score")))


def plain(table):
    return table.fillna(-1, ["min_score", "max_score", "avg_score"]).fillna("none", ["bucket"])


@query("l09_threshold_buckets", f"""
SELECT xid, {LABEL_SQL} AS bucket FROM {RANKED.format(by='')}""")
def _(spark, sf):
    from cohortia.operators.ranking import with_percent_rank

    ranked = with_percent_rank(gappy(spark, sf), "score")
    label = sc.bucket_label(
        F.col("raw_percentile"), F.array(*map(F.lit, CUTS)), F.array(*map(F.lit, LABELS))
    )
    return ranked.select("xid", F.coalesce(label, F.lit("none")).alias("bucket"))


@query("f09_bucket_ranges", f"""
SELECT 'percentile' AS strategy, {LABEL_SQL} AS bucket, {RANGES} FROM {RANKED.format(by='')} GROUP BY 2""")
def _(spark, sf):
    return plain(sc.threshold_table(gappy(spark, sf), "percentile", CUTS, LABELS))


@query("f08_decile_stats", f"""
WITH {DECILES.format(keys='', group='')} SELECT 10 - len(list_filter(c, lambda x: x <= score)) AS decile, count(*) AS count,
  round(CAST(max(score) AS DOUBLE), 6) AS max_score, round(CAST(min(score) AS DOUBLE), 6) AS min_score,
  round(avg(CAST(score AS DOUBLE)), 6) AS avg_score FROM v_scores, cuts GROUP BY 1""")
def _(spark, sf):
    stats = sc.score_stats(sc.with_decile(v.v_scores(spark, sf), "score"))
    return stats.withColumn("decile", F.col("decile").cast("bigint"))


@query("l12_model_lookup", """
SELECT workflow_id, json_extract_string(info, '$.model_uri') AS model_uri FROM (SELECT *, row_number() OVER (
  PARTITION BY workflow_id ORDER BY arg_date DESC, execution_date DESC) AS rn FROM v_history
  WHERE stage = 'training' AND status = 'success' AND arg_date <= DATE '2000-01-01') WHERE rn = 1""")
def _(spark, sf):
    last = scoring.last_trainings(v.v_history(spark, sf), datetime.date(2000, 1, 1))
    return last.select("workflow_id", F.get_json_object("info", "$.model_uri").alias("model_uri"))


def two_workflows():
    return [Workflow("w1", "wf_a_1", 11), Workflow("w2", "wf_b_2", 12)]


def trained(spark, sf):
    """Two trained workflows: their training sets, reports and models folder."""
    rows = v.v_training(spark, sf)
    other = rows.withColumn("target", 1 - F.col("target"))
    sets = rows.withColumn("workflow_id", F.lit("w1")).unionByName(
        other.withColumn("workflow_id", F.lit("w2"))
    )
    path = scratch(spark, "sets")
    sinks.write_training_sets(sets, path)
    models = scratch(spark, "models")
    reports = training.train_workflows(spark.read.parquet(path), two_workflows(), DAY, models)
    assert all(r["status"] == "success" for r in reports), reports
    return reports


@query("m16_train_workflows")
def _(spark, sf):
    reports = trained(spark, sf)
    measured = [(r["workflow_id"], k, float(x)) for r in reports for k, x in json.loads(r["stats"]).items()]
    rows = v.v_training(spark, sf).agg(F.count(F.lit(1)).alias("rows_used"))
    entries = [F.struct(*[F.lit(x).alias(n) for x, n in zip(m, ("workflow_id", "metric", "value"))]) for m in measured]
    return rows.select("rows_used", F.inline(F.array(*entries)))


@query("m17_score_workflows", """
SELECT 11 + w AS tid, '2024-02-01' AS date, count(*) AS n, 10 AS deciles FROM v_training, (SELECT unnest([0, 1]) AS w) GROUP BY w""")
def _(spark, sf):
    """Scores written for two trained workflows; a third has no model."""
    history = sinks.history_frame(spark, trained(spark, sf))
    features = v.v_training(spark, sf).drop("target").withColumnRenamed("xid", "infinity_id")
    features = features.withColumn("last_seen_date", F.lit(DAY))
    path = scratch(spark, "scores")
    workflows = [*two_workflows(), Workflow("w3", "wf_c_3", 13)]
    responses = scoring.score_all(features, None, history, workflows, DAY, path)
    assert [r["status"] for r in responses] == ["success", "success", "MissingHistoryError"], responses
    written_scores = spark.read.schema(schemas.SCORES).parquet(path)
    return written_scores.groupBy("tid", "date").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("decile").alias("deciles")
    )


@query("m18_passthrough_scores", """
SELECT DISTINCT xid, CAST(1 AS DOUBLE) AS score, 1 AS decile, '2024-01-08' AS date, 77 AS tid FROM v_targets
WHERE vendor = 'dfp' AND date = DATE '2024-01-08' AND "group" = 'g3'""")
def _(spark, sf):
    return scoring.passthrough_scores(
        v.v_targets(spark, sf), datetime.date(2024, 1, 10), "dfp", "g3", 77
    )


TENTHS = [i / 10 for i in range(1, 10)]
TENTH_LABELS = [f"d{i}" for i in range(1, 11)]


@query("m19_threshold_table", f"""
SELECT 'decile' AS strategy, CASE WHEN p IS NULL THEN 'none' ELSE 'd' || (1 + {' + '.join(f'CAST(p >= {t} AS INTEGER)' for t in TENTHS)}) END AS bucket,
  {RANGES} FROM {RANKED.format(by='')} GROUP BY 2""")
def _(spark, sf):
    return plain(sc.threshold_table(gappy(spark, sf), "decile", TENTHS, TENTH_LABELS))


@query("m20_external_scores", """
SELECT xid, round(CAST(score AS DOUBLE), 6) AS score, 3 AS decile, CAST(date AS VARCHAR) AS date, tid FROM v_scores WHERE tid = 1""")
def _(spark, sf):
    external = v.v_scores(spark, sf).select("*", F.lit(3).alias("decile"), F.lit("x").alias("extra"))
    source = written(external, "external", "date", "tid")
    path = scratch(spark, "scores")
    postprocessing.normalise_external(spark, f"{source}/date={DAY}/tid=1", path)
    return spark.read.schema(schemas.SCORES).parquet(path)


@query("m21_all_postprocessors", f"""
SELECT '2024-02-01' AS date, tid, 'p' || tid || 'a' AS pid, 'percentile' AS strategy, {LABEL_SQL} AS bucket, {RANGES}
FROM {RANKED.format(by='PARTITION BY tid')} GROUP BY tid, bucket
UNION ALL SELECT '2024-02-01', tid, 'p' || tid || 'b', 'absolute',
  CASE WHEN score < 0.5 THEN 'low' WHEN score >= 0.5 THEN 'high' ELSE 'none' END AS bucket, {RANGES}
FROM {RANKED.format(by='')} GROUP BY tid, bucket""")
def _(spark, sf):
    def workflow(tid):
        steps = [
            Thresholds(f"p{tid}a", "percentile", CUTS, LABELS),
            Thresholds(f"p{tid}b", "absolute", [0.5], ["low", "high"]),
        ]
        return Workflow(f"w{tid}", f"wf_x_{tid}", tid, postprocessors=steps)

    path = scratch(spark, "thresholds")
    responses = postprocessing.postprocess_all(
        gappy(spark, sf), [workflow(t) for t in (0, 1, 2)], DAY, path
    )
    assert {r["status"] for r in responses} == {"success"}, responses
    return plain(spark.read.parquet(path))


@query("m21_rerun_with_new_external_scores", f"""
SELECT '2024-02-01' AS date, tid, 'p' || tid AS pid, 'absolute' AS strategy,
  CASE WHEN score < 0.5 THEN 'low' WHEN score >= 0.5 THEN 'high' ELSE 'none' END AS bucket, {RANGES}
FROM (SELECT tid, CASE WHEN tid = 1 THEN CAST(1 - score AS FLOAT) ELSE score END AS score FROM v_scores WHERE tid IN (0, 1, 2))
GROUP BY tid, bucket""")
def _(spark, sf):
    """Trait 1 is scored elsewhere, and once more before the second run; its first scores leave no trace."""
    scores = v.v_scores(spark, sf).withColumn("decile", F.lit(1))
    table, path = sinks.score_table(spark, scratch(spark, "score-table")), scratch(spark, "thresholds")
    table.replace(scores)
    outside = scratch(spark, "external")
    bring = postprocessing.ExternalScores("x", outside + "/date={date}/tid={tid}", table)

    def workflow(tid):
        steps = [Thresholds(f"p{tid}", "absolute", [0.5], ["low", "high"]), *([bring] if tid == 1 else [])]
        return Workflow(f"w{tid}", f"wf_x_{tid}", tid, postprocessors=steps)

    for changed in (F.col("score") / 2, 1 - F.col("score")):
        sinks.write_scores(scores.filter("tid = 1").withColumn("score", changed.cast("float")), outside)
        responses = postprocessing.postprocess_all(table, [workflow(t) for t in (0, 1, 2)], DAY, path)
        assert {r["status"] for r in responses} == {"success"}, responses
    return plain(spark.read.parquet(path))
