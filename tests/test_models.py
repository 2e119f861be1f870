"""Scores, thresholds, features, training and reports."""

import datetime
import json

import pytest
from pyspark.sql import functions as F
from tests.conftest import day, rows

from cohortia import schemas
from cohortia.errors import InvalidDefinition
from cohortia.operators import features as feat
from cohortia.operators import scores as sc
from cohortia.operators.recipes import Behavior, Dataset, MatchesAny
from cohortia.plans import assembly, postprocessing, reports, scoring, training
from cohortia.plans.workflow import Thresholds, Workflow
from cohortia.sources import sinks, tables

D = day("2021-02-01")


def score_rows(spark, values, tid=1):
    data = [(f"u{i:04d}", v, D, tid) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "xid string, score float, date date, tid int")


def test_deciles_of_a_hundred_scores(spark):
    scored = sc.with_decile(score_rows(spark, [i / 100 for i in range(100)]), "score")
    assert [r["count"] for r in sc.score_stats(scored).collect()] == [11, 10, 10, 10, 10, 10, 10, 10, 10, 9]
    report = sc.stats_report(scored)["decile_stats"]
    assert report[0]["decile"] == 1 and report[0]["max_score"] == pytest.approx(0.99)


def test_deciles_do_not_depend_on_layout(spark):
    df = score_rows(spark, [0.5] * 200 + [i / 300 for i in range(300)])
    one, many = (rows(sc.with_decile(sc.jittered(df.repartition(n)))) for n in (1, 9))
    assert one == many and sum(one.values()) == 500


def test_jitter_is_small_and_ordered(spark):
    df = sc.jittered(score_rows(spark, [0.1, 0.2]))
    assert all(0 <= r.temp_score - r.score < 1.01e-4 for r in df.collect())


def test_threshold_buckets_are_half_open(spark):
    df = score_rows(spark, [0.0, 0.5, 0.5, 0.75, 1.0, None])
    table = sc.threshold_table(df, "absolute", [0.5, 0.75], ["low", "mid", "high"])
    assert [tuple(r)[1:] for r in table.collect()] == [
        ("high", 0.75, 1.0, 0.875), ("mid", 0.5, 0.5, 0.5), ("low", 0.0, 0.0, 0.0), (None, None, None, None)]
    ranked = sc.threshold_table(df.filter("score IS NOT NULL"), "percentile", [0.5], ["top", "rest"])
    assert {r.bucket: (r.min_score, r.max_score) for r in ranked.collect()} == {"top": (0.75, 1.0), "rest": (0.0, 0.5)}


@pytest.mark.parametrize("strategy, cuts, names, fault", [
    ("unknown", [0.5], ["a", "b"], NotImplementedError), ("decile", [0.5], ["a", "b"], InvalidDefinition),
    ("percentile", 0.5, ["a", "b"], InvalidDefinition), ("absolute", [0.5], ["a"], InvalidDefinition)])
def test_threshold_settings_are_checked(strategy, cuts, names, fault):
    with pytest.raises(fault):
        sc.check_thresholds(strategy, cuts, names)


def test_postprocessing_reports_each_step(spark, folder):
    scores = score_rows(spark, [i / 10 for i in range(10)]).unionByName(score_rows(spark, [0.9, 0.1], 2))
    score_rows(spark, [0.3], 3).withColumn("decile", F.lit(1)).write.partitionBy("date", "tid").parquet(f"{folder}/in")
    good = Thresholds("p1", "absolute", [0.5], ["low", "high"])
    bad = Thresholds("p2", "decile", [0.5], ["low", "high"])
    flows = [Workflow("w1", "n1", 1, postprocessors=[good, bad]), Workflow("w2", "n2", 2, postprocessors=[good]),
             Workflow("w3", "n 3", 3, postprocessors=[
                 postprocessing.ExternalScores("p3", folder + "/in/date={date}/tid={tid}", f"{folder}/scores"),
                 postprocessing.ExternalScores("p4", folder + "/nowhere/date={date}", f"{folder}/scores")])]
    found = postprocessing.postprocess_all(scores, flows, D, f"{folder}/thresholds")
    assert [r["status"] for r in found] == ["success", "failed_on_threshold", "success", "success", "failed"]
    assert json.loads(found[3]["info"]) == {"name": "n3", "description": "", "postprocess_id": "p3"}
    assert spark.read.parquet(f"{folder}/scores").count() == 1
    stored = spark.read.parquet(f"{folder}/thresholds")
    assert rows(stored.groupBy("tid", "pid").count()) == {(1, "p1", 2): 1, (2, "p1", 2): 1}
    assert good.to_dict()["buckets"] == ["low", "high"]


def test_external_scores_need_their_columns(spark, folder):
    full = score_rows(spark, [0.5]).withColumn("decile", F.lit(1)).withColumn("extra", F.lit("x"))
    full.write.partitionBy("date", "tid").parquet(f"{folder}/in")
    postprocessing.normalise_external(spark, f"{folder}/in/date=2021-02-01/tid=1", f"{folder}/out")
    assert rows(spark.read.schema(schemas.SCORES).parquet(f"{folder}/out")) == {("u0000", 0.5, 1, D, 1): 1}
    with pytest.raises(ValueError, match="decile"):
        tables.require_columns(full.drop("decile"), schemas.SCORES.names)


def test_passthrough_scores(spark):
    def members(date):
        data = [("a", date, "own", "ga", "g", "{}", 1.0)] * 2 + [("b", date, "own", "ga", "h", "{}", 1.0)]
        return spark.createDataFrame(data, schemas.TARGETS)

    late = scoring.passthrough_scores(members(day("2021-01-30")), D, "own", "g", 9)
    assert rows(late) == {("a", 1.0, 1, day("2021-01-30"), 9): 1}
    early = scoring.passthrough_scores(members(day("2020-03-12")), day("2020-03-01"), "own", "g", 9)
    assert rows(early) == {("a", 1.0, 1, day("2020-02-28"), 9): 1}


NESTED = "infinity_id string, feature_brands array<struct<name:string,count:int>>, feature_route array<struct<name:string,count:int>>, feature_admantx array<struct<name:string,score_sum:double>>, feature_duration struct<lifespan:int,days_since_last_seen:int>"


def nested(spark):
    data = [("a", [("x", 1), ("y", 2), ("x", 5)], [("x", 7)], [("Topics::Cars", 0.5)], (3, 1)),
            ("b", [("z", 4)], None, [], (9, 2)), ("c", [], [("q", 1)], [("Other::Cars", 2.0)], (1, 1))]
    return spark.createDataFrame(data, NESTED)


def test_linear_models_score_as_their_pipelines(spark):
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    from pyspark.sql import functions as F

    data = [(f"u{i}", i % 2, (i * 7 % 11) / 3, None if i % 9 == 0 else float(i % 5), i % 3) for i in range(200)]
    raw = spark.createDataFrame(data, "infinity_id string, target int, feature_a double, feature_b double, feature_c int")
    df = raw.fillna(0)
    models = {}
    for tid, names in enumerate((["feature_a", "feature_b", "feature_c"], ["feature_c", "feature_a"], ["feature_a", "feature_b", "feature_c"])):
        vectors = VectorAssembler(inputCols=names, outputCol="features")
        fitted = LogisticRegression(labelCol="target", regParam=0.01 * tid, elasticNetParam=1.0).fit(vectors.transform(df))
        models[tid] = PipelineModel([vectors, fitted])
    vectors = VectorAssembler(inputCols=["feature_a", "feature_b"], outputCol="raw")
    scaler = StandardScaler(inputCol="raw", outputCol="features").fit(vectors.transform(df))
    fitted = LogisticRegression(labelCol="target").fit(scaler.transform(vectors.transform(df)))
    models[3] = PipelineModel([vectors, scaler, fitted])  # another kind of model
    assert [scoring.LinearModel.of(m) is None for m in models.values()] == [False, False, False, True]
    got = {(r.xid, r.tid): r.score for r in scoring.score_rows(raw, models).collect()}
    assert len(got) == 800
    for tid, model in models.items():
        for r in scoring.predicted(df, model, "score").select("infinity_id", "score").collect():
            assert got[r.infinity_id, tid] == pytest.approx(r.score, abs=1e-6)
    plan = scoring.linear_scores(df, {t: scoring.LinearModel.of(models[t]) for t in (0, 1, 2)})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("_x0") and "_x2" not in plan  # two lists of features, two assemblies
    with pytest.raises(ValueError, match="feature_c"):
        scoring.check_model(df.drop("feature_c"), models[1])


def test_unpacked_arrays(spark):
    wide = feat.unpack_arrays(nested(spark), {"feature_brands": ["x", "y"], "feature_route": ["x"]})
    names = ["feature_brands_x", "feature_brands_y", "feature_route_x"]
    # the last duplicate wins, equal names in two arrays stay apart
    assert rows(wide.select("infinity_id", *names)) == {("a", 5, 2, 7): 1, ("b", 0, 0, 0): 1, ("c", 0, 0, 0): 1}


def brute_slots(items, names, none=0):
    first = {}
    for name, value in items:
        if value is not None:
            first.setdefault(name, value)
    return [first.get(n, none) for n in names]


def test_slots_equal_brute_force(spark):
    import random

    draw = random.Random(4)
    names = [f"n{i}" for i in range(40)] + ["é", "", "a b", 'q"uote']
    data = [(f"u{k}", [(draw.choice([*names, "unknown", None]), draw.choice([None, 1, 2, 3])) for _ in range(draw.randint(1, 30))])
            for k in range(120)]
    df = spark.createDataFrame([*data, ("none", None), ("empty", [])], "infinity_id string, feature_brands array<struct<name:string,count:int>>")
    got = {r.infinity_id: list(r)[1:] for r in feat.pivot_array(df, "feature_brands", names).collect()}
    assert got == {user: brute_slots(items, names) for user, items in data}
    found = feat.pivot_array(df, "feature_brands")
    seen = sorted({name for _, items in data for name, _ in items if name is not None})
    assert found.columns == ["infinity_id", *[f"feature_brands_{n}" for n in seen]]
    assert {r.infinity_id: list(r)[1:] for r in found.collect()} == {u: brute_slots(i, seen) for u, i in data}


def test_features_need_no_shuffle_and_no_join(spark, folder):
    nested(spark).write.parquet(f"{folder}/t")
    df = spark.read.parquet(f"{folder}/t")
    wide = feat.nested_features(df, [*feat.STRUCT_FAMILIES][:1] + ["feature_brands", "feature_route", "feature_admantx"],
                                topics=["feature_admantx_topics_cars"], names={"feature_brands": ["x"], "feature_route": ["x"]})
    for frame_ in (wide, feat.pivot_array(df, "feature_brands"), feat.pivot_topics(df)):
        assert not any(word in frame_._jdf.queryExecution().toString() for word in ("Exchange", "Join", "Generate", "Pivot"))
    assert wide.columns == ["infinity_id", "feature_duration_lifespan", "feature_duration_days_since_last_seen",
                            "feature_brands_x", "feature_route_x", "feature_admantx_topics_cars"]
    assert rows(wide) == {("a", 3, 1, 1, 7, 0.5): 1}


def test_more_names_than_a_pivot_allows(spark):
    names = [f"n{i:05}" for i in range(10_050)]
    df = spark.createDataFrame([("a", [(n, i + 1) for i, n in enumerate(names)])], "infinity_id string, feature_brands array<struct<name:string,count:int>>")
    wide = feat.pivot_array(df, "feature_brands")
    assert len(wide.columns) == 10_051
    total = wide.select(sum([F.col(f"feature_brands_{n}") for n in (names[0], names[777], names[-1])], F.lit(0)).alias("t"))
    assert total.first().t == 1 + 778 + 10_050


def test_nested_and_flat_features(spark):
    wide = feat.nested_features(nested(spark), ["feature_duration", "feature_brands"], names={"feature_brands": ["y", "z"]})
    assert rows(wide.select("infinity_id", "feature_duration_lifespan", "feature_brands_y", "feature_brands_z")) == {
        ("a", 3, 2, 0): 1, ("b", 9, 0, 4): 1}
    topics = feat.pivot_topics(nested(spark))
    assert topics.columns == ["infinity_id", "feature_admantx_topics_cars"]
    flat = spark.createDataFrame([("a", 1, 2)], "infinity_id string, feature_dma_1 int, feature_zip_2 int")
    assert feat.flat_features(flat, ["feature_dma"]).columns == ["infinity_id", "feature_dma_1"]
    for unknown in (lambda: feat.flat_features(flat, ["feature_nope"]), lambda: feat.flat_features(flat, ["feature_brand"])):
        with pytest.raises(ValueError):
            unknown()
    assert feat.tidy_names(flat.withColumnRenamed("feature_dma_1", "A::b C.")).columns[1] == "a__b_c"


def recipe(group, requirements):
    positive = MatchesAny([Behavior({"group": group, "value": 1})])
    negative = MatchesAny([Behavior({"group": group, "value": 0})])
    made = Dataset("binary", {"positive": positive, "negative": negative})
    return Dataset.from_dict({**made.to_dict(), "data_requirements": requirements})


FREE = {"logic": "no_requirements"}


def test_assemble_train_score_and_report(spark, folder):
    users = [f"u{i:03d}" for i in range(240)]
    data = [(u, D, "v", "s", "g", "{}", float(i % 2)) for i, u in enumerate(users)]
    data += [(u, D, "v", "s", "one_sided", "{}", 1.0) for u in users]
    data += [("unknown-user", D, "v", "s", "elsewhere", "{}", 1.0), ("unknown-two", D, "v", "s", "elsewhere", "{}", 0.0)]
    targets = spark.createDataFrame(data, schemas.TARGETS)
    features = spark.createDataFrame([(u, float(i % 2) + (i % 7) / 3, float(i % 5)) for i, u in enumerate(users)],
                                     "xid string, feature_1 double, feature_2 double")
    small = {"logic": "min_max_provided", "min_positive": 10**9, "min_negative": 1}
    flows = [Workflow("w1", "wf_v_1", 1, "first", dataset=recipe("g", FREE)),
             Workflow("w2", "wf_v_2", 2, dataset=recipe("one_sided", FREE)),
             Workflow("w3", "wf_v_3", 3, dataset=recipe("g", small)),
             Workflow("w4", "wf_v_4", 4, dataset=recipe("elsewhere", FREE)),
             Workflow("w5", "wf_v_5", 5, dataset=None)]
    sets_uri, history_uri, scores_uri = (f"{folder}/{n}" for n in ("sets", "history", "scores"))
    made = assembly.assemble(features, targets, flows, D, sets_uri)
    assert [r["status"] for r in made] == ["success", "failed_on_load_target", "failed_on_load_target",
                                           "failed_on_join_or_write", "failed_on_load_target"]
    assert json.loads(made[0]["stats"]) == {"total_positives": 120, "total_negatives": 120,
                                            "final_positives": 120, "final_negatives": 120}
    assert "negative" in made[1]["error"]
    sinks.append_history(sinks.history_frame(spark, made), history_uri)

    sets = spark.read.parquet(sets_uri)
    assert rows(sets.groupBy("workflow_id", "target").count()) == {("w1", 1, 120): 1, ("w1", 0, 120): 1}
    fitted = training.train_workflows(sets, flows[:2], D, f"{folder}/models")
    assert [r["status"] for r in fitted] == ["success", "failed_on_train"]
    measured = json.loads(fitted[0]["stats"])
    assert set(measured) == {f"{part}_{m}" for part in ("train", "test") for m in ("roc_auc", "balanced_accuracy")}
    assert measured["train_roc_auc"] > 0.7
    sinks.append_history(sinks.history_frame(spark, fitted), history_uri)

    history = spark.read.schema(schemas.HISTORY).parquet(history_uri)
    snapshot = features.withColumnRenamed("xid", "infinity_id").withColumn("last_seen_date", F.lit(D))
    proxy = Workflow("w6", "wf_v_6", 6, vendor="v", passthrough_group="g")
    old = targets.withColumn("date", F.lit(day("2021-01-30")))
    scored = scoring.score_all(snapshot, old, history, [flows[0], flows[1], proxy], D, scores_uri)
    assert [r["status"] for r in scored] == ["success", "MissingHistoryError", "success"]
    stored = spark.read.schema(schemas.SCORES).parquet(scores_uri)
    assert rows(stored.groupBy("tid").count()) == {(1, 240): 1, (6, 240): 1}
    assert sum(d["count"] for d in json.loads(scored[0]["stats"])["decile_stats"]) == 240
    late = scoring.score_all(snapshot, old, history, [flows[0]], day("2021-03-01"), scores_uri)
    assert late[0]["status"] == "MissingFeaturesError"
    no_model = history.withColumn("info", F.lit("{}"))
    assert scoring.score_all(snapshot, old, no_model, [flows[0]], D, scores_uri)[0]["status"] == "MLFlowDependenceError"

    flow_table = spark.createDataFrame([(w.id, w.name, w.description, True, w.trait_id, 1) for w in flows],
                                       "id string, name string, description string, enabled boolean, trait_id int, weekday int")
    sides = [reports.stage_report(history, flow_table, stage, arg_date=D) for stage in ("assembly", "training")]
    both = reports.training_report(*sides)
    assert rows(both.select("workflow_id", "assembly_status", "training_status").filter("training_status IS NOT NULL")) == {
        ("w1", "success", "success"): 1, ("w2", "failed_on_load_target", "failed_on_train"): 1}


def test_the_daily_report_reads_the_history_once(spark, folder):
    done = [sinks.response_row(f"w{k % 3}", stage, status, D, executed=datetime.datetime(2021, 2, 1, k))
            for k, (stage, status) in enumerate([("assembly", "success"), ("training", "failed_on_train"), ("scoring", "success"),
                                                 ("assembly", "failed"), ("training", "success"), ("scoring", "MissingHistoryError")])]
    sinks.append_history(sinks.history_frame(spark, done), f"{folder}/history")
    history = spark.read.schema(schemas.HISTORY).parquet(f"{folder}/history")
    flows = spark.createDataFrame([(f"w{k}", f"n{k}", "", True, k, 1) for k in range(4)],
                                  "id string, name string, description string, enabled boolean, trait_id int, weekday int")
    report = reports.daily_report(history, flows, D)
    for stage, frames in report.items():
        plain = {"counts": reports.status_counts(history, flows, stage, D), "failures": reports.latest_failures(history, flows, stage, D),
                 "missing": reports.unlaunched(history, flows, stage, D)}
        for name, frame_ in frames.items():
            assert rows(frame_) == rows(plain[name])
            assert f"{folder}/history" not in frame_._jdf.queryExecution().toString()
    assert {r.workflow_id for r in report["scoring"]["missing"].collect()} == {"w0", "w1", "w3"}


def test_a_model_that_fails_leaves_its_batch_alone(spark, folder):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StringIndexer, VectorAssembler

    wide = spark.createDataFrame([(f"u{i}", D, float(i), float(i), float(i % 2)) for i in range(20)],
                                 "infinity_id string, last_seen_date date, a double, b double, label double")
    uris = {}
    for name in ("a", "b"):  # b has a value when it is scored that it had not in training
        first = [StringIndexer(inputCol="b", outputCol="index")] if name == "b" else []
        stages = [*first, VectorAssembler(inputCols=["index" if first else name], outputCol="features"), LogisticRegression(maxIter=2)]
        uris[name] = f"{folder}/model_{name}"
        Pipeline(stages=stages).fit(wide).write().overwrite().save(uris[name])
    snapshot = wide.drop("label").withColumn("b", F.col("b") + 100)
    flows = [Workflow(f"w{k}", f"wf_v_{k}", k, dataset=None) for k in (1, 2, 3)]
    done = [sinks.response_row(w.id, "training", "success", D, info={**w.label(), "model_uri": uris[x]})
            for w, x in zip(flows, "aba", strict=True)]
    past = sinks.history_frame(spark, done)
    got = scoring.score_all(snapshot, None, past, flows, D, f"{folder}/isolated")
    assert [r["status"] for r in got] == ["success", "failed", "success"]
    stored = spark.read.schema(schemas.SCORES).parquet(f"{folder}/isolated")
    assert rows(stored.groupBy("tid").count()) == {(1, 20): 1, (3, 20): 1}
    lacks = scoring.score_all(snapshot.drop("b"), None, past, flows, D, f"{folder}/lacks")
    assert [r["status"] for r in lacks] == ["success", "failed", "success"]


def test_quality_warnings_are_one_sided():
    def names(train, test):
        return set(training.quality_warnings({"train_roc_auc": train, "test_roc_auc": test}))

    assert names(0.9, 0.8) == {"overfit_warning"}
    assert names(0.7, 0.8) == set()
    assert names(0.62, 0.55) == {"overfit_warning", "poor_model_warning"}


def test_trials_are_seeded_and_in_range():
    from pyspark.ml.classification import LogisticRegression

    lr = LogisticRegression()
    first, again = training.trial_params(lr), training.trial_params(lr)
    assert [list(p.values()) for p in first] == [list(p.values()) for p in again] and len(first) == 4
    assert all(1e-6 <= p[lr.regParam] <= 1e-2 and 0 <= p[lr.elasticNetParam] <= 1 for p in first)


def history(spark, *specs):
    data = [(w, s, st, day(d), datetime.datetime.fromisoformat(f"{d} 10:00:{i:02d}"), "{}", "{}", "{}", None, None)
            for i, (w, s, st, d) in enumerate(specs)]
    return spark.createDataFrame(data, schemas.HISTORY)


def workflows(spark):
    return spark.createDataFrame([("a", "wf_x_1", "A", True, 1, 1), ("b", "wf_y_2", "B", True, 2, 2), ("c", "wf_x_3", "C", False, 3, 1)],
                                 "id string, name string, description string, enabled boolean, trait_id int, weekday int")


def test_run_reports(spark):
    h = history(spark, ("a", "training", "success", "2021-02-01"), ("a", "training", "failed", "2021-02-01"),
                ("b", "training", "failed", "2021-02-01"), ("a", "scoring", "success", "2021-01-01"),
                ("b", "scoring", "success", "2021-01-20"), ("c", "scoring", "success", "2020-01-01"))
    w = workflows(spark)
    best = reports.stage_runs(h, w, "training", arg_date=D)
    assert rows(best.select("workflow_id", "status")) == {("a", "success"): 1, ("b", "failed"): 1}
    for wrong in ({}, {"arg_date": D, "as_of": D}):
        with pytest.raises(ValueError):
            reports.stage_runs(h, w, "training", **wrong)
    assert rows(reports.failed_workflows(h, "training", D).select("workflow_id")) == {("b",): 1}
    assert reports.stage_response(h, "a", "training").first().status == "failed"
    assert reports.stage_response(h, "a", "training", ignore_failures=True).first().status == "success"
    assert rows(reports.stale_workflows(h, w, "scoring", day("2021-01-27"))) == {("a", day("2021-01-01")): 1, ("b", day("2021-01-20")): 1}
    ids = w.select(F.col("id").alias("workflow_id"))
    assert rows(reports.ran_on(h, "scoring", day("2021-01-20"), ids)) == {("b",): 1}
    assert reports.failures_since(h, "training", datetime.datetime(2021, 2, 2), 86400).count() == 2
    # 2021-02-01 is a Monday
    assert rows(reports.scheduled(w, D).select("id")) == {("a",): 1, ("c",): 1}
    assert reports.unlaunched(h, w, "training", D).isEmpty()
    assert rows(reports.unlaunched(h, w, "scoring", D).select("workflow_id")) == {("a",): 1, ("b",): 1}
    assert reports.unlaunched(h, w, "scoring", day("1999-01-01")).isEmpty()
    assert dict(reports.status_counts(h, w, "training", D).collect()) == {
        "failed": 2, "num_launched": 2, "num_workflows": 2, "num_not_launched": 0}


def test_readiness(spark):
    now = datetime.datetime(2021, 2, 10)
    h = history(spark, ("a", "assembly", "success", "2021-02-09"), ("a", "training", "success", "2021-01-01"),
                ("b", "training", "success", "2021-01-01"))

    def ready(frame, stage="training"):
        return sorted(r.workflow_id for r in reports.ready_workflows(frame, workflows(spark), stage, now, 7 * 86400, now).collect())

    assert ready(h) == ["a"]  # b has no fresh training set
    assert ready(h, "scoring") == ["a", "b"]
    failing = h.unionByName(history(spark, *[("a", "training", "failed", "2021-02-08")] * 3))
    assert ready(failing) == []


def test_lookups(spark):
    w = workflows(spark)
    asked = spark.createDataFrame([("a",), ("a",), ("zz",)], "id string")
    assert rows(reports.by_ids(w, asked).select("id")) == {("a",): 1}
    assert rows(reports.missing_ids(w, asked)) == {("zz",): 1}
    assert rows(reports.counts_by_vendor(w)) == {("x", 2): 1, ("y", 1): 1}
    assert reports.text_like(w, "name", "_x_").count() == 2 and reports.text_is(w, "description", "b").count() == 1


def test_thresholds_see_external_scores_of_the_same_run_and_fail_without_any(spark, folder):
    external = score_rows(spark, [0.2, 0.8], tid=2).withColumn("decile", F.lit(3))
    external.write.partitionBy("date", "tid").parquet(f"{folder}/external")
    bring = postprocessing.ExternalScores("x", f"{folder}/external/date={{date}}/tid={{tid}}", f"{folder}/scores")

    def flow(tid, *steps):
        cut = Thresholds(f"p{tid}", "absolute", [0.5], ["low", "high"])
        return Workflow(f"w{tid}", f"wf_x_{tid}", tid, postprocessors=[cut, *steps])

    flows = [flow(1), flow(2, bring), flow(3)]
    reports_ = postprocessing.postprocess_all(score_rows(spark, [0.1, 0.9]), flows, D, f"{folder}/thresholds")
    failed = [r["workflow_id"] for r in reports_ if r["status"] != "success"]
    assert failed == ["w3"]
    table = spark.read.parquet(f"{folder}/thresholds")
    assert {r.tid for r in table.select("tid").distinct().collect()} == {1, 2}


def test_thresholds_must_increase():
    with pytest.raises(InvalidDefinition):
        sc.check_thresholds("absolute", [0.8, 0.2], ["a", "b", "c"])
