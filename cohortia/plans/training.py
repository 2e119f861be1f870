"""Logistic models: split, tune, evaluate and report."""

from __future__ import annotations

import datetime
import random
import traceback as tb

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortia.functions.ids import unit_hash
from cohortia.plans.workflow import Workflow
from cohortia.sources import sinks
from cohortia.sources.tables import training_set

STAGE = "training"
SEED = 42
TRIALS = 4
REG_PARAM = (1e-6, 1e-2)  # log-uniform
SPLIT = (0.6, 0.2, 0.2)
OVERFIT_GAP = 0.05
POOR_SCORE = 0.6


def feature_names(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("feature_")]


def assembler(df: DataFrame) -> VectorAssembler:
    return VectorAssembler(inputCols=feature_names(df), outputCol="features")


def with_split(df: DataFrame, key="xid") -> DataFrame:
    """Add ``split``: train, validation or test, the same on any layout."""
    position = unit_hash(F.lit("split"), key)
    first, second = SPLIT[0], SPLIT[0] + SPLIT[1]
    return df.withColumn(
        "split",
        F.when(position < first, "train").when(position < second, "validation").otherwise("test"),
    )


def trial_params(lr: LogisticRegression, seed=SEED, trials=TRIALS) -> list[dict]:
    """Seeded random settings: log-uniform ``regParam``, uniform ``elasticNetParam``."""
    import math

    draw = random.Random(seed)
    low, high = (math.log(v) for v in REG_PARAM)
    return [
        {lr.regParam: math.exp(draw.uniform(low, high)), lr.elasticNetParam: draw.random()}
        for _ in range(trials)
    ]


def roc_auc(predicted: DataFrame, label="target") -> float:
    return BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol="rawPrediction", metricName="areaUnderROC",
        numBins=0,  # every distinct score is a point of the curve, however many there are
    ).evaluate(predicted)


def balanced_accuracy(predicted: DataFrame, label="target", prediction="prediction") -> DataFrame:
    """One row: the mean of the true-positive and true-negative rates."""

    def rate(value):
        right = F.count_if((F.col(label) == value) & (F.col(prediction) == value))
        return right / F.count_if(F.col(label) == value)

    return predicted.agg(((rate(1) + rate(0)) / 2).alias("balanced_accuracy"))


def metrics(model: PipelineModel, rows: DataFrame, name: str) -> dict[str, float]:
    predicted = model.transform(rows)
    return {
        f"{name}_roc_auc": roc_auc(predicted),
        f"{name}_balanced_accuracy": balanced_accuracy(predicted).first()[0],
    }


def quality_warnings(measured: dict, metric="roc_auc") -> dict[str, str]:
    """Warn when train exceeds test by far, or when test is poor."""
    train, test = measured[f"train_{metric}"], measured[f"test_{metric}"]
    warnings = {}
    if train - test > OVERFIT_GAP:
        warnings["overfit_warning"] = (
            f"{metric} falls by {train - test} from the training to the test rows: check for overfitting"
        )
    if test < POOR_SCORE:
        warnings["poor_model_warning"] = f"{metric} on the test rows is {test}, below {POOR_SCORE}"
    return warnings


def fit_best(df: DataFrame) -> tuple[PipelineModel, dict[str, float]]:
    """Best of the trials by validation AUC, and its train and test metrics."""
    rows = with_split(df)
    vectors = assembler(df)
    part = {name: vectors.transform(rows.filter(F.col("split") == name)) for name in ("train", "validation")}
    train = part["train"].select("features", "target").persist()
    lr = LogisticRegression(labelCol="target", featuresCol="features")
    try:
        trials = [lr.fit(train, params) for params in trial_params(lr)]
    finally:
        train.unpersist()
    best = max(trials, key=lambda model: roc_auc(model.transform(part["validation"])))
    model = PipelineModel([vectors, best])
    measured = {}
    for name in ("train", "test"):
        measured |= metrics(model, rows.filter(F.col("split") == name), name)
    return model, measured


def train(sets: DataFrame, workflow: Workflow, date: datetime.date, models_uri: str) -> dict:
    """Train and store one workflow's model; a failure becomes its report."""
    info = {"name": workflow.name, "description": workflow.description}
    try:
        rows = training_set(sets, workflow.id)
        model, measured = fit_best(rows)
        uri = f"{models_uri.rstrip('/')}/workflow_id={workflow.id}/date={date}"
        model.write().overwrite().save(uri)
        return sinks.response_row(
            workflow.id, STAGE, "success", date, info={**info, "model_uri": uri},
            stats=measured, warnings=quality_warnings(measured),
        )
    except Exception as fault:
        return sinks.response_row(
            workflow.id, STAGE, "failed_on_train", date, info=info, error=fault,
            traceback="".join(tb.format_exception(fault)),
        )


def train_workflows(sets: DataFrame, workflows: list[Workflow], date, models_uri: str) -> list[dict]:
    return [train(sets, workflow, date, models_uri) for workflow in workflows]
