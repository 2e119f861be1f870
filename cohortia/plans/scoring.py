"""Scores of many workflows from one pass over the features."""

from __future__ import annotations

import datetime
import json
import traceback as tb
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortia.errors import MissingFeatures, MissingHistory, MissingModel, ScoringError
from cohortia.operators.latest import best_by
from cohortia.operators.scores import jittered, score_stats, with_decile
from cohortia.plans.workflow import Workflow
from cohortia.session import staged
from cohortia.sources import sinks
from cohortia.sources.tables import feature_snapshot, require_rows
from cohortia.sources.versioned import VersionedTable

STAGE = "scoring"
PASSTHROUGH_LAG = 2  # days
FIRST_PASSTHROUGH = datetime.date(2020, 3, 12)
BATCH = 50  # models applied to the features in one pass


def last_trainings(history: DataFrame, date: datetime.date) -> DataFrame:
    """Each workflow's newest successful training on or before the date."""
    done = history.filter(
        (F.col("stage") == "training")
        & (F.col("status") == "success")
        & (F.col("arg_date") <= F.lit(date))
    )
    return best_by(done, ["workflow_id"], [F.col("arg_date"), F.col("execution_date")])


def model_uris(history: DataFrame, workflows: list[Workflow], date) -> dict[str, str | Exception]:
    """Where each workflow's model lies, or the named error that stops it."""
    ids = [w.id for w in workflows]
    rows = last_trainings(history.filter(F.col("workflow_id").isin(ids)), date)
    found = {r.workflow_id: json.loads(r.info or "{}") for r in rows.select("workflow_id", "info").collect()}

    def locate(workflow):
        if workflow.id not in found:
            return MissingHistory(f"no successful training of {workflow.id} up to {date}")
        uri = found[workflow.id].get("model_uri")
        return uri or MissingModel(f"the training report of {workflow.id} names no model")

    return {w.id: locate(w) for w in workflows}


def predicted(features: DataFrame, model: PipelineModel, name: str) -> DataFrame:
    """Add the positive-class probability as a column."""
    scratch = ["features", "rawPrediction", "probability", "prediction"]
    scored = model.transform(features)
    return scored.withColumn(name, vector_to_array("probability")[1]).drop(*scratch)


@dataclass(frozen=True)
class LinearModel:
    """What a trained pipeline of an assembler and a binary logistic regression comes down to."""

    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float

    @classmethod
    def of(cls, model: PipelineModel) -> LinearModel | None:
        """The model's numbers; None if it is of another kind."""
        if len(model.stages) != 2:
            return None
        assembler, regression = model.stages
        if not isinstance(assembler, VectorAssembler) or not isinstance(regression, LogisticRegressionModel):
            return None
        if regression.coefficientMatrix.numRows != 1 or regression.getFeaturesCol() != assembler.getOutputCol():
            return None
        names, weights = tuple(assembler.getInputCols()), tuple(regression.coefficients.toArray().tolist())
        return cls(names, weights, float(regression.intercept)) if len(names) == len(weights) else None


def _linear_score(x: Column):
    """From an entry of the coefficient table to ``tid, score`` of the features in x."""

    def score(model):
        margin = F.aggregate(model["terms"], model["start"], lambda total, term: total + term["by"] * F.get(x, term["at"]))
        return F.struct(model["tid"].alias("tid"), (1 / (1 + F.exp(-margin))).cast("float").alias("score"))

    return score


def linear_scores(features: DataFrame, models: dict[int, LinearModel], user="infinity_id") -> DataFrame:
    """``xid, tid, score`` of every user under every model.

    Models with one list of features share its assembly into an array, and one
    expression gives the scores of all of them: it runs over a constant table of
    their coefficients other than 0.
    """
    lists: dict[tuple, list[int]] = {}
    for tid, model in models.items():
        lists.setdefault(model.features, []).append(tid)
    held, entries = [], []
    for k, (names, tids) in enumerate(lists.items()):
        held.append(F.array(*[F.col(f"`{n}`").cast("double") for n in names]).alias(f"_x{k}"))
        table = [
            {"tid": t, "start": models[t].intercept, "terms": [{"at": i, "by": c} for i, c in enumerate(models[t].coefficients) if c]}
            for t in tids
        ]
        table = F.from_json(
            F.lit(json.dumps(table)), "array<struct<tid:int,start:double,terms:array<struct<at:int,by:double>>>>"
        )
        entries.append(F.transform(table, _linear_score(F.col(f"_x{k}"))))
    return features.select(F.col(user).cast("string").alias("xid"), *held).select("xid", F.inline(F.concat(*entries)))


def score_rows(features: DataFrame, models: dict[int, PipelineModel], user="infinity_id") -> DataFrame:
    """``xid, tid, score`` of every user under every model, in one pass; missing numbers count as 0."""
    features = features.fillna(0)
    linear = {tid: found for tid, model in models.items() if (found := LinearModel.of(model))}
    others = {tid: model for tid, model in models.items() if tid not in linear}
    parts = [linear_scores(features, linear, user)] if linear else []
    if others:
        wide = features
        for tid, model in others.items():
            wide = predicted(wide, model, f"score_{tid}")
        entries = [
            F.struct(F.lit(tid).cast("int").alias("tid"), F.col(f"score_{tid}").cast("float").alias("score"))
            for tid in others
        ]
        parts.append(wide.select(F.col(user).cast("string").alias("xid"), F.inline(F.array(*entries))))
    return reduce(DataFrame.unionByName, parts)


def check_model(features: DataFrame, model: PipelineModel) -> None:
    """Raise where a model cannot be applied to these columns."""
    linear = LinearModel.of(model)
    if linear is None:
        predicted(features, model, "_score")
    elif missing := [n for n in linear.features if n not in features.columns]:
        raise ValueError(f"the snapshot lacks {missing}")


def finish_scores(rows: DataFrame, date: datetime.date) -> DataFrame:
    """Score rows with deciles per workflow, in the score table's layout."""
    ranked = with_decile(jittered(rows), by=["tid"])
    return ranked.select("xid", "score", "decile", F.lit(date).alias("date"), "tid")


def passthrough_scores(targets: DataFrame, date: datetime.date, vendor: str, group: str, tid: int):
    """Members of a target group two days before count as the best score.

    Targets before the first passthrough day are taken from that day.
    """
    day = date - datetime.timedelta(days=PASSTHROUGH_LAG)
    source = max(day, FIRST_PASSTHROUGH)
    members = targets.filter(
        (F.col("vendor") == vendor)
        & (F.col("date") == F.lit(source))
        & (F.col("group") == F.lit(str(group)))
    )
    return members.select("xid").distinct().select(
        "xid",
        F.lit(1.0).cast("float").alias("score"),
        F.lit(1).alias("decile"),
        F.lit(day).alias("date"),
        F.lit(tid).alias("tid"),
    )


def _response(workflow, date, status="success", info=None, stats=None, fault=None):
    return sinks.response_row(
        workflow.id, STAGE, status, date,
        info={**workflow.label(), **(info or {})},
        stats=stats, error=fault,
        traceback=None if fault is None else "".join(tb.format_exception(fault)),
    )


def _failure(workflow, date, fault):
    status = fault.status if isinstance(fault, ScoringError) else ScoringError.status
    return _response(workflow, date, status, fault=fault)


def score_all(features: DataFrame, targets: DataFrame, history: DataFrame,
              workflows: list[Workflow], date: datetime.date, scores_uri: str | VersionedTable) -> list[dict]:
    """Score and write every workflow; returns one report per workflow.

    ``scores_uri`` is a folder, or a ``sinks.score_table``.

    A batch that fails is tried again by halves, so that a fault is reported
    for the workflow that has it alone.
    """
    responses = {}
    for w in (w for w in workflows if w.passthrough_group is not None):
        try:
            rows = passthrough_scores(targets, date, w.vendor, w.passthrough_group, w.trait_id)
            sinks.write_scores(rows, scores_uri)
            responses[w.id] = _response(w, date)
        except Exception as fault:
            responses[w.id] = _failure(w, date, fault)

    modelled = [w for w in workflows if w.passthrough_group is None]
    try:
        snapshot = require_rows(
            feature_snapshot(features, date), f"no features for {date}", MissingFeatures
        )
        located = model_uris(history, modelled, date)
    except Exception as fault:
        responses |= {w.id: _failure(w, date, fault) for w in modelled}
        modelled = []

    ready = {}
    for w in modelled:
        try:
            if isinstance(located[w.id], Exception):
                raise located[w.id]
            model = PipelineModel.load(located[w.id])
            check_model(snapshot, model)
            ready[w.id] = (w, model)
        except Exception as fault:
            responses[w.id] = _failure(w, date, fault)

    sound = list(ready.values())
    batches = [sound[start : start + BATCH] for start in range(0, len(sound), BATCH)]
    while batches:
        batch = batches.pop(0)
        try:
            # probabilities are computed once; ranks and writes re-read them
            rows = staged(score_rows(snapshot, {w.trait_id: m for w, m in batch}), "scores")
            scores = finish_scores(rows, date)
            sinks.write_scores(scores, scores_uri)
            stored = sinks.read_scores(features.sparkSession, scores_uri).filter(
                (F.col("date") == F.lit(date)) & F.col("tid").isin([w.trait_id for w, _ in batch])
            )
            stats: dict[int, list] = {}
            for row in score_stats(stored, ["tid"]).collect():  # ten rows per workflow
                entry = row.asDict()
                stats.setdefault(entry.pop("tid"), []).append(entry)
            for w, _ in batch:
                responses[w.id] = _response(
                    w, date, info={"model_uri": located[w.id]},
                    stats={"decile_stats": stats.get(w.trait_id, [])},
                )
        except Exception as fault:
            half = len(batch) // 2
            if half:
                batches[:0] = [batch[:half], batch[half:]]
            else:
                responses |= {w.id: _failure(w, date, fault) for w, _ in batch}
    return [responses[w.id] for w in workflows]
