"""Training sets of many workflows in one pass over targets and features."""

from __future__ import annotations

import datetime
import traceback as tb

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortia.functions.ids import unit_hash
from cohortia.operators.recipe_index import label_rows
from cohortia.operators.recipes import ID
from cohortia.operators.requirements import BINARY
from cohortia.plans.workflow import Workflow
from cohortia.session import staged
from cohortia.sources import sinks

STAGE = "assembly"


def _label(position: int) -> str:
    return f"label_{position}"


def label_counts(labels: DataFrame, datasets: dict) -> dict[str, dict]:
    """``{label name: {class: users}}``; a few numbers per workflow."""
    counts: dict[str, dict] = {name: {} for name in datasets}
    for row in labels.groupBy("name", "target").count().collect():
        if row["name"] in counts:
            counts[row["name"]][class_of(datasets[row["name"]], row["target"])] = row["count"]
    return counts


def class_of(dataset, label):
    """The class of a label that may have become a text beside those of other workflows."""
    number = dataset.family == BINARY and not dataset.column and isinstance(label, str)
    return int(label) if number else label


def kept_labels(labels: DataFrame, shares: dict[str, tuple[str, dict]]) -> DataFrame:
    """``workflow_id, xid, target`` of the users that survive their class's down-sampling.

    ``shares`` holds ``{label name: (workflow id, {class: share})}``.
    """
    listed = [
        (name, workflow, str(label), float(share))
        for name, (workflow, ratios) in shares.items()
        for label, share in ratios.items()
    ]
    columns = ["name", "workflow_id", "_class", "_share"]
    arrays = [pa.array(values, kind) for values, kind in zip(zip(*listed), [pa.string()] * 3 + [pa.float64()])]
    table = labels.sparkSession.createDataFrame(pa.table(arrays, names=columns))
    found = labels.join(table, (labels["name"] == table["name"]) & (F.col("target").cast("string") == F.col("_class")))
    return found.filter(unit_hash(ID) < F.col("_share")).select("workflow_id", ID, "target")


def training_rows(features: DataFrame, kept: DataFrame) -> DataFrame:
    """``workflow_id, xid, feature_*, target`` for every kept user and workflow."""
    names = [c for c in features.columns if c.startswith("feature_")]
    # the narrow side is filtered before it meets the wide features
    return features.select(ID, *names).join(kept, ID).select("workflow_id", ID, *names, "target")


def assemble(features: DataFrame, targets: DataFrame, workflows: list[Workflow],
             date: datetime.date, uri: str) -> list[dict]:
    """Write the training set of each workflow; returns one report per workflow.

    A workflow that fails is reported and left out; the others go on.
    """
    spark = targets.sparkSession
    problems: dict[str, tuple[str, Exception | str, str]] = {}
    stats: dict[str, dict] = {w.id: {} for w in workflows}

    def failed(workflow, status, fault):
        trace = "".join(tb.format_exception(fault))
        problems[workflow.id] = (status, fault, trace)

    usable = {_label(position): workflow for position, workflow in enumerate(workflows)}
    faults: dict[str, Exception] = {}
    found = label_rows(targets, {name: w.dataset for name, w in usable.items()}, faults)
    for name, fault in faults.items():
        failed(usable.pop(name), "failed_on_load_target", fault)

    if usable:
        labels = staged(found, "labels")
        before = label_counts(labels, {name: w.dataset for name, w in usable.items()})
        for name, workflow in list(usable.items()):
            try:
                sizes = workflow.dataset.requirements.check(before[name])
                stats[workflow.id] |= {f"total_{c}s": n for c, n in sizes.items()}
            except Exception as fault:
                failed(workflow, "failed_on_load_target", fault)
                usable.pop(name)

    if usable:
        present = labels.join(features.select(ID), ID)
        joined = label_counts(present, {name: w.dataset for name, w in usable.items()})
        kept: dict[str, tuple[str, dict]] = {}
        for name, workflow in list(usable.items()):
            try:
                workflow.dataset.requirements.check(joined[name])
                kept[name] = (workflow.id, workflow.dataset.requirements.ratios(joined[name]))
            except Exception as fault:
                failed(workflow, "failed_on_join_or_write", fault)
                usable.pop(name)

    if usable:
        try:
            rows = training_rows(features, kept_labels(labels, kept))
            sinks.write_training_sets(rows, uri)
            # with the schema given, an id like 0012 stays a text
            written = spark.read.schema(rows.schema).parquet(uri).filter(F.col("workflow_id").isin([w.id for w in usable.values()]))
            by_id = {w.id: w for w in usable.values()}
            for row in written.groupBy("workflow_id", "target").count().collect():
                workflow = by_id[row["workflow_id"]]
                name = workflow.dataset.requirements.name(class_of(workflow.dataset, row["target"]))
                stats[workflow.id][f"final_{name}s"] = row["count"]
        except Exception as fault:
            for workflow in usable.values():
                failed(workflow, "failed_on_join_or_write", fault)

    responses = []
    for workflow in workflows:
        status, fault, trace = problems.get(workflow.id, ("success", None, None))
        responses.append(
            sinks.response_row(
                workflow.id, STAGE, status, date,
                info=workflow.label(),
                stats=stats[workflow.id], error=fault, traceback=trace,
            )
        )
    return responses
