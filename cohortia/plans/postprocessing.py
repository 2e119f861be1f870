"""Post-processing of written scores: threshold tables and external scores."""

from __future__ import annotations

import datetime
import traceback as tb
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortia import schemas
from cohortia.errors import EmptyInput
from cohortia.operators.scores import check_thresholds, threshold_ranges
from cohortia.plans.workflow import Postprocessor, Thresholds, Workflow
from cohortia.sources import sinks
from cohortia.sources.tables import load_partition, require_columns
from cohortia.sources.versioned import VersionedTable


def configurations(spark: SparkSession, workflows: list[Workflow]) -> DataFrame:
    """One row per valid post-processor: ``tid, pid, strategy, thresholds, buckets``."""
    rows = [
        (w.trait_id, str(p.pid), p.strategy, [float(t) for t in p.thresholds], list(p.buckets))
        for w in workflows
        for p in w.postprocessors
    ]
    return spark.createDataFrame(
        rows, "tid int, pid string, strategy string, thresholds array<double>, buckets array<string>"
    )


def threshold_tables(scores: DataFrame, configs: DataFrame) -> DataFrame:
    """Threshold tables of all configured workflows from one pass over the scores.

    ``scores`` holds ``tid, score`` of one date.  Ranks are computed once per
    workflow, whatever the number of its post-processors.
    """
    wanted = scores.join(configs.select("tid").distinct(), "tid", "left_semi")
    return threshold_ranges(wanted, lambda spans: spans.join(configs, "tid"), ["tid"], ["pid"])


def normalise_external(spark: SparkSession, uri: str, to: str | VersionedTable) -> list[tuple]:
    """Copy scores written elsewhere into the score table, needed columns only.

    Returns the date and trait of every partition that it replaced.
    """
    rows = require_columns(load_partition(spark, uri), schemas.SCORES.names)
    rows = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.SCORES])
    written = [tuple(row) for row in rows.select(*sinks.SCORE_KEYS).distinct().collect()]  # one per trait
    sinks.write_scores(rows, to)
    return written


@dataclass
class ExternalScores(Postprocessor):
    """Bring one workflow's externally written scores into the score table.

    ``uri`` may name ``{date}`` and ``{tid}``.  ``scores_uri`` is a folder, or a
    ``sinks.score_table``.  ``written`` lists what the last run replaced.
    """

    pid: str
    uri: str
    scores_uri: str | VersionedTable
    written: list[tuple] = field(default_factory=list, compare=False)

    def process(self, scores, workflow, date):
        self.written = []
        uri = self.uri.format(date=date, tid=workflow.trait_id)
        self.written = normalise_external(scores.sparkSession, uri, self.scores_uri)


def scores_after(scores: DataFrame, date: datetime.date, steps: list[ExternalScores]) -> DataFrame:
    """``tid, score`` of a date as they are after these steps.

    A trait that a step has replaced is read anew from where the step wrote it,
    and only from there: none of its older rows is left, whatever table ``scores``
    was read from.  As traits are partitions, replaced files are not opened.
    """
    spark = scores.sparkSession
    source = {tid: step.scores_uri for step in steps for day, tid in step.written if day == date}  # the last one counts
    current = scores.filter((F.col("date") == F.lit(date)) & ~F.col("tid").isin(list(source))).select("tid", "score")
    for to in list(dict.fromkeys(source.values())):
        traits = [tid for tid, place in source.items() if place == to]
        fresh = sinks.read_scores(spark, to).filter((F.col("date") == F.lit(date)) & F.col("tid").isin(traits))
        current = current.unionByName(fresh.select("tid", "score"))
    return current


def _write_tables(day: DataFrame, together: list[Workflow], date: datetime.date, uri) -> dict[tuple, Exception]:
    """Threshold tables of all these workflows from one job; the fault of each step that failed.

    Where the job fails, it is tried again by halves, so that scores that cannot be
    read fail their own trait alone.
    """
    faults: dict[tuple, Exception] = {}
    batches = [together]
    while batches:
        batch = batches.pop(0)
        wanted = [w.trait_id for w in batch]
        try:
            of_batch = day.filter(F.col("tid").isin(wanted))
            found = {r.tid for r in of_batch.select("tid").distinct().collect()}  # at most one per workflow
            table = threshold_tables(of_batch, configurations(day.sparkSession, batch))
            sinks.write_thresholds(table.withColumn("date", F.lit(date)), uri)
            for w in batch:
                if w.trait_id not in found:
                    missing = EmptyInput(f"no scores of trait {w.trait_id} on {date}")
                    faults[w.id, w.postprocessors[0].pid] = missing
        except Exception as fault:
            half = len(batch) // 2
            if half:
                batches[:0] = [batch[:half], batch[half:]]
            else:
                faults |= {(w.id, w.postprocessors[0].pid): fault for w in batch}
    return faults


def postprocess_all(scores: DataFrame | VersionedTable, workflows: list[Workflow], date: datetime.date,
                    uri: str) -> list[dict]:
    """Run every post-processor of every workflow; one report each.

    All threshold tables come from one job; other steps run one by one, before
    it.  Thresholds are cut from the scores as those steps left them, so a rerun
    after new external scores gives tables of the new ones only.  With a versioned
    score table they are cut from one version, named in the reports, whatever is
    written meanwhile.

    A step that fails is reported and the others go on; thresholds of a workflow
    without scores fail.
    """
    versioned = isinstance(scores, VersionedTable)
    steps = [(w, p) for w in workflows for p in w.postprocessors]
    faults: dict[tuple, Exception] = {}

    together: list[Workflow] = []
    brought: list[ExternalScores] = []
    for workflow, step in steps:
        try:
            if isinstance(step, Thresholds):
                check_thresholds(step.strategy, step.thresholds, step.buckets)
                together.append(replace(workflow, postprocessors=[step]))
            else:
                step.process(scores.read() if versioned else scores, workflow, date)
                if isinstance(step, ExternalScores):
                    brought.append(step)
        except Exception as fault:
            faults[workflow.id, step.pid] = fault
    info = {}
    if together:
        try:
            if versioned:
                info = {"scores_version": scores.version()}
                day = scores.read(info["scores_version"]).filter(F.col("date") == F.lit(date))
                elsewhere = [s for s in brought if s.scores_uri is not scores]
                day = scores_after(day, date, elsewhere)
            else:
                day = scores_after(scores, date, brought)
            faults |= _write_tables(day, together, date, uri)
        except Exception as fault:
            faults |= {(w.id, w.postprocessors[0].pid): fault for w in together}

    responses = []
    for workflow, step in steps:
        fault = faults.get((workflow.id, step.pid))
        cut = info if isinstance(step, Thresholds) else {}
        responses.append(
            sinks.response_row(
                workflow.id, step.stage, "success" if fault is None else step.failed, date,
                info={**workflow.label(), "postprocess_id": str(step.pid), **cut}, error=fault,
                traceback=None if fault is None else "".join(tb.format_exception(fault)),
            )
        )
    return responses
