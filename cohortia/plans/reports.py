"""Questions about the run history.

``history`` rows are run reports (see ``schemas.HISTORY``); ``workflows`` has one
row per workflow: ``id, name, description, enabled, trait_id, weekday``.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortia.errors import EmptyInput
from cohortia.functions.ids import vendor_of
from cohortia.operators.latest import best_run, last_date, latest, newest
from cohortia.session import staged

SUCCESS = "success"
MAX_FAILURES = 3
STALE_DAYS = 7

# Statuses that count as failures in the daily report.
FAILURE_STATUSES = [
    "failed",
    "MLFlowDependenceError",
    "MissingFeaturesError",
    "MissingHistoryError",
]


def succeeded(history: DataFrame, stage=None) -> DataFrame:
    rows = history.filter(F.col("status") == SUCCESS)
    return rows if stage is None else rows.filter(F.col("stage") == stage)


def enabled(workflows: DataFrame) -> DataFrame:
    return workflows.filter("enabled")


def latest_successes(history: DataFrame, workflow_id=None) -> DataFrame:
    """Newest successful run per workflow and stage."""
    rows = succeeded(history)
    if workflow_id is not None:
        rows = rows.filter(F.col("workflow_id") == F.lit(workflow_id))
    return latest(rows, ["workflow_id", "stage"])


def stage_runs(history: DataFrame, workflows: DataFrame, stage: str, arg_date=None, as_of=None):
    """Best run of each workflow at a stage, on a date or up to a moment."""
    if (arg_date is None) == (as_of is None):
        raise ValueError("give either arg_date or as_of")
    if arg_date is not None:
        when = F.col("arg_date") == F.lit(arg_date)
    else:
        when = F.col("execution_date") <= F.lit(as_of)
    runs = best_run(history.filter((F.col("stage") == stage) & when))
    known = workflows.select(
        F.col("id").alias("workflow_id"),
        "enabled",
        "trait_id",
        "name",
        F.col("description").alias("ui_name"),
    )
    return runs.join(known, "workflow_id")


def last_success(history: DataFrame, stage: str) -> DataFrame:
    """``workflow_id, last_date``."""
    return last_date(succeeded(history, stage), ["workflow_id"])


def ran_on(history: DataFrame, stage: str, date, workflow_ids: DataFrame) -> DataFrame:
    """Of the given ids, those whose last success is exactly the date."""
    done = last_success(history, stage).filter(F.col("last_date") == F.lit(date))
    return workflow_ids.select("workflow_id").join(done, "workflow_id", "left_semi")


def failures_since(history: DataFrame, stage: str, as_of: datetime.datetime, seconds: int) -> DataFrame:
    start = as_of - datetime.timedelta(seconds=seconds)
    return history.filter(
        (F.col("status") != SUCCESS)
        & (F.col("stage") == stage)
        & (F.col("arg_date").cast("timestamp") >= F.lit(start).cast("timestamp"))
    )


def failed_workflows(history: DataFrame, stage: str, date) -> DataFrame:
    """Best runs of the date that are still failures."""
    rows = history.filter((F.col("arg_date") == F.lit(date)) & (F.col("stage") == stage))
    return best_run(rows).filter(F.col("status") != SUCCESS)


def stage_response(history: DataFrame, workflow_id, stage: str, arg_date=None, as_of=None,
                   ignore_failures=False) -> DataFrame:
    """The newest run of one workflow at a stage."""
    rows = history.filter(
        (F.col("workflow_id") == F.lit(workflow_id))
        & (F.col("stage") == stage)
        & F.col("execution_date").isNotNull()
    )
    if ignore_failures:
        rows = succeeded(rows)
    if arg_date is not None:
        rows = rows.filter(F.col("arg_date") == F.lit(arg_date))
    if as_of is not None:
        rows = rows.filter(F.col("execution_date") <= F.lit(as_of))
    return newest(rows)


def stale_workflows(history: DataFrame, workflows: DataFrame, stage: str, date, days=STALE_DAYS):
    """Enabled workflows whose last success is at least ``days`` old."""
    limit = date - datetime.timedelta(days=days)
    last = last_success(history, stage).filter(F.col("last_date") <= F.lit(limit))
    ids = enabled(workflows).select(F.col("id").alias("workflow_id"))
    return last.join(ids, "workflow_id", "left_semi")


def _seconds_between(later, earlier: Column) -> Column:
    return F.unix_timestamp(F.lit(later).cast("timestamp")) - F.unix_timestamp(
        earlier.cast("timestamp")
    )


def ready_workflows(history: DataFrame, workflows: DataFrame, stage: str,
                    target: datetime.datetime, seconds: int, now: datetime.datetime) -> DataFrame:
    """Enabled workflows due at a stage.

    Due means: stale or never run, fewer than three recent failures and, for
    training, a training set that is not stale.  All three come from one
    aggregate over the history.
    """
    start = now - datetime.timedelta(seconds=seconds)
    ok = F.col("status") == SUCCESS
    here = F.col("stage") == stage
    recent = F.col("arg_date").cast("timestamp") >= F.lit(start).cast("timestamp")
    facts = history.groupBy("workflow_id").agg(
        F.max(F.when(ok & here, F.col("arg_date"))).alias("last_run"),
        F.max(F.when(ok & (F.col("stage") == "assembly"), F.col("arg_date"))).alias("last_set"),
        F.count_if(~ok & here & recent).alias("failures"),
    )
    age = _seconds_between(target, F.col("last_run"))
    due = F.col("last_run").isNull() | (age >= seconds)
    calm = F.coalesce("failures", F.lit(0)) < MAX_FAILURES
    if stage == "training":
        fresh = _seconds_between(target, F.col("last_set")) <= seconds
        due = due & F.coalesce(fresh, F.lit(False))
    ids = enabled(workflows).select(F.col("id").alias("workflow_id"))
    return ids.join(facts, "workflow_id", "left").filter(due & calm)


def latest_runs(history: DataFrame, workflows: DataFrame, stage: str, date) -> DataFrame:
    """Newest run per enabled workflow of a stage and date."""
    ids = enabled(workflows).select(F.col("id").alias("workflow_id"))
    rows = history.filter((F.col("arg_date") == F.lit(date)) & (F.col("stage") == stage))
    return latest(rows.join(ids, "workflow_id", "left_semi"), ["workflow_id"])


def latest_failures(history: DataFrame, workflows: DataFrame, stage: str, date) -> DataFrame:
    return latest_runs(history, workflows, stage, date).filter(
        F.col("status").isin(FAILURE_STATUSES)
    )


def weekday_of(date: Column) -> Column:
    """0 for Sunday to 6 for Saturday, as in a cron line."""
    return F.dayofweek(date) - 1


def scheduled(workflows: DataFrame, date) -> DataFrame:
    return workflows.filter(F.col("weekday") == weekday_of(F.lit(date)))


def unlaunched(history: DataFrame, workflows: DataFrame, stage: str, date) -> DataFrame:
    """Enabled workflows expected at a stage on the date that left no report.

    Scoring is expected daily; other stages only on their weekday.  When nothing
    at all ran on the date, nothing is reported.
    """
    that_day = history.filter(F.col("arg_date") == F.lit(date))
    expected = enabled(workflows)
    if stage != "scoring":
        expected = scheduled(expected, date)
    ran = that_day.filter(F.col("stage") == stage).select(F.col("workflow_id").alias("id"))
    any_run = that_day.agg((F.count(F.lit(1)) > 0).alias("any"))
    return (
        expected.filter(any_run.scalar())
        .join(ran.distinct(), "id", "left_anti")
        .select(F.col("id").alias("workflow_id"), "trait_id", "description")
    )


def day_runs(history: DataFrame, date) -> DataFrame:
    """The newest run of each workflow and stage on a date, written once.

    One scan of the history; what reports ask about the date is asked of this
    table, which has a row per workflow and stage.
    """
    return staged(latest(history.filter(F.col("arg_date") == F.lit(date)), ["workflow_id", "stage"]), "day-runs")


def status_counts(history: DataFrame, workflows: DataFrame, stage: str, date) -> DataFrame:
    """``status, n``: latest runs by status, then the three launch totals."""
    return _status_counts(day_runs(history, date), workflows, stage, date)


def _status_counts(history: DataFrame, workflows: DataFrame, stage: str, date) -> DataFrame:
    counted = latest_runs(history, workflows, stage, date).filter(
        F.col("status").isin([*FAILURE_STATUSES, SUCCESS])
    )
    by_status = counted.groupBy("status").agg(F.count(F.lit(1)).alias("n"))

    def total(rows, name):
        return rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("status"), "n")

    return (
        by_status.unionByName(
            by_status.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(
                F.lit("num_launched").alias("status"), "n"
            )
        )
        .unionByName(total(enabled(workflows), "num_workflows"))
        .unionByName(total(unlaunched(history, workflows, stage, date), "num_not_launched"))
    )


def daily_report(history: DataFrame, workflows: DataFrame, date,
                 stages=("assembly", "training", "scoring")) -> dict[str, dict[str, DataFrame]]:
    """Counts, failures and unlaunched workflows of each stage, from one scan of the history."""
    runs = day_runs(history, date)
    return {
        stage: {
            "counts": _status_counts(runs, workflows, stage, date),
            "failures": latest_failures(runs, workflows, stage, date),
            "missing": unlaunched(runs, workflows, stage, date),
        }
        for stage in stages
    }


REPORT_KEYS = ["workflow_id", "trait_id", "name", "ui_name"]


def stage_report(history: DataFrame, workflows: DataFrame, stage: str, arg_date=None, as_of=None):
    """Best runs of a stage as the flat, typed report frame."""
    from cohortia import schemas

    runs = stage_runs(history, workflows, stage, arg_date, as_of)
    return runs.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.STAGE_REPORT]
    )


def training_report(assembly: DataFrame, training: DataFrame) -> DataFrame:
    """Assembly and training reports side by side, either may be absent."""
    from cohortia.operators.reshape import prefix_others

    sides = [
        prefix_others(frame.drop("stage"), f"{name}_", REPORT_KEYS)
        for name, frame in (("assembly", assembly), ("training", training))
    ]
    return sides[0].join(sides[1], REPORT_KEYS, "full_outer")


def with_trait(workflows: DataFrame, trait_id: int) -> DataFrame:
    return workflows.filter(F.col("trait_id") == F.lit(trait_id))


def text_is(workflows: DataFrame, column: str, text: str) -> DataFrame:
    return workflows.filter(F.lower(column) == F.lit(text))


def text_like(workflows: DataFrame, column: str, part: str) -> DataFrame:
    return workflows.filter(F.lower(column).like(f"%{part}%"))


def by_ids(workflows: DataFrame, ids: DataFrame) -> DataFrame:
    return workflows.join(ids.select("id").distinct(), "id", "left_semi")


def missing_ids(workflows: DataFrame, ids: DataFrame) -> DataFrame:
    """Ids asked for that no workflow has."""
    return ids.select("id").distinct().join(workflows, "id", "left_anti")


def counts_by_vendor(workflows: DataFrame) -> DataFrame:
    return workflows.groupBy(vendor_of(F.col("name")).alias("vendor")).agg(
        F.count(F.lit(1)).alias("n")
    )


def require_one(rows: DataFrame, message: str) -> DataFrame:
    if rows.isEmpty():
        raise EmptyInput(message)
    return rows
