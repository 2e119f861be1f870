"""Idempotent writes on parquet tables.

Partition replacement uses dynamic overwrite: a retried write gives the same
table.  ``rebalance`` lets adaptive execution split a hot partition over many
tasks and merge tiny ones, so one group holding a third of the rows is written
in parallel.
"""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortia import schemas
from cohortia.errors import Conflict, InvalidDefinition
from cohortia.session import scratch_dir
from cohortia.sources import files
from cohortia.sources.versioned import VersionedTable

TARGET_KEYS = ["vendor", "source", "date", "group"]
MEMBERSHIP_KEYS = ["ref_date", "type", "timestamp"]
SCORE_KEYS = ["date", "tid"]
THRESHOLD_KEYS = ["date", "tid", "pid"]


def overwrite_partitions(df: DataFrame, uri: str, keys: list[str]) -> None:
    """Replace exactly the partitions that occur in ``df``."""
    (
        df.hint("rebalance", *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(uri)
    )


def overwrite_and_list(df: DataFrame, uri: str, keys: list[str]) -> set[tuple]:
    """Replace the partitions that occur in ``df``; their keys as text.

    Rows are written aside first, where folder names tell which partitions there
    are; the table's own files are not listed.
    """
    spark = df.sparkSession
    aside = f"{scratch_dir(spark)}/aside-{uuid.uuid4().hex}"
    df.hint("rebalance", *keys).write.partitionBy(*keys).parquet(aside)
    written = set(files.partition_values(spark, aside, keys))
    if written:
        overwrite_partitions(spark.read.schema(df.schema).parquet(aside), uri, keys)
    files.delete(spark, aside)
    return written


def replace_targets(targets: DataFrame, uri: str, replaced: DataFrame) -> bool:
    """Write targets, replacing whole partitions listed in ``replaced``.

    ``replaced`` holds partition keys, a subset of ``TARGET_KEYS``.  Covered
    partitions that are not among those written vanish.  Both are known from
    folder names, so neither the files nor the rows of other partitions are
    listed.  False, and nothing dropped, when there were no rows.
    """
    spark = targets.sparkSession
    written = overwrite_and_list(targets.select(*schemas.TARGETS.names), uri, TARGET_KEYS)
    if not written:
        return False
    rows = [row.asDict() for row in replaced.distinct().collect()]  # the caller's list of partitions
    wanted: dict[tuple, set] = {}  # groups by the rest of the key: one listing for all groups of a day
    for row in rows:
        day = tuple(row.get(k, files.ANY) for k in TARGET_KEYS[:-1])
        wanted.setdefault(day, set()).add(row.get("group", files.ANY))
    for day, groups in wanted.items():
        narrowed = dict(zip(TARGET_KEYS, day))
        texts = {None if g in (None, "") else g if g is files.ANY else str(g) for g in groups}
        for found in files.partition_values(spark, uri, TARGET_KEYS, **narrowed):
            if (files.ANY in texts or found[-1] in texts) and found not in written:
                files.delete(spark, files.partition_pattern(uri, dict(zip(TARGET_KEYS, found))))
    return True


def replace_day(targets: DataFrame, uri: str, vendor: str, source: str | None, date) -> bool:
    """Replace one vendor, source and date; every source when it is None."""
    spark = targets.sparkSession
    if source is None:
        keys = spark.createDataFrame([(vendor, date)], "vendor string, date date")
    else:
        keys = spark.createDataFrame(
            [(vendor, source, date)], "vendor string, source string, date date"
        )
    return replace_targets(targets, uri, keys)


def score_table(spark: SparkSession, uri: str) -> VersionedTable:
    """Scores of every date and trait, each replaced as a whole; readers pin a version."""
    return VersionedTable(spark, uri, schemas.SCORES, SCORE_KEYS)


def write_scores(scores: DataFrame, to: str | VersionedTable) -> None:
    """Replace the scores of each date and trait that occurs, in a folder or a versioned table."""
    rows = scores.select(*schemas.SCORES.names)
    if isinstance(to, VersionedTable):
        to.replace(rows)
    else:
        overwrite_partitions(rows, to, SCORE_KEYS)


def read_scores(spark: SparkSession, to: str | VersionedTable) -> DataFrame:
    return to.read() if isinstance(to, VersionedTable) else spark.read.schema(schemas.SCORES).parquet(to)


def write_training_sets(rows: DataFrame, uri: str) -> None:
    """``workflow_id, xid, feature_*, target`` rows, one partition per workflow."""
    overwrite_partitions(rows, uri, ["workflow_id"])


def write_thresholds(table: DataFrame, uri: str) -> None:
    """Threshold rows carrying ``date, tid, pid``."""
    overwrite_partitions(table, uri, THRESHOLD_KEYS)


def write_membership(rows: DataFrame, uri: str) -> None:
    overwrite_partitions(rows.select(*schemas.MEMBERSHIP.names), uri, MEMBERSHIP_KEYS)


def append_history(rows: DataFrame, uri: str) -> None:
    """Append run reports; ``info, stats, warnings`` are JSON text."""
    rows.select(*schemas.HISTORY.names).write.mode("append").parquet(uri)


def response_row(workflow, stage, status, date, info=None, stats=None, warnings=None,
                 error=None, traceback=None, executed=None) -> dict:
    """One run report in the history layout."""
    return {
        "workflow_id": str(workflow),
        "stage": stage,
        "status": status,
        "arg_date": date,
        "execution_date": executed or datetime.datetime.now(datetime.timezone.utc),
        "info": json.dumps(info or {}),
        "stats": json.dumps(stats or {}),
        "warnings": json.dumps(warnings or {}),
        "error": None if error is None else str(error),
        "traceback": traceback,
    }


def history_frame(spark, responses: list[dict]) -> DataFrame:
    names = schemas.HISTORY.names
    return spark.createDataFrame([tuple(r[n] for n in names) for r in responses], schemas.HISTORY)


class SnapshotTable:
    """Small table rewritten as a whole: each write is a new numbered folder.

    Readers use the newest finished folder, so a failed or repeated write never
    shows a half-written table.  This serves the upserts of the segment list.

    Rows are written aside; a number is then claimed by a file that only one
    writer can create, and the folder gets its name.  ``update`` starts again from
    the other's rows where a second writer was faster, so no change is lost.
    """

    def __init__(self, spark, uri: str, schema):
        self.spark, self.uri, self.schema = spark, uri.rstrip("/"), schema

    def versions(self) -> list[int]:
        self._name_claimed()
        names = files.list_names(self.spark, self.uri)
        found = [int(n.split("=", 1)[1]) for n in names if n.startswith("snapshot=")]
        return sorted(v for v in found if files.exists(self.spark, f"{self._folder(v)}/_SUCCESS"))

    def _folder(self, version: int) -> str:
        return f"{self.uri}/snapshot={version}"

    def _claims(self) -> list[int]:
        return sorted(int(n) for n in files.list_names(self.spark, f"{self.uri}/_claims") if n.isdigit())

    def _last(self) -> int:
        """The highest number taken, by a finished folder or a claim."""
        return max([*self.versions(), *self._claims(), 0])

    def _name_claimed(self) -> None:
        """Finish what a writer that broke off after its claim has left: only the newest can be open."""
        for number in self._claims()[-1:]:
            if not files.exists(self.spark, self._folder(number)):
                aside = files.read_text(self.spark, f"{self.uri}/_claims/{number}")
                files.move(self.spark, f"{self.uri}/{aside}", self._folder(number))

    def read(self) -> DataFrame | None:
        versions = self.versions()
        if not versions:
            return None
        return self.spark.read.schema(self.schema).parquet(self._folder(versions[-1]))

    def _write(self, df: DataFrame, base: int) -> bool:
        """Write the version after base, unless another writer has taken that number."""
        aside = f"_writing-{uuid.uuid4().hex}"
        df.select(*self.schema.names).write.parquet(f"{self.uri}/{aside}")
        if not files.claim(self.spark, f"{self.uri}/_claims/{base + 1}", aside):
            files.delete(self.spark, f"{self.uri}/{aside}")
            return False
        files.move(self.spark, f"{self.uri}/{aside}", self._folder(base + 1))
        return True

    def create(self, df: DataFrame) -> None:
        base = self._last()
        if self.versions() or not self._write(df, base):
            raise InvalidDefinition(f"a table already exists at {self.uri}")

    def write(self, df: DataFrame) -> None:
        """Write a version that does not depend on the one before."""
        while not self._write(df, self._last()):
            pass

    def update(self, change: Callable[[DataFrame | None], DataFrame], tries: int = 10) -> None:
        """Write what ``change`` makes of the newest rows (None before the first write)."""
        for _ in range(tries):
            base = self._last()
            if self._write(change(self.read()), base):
                return
        raise Conflict(f"other writers changed {self.uri} during each of {tries} tries")

    def expire(self, keep: int = 10) -> None:
        """Drop all but the newest finished versions; readers of older ones must have ended."""
        for version in self.versions()[:-keep]:
            files.delete(self.spark, self._folder(version))


def upsert_segments(stored: DataFrame, changes: DataFrame) -> DataFrame:
    """Segment list after merging changes into the open (no end date) rows.

    A matched open row takes the new name and end date and keeps its start and
    last processed date; unmatched changes are inserted; closed rows stay.
    """
    is_open = F.col("end_date").isNull()
    new = changes.select(
        "segment_id",
        *[F.col(c).alias(f"new_{c}") for c in changes.columns if c != "segment_id"],
        F.lit(True).alias("changed"),
    )
    merged = stored.filter(is_open).withColumn("stored", F.lit(True)).join(
        new, "segment_id", "full_outer"
    )
    matched = F.col("stored") & F.col("changed")
    inserted = F.col("stored").isNull()

    def choose(name, when_matched):
        source = F.col(f"new_{name}") if when_matched else F.col(name)
        return (
            F.when(matched, source)
            .when(inserted, F.col(f"new_{name}"))
            .otherwise(F.col(name))
            .alias(name)
        )

    rows = merged.select(
        "segment_id",
        choose("segment_name", True),
        choose("start_date", False),
        choose("end_date", True),
        choose("last_processed_date", False),
    )
    return stored.filter(~is_open).unionByName(rows)


def mark_processed(stored: DataFrame, changes: DataFrame) -> DataFrame:
    """Set ``last_processed_date`` of segments in ``changes``, closed ones too."""
    new = changes.select("segment_id", F.col("last_processed_date").alias("new_date")).distinct()
    return (
        stored.join(new.withColumn("hit", F.lit(True)), "segment_id", "left")
        .withColumn(
            "last_processed_date",
            F.when(F.col("hit"), F.col("new_date")).otherwise(F.col("last_processed_date")),
        )
        .select(*stored.columns)
    )
