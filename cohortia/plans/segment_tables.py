"""Upkeep of the segment list and the membership table."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortia import schemas
from cohortia.errors import EmptyInput
from cohortia.operators import segments as seg
from cohortia.sources import files, sinks
from cohortia.sources import segment_files as sf
from cohortia.sources.ledger import Ledger


def read_membership(spark: SparkSession, uri: str) -> DataFrame | None:
    if not files.exists(spark, uri):
        return None
    return spark.read.schema(schemas.MEMBERSHIP).parquet(uri)


def read_targets(spark: SparkSession, uri: str) -> DataFrame:
    return spark.read.schema(schemas.TARGETS).parquet(uri)


def segment_table(spark: SparkSession, uri: str) -> sinks.SnapshotTable:
    return sinks.SnapshotTable(spark, uri, schemas.ACTIVE_SEGMENTS)


def latest_segment_dates(targets: DataFrame, membership: DataFrame, listed: DataFrame) -> DataFrame:
    """Newest target date per listed segment, since the newest full file."""
    full = seg.latest_full_date(membership)
    rows = targets.filter((F.col("vendor") == "adobe") & (F.col("source") == "mcid"))
    recent = rows.filter(F.col("date") >= F.lit(full))
    if recent.isEmpty():
        raise EmptyInput(f"no targets since {full}")
    return seg.last_target_dates(recent, listed)


def maintain_segments(table: sinks.SnapshotTable, listed: DataFrame, date: datetime.date,
                      targets: DataFrame | None = None, membership: DataFrame | None = None) -> None:
    """Create the segment list, or merge a newly listed set into it."""

    def merged(stored):
        if stored is None:
            return seg.new_segment_table(listed, latest_segment_dates(targets, membership, listed))
        return sinks.upsert_segments(stored, seg.segment_changes(stored, listed, date))

    table.update(merged)


def targets_written(targets: DataFrame, date: datetime.date) -> bool:
    """Are there segment targets of the date?"""
    wanted = (
        (F.col("vendor") == "adobe")
        & (F.col("source") == "mcid")
        & (F.col("date") == F.lit(date))
    )
    return not targets.filter(wanted).isEmpty()


def advance_processed(table: sinks.SnapshotTable, membership: DataFrame, targets: DataFrame,
                      date: datetime.date) -> None:
    """Move the last processed date to the newest segment file, once targets exist."""
    if not targets_written(targets, date):
        raise EmptyInput(f"segment targets were not written for {date}")
    newest = seg.latest_file_date(membership).scalar()
    table.update(lambda stored: sinks.mark_processed(stored, stored.withColumn("last_processed_date", newest)))


def membership_partitions(spark: SparkSession, uri: str) -> DataFrame | None:
    """``ref_date, type, timestamp`` of the stored files, from folder names alone; None without a table.

    Serves wherever only the newest file or the full-file dates of the membership
    table are asked for: a local frame, so no plan that uses it reads a data file.
    """
    found = files.partition_values(spark, uri, sinks.MEMBERSHIP_KEYS)
    if not found:
        return None
    rows = [(datetime.date.fromisoformat(ref), kind, int(stamp)) for ref, kind, stamp in found]
    return spark.createDataFrame(rows, "ref_date date, type string, timestamp int")


DESCRIBED = ["uri", "name", "type", "timestamp", "date"]


def _plan_batch(spark, delivered: list[dict], before: dict | None, membership_uri: str) -> dict:
    """What is to be done with delivered manifests, and what the next batch starts from.

    ``newest`` is the time of the newest file stored so far: only newer files are
    taken.  Before the first full file all wait; with it, those from shortly before
    it on are taken and the others dropped, as a batch over the folder would.
    """
    stored = membership_partitions(spark, membership_uri)
    if before is None:
        newest = None if stored is None else stored.agg(F.max("timestamp")).first()[0]
        before = {"newest": newest, "waiting": []}
    offered = {m["name"]: m for m in [*before["waiting"], *delivered]}
    newest, waiting, taken = before["newest"], [], []
    cut = newest
    if newest is None:
        fulls = [m["timestamp"] for m in offered.values() if m["type"] == "full"]
        cut = max(fulls) - sf.BOOTSTRAP_MARGIN if fulls else None
    if cut is None:
        waiting = list(offered.values())
    else:
        taken = [m for m in offered.values() if m["timestamp"] is not None and m["timestamp"] > cut]
    if taken:
        rows = [tuple(datetime.date.fromisoformat(m[c]) if c == "date" else m[c] for c in DESCRIBED) for m in taken]
        described = spark.createDataFrame(rows, "uri string, name string, type string, timestamp int, date date")
        refs = {r["name"]: r.ref_date for r in seg.reference_dates(described, stored).collect()}  # one per file
        waiting += [m for m in taken if refs[m["name"]] is None]
        taken = [{**m, "ref_date": str(refs[m["name"]])} for m in taken if refs[m["name"]] is not None]
        newest = max([m["timestamp"] for m in taken], default=newest)
    return {"cut": cut, "newest": newest, "files": sorted(taken, key=lambda m: (m["timestamp"], m["name"])), "waiting": waiting}


@dataclass
class SegmentIngest:
    """Stores described manifests in a membership table, each batch once whatever happens in between."""

    spark: SparkSession
    folder: str
    membership_uri: str
    tries: int = 10
    wait_seconds: float = 120

    def __post_init__(self):
        self.ledger = Ledger(self.spark, f"{self.membership_uri.rstrip('/')}_ledger")

    def _carry_out(self, number: int) -> int:
        """Write the partitions an entry names; a repetition writes the same ones."""
        taken = self.ledger.entry(number)["files"]
        if taken:
            rows = [{**m, "ref_date": datetime.date.fromisoformat(m["ref_date"])} for m in taken]
            store_manifests(self.spark, self.folder, rows, self.membership_uri, self.tries, self.wait_seconds)
        self.ledger.mark_done(number)
        return len(taken)

    def finish_open(self) -> None:
        """Carry out what earlier runs have decided but not written to the end."""
        for number in self.ledger.open_entries():
            self._carry_out(number)

    def take(self, described: DataFrame, stream: str, batch: int, must_refer=False) -> int:
        """Decide on a batch of ``uri, name, type, timestamp, date`` and store it; returns how many files.

        A batch of this stream that has an entry is carried out as the entry says.
        With must_refer, a file without a full file to refer to stops the run.
        """
        known = self.ledger.of_batch(stream, batch)
        self.finish_open()
        if known is not None:
            return self._carry_out(known)
        delivered = [{**r.asDict(), "date": str(r.date)} for r in described.select(*DESCRIBED).collect()]  # one per manifest
        while True:
            numbers = self.ledger.numbers()
            before = self.ledger.entry(numbers[-1]) if numbers else None
            entry = _plan_batch(self.spark, delivered, before, self.membership_uri)
            if must_refer and entry["cut"] is not None and entry["waiting"]:
                raise EmptyInput("no full segment file yet: try again when one is available")
            after = numbers[-1] if numbers else 0
            if self.ledger.add(after, {"stream": stream, "batch": batch, **entry}):
                return self._carry_out(after + 1)
            self.finish_open()  # another run was faster


def ingest_files(spark: SparkSession, folder: str, membership_uri: str, tries=10, wait_seconds=120) -> int:
    """Store all new segment files of a folder, oldest first; returns how many.

    One job reads the lines of all new files together and writes one partition
    per file; reference dates of the whole batch are resolved beforehand and kept
    in a ledger beside the table, see ``SegmentIngest``.
    """
    ingest = SegmentIngest(spark, folder, membership_uri, tries, wait_seconds)
    ingest.finish_open()
    manifests = sf.listed_files(spark, folder, ".info")
    described = manifests.select("uri", "name", *sf.file_details(F.col("name")))
    todo = sf.unprocessed(described, membership_partitions(spark, membership_uri))
    if todo.isEmpty():
        return 0
    return ingest.take(todo, "folder", len(ingest.ledger.numbers()), must_refer=True)


def store_manifests(spark, folder, rows, membership_uri, tries=10, wait_seconds=120) -> None:
    """Read the data files of described manifests and write their partitions."""
    held = set(files.list_names(spark, folder))
    described = {row["name"]: row for row in rows}
    owner = []
    # file names only, of all manifests in one job
    for manifest, name in sf.manifest_names(spark, [row["uri"] for row in rows]).collect():
        if name not in held:
            raise EmptyInput(f"{manifest} lists {name}, which is not there")
        row = described[manifest]
        owner.append((name, row["ref_date"], row["type"], row["timestamp"]))
    base = folder.rstrip("/")
    lines = sf.read_lines(spark, [f"{base}/{o[0]}" for o in owner], tries, wait_seconds)
    details = spark.createDataFrame(
        owner, "name string, ref_date date, type string, timestamp int"
    )
    tagged = lines.withColumn("name", F.col("_metadata.file_name")).join(details, "name")  # a row per data file
    parsed = sf.parse_lines(tagged)
    sinks.write_membership(
        sf.stamp(parsed, F.col("ref_date"), F.col("type"), F.col("timestamp")), membership_uri
    )
