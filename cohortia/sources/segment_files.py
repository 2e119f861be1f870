"""Segment files: names, manifests, lists and lines."""

import time

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortia import schemas
from cohortia.errors import EmptyInput
from cohortia.functions.ids import MCID_PATTERN
from cohortia.sources.files import list_names

LOCAL_ZONE = "EST"  # fixed UTC-5 without daylight saving
FILE_NAME = r"(full|iter)_(\d+)"
BOOTSTRAP_MARGIN = 3600  # seconds before the newest full file


def local_date(epoch: Column) -> Column:
    """Vendor-local calendar date of an epoch in seconds."""
    return F.from_utc_timestamp(F.timestamp_seconds(epoch), LOCAL_ZONE).cast("date")


def file_details(name: Column) -> list[Column]:
    """``type``, ``timestamp`` (seconds) and local ``date`` parsed from a file name."""
    millis = F.regexp_extract(name, FILE_NAME, 2).try_cast("bigint")
    seconds = F.floor(millis / 1000).cast("int")
    return [
        F.regexp_extract(name, FILE_NAME, 1).alias("type"),
        seconds.alias("timestamp"),
        local_date(seconds).alias("date"),
    ]


def described_files(names: DataFrame) -> DataFrame:
    """``name, type, timestamp, date`` of a frame of file names."""
    return names.select("name", *file_details(F.col("name")))


def listed_files(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """Names and paths under a folder that contain a suffix."""
    rows = [(n, f"{folder.rstrip('/')}/{n}") for n in list_names(spark, folder) if suffix in n]
    return spark.createDataFrame(rows, "name string, uri string")


def unprocessed(described: DataFrame, membership: DataFrame | None) -> DataFrame:
    """Files newer than the last one stored, oldest first.

    Without a stored table, start from the newest full file.
    """
    if membership is None:
        full = F.max(F.when(F.col("type") == "full", F.col("timestamp"))) - BOOTSTRAP_MARGIN
        last = described.agg(full.alias("last"))
    else:
        last = membership.agg(F.max("timestamp").alias("last"))
    return described.filter(F.col("timestamp") > last.scalar()).orderBy("timestamp", "name")


def manifest_names(spark: SparkSession, uris: str | list[str]) -> DataFrame:
    """Data file names listed in multi-line JSON manifests: ``manifest, name``."""
    manifests = spark.read.schema(schemas.MANIFEST).option("multiLine", True).json(uris)
    entry = F.map_filter("entry", lambda key, _: F.lower(key) == "filename")
    entries = manifests.select(
        F.col("_metadata.file_name").alias("manifest"), F.explode("Files").alias("entry")
    )
    return entries.select("manifest", F.map_values(entry)[0].alias("name"))


def read_lines(spark: SparkSession, paths: list[str], tries=10, wait_seconds=120) -> DataFrame:
    """Lines of several files, waiting while the files are being moved; other faults surface at once."""
    if not paths:
        raise EmptyInput("no segment files to read")
    for attempt in range(tries):
        try:
            return spark.read.text(paths)
        except AnalysisException as fault:
            if fault.getCondition() != "PATH_NOT_FOUND":
                raise
            if attempt == tries - 1:
                raise EmptyInput(f"files still missing after {tries} tries") from fault
            time.sleep(wait_seconds)


def parse_lines(lines: DataFrame, column="value") -> DataFrame:
    """``<mcid> <segment> <segment> ...`` to ``mcid, segment_array``.

    Lines without a segment or without a 38-digit id are dropped; a token that
    is not a number becomes NULL inside the array.  A comma ends the line, as
    the files are read as the first column of a CSV.
    """
    tokens = F.split(F.split(F.col(column), ",")[0], " ")
    keep = [c for c in lines.columns if c != column]
    return (
        lines.withColumn("_tokens", tokens)
        .filter(F.size("_tokens") > 1)
        .withColumn("mcid", F.col("_tokens")[0])
        .filter(F.col("mcid").rlike(MCID_PATTERN))
        .withColumn(
            "segment_array",
            F.transform(
                F.slice("_tokens", 2, F.size("_tokens") - 1), lambda token: token.try_cast("int")
            ),
        )
        .select(*keep, "mcid", "segment_array")
    )


def segment_list(cells: DataFrame, date, column="value") -> DataFrame:
    """Segment rows from a JSON array kept in one text cell, starting on ``date``.

    The cell may be quoted as in a CSV file, with doubled inner quotes.
    """
    quoted = F.col(column).startswith('"')
    body = F.regexp_replace(F.regexp_replace(F.col(column), r'^"|"$', ""), '""', '"')
    text = F.when(quoted, body).otherwise(F.col(column))
    day = F.lit(date) if not isinstance(date, Column) else date
    return (
        cells.select(F.inline(F.from_json(text, schemas.SEGMENT_LIST)))
        .select(
            F.col("SID").try_cast("int").alias("segment_id"),
            F.col("Name").alias("segment_name"),
            day.cast("date").alias("start_date"),
            F.lit(None).cast("date").alias("end_date"),
            F.lit(None).cast("date").alias("last_processed_date"),
        )
    )


def stamp(parsed: DataFrame, ref_date: Column, kind: Column, timestamp: Column) -> DataFrame:
    """Parsed lines as membership rows."""
    return parsed.select(
        ref_date.cast("date").alias("ref_date"),
        kind.alias("type"),
        timestamp.cast("int").alias("timestamp"),
        "mcid",
        "segment_array",
    )
