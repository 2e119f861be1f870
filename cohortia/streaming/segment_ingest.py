"""Segment-file ingest as a stream of manifests."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortia import schemas
from cohortia.plans.segment_tables import SegmentIngest
from cohortia.sources import files
from cohortia.sources import segment_files as sf


def manifest_stream(spark: SparkSession, folder: str) -> DataFrame:
    """New manifest files, each delivered once: ``uri, name, type, timestamp, date``."""
    manifests = (
        spark.readStream.schema(schemas.MANIFEST)
        .option("multiLine", True)
        .option("pathGlobFilter", "*.info")
        .json(folder)
    )
    name = F.col("_metadata.file_name")
    return manifests.select(
        F.col("_metadata.file_path").alias("uri"), name.alias("name"), *sf.file_details(name)
    )


def ingest_stream(spark: SparkSession, folder: str, membership_uri: str, checkpoint: str,
                  tries=10, wait_seconds=120) -> None:
    """Store every manifest that arrived since the last run, then stop.

    The manifest is the unit of work: all data files it lists are written as
    one ``(ref_date, type, timestamp)`` partition.  What is done with each manifest
    is recorded in a ledger beside the table before anything is written, so the
    table ends up the same if a batch is replayed, at whatever point the run
    before broke off.  Files older than the newest one stored are left out, as a
    batch over the folder does; files that come before the first full one wait.
    """
    ingest = SegmentIngest(spark, folder, membership_uri, tries, wait_seconds)

    def store(batch: DataFrame, batch_id: int) -> None:
        # the id of this checkpoint: another stream over the folder counts its batches anew
        stream = json.loads(files.read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]
        ingest.take(batch, stream, batch_id)

    (
        manifest_stream(spark, folder)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
