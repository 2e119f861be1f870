"""Hadoop file system helpers: existence, listing and dropping partitions."""

import os
import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, uri: str) -> bool:
    fs, path = _fs(spark, uri)
    return fs.exists(path)


def list_names(spark: SparkSession, uri: str) -> list[str]:
    """Names directly under a folder; none when it does not exist."""
    fs, path = _fs(spark, uri)
    if not fs.exists(path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(path))


def delete(spark: SparkSession, uri: str) -> None:
    fs, path = _fs(spark, uri)
    if fs.exists(path):
        fs.delete(path, True)


def read_text(spark: SparkSession, uri: str) -> str:
    """Content of a small text file."""
    fs, path = _fs(spark, uri)
    stream = fs.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def claim(spark: SparkSession, uri: str, text: str) -> bool:
    """Create a small file with this content, unless it exists: of several writers one succeeds.

    The content is complete before the name appears.  A local folder takes a hard
    link; elsewhere a rename must refuse to replace a file, as it does on HDFS.
    """
    fs, path = _fs(spark, uri)
    fs.mkdirs(path.getParent())
    draft = spark._jvm.org.apache.hadoop.fs.Path(path.getParent(), f"_draft-{uuid.uuid4().hex}")
    if fs.getScheme() == "file":
        source, target = draft.toUri().getPath(), path.toUri().getPath()
        with open(source, "x", encoding="utf-8") as out:
            out.write(text)
        try:
            os.link(source, target)
        except FileExistsError:
            return False
        finally:
            os.unlink(source)
        return True
    stream = fs.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not fs.exists(path) and fs.rename(draft, path):
        return True
    fs.delete(draft, False)
    return False


def move(spark: SparkSession, uri: str, target: str) -> bool:
    """Give a folder its final name; False where there is nothing to move, or the name is taken."""
    fs, path = _fs(spark, uri)
    _, to = _fs(spark, target)
    return fs.exists(path) and not fs.exists(to) and fs.rename(path, to)


def names_older_than(spark: SparkSession, uri: str, hours: float) -> list[str]:
    """Names directly under a folder that were last changed so long ago."""
    fs, path = _fs(spark, uri)
    if not fs.exists(path):
        return []
    limit = (time.time() - hours * 3600) * 1000
    return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.getModificationTime() <= limit)


ANY = object()  # partition value that matches everything


# Characters Spark escapes in partition folder names.
_ESCAPED = "\"#%'*/:=?\\\x7f{[]^"


def _escape(value) -> str:
    if value is None or value == "":
        return "__HIVE_DEFAULT_PARTITION__"
    return "".join(
        f"%{ord(ch):02X}" if ch in _ESCAPED or ord(ch) < 32 else ch for ch in str(value)
    )


def partition_folder(name: str, value) -> str:
    """Folder name of one partition value, or the glob for all of them."""
    return f"{name}=*" if value is ANY else f"{name}={_escape(value)}"


def partition_pattern(base: str, keys: dict) -> str:
    """Glob for the partitions with the given keys, in the table's partition order."""
    return "/".join([base.rstrip("/"), *[partition_folder(k, v) for k, v in keys.items()]])


def files_by_folder(spark: SparkSession, pattern: str) -> dict[str, list[str]]:
    """Names of the files that match a glob, by folder."""
    fs, path = _fs(spark, pattern)
    found: dict[str, list[str]] = {}
    for status in fs.globStatus(path) or []:
        folder, name = status.getPath().toString().rsplit("/", 1)
        found.setdefault(folder, []).append(name)
    return {folder: sorted(names) for folder, names in found.items()}


def _unescape(text: str) -> str | None:
    if text == "__HIVE_DEFAULT_PARTITION__":
        return None
    return re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), text)


def partition_values(spark: SparkSession, base: str, keys: list[str], **wanted) -> list[tuple]:
    """Partition values of a table as text, from folder names alone; wanted narrows the listing.

    No data file is looked at, and no file name leaves the file system.
    """
    pattern = partition_pattern(base, {k: wanted.get(k, ANY) for k in keys})
    fs, path = _fs(spark, pattern)
    found = []
    for status in fs.globStatus(path) or []:
        parts = status.getPath().toString().split("/")[-len(keys):]
        found.append(tuple(_unescape(part.split("=", 1)[1]) for part in parts))
    return found


def partitions(spark: SparkSession, base: str, columns: list[str], schema) -> DataFrame | None:
    """Distinct partition keys of a table, or None when there is no table.

    The schema is given, so that a group such as ``0012`` stays text.
    """
    if not exists(spark, base):
        return None
    return spark.read.schema(schema).parquet(base).select(*columns).distinct()


def any_partition(spark: SparkSession, base: str, columns: list[str], schema, condition) -> bool:
    """Does any partition satisfy the condition on the partition columns?"""
    keys = partitions(spark, base, columns, schema)
    return keys is not None and not keys.filter(condition).isEmpty()
