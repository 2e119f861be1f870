"""Scans.  Dates and ids are filters, so Spark prunes partitions itself."""

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortia.errors import EmptyInput
from cohortia.sources.files import exists

FORMATS = ("parquet", "orc", "csv", "json")


def load(spark: SparkSession, uri: str, fmt="parquet", schema=None, **options) -> DataFrame:
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load(uri)


def cached(df: DataFrame) -> DataFrame:
    """The frame kept in memory, unless it already is; the caller unpersists it."""
    return df if df.storageLevel.useMemory else df.persist()


def load_if_present(spark: SparkSession, uri: str, fmt="parquet", **options) -> DataFrame | None:
    """The table, or None when nothing is stored there.  Other faults surface."""
    return load(spark, uri, fmt, **options) if exists(spark, uri) else None


def load_partition(spark: SparkSession, uri: str, fmt="parquet") -> DataFrame:
    """One partition given as ``base/k1=v1/k2=v2``, keeping the partition columns."""
    parts = uri.rstrip("/").split("/")
    keyed = ["=" in part for part in parts]
    first = keyed.index(True) if any(keyed) else len(parts)
    if not all(keyed[first:]):
        raise ValueError("partition parts must come last in the path")
    df = spark.read.format(fmt).load("/".join(parts[:first]))
    for part in parts[first:]:
        name, value = part.split("=", 1)
        df = df.filter(F.col(name) == F.lit(value).cast(df.schema[name].dataType))
    return df


def on_date(df: DataFrame, date: datetime.date, column="dt") -> DataFrame:
    return df.filter(F.col(column) == F.lit(date))


def since(df: DataFrame, date: datetime.date, days=0, column="dt") -> DataFrame:
    """Rows from ``days`` before the date onwards (no upper end)."""
    return df.filter(F.col(column) >= F.lit(date - datetime.timedelta(days=days)))


def feature_snapshot(features: DataFrame, date: datetime.date, column="last_seen_date") -> DataFrame:
    """Features last seen on the date, missing numbers as 0."""
    return on_date(features, date, column).fillna(0)


def training_set(sets: DataFrame, workflow_id) -> DataFrame:
    """One workflow's training rows, missing numbers as 0."""
    return sets.filter(F.col("workflow_id") == F.lit(workflow_id)).fillna(0)


def scores_of(scores: DataFrame, date: datetime.date, tid: int) -> DataFrame:
    return scores.filter((F.col("date") == F.lit(date)) & (F.col("tid") == F.lit(tid)))


def with_id(df: DataFrame, column: str | Column) -> DataFrame:
    """Expose the chosen column as ``id``."""
    return df.withColumn("id", F.col(column) if isinstance(column, str) else column)


def rename_id(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.withColumnRenamed(column, name)


def active_orders(orders: DataFrame) -> DataFrame:
    """Ids of the active ad orders."""
    return orders.filter("active").select("order_id").distinct()


def of_orders(events: DataFrame, orders: DataFrame | list, column="order_id") -> DataFrame:
    """Events of the given orders: a literal list, or a frame of ids of any size."""
    if isinstance(orders, DataFrame):
        ids = orders.select(F.col("order_id").alias(column))
        return events.join(ids, column, "left_semi")
    return events.filter(F.col(column).isin(list(orders)))


def require_rows(df: DataFrame, message: str, error=EmptyInput) -> DataFrame:
    """The frame itself, or a named error when it is empty."""
    if df.isEmpty():
        raise error(message)
    return df


def require_columns(df: DataFrame, needed: list[str]) -> DataFrame:
    """Just the needed columns; a ValueError names the missing ones."""
    missing = [name for name in needed if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}")
    return df.select(*needed)


def matching(df: DataFrame, template: str, **arguments) -> DataFrame:
    """Rows that satisfy a SQL predicate with ``{named}`` arguments.

    Arguments become typed literals, so text is never spliced into the SQL; a
    ``{name}`` may stand alone or inside quotes or ``DATE('...')``.
    """
    if not template:
        return df
    names = {}
    text = template
    for name, value in arguments.items():
        marked = "{" + name + "}"
        for quoted in (f"DATE('{marked}')", f"'{marked}'", marked):
            text = text.replace(quoted, f"__arg_{name}")
        names[f"__arg_{name}"] = F.lit(value)
    bound = df.withColumns(names) if names else df
    return bound.filter(F.expr(text)).drop(*names)


def columns_with_prefix(df: DataFrame, prefix: str, *keys: str) -> DataFrame:
    return df.select(*keys, *[c for c in df.columns if c.startswith(prefix) and c not in keys])


def columns_containing(df: DataFrame, part: str, *keys: str) -> DataFrame:
    found = [c for c in df.columns if part in c and c not in keys]
    if not found:
        raise ValueError(f"no column contains {part!r}")
    return df.select(*keys, *found)


def known_features(wanted: list[str], known: list[str]) -> list[str]:
    unknown = [name for name in wanted if name not in known]
    if unknown:
        raise ValueError(f"unknown feature columns {unknown}; valid ones are {sorted(known)}")
    return wanted
