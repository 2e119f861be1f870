"""Identity table scans and checks on the days they hold."""

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortia.errors import EmptyInput
from cohortia.functions.ids import keep_valid_mcids, keep_valid_xids
from cohortia.sources.tables import require_rows, since


def day_spine(spark, date: datetime.date, n_days: int) -> DataFrame:
    """The ``n_days`` dates ending on ``date``, as ``dt``."""
    first = date - datetime.timedelta(days=n_days - 1)
    days = F.sequence(F.lit(first), F.lit(date))
    return spark.range(1).select(F.explode(days).alias("dt"))


def window_of(df: DataFrame, date: datetime.date, n_days: int) -> DataFrame:
    """Partitions of the ``n_days`` days ending on ``date``; absent days are simply absent."""
    first = date - datetime.timedelta(days=n_days - 1)
    return df.filter(F.col("dt").between(F.lit(first), F.lit(date)))


def days_present(identity: DataFrame, date: datetime.date, n_days: int) -> DataFrame:
    """Each wanted day with whether the table holds it: ``dt, present``."""
    held = window_of(identity, date, n_days).select("dt").distinct().withColumn("held", F.lit(True))
    spine = day_spine(identity.sparkSession, date, n_days)
    return spine.join(held, "dt", "left").select("dt", F.col("held").isNotNull().alias("present"))


def days_found(wanted: DataFrame, held: DataFrame) -> DataFrame:
    return wanted.select("dt").intersect(held.select("dt"))


def days_missing(wanted: DataFrame, held: DataFrame) -> DataFrame:
    return wanted.select("dt").distinct().exceptAll(held.select("dt").distinct())


def require_some_day(identity: DataFrame, date: datetime.date, n_days: int) -> list[datetime.date]:
    """Missing days of the window; an error when no wanted day exists at all."""
    days = days_present(identity, date, n_days).collect()  # n_days rows
    missing = sorted(row.dt for row in days if not row.present)
    if len(missing) == len(days):
        raise EmptyInput(f"no identity data for the {n_days} days up to {date}")
    return missing


def id_maps(identity: DataFrame, date: datetime.date, n_days: int) -> tuple[DataFrame, DataFrame]:
    """Valid, distinct ``mcid``-to-visitor and ``xid``-to-visitor pairs of a window."""
    window = window_of(identity, date, n_days)

    def of_kind(kind, name):
        return window.filter(F.col("type") == kind).select(
            F.col("mapped_id").alias(name), "fullvisitor_id"
        )

    mcid = keep_valid_mcids(of_kind("adobe_mcid", "mcid")).distinct()
    xid = keep_valid_xids(of_kind("infinity_id", "xid")).distinct()
    return mcid, xid


def ids_since(identity: DataFrame, date: datetime.date, n_days=0) -> DataFrame:
    """All ids from ``n_days`` before the date onwards, with the day as ``date``."""
    rows = since(identity, date, n_days)
    return require_rows(rows, f"no identity data from {date} minus {n_days} days").withColumnRenamed(
        "dt", "date"
    )
