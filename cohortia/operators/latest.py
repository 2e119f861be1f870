"""Newest or best record per key, as partial aggregates.

``max_by`` over a struct keeps one record per task and key, where a window
would sort every run of a busy workflow in a single task.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _any_order(df: DataFrame) -> Column:
    """A number that tells rows apart by their columns, but for maps, which cannot be hashed."""
    plain = [name for name, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    return F.xxhash64(*plain)


def best_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row of each key with the largest ``order`` tuple, all columns kept.

    Of several such rows the one whose columns have the largest hash: the same on every layout.
    """
    record = F.struct(*df.columns)
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], _any_order(df).alias("tie"))
    picked = df.groupBy(*keys).agg(F.max_by(record, rank).alias("_best"))
    return picked.select("_best.*")


def latest(df: DataFrame, keys: list[str], when="execution_date") -> DataFrame:
    return best_by(df, keys, [F.col(when)])


def best_run(df: DataFrame, keys=("workflow_id", "stage")) -> DataFrame:
    """Successful runs before failed ones, then the newest."""
    return best_by(df, list(keys), [F.col("status") == "success", F.col("execution_date")])


def newest(df: DataFrame, when="execution_date") -> DataFrame:
    """The single newest row; of several the one whose columns have the largest hash."""
    return df.orderBy(F.col(when).desc(), _any_order(df).desc()).limit(1)


def last_date(df: DataFrame, keys: list[str], column="arg_date", name="last_date") -> DataFrame:
    return df.groupBy(*keys).agg(F.max(column).alias(name))


def recent_activity(rows: DataFrame, user: str, day="dt", days=30) -> DataFrame:
    """Rows within ``days`` of the user's last day, with that day as ``last_seen``.

    The one-row-per-user side is moved off the user's own partitioning first:
    adaptive execution splits a hot user only when both join inputs come
    straight from a shuffle, not from an aggregate that already sits on the key.
    """
    last = rows.groupBy(user).agg(F.max(day).alias("last_seen")).repartition(F.xxhash64(user))
    return rows.join(last, user).filter(F.col(day) >= F.date_sub("last_seen", days))
