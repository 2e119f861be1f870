"""Wide to long, and back."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortia.errors import InvalidDefinition


def to_long(df: DataFrame, key: str, value: str, by=("xid", "date")) -> DataFrame:
    """Unpivot every column outside ``by``; they must share one type."""
    kinds = {kind for name, kind in df.dtypes if name not in by}
    if len(kinds) != 1:
        raise InvalidDefinition(f"all unpivoted columns must have one type, found {sorted(kinds)}")
    return df.unpivot(list(by), [c for c in df.columns if c not in by], key, value)


def melt(df: DataFrame, ids: list, values: list, key="variable", value="value") -> DataFrame:
    """Unpivot chosen columns and keep the ids."""
    return df.unpivot(ids, values, key, value)


def pivot_first(df: DataFrame, by: str, name: str, value: str, values=None, fill=True) -> DataFrame:
    """One column per name with its first value; missing numbers as 0.

    Give ``values`` whenever the names are known: it saves a pass over the data
    and fixes the column order.  Otherwise all distinct names are looked up, sorted,
    however many there are.
    """
    if values is None:
        values = [r[0] for r in df.select(name).distinct().sort(name).collect()]  # the columns of the result
    pivoted = df.groupBy(by).pivot(name, values).agg(F.first(value, ignorenulls=True))
    return pivoted.fillna(0) if fill else pivoted


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def prefix_others(df: DataFrame, prefix: str, keys: list[str]) -> DataFrame:
    """Keep the keys and prefix every other column."""
    return df.select(*keys, *[F.col(c).alias(f"{prefix}{c}") for c in df.columns if c not in keys])
