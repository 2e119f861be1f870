"""JSON aspect columns."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def aspect(pairs: dict[str, str | Column] | None = None, as_text=False) -> Column:
    """JSON object text from ``{name: column}``; no pairs gives ``{}``.

    All values of one map have one type.  ``as_text`` states that it is text,
    for columns of several types; ANSI coercion would try numbers instead.
    """
    entries = []
    for name, value in (pairs or {}).items():
        column = F.col(value) if isinstance(value, str) else value
        entries += [F.lit(name), column.cast("string") if as_text else column]
    return F.to_json(F.create_map(*entries))


def constant_aspect(**values: str) -> Column:
    return aspect({name: F.lit(value) for name, value in values.items()})


def aspect_columns(df: DataFrame, groups: dict[str, dict], keys=("xid", "date")) -> DataFrame:
    """Keep ``keys`` and add one JSON column per group."""
    return df.select(*keys, *[aspect(pairs).alias(group) for group, pairs in groups.items()])


def aspect_value(name: str, column="aspect") -> Column:
    return F.get_json_object(column, f"$.{name}")


def balanced(join, conditions: list[Column]) -> Column:
    """One condition whose depth grows with the logarithm of their number."""
    while len(conditions) > 1:
        pairs = zip(conditions[::2], conditions[1::2])
        conditions = [join(left, right) for left, right in pairs] + conditions[len(conditions) // 2 * 2 :]
    return conditions[0]


def all_of(conditions: list[Column]) -> Column:
    return balanced(lambda left, right: left & right, conditions)


def any_of(conditions: list[Column]) -> Column:
    return balanced(lambda left, right: left | right, conditions)
