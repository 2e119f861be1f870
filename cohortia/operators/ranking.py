"""Exact ranks, quantile cuts and order statistics without a single-task sort.

A plain ``row_number().over(orderBy(x))`` moves every row into one task.  Here
rows are first counted per distinct value, so that partial aggregation absorbs
ties, however hot.  ``counted_before`` then deals the distinct values out by range,
writes them once, and adds up the ranges before a value's own and what lies before
it inside.  Ranges follow the values that are there, so values of any orderable
type may crowd anywhere without one task getting more than a range.

Cuts and threshold tables need few ranks.  They first count rows per order bucket, a
function of the value alone, and look at single values only where a cut falls.  For
4-byte floats, such as scores are, a bucket has at most about 16,400 values; doubles
that crowd in the bucket of a cut are one task.
"""

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortia.session import staged

_STEPS = 512  # buckets per power of two


def order_bucket(value: Column) -> Column:
    """Integer that never decreases as ``value`` grows; NULL stays NULL."""
    number = value.cast("double")
    size = F.abs(number)
    exponent = F.floor(F.log2(size))
    mantissa = F.floor(size / F.pow(F.lit(2.0), exponent) * _STEPS)
    magnitude = (exponent + 1100) * (2 * _STEPS + 2) + mantissa
    unlimited = F.lit(2**40)
    code = F.when(F.isnan(size) | (size == float("inf")), unlimited).otherwise(magnitude)
    return (
        F.when(number.isNull(), F.lit(None))
        .when(number == 0, F.lit(0))
        .when(F.isnan(number) | (number > 0), code)
        .otherwise(-code)
    ).cast("bigint")


def with_order_bucket(df: DataFrame, value: str) -> DataFrame:
    """Add ``_bucket``; NULL forms its own bucket below every other."""
    return df.withColumn("_bucket", F.coalesce(order_bucket(F.col(value)), F.lit(-(2**50))))


def up_to_here(keys: list, order: Column):
    """Window over the rows of a group up to the current one."""
    return (
        Window.partitionBy(*keys)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def bucket_offsets(rows: DataFrame, keys: list, size: Column, direction=F.asc, measures=()):
    """``keys, _bucket, _in_bucket, _offset, n_total`` and ``measures`` per bucket.

    ``_offset`` counts the rows in earlier buckets of the group.
    """
    totals = rows.groupBy(*keys, "_bucket").agg(size.alias("_in_bucket"), *measures)
    running = F.sum("_in_bucket").over(up_to_here(keys, direction("_bucket")))
    return totals.select(
        *totals.columns,
        (running - F.col("_in_bucket")).alias("_offset"),
        F.sum("_in_bucket").over(Window.partitionBy(*keys)).alias("n_total"),
    )


def counted_before(counts: DataFrame, keys: list, order: list, n: str = "n_rows", descending=False) -> DataFrame:
    """Add ``n_before`` and ``n_total``: the ``n`` of rows sorted before a row, and of all, within its keys.

    ``counts`` holds each combination of keys and order columns once.  NULL sorts
    first when ascending and last when descending, as Spark sorts it.
    """
    direction = [(F.desc if descending else F.asc)(c) for c in order]
    ranges = [*[F.col(k) for k in keys], *direction]
    placed = counts.repartitionByRange(*ranges).sortWithinPartitions(*ranges)
    placed = staged(placed.withColumn("_part", F.spark_partition_id()), "ranges")  # the write fixes the ranges
    parts = placed.groupBy(*keys, "_part").agg(F.sum(n).alias("_in_part"))
    earlier = F.sum("_in_part").over(up_to_here(keys, F.asc("_part"))) - F.col("_in_part")
    parts = parts.select(
        *keys, "_part", earlier.alias("_earlier"), F.sum("_in_part").over(Window.partitionBy(*keys)).alias("n_total")
    )
    inside = Window.partitionBy(*keys, "_part").orderBy(*direction)
    inside = F.sum(n).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col(n)
    return (
        placed.withColumn("_inside", inside)
        .join(parts, [*keys, "_part"])
        .withColumn("n_before", F.col("_earlier") + F.col("_inside"))
        .select(*counts.columns, "n_before", "n_total")
    )


def value_ranks(df: DataFrame, value: str, by=(), descending=False) -> DataFrame:
    """One row per distinct value: ``by, value, n_rows, n_before, n_total``.

    ``n_before`` counts the rows sorted strictly before the value.  NULL sorts
    first when ascending and last when descending, as Spark sorts it.
    """
    counts = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted_before(counts, list(by), [value], descending=descending)


def percent_ranks(df: DataFrame, value: str, by=()) -> DataFrame:
    """Distinct values with their descending ``percent_rank``; NULL has none."""
    share = F.col("n_before") / F.greatest(F.col("n_total") - 1, F.lit(1))
    return value_ranks(df, value, by, descending=True).select(
        *by,
        value,
        "n_rows",
        F.when(F.col(value).isNotNull(), share).alias("raw_percentile"),
    )


def with_percent_rank(df: DataFrame, value: str, by=()) -> DataFrame:
    """Add ``raw_percentile`` to every row."""
    ranks = percent_ranks(df, value, by).drop("n_rows").filter(F.col(value).isNotNull())
    return df.join(ranks, [*by, value], "left")


def quantile_cuts(df: DataFrame, value: str, buckets: int, by=()) -> DataFrame:
    """Inner cut values ``cuts`` of an equal-count split, one row per group.

    The cut for share q is the smallest value with at least q of the rows at or
    below it; equal cuts collapse.  Rows are first counted per order bucket, so
    hardly anything is shuffled; only the few buckets in which a cut falls are
    then counted per value.
    """
    keys = list(by)
    known = with_order_bucket(df.filter(F.col(value).isNotNull()).select(*keys, value), value)

    steps = F.array(*[F.lit(step) for step in range(1, buckets)])
    ranks = F.transform(steps, lambda step: F.ceil(step * F.col("n_total") / buckets))
    in_bucket = F.filter(
        ranks,
        lambda rank: (rank > F.col("_offset")) & (rank <= F.col("_offset") + F.col("_in_bucket")),
    )
    crossed = (
        bucket_offsets(known, keys, F.count(F.lit(1)))
        .select(*keys, "_bucket", "_offset", in_bucket.alias("_ranks"))
        .filter(F.size("_ranks") > 0)
    )

    near = known.join(crossed.select(*keys, "_bucket"), [*keys, "_bucket"], "left_semi")
    counts = near.groupBy(*keys, "_bucket", value).agg(F.count(F.lit(1)).alias("n_rows"))
    last = F.col("_offset") + F.sum("n_rows").over(up_to_here([*keys, "_bucket"], F.asc(value)))
    ranked = counts.join(crossed, [*keys, "_bucket"]).withColumn("_last", last)
    is_cut = F.exists(
        "_ranks",
        lambda rank: (rank > F.col("_last") - F.col("n_rows")) & (rank <= F.col("_last")),
    )
    # at most one value per cut
    return ranked.filter(is_cut).groupBy(*keys).agg(F.sort_array(F.collect_set(value)).alias("cuts"))


def bucket_number(value: Column, cuts: Column, buckets: int) -> Column:
    """How many of the cuts lie at or below the value: its half-open bucket, from 0."""
    passed = [F.when(F.get(cuts, F.lit(i)) <= value, 1).otherwise(0) for i in range(buckets - 1)]
    return sum(passed[1:], passed[0])


@dataclass(frozen=True)
class Edge:
    """A top or bottom share of the rows that satisfy a condition, by a value."""

    condition: Column
    value: str
    share: float
    from_top: bool


def boundary_keys(df: DataFrame, edges: list[Edge], tie: str) -> list[dict | None]:
    """For each edge, the row key at which ``row_number / count`` crosses its share.

    Rows are ordered by ``(value, md5(tie), tie)``; the value may be of any orderable
    type.  From the top that is the first key whose ratio reaches the share, else the
    last one that does not exceed it; None when there is none.

    Edges on one column are found together: their rows are counted per distinct
    key in one scan, the keys written once in order, and one row per edge read back.
    """
    found: list[dict | None] = [None] * len(edges)
    for name in dict.fromkeys(e.value for e in edges):
        mine = [(i, e) for i, e in enumerate(edges) if e.value == name]
        marks = F.array_compact(F.array(*[F.when(e.condition, F.lit(i)) for i, e in mine]))
        rows = df.filter(reduce(or_, [e.condition for _, e in mine])).select(
            F.col(name).alias("v"), F.col(tie).alias("t"), F.explode(marks).alias("edge")
        )
        counts = rows.groupBy("edge", "v", "t").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("h", F.md5("t"))
        ranked = counted_before(counts, ["edge"], ["v", "h", "t"])

        def per_edge(values, kind):
            listed = F.create_map(*[F.lit(x) for i, e in mine for x in (i, values(e))])
            return listed[F.col("edge")].cast(kind)

        share, from_top = per_edge(lambda e: float(e.share), "double"), per_edge(lambda e: e.from_top, "boolean")
        first = (F.col("n_before") + 1) / F.col("n_total")
        last = (F.col("n_before") + F.col("n_rows")) / F.col("n_total")
        key = F.struct("v", "h", "t")
        ends = ranked.filter(F.when(from_top, last >= share).otherwise(first <= share)).groupBy("edge").agg(
            F.min_by(key, "n_before").alias("lowest"), F.max_by(key, "n_before").alias("highest")
        )
        kind = df.schema[name].dataType.simpleString()
        for row in ends.collect():  # one per edge
            end = row.lowest if edges[row.edge].from_top else row.highest
            found[row.edge] = {**end.asDict(), "kind": kind}
    return found


def beyond(value: Column, tie: Column, key: dict | None, from_top: bool) -> Column:
    """Does the row's ``(value, md5(tie), tie)`` lie at the key or on its far side?

    A NULL value lies below all others; ties are hashed only where values are equal.
    """
    if key is None:
        return F.lit(False)
    row, edge = F.struct(F.md5(tie).alias("h"), tie.alias("t")), F.struct(F.lit(key["h"]).alias("h"), F.lit(key["t"]).alias("t"))
    level = (row >= edge) if from_top else (row <= edge)
    if key["v"] is None:
        return value.isNotNull() | level if from_top else value.isNull() & level
    at = F.lit(key["v"]).cast(key["kind"])
    far = (value > at) if from_top else (value < at)
    return F.coalesce(far | ((value == at) & level), F.lit(not from_top))


def row_shares(df: DataFrame, value: str, tie: str) -> DataFrame:
    """``row_number / count`` of rows ordered by ``(value, md5(tie), tie)``, the value of any orderable type.

    One row per distinct ``(value, tie)`` with the shares of its first and last
    copy.  Ties on the value are dealt out by md5 like all else, so neither a hot
    value nor a hot user is ranked in a single task.
    """
    counts = df.groupBy(value, tie).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("_hash", F.md5(tie))
    return counted_before(counts, [], [value, "_hash", tie]).select(
        value,
        tie,
        "n_rows",
        ((F.col("n_before") + 1) / F.col("n_total")).alias("first_share"),
        ((F.col("n_before") + F.col("n_rows")) / F.col("n_total")).alias("last_share"),
    )
