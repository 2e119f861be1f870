"""Score tables: jitter, deciles, statistics and threshold buckets."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortia.errors import InvalidDefinition
from cohortia.functions.ids import unit_hash
from cohortia.operators.ranking import (
    bucket_number,
    bucket_offsets,
    quantile_cuts,
    up_to_here,
    with_order_bucket,
)

JITTER = 0.0001
BUCKETS = 10
STRATEGIES = ("decile", "percentile", "absolute")


def jittered(scores: DataFrame, user="xid") -> DataFrame:
    """Add ``temp_score``: the score plus up to 1e-4, to tell equal scores apart."""
    noise = unit_hash(user) * JITTER
    return scores.withColumn("temp_score", (F.col("score") + noise).cast("float"))


def with_decile(scores: DataFrame, value="temp_score", by=(), cuts=None) -> DataFrame:
    """Add ``decile``, 1 for the best tenth.

    ``cuts`` defaults to the exact tenths of the frame itself; the cut row is
    one per group of ``by`` and at most nine numbers wide.
    """
    if cuts is None:
        cuts = quantile_cuts(scores, value, BUCKETS, by)
    if by:
        scores = scores.join(cuts, list(by), "left")
    else:
        scores = scores.withColumn("cuts", cuts.select("cuts").scalar())
    number = bucket_number(F.col(value), F.col("cuts"), BUCKETS)
    return scores.withColumn("decile", (F.lit(BUCKETS) - number).cast("int")).drop("cuts")


def score_stats(scores: DataFrame, by=()) -> DataFrame:
    """Size and score range of each decile, in order."""
    return (
        scores.groupBy(*by, "decile")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.max("score").alias("max_score"),
            F.min("score").alias("min_score"),
            F.avg("score").alias("avg_score"),
        )
        .orderBy(*by, "decile")
    )


def stats_report(scores: DataFrame) -> dict:
    """The decile statistics as plain data: at most ten rows."""
    return {"decile_stats": [row.asDict() for row in score_stats(scores).collect()]}


def check_thresholds(strategy: str, thresholds: list[float], buckets: list[str]) -> None:
    if strategy not in STRATEGIES:
        raise NotImplementedError(f"{strategy} is not a supported strategy")
    if not isinstance(thresholds, list):
        raise InvalidDefinition("thresholds must be a list, even of one value")
    if strategy == "decile" and len(thresholds) != BUCKETS - 1:
        raise InvalidDefinition("decile thresholds need nine values for ten buckets")
    if len(buckets) != len(thresholds) + 1:
        raise InvalidDefinition("there must be one more bucket than thresholds")
    if any(high <= low for low, high in zip(thresholds, thresholds[1:])):
        raise InvalidDefinition("thresholds must increase")


def bucket_label(value: Column, thresholds: Column, buckets: Column) -> Column:
    """Label of the half-open bucket holding the value; NULL stays NULL."""
    passed = F.size(F.filter(thresholds, lambda cut: cut <= value))
    return F.when(value.isNotNull(), F.element_at(buckets, passed + 1))


SETTINGS = ["strategy", "thresholds", "buckets"]
RANGE = ["low", "high", "total", "known"]  # smallest, largest, sum and number of scores


def _label(percentile: Column, score: Column) -> Column:
    value = F.when(F.col("strategy") == "absolute", score.cast("double")).otherwise(percentile)
    return bucket_label(F.when(score.isNotNull(), value), F.col("thresholds"), F.col("buckets"))


def threshold_ranges(scores: DataFrame, attach, by=(), steps=()) -> DataFrame:
    """Score range of each named bucket: ``by, steps, strategy, bucket`` and the range.

    ``attach`` adds the columns ``steps, strategy, thresholds, buckets`` to a
    frame that has ``by``.  Percentiles are the descending ``percent_rank``.

    Rows are aggregated per order bucket first.  Labels only change along the
    order, so an order bucket whose first and last row carry one label is done;
    only the few in which a threshold falls are looked at value by value.
    """
    keys, ids = list(by), [*by, *steps]
    rows = with_order_bucket(scores.select(*keys, "score"), "score")
    measures = [
        F.min("score").alias("low"),
        F.max("score").alias("high"),
        F.sum(F.col("score").cast("double")).alias("total"),
        F.count("score").alias("known"),
    ]
    spans = bucket_offsets(rows, keys, F.count(F.lit(1)), F.desc, measures)

    last_row = F.greatest(F.col("n_total") - 1, F.lit(1))
    spans = attach(spans).withColumns(
        {
            "bucket": _label(F.col("_offset") / last_row, F.col("high")),
            "_end": _label((F.col("_offset") + F.col("_in_bucket") - 1) / last_row, F.col("low")),
        }
    )
    whole = spans.filter(F.col("bucket").eqNullSafe(F.col("_end"))).select(*ids, "strategy", "bucket", *RANGE)

    split = spans.filter(~F.col("bucket").eqNullSafe(F.col("_end"))).select(
        *ids, *SETTINGS, "_bucket", "_offset", "n_total"
    )
    near = rows.join(split.select(*keys, "_bucket").distinct(), [*keys, "_bucket"], "left_semi")
    values = near.groupBy(*keys, "_bucket", "score").agg(F.count(F.lit(1)).alias("known"))
    before = F.sum("known").over(up_to_here([*ids, "_bucket"], F.desc("score"))) - F.col("known")
    parts = (
        values.join(split, [*keys, "_bucket"])
        .withColumn("_before", F.col("_offset") + before)
        .select(
            *ids,
            "strategy",
            _label(F.col("_before") / last_row, F.col("score")).alias("bucket"),
            F.col("score").alias("low"),
            F.col("score").alias("high"),
            (F.col("score").cast("double") * F.col("known")).alias("total"),
            "known",
        )
    )
    return (
        whole.unionByName(parts)
        .groupBy(*ids, "strategy", "bucket")
        .agg(
            F.min("low").alias("min_score"),
            F.max("high").alias("max_score"),
            F.try_divide(F.sum("total"), F.sum("known")).alias("avg_score"),
        )
    )


def threshold_table(scores: DataFrame, strategy, thresholds, buckets, by=()) -> DataFrame:
    """``strategy, bucket, min_score, max_score, avg_score``, best bucket first."""
    check_thresholds(strategy, thresholds, buckets)
    chosen = {
        "strategy": F.lit(strategy),
        "thresholds": F.array(*[F.lit(float(t)) for t in thresholds]),
        "buckets": F.array(*[F.lit(b) for b in buckets]),
    }
    table = threshold_ranges(scores, lambda spans: spans.withColumns(chosen), by)
    return table.orderBy(*by, F.col("avg_score").desc())
