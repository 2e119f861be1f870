"""Distributed ranks against plain windows, on ties, NULLs and hot values."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from tests.conftest import rows

from cohortia.operators import ranking


def frame(spark, values, partitions=4):
    data = [(i, None if x is None else float(x), f"u{i % 17}") for i, x in enumerate(values)]
    return spark.createDataFrame(data, "i long, v float, u string").repartition(partitions)


def awkward(n=700, seed=3):
    draw = random.Random(seed)
    values = [draw.choice([None, 0.0, -1.5, 0.5, 0.5, 0.5, draw.gauss(0, 3), draw.gauss(0, 1e-6), 1e30 * draw.random()])
              for _ in range(n)]
    return values + [0.25] * (n // 2)  # one value holds a third of all rows


def test_order_bucket_never_decreases(spark):
    draw = random.Random(1)
    values = [draw.gauss(0, 10.0 ** draw.randint(-30, 30)) for _ in range(3000)]
    values += [2.0**k for k in range(-60, 60)] + [-(2.0**k) for k in range(-60, 60)]
    values += [0.0, float("inf"), float("-inf")]
    df = spark.createDataFrame([(x,) for x in values], "v double")
    buckets = [r.b for r in df.orderBy("v").select(ranking.order_bucket(F.col("v")).alias("b")).collect()]
    assert buckets == sorted(buckets)


def test_order_bucket_of_nan_is_last(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (1e300,)], "v double")
    by_value = [r.b for r in df.select(ranking.order_bucket(F.col("v")).alias("b")).collect()]
    assert by_value[0] == by_value[1] == max(by_value)


@pytest.mark.parametrize("partitions", [1, 7])
def test_percent_rank_matches_the_window(spark, partitions):
    df = frame(spark, awkward(), partitions)
    plain = F.when(
        F.col("v").isNotNull(), F.percent_rank().over(Window.orderBy(F.col("v").desc()))
    )
    expected = df.withColumn("raw_percentile", plain).select("i", "raw_percentile")
    assert rows(ranking.with_percent_rank(df, "v").select("i", "raw_percentile")) == rows(expected)


def test_percent_rank_by_group(spark):
    df = frame(spark, awkward())
    window = Window.partitionBy("u").orderBy(F.col("v").desc())
    expected = df.select("i", F.when(F.col("v").isNotNull(), F.percent_rank().over(window)))
    assert rows(ranking.with_percent_rank(df, "v", ["u"]).select("i", "raw_percentile")) == rows(expected)


def test_percent_rank_of_one_row_is_zero(spark):
    assert ranking.with_percent_rank(frame(spark, [0.3]), "v").first()["raw_percentile"] == 0


@pytest.mark.parametrize("buckets", [4, 10])
def test_quantile_cuts_are_order_statistics(spark, buckets):
    values = np.float32([x for x in awkward() if x is not None])
    ordered = np.sort(values)
    expected = [ordered[int(np.ceil(k * len(ordered) / buckets)) - 1] for k in range(1, buckets)]
    cuts = ranking.quantile_cuts(frame(spark, awkward()), "v", buckets).first()["cuts"]
    assert cuts == [float(x) for x in dict.fromkeys(expected)]


def ratio_rows(df):
    order = Window.orderBy("v", F.md5("u"), "u")
    return df.withColumn("ratio", F.row_number().over(order) / F.count(F.lit(1)).over(Window.partitionBy()))


@pytest.mark.parametrize("share", [0.0, 0.1, 1 / 3, 0.5, 0.95, 1.0])
@pytest.mark.parametrize("from_top", [True, False])
def test_boundary_selects_the_users_of_the_window_form(spark, share, from_top):
    df = frame(spark, awkward(120)).cache()
    ratio = F.col("ratio") >= share if from_top else F.col("ratio") <= share
    pairs = [F.col("v").cast("double"), "u"]
    expected = set(map(tuple, ratio_rows(df).filter(ratio).select(*pairs).distinct().collect()))
    edges = [ranking.Edge(F.lit(True), "v", share, from_top), ranking.Edge(F.lit(False), "v", share, from_top)]
    key, none = ranking.boundary_keys(df, edges, "u")
    assert none is None
    chosen = df.filter(ranking.beyond(F.col("v"), F.col("u"), key, from_top))
    assert set(map(tuple, chosen.select(*pairs).distinct().collect())) == expected


WIDE = 2**53
KINDS = {
    "string": ["https://www.example.com/a", "https://www.example.com/b", "", "é", "zz", "https://www.example.com/", None],
    "bigint": [WIDE, WIDE + 1, WIDE + 2, -WIDE - 1, -WIDE, 0, None],
    "decimal(38,10)": ["12345678901234567890.0000000001", "12345678901234567890.0000000002", "-1.5", "0", None],
    "date": ["2021-01-01", "2021-01-02", "1900-01-01", None],
    "timestamp": ["2021-01-01 00:00:00.000001", "2021-01-01 00:00:00.000002", "1969-12-31 23:59:59", None],
    "boolean": ["true", "false", None],
}


@pytest.mark.parametrize("kind", sorted(KINDS))
@pytest.mark.parametrize("from_top", [True, False])
def test_boundaries_of_any_orderable_type(spark, kind, from_top):
    draw = random.Random(kind)
    data = [(None if (x := draw.choice(KINDS[kind])) is None else str(x), f"u{draw.randrange(9)}") for _ in range(150)]
    df = spark.createDataFrame(data, "v string, u string").withColumn("v", F.col("v").cast(kind)).cache()
    edges = [ranking.Edge(F.lit(True), "v", share, from_top) for share in (0.05, 0.3, 0.5, 0.9)]
    ranked = ratio_rows(df)
    for edge, key in zip(edges, ranking.boundary_keys(df, edges, "u")):
        ratio = F.col("ratio") >= edge.share if from_top else F.col("ratio") <= edge.share
        expected = set(map(tuple, ranked.filter(ratio).select("v", "u").distinct().collect()))
        chosen = df.filter(ranking.beyond(F.col("v"), F.col("u"), key, from_top))
        assert set(map(tuple, chosen.select("v", "u").distinct().collect())) == expected


def test_crowded_doubles_are_ranked_by_range(spark):
    """Distinct doubles that all fall into a handful of order buckets are spread over all tasks."""
    n = 200_000
    df = spark.range(n, numPartitions=4).select((0.5 + F.col("id") * 5e-10).alias("v"))
    ranks = ranking.value_ranks(df, "v", descending=True)
    assert ranks.filter(F.col("n_before") != F.lit(n - 1) - F.round((F.col("v") - 0.5) / 5e-10)).isEmpty()
    counts = df.groupBy("v").agg(F.count(F.lit(1)).alias("n_rows"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # they are tiny here
    try:
        parts = counts.repartitionByRange("v").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert parts < 0.4 * n  # four shuffle partitions
    cuts = ranking.quantile_cuts(df, "v", 4).first()["cuts"]
    assert [round((c - 0.5) / 5e-10) for c in cuts] == [n // 4 - 1, n // 2 - 1, 3 * n // 4 - 1]


def test_edges_on_several_columns(spark):
    df = spark.createDataFrame([(i, f"t{i:03}", f"u{i}") for i in range(100)], "v int, w string, u string")
    edges = [ranking.Edge(F.lit(True), "v", 0.9, True), ranking.Edge(F.col("v") < 50, "w", 0.1, False)]
    top, low = ranking.boundary_keys(df, edges, "u")
    assert (top["v"], low["v"]) == (89, "t004")


def test_edges_are_found_together(spark):
    df = frame(spark, awkward(300)).cache()
    parts = [F.col("i") % 3 == 0, F.col("v") > 0, F.col("u").isin("u1", "u2"), F.col("v").isNull()]
    edges = [ranking.Edge(c, "v", share, top) for c in parts for share in (0.2, 0.9) for top in (True, False)]
    together = ranking.boundary_keys(df, edges, "u")
    for edge, key in zip(edges, together):
        assert ranking.boundary_keys(df, [edge], "u") == [key]


def test_boundary_of_no_rows(spark):
    edge = ranking.Edge(F.lit(True), "v", 0.5, True)
    assert ranking.boundary_keys(frame(spark, [1.0]).filter("false"), [edge], "u") == [None]
    nothing = frame(spark, [1.0, 2.0]).filter(ranking.beyond(F.col("v"), F.col("u"), None, True))
    assert nothing.isEmpty()


def test_row_shares_match_the_window(spark):
    df = frame(spark, awkward(200))
    expected = ratio_rows(df).groupBy(F.col("v").cast("double").alias("v"), "u").agg(
        F.count(F.lit(1)), F.min("ratio"), F.max("ratio")
    )
    got = ranking.row_shares(df, "v", "u").select("v", "u", "n_rows", "first_share", "last_share")
    assert rows(got) == rows(expected)
