"""Connected components of an edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortia.session import staged


def components(edges: DataFrame) -> DataFrame:
    """node and root, the smallest node reachable, of every node in edges (columns a and b).

    Every round a node takes the smallest label around it, then its label's
    label, so rounds grow with the logarithm of a component's diameter. Labels
    are written after each round; minima are taken before rows are shuffled, so a
    node with many edges costs no more than one row a task.
    """
    both = staged(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges"
    )
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("root")), "labels")
    while True:
        around = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
        near = labels.join(around.agg(F.min("root").alias("near")), "node").select(
            "node", F.col("root").alias("was"), F.least("root", "near").alias("root")
        )
        of_root = labels.select(F.col("node").alias("root"), F.col("root").alias("next"))
        jumped = staged(
            near.join(of_root, "root").select("node", F.least("root", "next").alias("root"), "was"), "labels"
        )
        changed = not jumped.where("root <> was").isEmpty()
        labels = jumped.select("node", "root")
        if not changed:
            return labels
