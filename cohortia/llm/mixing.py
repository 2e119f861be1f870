"""Mixing sources to target weights by pivotal dependent rounding.

A source whose target is r times its size takes each document floor(r) or
floor(r) + 1 times. Rounding is dependent: two documents exchange mass, in
words, until one of them is taken or left for good; the other goes on with what
remains of its probability. Which way the mass moves is random, with odds that
keep every document's expected copies at r. What a source takes therefore
misses its target by one document at most.

The exchange is a reduction tree. A leaf holds about ``FANOUT`` documents of one
source; it settles all but one of them, and the residuals of ``FANOUT`` leaves
form a node of the next level, up to one node per source. A level has a
``FANOUT``-th of the rows of the one before, and no group is larger than a leaf,
however large its source. Random numbers are hashes of the documents' ids, so
reruns agree on any layout.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortia.session import staged

# Fixed value of the word definition.
WORD = r"[^\x20\x09-\x0D]+"
FANOUT = 64


def word_sizes(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """doc_id, source and size: the words of the text, 0 for a null text."""
    return docs.select(
        docs[id_col].alias("doc_id"),
        docs[source_col].cast("string").alias("source"),
        F.coalesce(F.regexp_count(docs[text_col].cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )


def source_targets(sizes: DataFrame, weights=(3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size, rows and target, with one row per source.

    Sources by code point, null last, weigh ``weights`` in turn and share
    ``share`` of all sizes. A target stops at ``most`` times its source's size,
    and the excess is shared again by weight until none is above. That end is a
    common level per unit of weight: in order of their limit per weight, sources
    are at their limit as long as the level of those left is not below it.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    turn = (F.row_number().over(in_order) - 1) % len(weights)
    weight = reduce(lambda c, k: c.when(turn == k, float(weights[k])), range(len(weights)), F)
    weighted = sources.withColumn("weight", weight).withColumn("limit", most * F.col("source_size"))
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before, onward = by_limit.rowsBetween(Window.unboundedPreceding, -1), by_limit.rowsBetween(0, Window.unboundedFollowing)
    everywhere = Window.partitionBy()
    levels = weighted.withColumn(
        "level",
        (share * F.sum("source_size").over(everywhere) - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        / F.sum("weight").over(onward),
    )
    open_ = F.col("level") < F.col("limit") / F.col("weight")
    level = F.max(F.when(open_, F.col("level"))).over(everywhere)
    target = F.when(open_, level * F.col("weight")).otherwise(F.col("limit"))
    return levels.select("source", "source_size", "rows", target.cast("double").alias("target"))


def _uniform(*columns: Column) -> Column:
    """A number in (0, 1) that depends on the columns alone."""
    return (F.shiftrightunsigned(F.xxhash64(*columns), 12).cast("double") + 0.5) / F.lit(float(1 << 52))


#: Pairs a document x with the open one of s, by the mass that can move up (from x to s) and down.
SETTLE = """
aggregate(
  slice(items, 2, size(items)),
  named_struct('open', items[0], 'done', array_repeat(named_struct('doc_id', items[0].doc_id, 'copy', items[0].copy,
                                                                   'size', items[0].size, 'up', false), 0)),
  (s, x) -> transform(array(named_struct(
      'a', s.open, 'b', x,
      'up', least(s.open.size * (1D - s.open.p), x.size * x.p),
      'down', least(s.open.size * s.open.p, x.size * (1D - x.p)))),
    m -> transform(array(named_struct(
        'rise', m.b.u * (m.up + m.down) < m.down,
        'a_p', if(m.b.u * (m.up + m.down) < m.down, m.a.p + m.up / m.a.size, m.a.p - m.down / m.a.size),
        'b_p', if(m.b.u * (m.up + m.down) < m.down, m.b.p - m.up / m.b.size, m.b.p + m.down / m.b.size),
        'a_settles', if(m.b.u * (m.up + m.down) < m.down,
                        m.a.size * (1D - m.a.p) <= m.b.size * m.b.p, m.a.size * m.a.p <= m.b.size * (1D - m.b.p)))),
      r -> named_struct(
        'open', if(r.a_settles,
          named_struct('order', m.b.order, 'u', m.b.u, 'doc_id', m.b.doc_id, 'copy', m.b.copy, 'size', m.b.size, 'p', least(greatest(r.b_p, 0D), 1D)),
          named_struct('order', m.a.order, 'u', m.a.u, 'doc_id', m.a.doc_id, 'copy', m.a.copy, 'size', m.a.size, 'p', least(greatest(r.a_p, 0D), 1D))),
        'done', concat(s.done, array(if(r.a_settles,
          named_struct('doc_id', m.a.doc_id, 'copy', m.a.copy, 'size', m.a.size, 'up', r.rise),
          named_struct('doc_id', m.b.doc_id, 'copy', m.b.copy, 'size', m.b.size, 'up', NOT r.rise))))))[0])[0],
  s -> s)
"""


def round_copies(items: DataFrame, id_type: str, seed: int = 0) -> DataFrame:
    """Settle all fractional copies: source, doc_id, copy, size and ``up``, whether the document is taken once more.

    items: source, rows (of the source), doc_id, copy, size (above 0) and p in [0, 1).
    """
    leaves = F.ceil(F.col("rows") / F.lit(FANOUT))
    level = items.withColumn("node", F.pmod(F.xxhash64("doc_id", "copy", F.lit(seed)), leaves))
    most = items.agg(F.max("rows")).first()[0]
    nodes, settled, depth = -(-(most or 0) // FANOUT), [], 0
    while True:
        depth += 1
        item = F.struct(
            (-F.col("size")).cast("double").alias("order"),  # the open one then tends to be small
            _uniform(F.col("doc_id"), F.col("copy"), F.lit(seed + depth)).alias("u"), "doc_id", "copy",
            F.col("size").cast("double").alias("size"), "p",
        )
        grouped = level.groupBy("source", "node").agg(F.sort_array(F.collect_list(item)).alias("items"))
        met = staged(grouped.select("source", "node", F.expr(SETTLE).alias("met")), "mix-level")
        settled.append(met.select("source", F.explode("met.done").alias("d")).select("source", "d.*"))
        level = met.select(
            "source", F.floor(F.col("node") / FANOUT).alias("node"),
            F.col("met.open.doc_id").alias("doc_id"), F.col("met.open.copy").alias("copy"),
            F.col("met.open.size").alias("size"), F.col("met.open.p").alias("p"),
        )
        if nodes <= 1:
            break
        nodes = -(-nodes // FANOUT)
    last = _uniform(F.col("doc_id"), F.col("copy"), F.lit(seed - 1)) < F.col("p")
    settled.append(level.select("source", "doc_id", "copy", "size", last.alias("up")))
    return reduce(DataFrame.unionByName, settled).withColumn("doc_id", F.col("doc_id").cast(id_type))


def mix(sizes: DataFrame, weights=(3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 0) -> DataFrame:
    """How often each document is taken: doc_id, source, copy, size, source_size, target, copies and taken.

    sizes: doc_id, source and size, as ``word_sizes`` gives them. ``copy`` tells
    rows apart that agree in all three, from 1; each of them is rounded for
    itself. A document of size 0 is never taken, nor is any if all sizes are 0. A
    null source is a source of its own; a null id is an id like any other. No
    rows give no rows.
    """
    sizes = staged(sizes, "mix-sizes")
    targets = source_targets(sizes, weights, share, most)
    equal = sizes.groupBy("doc_id", "source", "size").agg(F.count("*").alias("equal_rows"))
    rows = equal.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("equal_rows"))))
    targets = staged(targets, "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    known = (
        rows.withColumnRenamed("source", "of")
        .join(targets, F.col("of").eqNullSafe(F.col("source")))
        .select("doc_id", "source", "size", "copy", "source_size", "rows", "target",
                F.floor(rate).alias("whole"), (rate - F.floor(rate)).alias("p"))
    )
    known = staged(known, "mix-rows")
    id_type = dict(sizes.dtypes)["doc_id"]
    rounded = round_copies(known.where("size > 0").select("source", "rows", "doc_id", "copy", "size", "p"), id_type, seed)
    of = targets.select(F.col("source").alias("of"), "source_size", "target", F.floor(rate).alias("whole"))
    counted = (
        rounded.join(of, F.col("of").eqNullSafe(F.col("source")))
        .select("doc_id", "source", "copy", F.col("size").cast("long").alias("size"), "source_size", "target",
                (F.col("whole") + F.col("up").cast("long")).alias("copies"))
    )
    nothing = known.where("size = 0").select(
        "doc_id", "source", "copy", "size", "source_size", "target", F.lit(0).cast("long").alias("copies")
    )
    return counted.unionByName(nothing).withColumn("taken", F.col("size") * F.col("copies"))


def mixed_documents(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", **how) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with their columns as they were."""
    names = [F.col(f"`{c}`") for c in docs.columns]
    sizes = word_sizes(docs, id_col, text_col, source_col)
    taken = mix(sizes, **how).where("copies > 0").select(
        F.struct("doc_id", "source", "size", "copy").alias("_mix_key"), F.col("copies").alias("_mix_copies")
    )
    size = F.coalesce(F.regexp_count(docs[text_col].cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    keyed = docs.withColumn("_mix_size", size)
    of_equal = [F.col(f"`{id_col}`"), F.col(f"`{source_col}`").cast("string"), F.col("_mix_size")]
    rank = F.row_number().over(Window.partitionBy(*of_equal).orderBy(F.col(f"`{text_col}`"))).cast("long")
    key = F.struct(of_equal[0].alias("doc_id"), of_equal[1].alias("source"), F.col("_mix_size").alias("size"), rank.alias("copy"))
    joined = keyed.withColumn("_mix_key", key).join(taken, "_mix_key")
    return joined.withColumn("_mix_turn", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_mix_copies")))).select(*names)
