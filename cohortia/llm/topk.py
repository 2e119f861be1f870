"""Exact top-k inner products over an impact-ordered index, score at a time.

The index holds blocks of vectors as postings (vector, dimension, value). The
quantised impact of a posting is the power of two below its magnitude; a block's
postings lie in segments of descending impact. A search adds whole segments, the
strongest first, to the scores of all vectors of a block. What weaker segments
can still add to a vector is at most the query's norm times the norm of the
vector's components in them, so every score has a lower and an upper bound. A
query stops only when this proves that few enough vectors can be among its k
best; those are scored exactly.

A search joins the index's blocks with blocks of queries, so a task holds one
block of either. Each pair of blocks returns k rows a query, from which the k
best are taken.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortia.session import staged

VECTORS_PER_BLOCK, QUERIES_PER_BLOCK, QUERIES_AT_ONCE = 4096, 4096, 256
#: A query of which so many vectors can be members, times k, goes on with the next segment.
FEW = 4
#: Larger components than this are summed as Python integers.
SMALL = 1 << 22
INDEX = "block int, ids binary, dims int, impacts array<int>, starts array<long>, vecs binary, at binary, vals binary"
HITS = "query_id long, query_key long, vec_id long, score long"


def usable(vectors: DataFrame, id_col="vec_id", vector_col="embedding", scale: int = 64) -> DataFrame:
    """vec_id and values (floor(scale * x) as doubles) of the rows that take part.

    Rows without an id or vector, or with a null or non-finite component, take
    none; nor do those whose product with scale is not finite.
    """
    values = F.transform(vectors[vector_col], lambda x: F.lit(float(scale)) * x.cast("double"))
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = vectors.select(vectors[id_col].cast("long").alias("vec_id"), values.alias("values"), finite.alias("finite"))
    return whole.where("vec_id is not null and values is not null and finite").select("vec_id", "values")


def _matrix(rows: pa.Array) -> np.ndarray:
    """Integer rows, short ones filled up with zeros; of Python integers if some are large."""
    sizes = np.diff(rows.offsets.to_numpy())
    flat = np.floor(rows.flatten().to_numpy(zero_copy_only=False))
    width = int(sizes.max(initial=0))
    out = np.zeros((len(rows), width), np.int64)
    if np.abs(flat).max(initial=0) >= SMALL:
        out = out.astype(object)
        flat = np.array([int(x) for x in flat], object)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def _segments(table: pa.Table) -> pa.Table:
    """A block's postings in segments of descending impact."""
    table = table.combine_chunks()
    matrix = _matrix(table["values"].chunk(0) if table.num_rows else pa.array([], pa.list_(pa.float64())))
    large = matrix.dtype == object
    vec, dim = np.nonzero(matrix)
    value = matrix[vec, dim]
    if large:
        impact = np.array([abs(x).bit_length() - 1 for x in value], np.int64)
        payload = "\n".join(map(str, value)).encode()
    else:
        impact = np.frexp(np.abs(value).astype(float))[1].astype(np.int64) - 1
        payload = None
    order = np.lexsort((vec, dim, -impact))
    impacts, counts = np.unique(-impact, return_counts=True)
    if large:
        payload = "\n".join(str(value[i]) for i in order).encode()
    else:
        payload = value[order].astype(np.int32).tobytes()
    return pa.table(
        {
            "block": pa.array([table["block"][0].as_py()], pa.int32()),
            "ids": pa.array([np.asarray(table["vec_id"], np.int64).tobytes()], pa.binary()),
            "dims": pa.array([matrix.shape[1]], pa.int32()),
            "impacts": pa.array([(-impacts).tolist()], pa.list_(pa.int32())),
            "starts": pa.array([np.r_[0, np.cumsum(counts)].tolist()], pa.list_(pa.int64())),
            "vecs": pa.array([vec[order].astype(np.int32).tobytes()], pa.binary()),
            "at": pa.array([dim[order].astype(np.int32).tobytes()], pa.binary()),
            "vals": pa.array([payload], pa.binary()),
        }
    )


def build_index(vectors: DataFrame, per_block: int = VECTORS_PER_BLOCK) -> DataFrame:
    """One row per block of about per_block vectors, staged. vectors: as ``usable`` gives them."""
    blocks = max(1, -(-vectors.count() // per_block))
    key = F.pmod(F.xxhash64("vec_id", "values"), F.lit(blocks)).cast("int").alias("block")
    grouped = vectors.select(key, "vec_id", "values").groupBy("block")
    return staged(grouped.applyInArrow(_segments, INDEX), "impact-index")


class Block:
    """A row of the index, opened for search."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], np.int64)
        vec, dim = np.frombuffer(row["vecs"], np.int32), np.frombuffer(row["at"], np.int32)
        starts = row["starts"]
        self.large = len(row["vals"]) != 4 * len(vec)
        values = (
            np.array([int(x) for x in row["vals"].split()], object) if self.large else np.frombuffer(row["vals"], np.int32)
        )
        self.exact = np.zeros((len(self.ids), row["dims"]), object if self.large else np.int64)
        self.exact[vec, dim] = values
        if self.large:
            return
        self.segments, rest = [], np.zeros(len(self.ids))
        np.add.at(rest, vec, values.astype(float) ** 2)
        for begin, end in zip(starts[:-1], starts[1:], strict=True):
            part = np.zeros(self.exact.shape)
            part[vec[begin:end], dim[begin:end]] = values[begin:end]
            rest = np.maximum(rest - (part * part).sum(1), 0)
            left = np.sqrt(rest) * (1 + 1e-9) if end < len(vec) else np.zeros(len(rest))
            self.segments.append((part.T.copy(), left))

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int):
        """(query, vector, score) triples that hold each query's k best."""
        width = max(queries.shape[1], self.exact.shape[1])
        fill = lambda m: np.pad(m, ((0, 0), (0, width - m.shape[1])))
        if self.large or queries.dtype == object:
            limit = (1 << 63) - 1
            scores = fill(queries.astype(object)) @ fill(self.exact.astype(object)).T
            for q in range(len(ids)):
                own = [(-int(s), int(i)) for i, s in zip(self.ids, scores[q], strict=True) if i != ids[q]]
                for score, vec_id in sorted(own)[:k]:
                    yield q, vec_id, min(max(-score, -limit), limit)
            return
        narrow = queries[:, : self.exact.shape[1]].astype(float)
        narrow = np.pad(narrow, ((0, 0), (0, self.exact.shape[1] - narrow.shape[1])))
        norms = np.sqrt((narrow * narrow).sum(1)) * (1 + 1e-9)
        same = ids[:, None] == self.ids[None, :]
        going, scores = np.arange(len(ids)), np.zeros((len(ids), len(self.ids)))
        members: list[np.ndarray | None] = [None] * len(ids)
        if not self.segments:
            members = [np.flatnonzero(~row) for row in same]
            going = going[:0]
        for number, (segment, left) in enumerate(self.segments):
            scores[going] += narrow[going] @ segment
            slack = norms[going, None] * left
            low = np.where(same[going], -np.inf, scores[going] - slack)
            if low.shape[1] > k:
                least = -np.partition(-low, k - 1, axis=1)[:, k - 1]
            else:
                least = np.full(len(going), -np.inf)
            can = (scores[going] + slack >= least[:, None]) & ~same[going]
            done = (can.sum(1) <= FEW * k) | (number == len(self.segments) - 1)
            for q, possible in zip(going[done], can[done], strict=True):
                members[q] = np.flatnonzero(possible)
            going = going[~done]
            if not len(going):
                break
        for q, possible in enumerate(members):
            exact = self.exact[possible] @ narrow[q].astype(np.int64)
            best = np.lexsort((self.ids[possible], -exact))[:k]
            for at in best:
                yield q, int(self.ids[possible[at]]), int(exact[at])


def search(index: DataFrame, queries: DataFrame, k: int = 20, per_block: int = QUERIES_PER_BLOCK) -> DataFrame:
    """Each query's k best: query_id, rank from 1, vec_id, score; all, if there are fewer.

    queries: vec_id and values, as ``usable`` gives them. Rows of the index with
    the query's id are its own and left out; queries that agree in id and values
    count once, and of those that agree in the id alone each has its own ranks.
    Ties go to the smaller vec_id; repeated rows are candidates each for itself.
    Vectors of different lengths are compared as if filled up with zeros. Scores
    beyond a long are returned as the nearest long. Without queries or vectors
    there are no rows.
    """
    queries = queries.distinct()
    groups = max(1, -(-queries.count() // per_block))

    def packed(table: pa.Table) -> pa.Table:
        return pa.table(
            {
                "ids": pa.array([table["vec_id"].to_pylist()], pa.list_(pa.int64())),
                "keys": pa.array([table["key"].to_pylist()], pa.list_(pa.int64())),
                "values": pa.array([table["values"].to_pylist()], pa.list_(pa.list_(pa.float64()))),
            }
        )

    key = F.xxhash64("vec_id", "values")
    keyed = queries.select(F.pmod(key, F.lit(groups)).alias("part"), "vec_id", key.alias("key"), "values")
    parts = keyed.groupBy("part").applyInArrow(packed, "ids array<long>, keys array<long>, values array<array<double>>")
    blocks = index.agg(F.max("block")).first()[0]
    blocks = -1 if blocks is None else blocks
    copies = parts.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(max(blocks, 0)))))

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                own = batch.slice(row, 1)
                named = {name: own.column(name)[0] for name in own.schema.names}
                block = Block({n: named[n].as_py() for n in ("ids", "dims", "impacts", "starts", "vecs", "at", "vals")})
                ids = np.array(named["query_ids"].as_py(), np.int64)
                keys = np.array(named["query_keys"].as_py(), np.int64)
                values = _matrix(named["query_values"].values)
                for begin in range(0, len(ids), QUERIES_AT_ONCE):
                    some = slice(begin, begin + QUERIES_AT_ONCE)
                    hits = list(block.search(ids[some], values[some], k))
                    at = np.array([h[0] for h in hits], np.int64) + begin
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[at]), pa.array(keys[at]), pa.array([h[1] for h in hits], pa.int64()),
                         pa.array([h[2] for h in hits], pa.int64())],
                        names=["query_id", "query_key", "vec_id", "score"],
                    )

    asked = copies.select(
        "block", F.col("ids").alias("query_ids"), F.col("keys").alias("query_keys"), F.col("values").alias("query_values")
    )
    hits = index.join(asked, "block").mapInArrow(run, HITS)
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, **columns) -> DataFrame:
    """``search`` of the rows of vectors for which is_query (over vec_id) holds, against all of them."""
    ready = usable(vectors, **columns)
    return search(build_index(ready), ready.where(is_query), k)
