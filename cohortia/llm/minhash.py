"""Near-duplicate documents by MinHash with tensored banding.

Keys of a hash table need several minhashes of their own, and high recall needs
many tables. Tensoring takes two small collections of short minhash tuples and
forms a table for every pair of one tuple from each, so the square of ``tuples``
tables cost two times ``tuples`` tuples. A pair of similarity s meets in some
table unless it misses a whole collection: with tuples of two minhashes, 8 at
0.85 or 10 at 0.8 in either, in all but 7 of 100,000 cases.

Documents of equal shingle sets are one node, however many there are. In each
table the nodes of a bucket are paired with one of them; pairs whose minhashes
differ widely are left out, and what remains connected is a cluster. Inside a
cluster all shingle sets are compared in full, chunk by chunk, and linked where
they are similar enough, so no bucket's size limits what is compared. Components
of the links are the result.

No step emits pairs of a bucket or cluster: a bucket gives a row per member, and
a comparison of two chunks at most an edge per member.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortia.llm.graphs import components
from cohortia.llm.sequences import Texts, Words, mixed
from cohortia.session import staged

TUPLE = 2
#: Minhashes that give two bits each, and the differing bits beyond which a pair is not followed: sets that share about half.
SKETCH, FAR_BITS = 32, 19
#: Sets, and shingles, that a chunk of a cluster has on average at most.
CHUNK, CHUNK_SHINGLES = 1024, 1 << 19
SLICE_BYTES = 1 << 21
COLUMNS = 1 << 12

SIGNED = "doc_id long, text_key long, n_shingles long, node binary, left_keys array<long>, right_keys array<long>, bits long"


def shingle_sets(texts: Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and the offsets of the texts in them."""
    texts = texts.lower_cased()
    words = Words(texts)
    codes, offsets = words.codes(texts), words.offsets
    n = np.diff(offsets)
    rolled = np.zeros(len(codes), np.uint64)
    for k in range(size):  # hash of the words from here on, as many as there are
        part = np.zeros(len(codes), np.uint64)
        part[: len(codes) - k] = codes[k:]
        inside = np.arange(len(codes)) + k < np.repeat(offsets[1:], n)
        rolled = np.where(inside, mixed(rolled * np.uint64(0x9E3779B97F4A7C15) + part + np.uint64(k + 1)), rolled)
    sets = []
    for begin, count in zip(offsets[:-1].tolist(), n.tolist(), strict=True):
        own = np.sort(rolled[begin : begin + (max(count - size + 1, 1) if count else 0)])
        if len(own) > 1:
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        sets.append(own)
    ends = np.cumsum([0, *map(len, sets)])
    return (np.concatenate(sets) if sets else rolled[:0]), ends


def _slices(batch: pa.RecordBatch):
    """Parts of a batch of about SLICE_BYTES of text, or one text."""
    sizes = np.array(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
    part = np.cumsum(sizes) // SLICE_BYTES
    cuts = np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(sizes)]
    for begin, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if end > begin:
            yield batch.slice(begin, end - begin)


def _node_keys(flat: np.ndarray, offsets: np.ndarray) -> list[bytes | None]:
    """128 bits that tell a set from others; none for an empty set."""
    total = lambda x: np.diff(np.concatenate([[np.uint64(0)], np.cumsum(x)])[offsets])
    key = np.stack([total(mixed(flat)), total(mixed(flat ^ np.uint64(0x5851F42D4C957F2D)))], 1)
    return [row.tobytes() if n else None for row, n in zip(key, np.diff(offsets), strict=True)]


def _signed(size: int, tuples: int, seed: int):
    rng = np.random.default_rng(seed)
    hashes = 2 * tuples * TUPLE
    factors = rng.integers(1, 1 << 63, hashes, np.uint64) | np.uint64(1)
    salts = rng.integers(1, 1 << 63, hashes, np.uint64)

    def run(batches):
        for batch in batches:
            for part in _slices(batch):
                flat, offsets = shingle_sets(Texts(part.column(1)), size)
                counts = np.diff(offsets)
                some = np.flatnonzero(counts)
                least = np.zeros((hashes, len(counts)), np.uint64)
                if len(some):
                    for k in range(hashes):
                        least[k, some] = np.minimum.reduceat((flat ^ salts[k]) * factors[k], offsets[some])
                keys = np.zeros((2 * tuples, len(counts)), np.uint64)
                for k in range(hashes):
                    keys[k // TUPLE] = mixed(keys[k // TUPLE] * np.uint64(31) + least[k] + np.uint64(k))
                bits = np.zeros(len(counts), np.uint64)
                for k in range(min(hashes, SKETCH)):
                    bits |= (mixed(least[k]) & np.uint64(3)) << np.uint64(2 * k)
                starts = pa.array(np.arange(len(counts) + 1) * tuples, pa.int32())
                lists = lambda m: pa.ListArray.from_arrays(starts, pa.array(m.T.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(counts), pa.array(_node_keys(flat, offsets), pa.binary()),
                     lists(keys[:tuples]), lists(keys[tuples:]), pa.array(bits.view(np.int64))],
                    names=["doc_id", "text_key", "n_shingles", "node", "left_keys", "right_keys", "bits"],
                )

    return run


def _clusters(nodes: DataFrame) -> DataFrame:
    """member and root of the nodes that some table pairs with a node that is not far off.

    A member is a node's hash: should two nodes share one, they come into the
    same cluster, where sets alone decide.
    """
    tables = (
        nodes.select("member", "bits", F.posexplode("left_keys").alias("i", "left"), "right_keys")
        .select("member", "bits", "i", "left", F.posexplode("right_keys").alias("j", "right"))
        .select(F.xxhash64("i", "j", "left", "right").alias("key"), "member", "bits")
    )
    # Spark sizes exploded rows as if there were one for each node, and would collect them for a broadcast
    buckets = tables.groupBy("key").agg(F.min("member").alias("centre"), F.max("member").alias("most"))
    centres = buckets.where("centre <> most").select("key", "centre").hint("merge").join(
        nodes.select(F.col("member").alias("centre"), F.col("bits").alias("centre_bits")), "centre"
    )
    near = F.bit_count(F.col("bits").bitwiseXOR(F.col("centre_bits"))) <= FAR_BITS
    edges = tables.hint("merge").join(centres, "key").where(near & (F.col("member") != F.col("centre")))
    # a member's centres, one a table at most, are tied to the least of them, so that many members share these edges
    tied = edges.groupBy("member").agg(F.collect_set("centre").alias("all")).withColumn("a", F.array_min("all"))
    between = tied.select("a", F.explode("all").alias("b")).where("a <> b").distinct()
    return components(tied.select("a", F.col("member").alias("b")).unionByName(between)).withColumnRenamed("node", "member")


def _forest(sets: list[np.ndarray], left: int, percent: int) -> list[tuple[int, int]]:
    """Edges that connect what links of percent similarity connect.

    The first ``left`` sets are compared with the others, or, if left is 0, all with each other.
    """
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate([[True], flat[1:] != flat[:-1]])
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1  # what one set alone has is in no intersection
    owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
    rows = slice(0, left or len(sets))
    others = slice(left, len(sets))
    common = np.zeros((rows.stop, len(sets) - left), np.float32)
    cuts = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else 0) + COLUMNS + 1, COLUMNS))
    for begin, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if end > begin:
            has = np.zeros((len(sets), COLUMNS), np.float32)
            has[owner[begin:end], column[begin:end] - column[begin] // COLUMNS * COLUMNS] = 1
            common += has[rows] @ has[others].T
    together = sizes[rows, None] + sizes[None, others] - common
    a, b = np.nonzero(100 * common >= percent * together)
    b = b + left
    a, b = a[a != b], b[a != b]
    root = np.arange(len(sets))
    while True:
        least = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        root = root[root]
        if (root == before).all():
            break
    linked = np.flatnonzero(root != np.arange(len(sets)))
    return list(zip(root[linked].tolist(), linked.tolist(), strict=True))


def _compare(percent: int):
    """Links of each (root, i, j) group, whose rows lie together: node, chunk and set."""

    def groups(batches):
        key, rows = None, []
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(4)]
            for row, now in enumerate(zip(*columns[:3], strict=True)):
                if now != key:
                    if rows:
                        yield key, rows
                    key, rows = now, []
                rows.append((columns[3][row], batch.column(4)[row].as_py(), np.frombuffer(batch.column(5)[row].as_py(), np.uint64)))
        if rows:
            yield key, rows

    def run(batches):
        for (_, i, j), rows in groups(batches):
            rows.sort(key=lambda row: (row[1] != i, row[0]))
            left = sum(row[1] == i for row in rows) if i != j else 0
            if len(rows) < 2 or i != j and left in (0, len(rows)):
                continue
            edges = _forest([row[2] for row in rows], left, percent)
            if edges:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([rows[a][0] for a, _ in edges], pa.binary()), pa.array([rows[b][0] for _, b in edges], pa.binary())],
                    names=["a", "b"],
                )

    return run


def _sets(size: int):
    """node and its shingles, from the rows whose text has that set."""

    def run(batches):
        for batch in batches:
            for part in _slices(batch):
                flat, offsets = shingle_sets(Texts(part.column(1)), size)
                same = [x == y for x, y in zip(_node_keys(flat, offsets), part.column(0).to_pylist(), strict=True)]
                sets = [flat[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                whole = pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], names=["node", "shingles"])
                yield whole.filter(pa.array(same, pa.bool_()))

    return run


def near_duplicates(
    docs: DataFrame, id_col="doc_id", text_col="text", shingle: int = 5, percent: int = 80, tuples: int = 10, seed: int = 1
) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest doc_id of the documents it is linked with, over others too.

    Words are what white space separates, with A-Z in lower case; a document's
    set holds its runs of ``shingle`` words, or all its words where it has fewer.
    Documents are linked if their sets' intersection has at least percent of
    their union.

    A document without words, or with a null text, has an empty set and is alone.
    A null id counts after all others; a component of null ids has a null
    component_id. Rows that repeat an id are documents of their own. Other
    columns are ignored, whatever their names; no rows give no rows.
    """
    return _grouped(docs, id_col, text_col, shingle, percent, tuples, seed).select("doc_id", "n_shingles", "component_id")


def _grouped(docs: DataFrame, id_col, text_col, shingle=5, percent=80, tuples=10, seed=1) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id and root, a node of the component; root is null for empty sets."""
    text = docs[text_col].cast("string")
    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    signed = staged(narrow.mapInArrow(_signed(shingle, tuples, seed), SIGNED), "minhash")
    filled = signed.where("node is not null")
    nodes = filled.groupBy("node").agg(
        F.min("doc_id").alias("least_id"), F.min(F.struct("doc_id", "text_key")).alias("found"),
        F.first("n_shingles").alias("n_shingles"), F.first("left_keys").alias("left_keys"),
        F.first("right_keys").alias("right_keys"), F.first("bits").alias("bits"),
    ).withColumn("member", F.xxhash64("node"))
    nodes = staged(nodes, "nodes")

    clusters = staged(_clusters(nodes).join(nodes.select("member", "node", "found", "n_shingles"), "member"), "clusters")
    parts = F.ceil(F.greatest(F.count("*") / CHUNK, F.sum("n_shingles") / CHUNK_SHINGLES)).cast("int")
    of_size = clusters.groupBy("root").agg(parts.alias("chunks"))
    wanted = clusters.join(of_size, "root").select(
        "node", "root", "found.doc_id", "found.text_key", "chunks",
        F.pmod(F.xxhash64("node", F.lit(7)), F.col("chunks")).cast("int").alias("chunk"),
    )
    same_row = wanted["doc_id"].eqNullSafe(narrow["doc_id"]) & (wanted["text_key"] == narrow["text_key"])
    texts = narrow.join(wanted, same_row).select("node", "text")
    sets = texts.mapInArrow(_sets(shingle), "node binary, shingles binary").dropDuplicates(["node"])
    placed = (
        wanted.select("node", "root", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
        .join(sets, "node")
        .select("root", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "node", "chunk", "shingles")
    )
    ordered = placed.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")
    linked = components(ordered.mapInArrow(_compare(percent), "a binary, b binary"))

    root = F.coalesce("root", "node")
    of_node = nodes.select("node", "least_id").join(linked, "node", "left").select("node", "least_id", root.alias("root"))
    least = of_node.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_node = of_node.join(least, "root").select("node", "component_id", "root")
    found = filled.join(by_node, "node").select("doc_id", "text_key", "n_shingles", "component_id", "root")
    alone = signed.where("node is null").select(
        "doc_id", "text_key", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(None).cast("binary").alias("root")
    )
    return found.unionByName(alone)


def one_of_each(docs: DataFrame, id_col="doc_id", text_col="text", **how) -> DataFrame:
    """One row of each component, with its columns as they were.

    It is that of the smallest id, null ids last, and of these that of the
    smallest text hash; of rows equal in both that of the smallest hash of all its
    columns. Each row without words is a component and stays.
    """
    found = _grouped(docs, id_col, text_col, **how).where("root is not null")
    texts = found.groupBy("root", "doc_id", "text_key").agg(F.count("*").alias("n"))
    key = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    first = texts.groupBy(F.col("root").alias("first_root")).agg(F.min(key).alias("first"))
    marks = texts.join(first, F.col("root") == F.col("first_root")).select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), (key != F.col("first")).alias("_gone"), "n"
    ).where("_gone or n > 1")
    text_key = F.xxhash64(docs[text_col].cast("string"))
    same = docs[id_col].cast("long").eqNullSafe(marks["_id"]) & (text_key == marks["_key"])
    whole = F.struct(*[docs[f"`{c}`"] for c in docs.columns])
    repeated = docs.join(marks.where("not _gone"), same, "left_semi").groupBy(docs[id_col].cast("long"), text_key).agg(
        F.min_by(whole, F.xxhash64(F.to_json(whole))).alias("row")
    )
    return docs.join(marks, same, "left_anti").unionByName(repeated.select("row.*"))
