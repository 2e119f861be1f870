"""Documents drawn by how much their word runs look like a target's.

Features are all runs of one to three words, hashed by CRC-32 into buckets. A
document's weight is the sum over its features of the logarithm of how much more
often the target falls into the feature's bucket than the documents do; the
largest weights, jittered by Gumbel noise that depends on the id alone, are drawn
without replacement.

Hashing every run byte by byte would cost three times the text. The vocabulary is
split instead: the CRC states of frequent words, and those of frequent pairs,
which give the pairs' buckets and are continued by a third word, are broadcast.
They are found by exact keys, the words' bytes. Words of the tail take their CRC
from their bytes, pairs and triples from the states of their parts: a state is
carried over the bytes that follow by a table per length, as CRC-32 is linear. So
tables change the time and never a bucket.

Every word or pair with a share of at least ``1 / WORD_SHARE`` or ``1 / PAIR_SHARE``
of the corpus has that share in some chunk of it, so chunks pass on only their own
frequent ones, and at most ``HEAD_WORDS`` and ``HEAD_PAIRS`` are broadcast (8 MB).
Bucket totals are summed up per task before they are shuffled.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortia.llm.sequences import Texts, Words, mixed
from cohortia.session import staged

OUTER = np.ones(256, bool)
OUTER[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

#: Bytes that a state is carried over by table; longer words are read byte by byte.
FAR = 64
#: Entries of the broadcast tables, and slots that each entry may have.
HEAD_WORDS, HEAD_PAIRS, ROOM = 1 << 15, 1 << 16, 4
#: A word or pair of this share of the corpus is a candidate for the tables.
WORD_SHARE, PAIR_SHARE = 1 << 16, 1 << 18
#: Words of a chunk, text bytes worked on at once, and counts held before they are merged.
CHUNK_WORDS, SLICE_BYTES, HELD = 1 << 23, 1 << 21, 1 << 21

MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def byte_codes() -> np.ndarray:
    """What each byte adds to a CRC-32."""
    code = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        code = (code >> np.uint32(1)) ^ np.where(code & 1, np.uint32(0xEDB88320), np.uint32(0)).astype(np.uint32)
    return code


class Crc:
    """CRC-32 of many byte strings at once."""

    def __init__(self):
        self.codes = byte_codes()
        bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
        tables = np.zeros((FAR + 1, 4, 256), np.uint32)
        values = np.arange(256)
        for far in range(FAR + 1):
            for place in range(32):
                tables[far, place >> 3, values >> (place & 7) & 1 == 1] ^= bits[place]
            bits = self.codes[bits & np.uint32(255)] ^ (bits >> np.uint32(8))
        self.tables = tables.reshape(-1)
        space = np.full(FAR + 1, zlib.crc32(b" "), np.uint32)
        self.space = self.carried(space, np.arange(FAR + 1))

    def carried(self, states: np.ndarray, far: np.ndarray) -> np.ndarray:
        """States after as many further bytes, without what those bytes add; far is at most FAR."""
        at = far.astype(np.int64) << 10
        out = self.tables[at + (states & np.uint32(255))]
        for place in (1, 2, 3):
            at += 256
            out ^= self.tables[at + (states >> np.uint32(8 * place) & np.uint32(255))]
        return out

    def of(self, data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Codes of stretches of data, read byte by byte."""
        out = np.zeros(len(begin), np.uint32)
        order = np.argsort(-np.minimum(size, FAR + 1), kind="stable")
        long = int(np.count_nonzero(size > FAR))
        for k in order[:long].tolist():
            out[k] = zlib.crc32(data[begin[k] : begin[k] + size[k]])
        order = order[long:]
        place, ends = begin[order], size[order]
        state = np.full(len(order), 0xFFFFFFFF, np.uint32)
        left = len(order)
        for step in range(int(ends[0]) if left else 0):
            left = int(np.searchsorted(-ends, -step, side="left"))  # those longer than step
            now = state[:left]
            state[:left] = self.codes[(now ^ data[place[:left] + step]) & np.uint32(255)] ^ (now >> np.uint32(8))
        out[order] = ~state
        return out


class Table:
    """Values of two-part keys in two possible slots each; a key that finds both taken is left out."""

    def __init__(self, one: np.ndarray, two: np.ndarray, values: np.ndarray):
        n = 1 << (ROOM * max(len(one), 1) - 1).bit_length()
        self.one, self.two, self.values = np.zeros(n, np.uint64), np.zeros(n, np.uint64), np.zeros(n, np.uint32)
        rest = np.arange(len(one))
        taken = np.zeros(n, bool)
        for slots in self.slots(one, two):
            free = rest[~taken[slots[rest]]]
            _, first = np.unique(slots[free], return_index=True)
            put = free[first]
            at = slots[put]
            self.one[at], self.two[at], self.values[at], taken[at] = one[put], two[put], values[put], True
            rest = np.setdiff1d(rest, put)

    def slots(self, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        code = mixed(one ^ mixed(two))
        last = np.uint64(len(self.one) - 1)
        return (code & last).astype(np.int64), (code >> np.uint64(32) & last).astype(np.int64)

    def find(self, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are held, and their values."""
        slots, second = self.slots(one, two)
        here = (self.one[slots] == one) & (self.two[slots] == two)
        slots = np.where(here, slots, second)
        here |= (self.one[slots] == one) & (self.two[slots] == two)
        return here & (one != 0), self.values[slots]


class Tokens:
    """The words of a slice of texts: places, sizes, and the bytes of short ones as numbers."""

    def __init__(self, texts: pa.Array):
        self.texts = Texts(texts).lower_cased()
        words = Words(self.texts, OUTER)
        self.begin, self.size, self.offsets = words.begin, words.end - words.begin, words.offsets
        self.counts = np.diff(self.offsets)
        self.text_of = np.repeat(np.arange(len(self.counts)), self.counts)
        padded = np.concatenate([self.texts.data, np.zeros(16, np.uint8)])
        eight = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
        self.low = eight[self.begin] & MASK[np.minimum(self.size, 8)]
        self.high = eight[self.begin + 8] & MASK[np.clip(self.size - 8, 0, 8)]

    def followed(self, by: int) -> np.ndarray:
        """Words that so many more words of their text follow."""
        n = max(len(self.begin) - by, 0)
        return np.flatnonzero(self.text_of[:n] == self.text_of[by:][:n])

    def short_pairs(self) -> np.ndarray:
        """Words that are followed by one, both of at most 8 bytes."""
        first = self.followed(1)
        return first[(self.size[first] <= 8) & (self.size[first + 1] <= 8)]


def sliced(texts: pa.Array):
    """Ranges of texts of about SLICE_BYTES, or one longer text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    before = np.concatenate([[0], np.cumsum(sizes)])
    at = 0
    while at < len(texts):
        end = max(int(np.searchsorted(before, before[at] + SLICE_BYTES, side="right")) - 1, at + 1)
        yield at, end
        at = end


class Counts:
    """Counts of two-part keys; only those of a share leave."""

    def __init__(self, share: int):
        self.share, self.total, self.held, self.parts = share, 0, 0, []

    def add(self, one: np.ndarray, two: np.ndarray):
        self.total += len(one)
        self.put(one, two, np.ones(len(one), np.int64))

    def put(self, one, two, n):
        # keys of equal hash only share a count, which decides on a place in a table
        _, first, same = np.unique(mixed(one ^ mixed(two)), return_index=True, return_inverse=True)
        self.parts.append((one[first], two[first], np.bincount(same, n, len(first)).astype(np.int64)))
        self.held += len(first)
        if self.held > HELD and len(self.parts) > 1:
            self.merge()

    def merge(self):
        parts, self.parts, self.held = self.parts, [], 0
        if parts:
            self.put(*(np.concatenate(column) for column in zip(*parts, strict=True)))
            self.held = 0

    def frequent(self, kind: int) -> pa.RecordBatch:
        self.merge()
        one, two, n = self.parts[0] if self.parts else (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
        keep = n * self.share >= self.total
        self.__init__(self.share)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(int(keep.sum()), kind, np.int32)), pa.array(one[keep].view(np.int64)),
             pa.array(two[keep].view(np.int64)), pa.array(n[keep])],
            names=["kind", "one", "two", "n"],
        )


def _frequent(batches):
    """Frequent words (kind 0) and pairs (kind 1) of each chunk of a task's texts."""
    words, pairs = Counts(WORD_SHARE), Counts(PAIR_SHARE)
    for batch in batches:
        texts = batch.column(0)
        for at, end in sliced(texts):
            tokens = Tokens(texts.slice(at, end - at))
            short = tokens.size <= 16
            words.add(tokens.low[short], tokens.high[short])
            first = tokens.short_pairs()
            pairs.add(tokens.low[first], tokens.low[first + 1])
            if words.total >= CHUNK_WORDS:
                yield words.frequent(0)
                yield pairs.frequent(1)
    yield words.frequent(0)
    yield pairs.frequent(1)


def vocabulary(texts: DataFrame) -> tuple[Table, Table]:
    """CRC states of the frequent words and pairs of the one text column."""
    counted = texts.mapInArrow(_frequent, "kind int, one long, two long, n long")
    counted = staged(counted.groupBy("kind", "one", "two").agg(F.sum("n").alias("n")), "frequent")

    def spelled(*parts: int) -> bytes:
        return b"".join((part & (2**64 - 1)).to_bytes(8, "little") for part in parts).rstrip(b"\0")

    def table(kind: int, most: int, code) -> Table:
        rows = counted.where(F.col("kind") == kind).orderBy(F.desc("n"), "one", "two").limit(most)
        rows = [(r.one, r.two) for r in rows.select("one", "two").collect()]
        keys = np.array(rows, np.int64).reshape(-1, 2).view(np.uint64)
        return Table(keys[:, 0], keys[:, 1], np.array([code(*row) for row in rows], np.uint32))

    return (
        table(0, HEAD_WORDS, lambda one, two: zlib.crc32(spelled(one, two))),
        table(1, HEAD_PAIRS, lambda one, two: zlib.crc32(spelled(one) + b" " + spelled(two))),
    )


class Hasher:
    """Buckets of all runs of one to three words."""

    def __init__(self, words: Table, pairs: Table, buckets: int):
        self.words, self.pairs, self.buckets, self.crc = words, pairs, np.uint32(buckets), Crc()

    def __call__(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """Bucket and text of every run."""
        crc, data, size = self.crc, tokens.texts.data, tokens.size
        known, single = self.words.find(tokens.low, tokens.high)
        known &= size <= 16
        tail = np.flatnonzero(~known)
        single[tail] = crc.of(data, tokens.begin[tail], size[tail])

        short = size < FAR
        after = crc.space[np.minimum(size, FAR)] ^ single  # of a space and the word

        def extended(states: np.ndarray, by: np.ndarray) -> np.ndarray:
            """States of runs after a space and one more word."""
            fits = short[by]
            out = crc.carried(states, np.where(fits, size[by] + 1, 0)) ^ after[by]
            for k in np.flatnonzero(~fits).tolist():
                begin = tokens.begin[by[k]]
                out[k] = zlib.crc32(data[begin : begin + size[by[k]]], zlib.crc32(b" ", int(states[k])))
            return out

        first = tokens.followed(1)
        double = np.zeros(len(single), np.uint32)
        brief = tokens.short_pairs()
        held, states = self.pairs.find(tokens.low[brief], tokens.low[brief + 1])
        frequent = np.zeros(len(single), bool)
        frequent[brief[held]] = True
        double[brief[held]] = states[held]
        rest = first[~frequent[first]]
        double[rest] = extended(single[rest], rest + 1)
        start = tokens.followed(2)
        triple = extended(double[start], start + 2)
        codes = np.concatenate([single, double[first], triple])
        of = np.concatenate([tokens.text_of, tokens.text_of[first], tokens.text_of[start]])
        return codes % self.buckets, of


def bucket_totals(texts: DataFrame, tables, buckets: int) -> np.ndarray:
    """How many runs of the one text column fall into each bucket."""

    def run(batches):
        hasher = Hasher(*tables, buckets)
        totals = np.zeros(buckets, np.int64)
        for batch in batches:
            for at, end in sliced(batch.column(0)):
                found, _ = hasher(Tokens(batch.column(0).slice(at, end - at)))
                totals += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(totals[some])], names=["bucket", "n"])

    counted = texts.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    totals = np.zeros(buckets, np.int64)
    for bucket, n in counted.collect():  # one row a bucket
        totals[bucket] = n
    return totals


def bucket_gains(docs: np.ndarray, target: np.ndarray, scale: int = 1000) -> np.ndarray:
    """Scaled logarithm of each bucket's smoothed share in the target over that in the documents, rounded down."""
    over, under = float(docs.sum() + len(docs)), float(target.sum() + len(target))
    return np.array(
        [
            math.floor(scale * math.log((float(t + 1) * over) / (float(s + 1) * under)))
            for s, t in zip(docs.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def document_weights(docs: DataFrame, tables, gains: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight, the sum of the gains of a document's runs."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        hasher = Hasher(*tables, len(gains))
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for at, end in sliced(texts):
                tokens = Tokens(texts.slice(at, end - at))
                found, of = hasher(tokens)
                n = len(tokens.counts)
                weight = np.bincount(of, gains[found], n).astype(np.int64)  # whole numbers far below 2 ** 53
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, end - at), pa.array(tokens.counts.astype(np.int64)),
                     pa.array(np.bincount(of, minlength=n).astype(np.int64)), pa.array(weight)],
                    names=["doc_id", "n_words", "n_features", "weight"],
                )

    return docs.mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")


def jitter(id_col: Column, seed: int, scale: int = 1000) -> Column:
    """Scaled Gumbel noise from the id's hash, rounded down; a null id counts as an empty one."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256), 1, 8)
    share = (F.conv(digits, 16, 10).cast("long") + 0.5) / F.lit(4294967296.0)
    return F.floor(-scale * F.log(-F.log(share))).cast("long")


def _ranked(scored: DataFrame, percent: int) -> DataFrame:
    """Add rank to the rows drawn from those of which ``able`` is true.

    Rows are dealt out by range and sorted; a row's place is its partition and its
    rank there, both fixed in the written table, so only a row per partition is
    summed up.
    """
    order = [F.desc("able"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("salt")]
    salted = scored.withColumn("salt", F.rand(0))  # equal rows need not stay together
    placed = salted.repartitionByRange(*order).sortWithinPartitions(*order).drop("salt")
    placed = staged(placed.withColumn("place", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("place", 33).alias("part")
    parts = placed.groupBy(part).agg(F.count(F.lit(1)).alias("n"), F.count_if("able").alias("n_able"))
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n_able").over(whole).alias("n_able")
    )
    drawn = F.expr(f"({int(percent)} * n_able) div 100")
    rank = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    ranked = placed.withColumn("part", part).join(parts, "part").withColumn("rank", rank)
    return ranked.withColumn("rank", F.when(F.col("able") & (F.col("rank") <= drawn), F.col("rank")).cast("long"))


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
    percent: int = 5, min_words: int = 20, buckets: int = 10_000, seed: int = 42,
) -> DataFrame:
    """Every document's likeness to the target, and the rank of those drawn.

    Returns doc_id, n_words, n_features, weight, score and rank: 1, 2, 3... of the
    documents drawn, ``percent`` of those of at least min_words words, by falling
    score and rising id; null for all others. Other columns are ignored, whatever
    their names.

    Words are runs of a-z, 0-9 and code points from U+0080 after A-Z is put in lower
    case. A null or empty text has no features and weight 0. A null id is hashed
    as an empty one and comes last among ties; of rows that repeat an id and a text
    each is drawn for itself. An empty target has gains all the same, from the
    smoothing. No rows give no rows.
    """
    docs = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    target = target.select(target[target_text_col].cast("string").alias("text"))
    tables = vocabulary(docs.select("text"))
    gains = bucket_gains(bucket_totals(docs.select("text"), tables, buckets), bucket_totals(target, tables, buckets))
    weighed = document_weights(docs, tables, gains)
    scored = weighed.withColumn("score", F.col("weight") + jitter(F.col("doc_id"), seed))
    scored = staged(scored.withColumn("able", F.col("n_words") >= min_words), "scored")
    return _ranked(scored, percent).select("doc_id", "n_words", "n_features", "weight", "score", "rank")
