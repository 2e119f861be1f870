"""Which stretches of texts repeat earlier ones, by messages between blocks and buckets.

Texts lie in blocks of a few megabytes, seeds (kept by winnowing) in buckets by
their hash. Every window of the given length keeps a seed, and equal windows
keep the same one at the same place, so what can repeat meets in a bucket.

1. A block sends each of its seeds with the hash of its context, that is all
   windows that keep it, and the smallest document id that has it. Equal contexts
   of a block are sent once, so a text copied a million times costs one message
   a block. Two short hashes go with them, of the seed with the half of a
   window's other symbols that lies before it, and of that behind it.
2. A bucket tells the blocks which contexts also occur with a smaller id: all
   their windows repeat. Of the contexts that are left, two of one seed can have
   a window in common only if one of their halves is equal, as a window reaches
   that far to one side at least; blocks are asked for these. Most seeds that
   texts share by chance, ever more in a larger corpus, have no such half.
3. The blocks send these contexts, and the bucket decides window by window; how,
   is what the operators on top differ in.
4. The blocks remove what the buckets named from their texts.

Texts are shuffled once, by block; the three steps that read them share that
exchange. A message holds numbers of a few bytes, not rows. Lost tasks are run
again from the shuffle; blocks put their texts in order first, so a rerun sends
the same messages.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortia.llm.sequences import (
    CODES,
    Stretches,
    Texts,
    Words,
    packed,
    packed_sorted,
    unpacked,
    unpacked_sorted,
    winnowed,
)

BLOCK_BYTES, BUCKET_BYTES = 1 << 21, 1 << 24
LAST = np.int64((1 << 63) - 1)
SEEDS = "bucket int, block int, seeds binary, contexts binary, halves binary, docs binary"
CODES_SENT = "block int, bucket int, codes binary"
ASKED = "bucket int, block int, seeds binary, docs binary, rows binary, places binary, payload binary"
SPANS = "block int, begins binary, ends binary"
COPY, EXTEND = 1, 2


@dataclass
class Block:
    """A block's texts in a fixed order, as a sequence of symbols."""

    table: pa.Table
    texts: Texts
    words: Words | None
    ids: np.ndarray  # by text; a null id comes after all others
    codes: np.ndarray  # by symbol
    offsets: np.ndarray  # by text, in symbols

    @classmethod
    def of(cls, table: pa.Table, by_word: bool) -> Block:
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")]).combine_chunks()
        texts = Texts(table["text"])
        ids = table["doc_id"].combine_chunks().fill_null(int(LAST)).to_numpy(zero_copy_only=False)
        if not by_word:
            return cls(table, texts, None, ids, CODES[texts.data], texts.offsets)
        words = Words(texts)
        return cls(table, texts, words, ids, words.codes(texts), words.offsets)


@dataclass
class Seeds:
    """A block's kept seeds in order of hash, context and place."""

    seed: np.ndarray  # 32 bits
    place: np.ndarray
    row: np.ndarray
    begin: np.ndarray  # of the context
    end: np.ndarray
    group: np.ndarray  # number of the seed and context
    first: np.ndarray  # by group, its first entry
    context: np.ndarray  # by group
    halves: np.ndarray  # by group, 16 bits for each side; 0 where no window reaches as far
    later: np.ndarray  # repeats an entry of its group
    stretches: Stretches


@dataclass(frozen=True)
class Finder:
    """window and seed count symbols; within: whether a window also repeats an earlier one of its own text."""

    window: int
    seed: int
    by_word: bool
    within: bool
    payload: Callable  # (block, seeds, entries) -> a row of bytes for each entry
    decide: Callable  # (Asked) -> (entries, first windows' shift from the context's begin)

    def seeds(self, block: Block) -> Seeds:
        lengths = np.diff(block.offsets)
        stretches = Stretches(block.codes)
        place, begin, last = winnowed(stretches, np.repeat(block.offsets[1:], lengths), self.window, self.seed)
        row, end = np.searchsorted(block.offsets, place, side="right") - 1, last + self.window
        seed = stretches(place, place + self.seed) >> np.uint64(32)
        shape = ((place - begin) << 32 | (end - place)).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        context = stretches(begin, end) ^ shape
        order = np.lexsort((place, context, seed))
        seed, context, place, row, begin, end = (x[order] for x in (seed, context, place, row, begin, end))
        new = np.ones(len(seed), bool)
        new[1:] = (seed[1:] != seed[:-1]) | (context[1:] != context[:-1])
        group = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        later = block.ids[row] > block.ids[row[first]][group] if len(row) else np.zeros(0, bool)
        if self.within:
            later[1:] |= ~new[1:] & (row[1:] == row[:-1])
        halves = self.halves(stretches, place[first], begin[first], end[first])
        return Seeds(seed, place, row, begin, end, group, first, context[first], halves, later, stretches)

    def halves(self, stretches: Stretches, place: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        reach = -(-(self.window - self.seed) // 2)
        left, right = np.maximum(begin, place - reach), np.minimum(end, place + self.seed + reach)
        short = lambda a, b: np.maximum(stretches(a, b) >> np.uint64(48), np.uint64(1)).astype(np.uint32)
        before = np.where(place - left == reach, short(left, place + self.seed), np.uint32(0))
        behind = np.where(right - place == self.seed + reach, short(place, right), np.uint32(0))
        return before << np.uint32(16) | behind

    def bucket_of(self, seed: np.ndarray, buckets: int) -> np.ndarray:
        return (seed * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _runs(values: np.ndarray):
    """(value, begin, end) of each run of equal values."""
    if len(values):
        cuts = np.flatnonzero(np.diff(values)) + 1
        for begin, end in zip(np.r_[0, cuts].tolist(), np.r_[cuts, len(values)].tolist(), strict=True):
            yield int(values[begin]), begin, end


def covered(n: int, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n symbols lie in a span."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, begins, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) > 0


def spans_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    return edges[::2], edges[1::2]


def spans_by_text(removed: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Removed runs, cut where a text ends."""
    begins, ends = spans_of(removed)
    inner = offsets[1:-1]
    inner = np.unique(inner[(inner > 0) & (inner < len(removed))])
    cut = inner[removed[inner] & removed[inner - 1]] if len(inner) else inner
    return np.sort(np.concatenate([begins, cut])), np.sort(np.concatenate([ends, cut]))


def span_lists(begins: np.ndarray, ends: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """For each text its removed runs, counted from its first symbol."""
    text = np.searchsorted(offsets, begins, side="right") - 1
    spans = pa.StructArray.from_arrays(
        [pa.array(begins - offsets[text], pa.int64()), pa.array(ends - offsets[text], pa.int64())], names=["begin", "end"]
    )
    first = np.searchsorted(text, np.arange(len(offsets)))
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), spans)


def _send_seeds(finder: Finder, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        block = Block.of(table, finder.by_word)
        found = finder.seeds(block)
        seed, ids = found.seed[found.first], block.ids[found.row[found.first]].view(np.uint64) ^ np.uint64(1 << 63)
        rows = [
            (bucket, packed_sorted(seed[a:b]), found.context[a:b].tobytes(), found.halves[a:b].tobytes(), packed(ids[a:b]))
            for bucket, a, b in _runs(finder.bucket_of(seed, buckets))
        ]
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        number = table["block"][0].as_py()
        return pa.table(
            [pa.array(columns[0], pa.int32()), pa.array([number] * len(rows), pa.int32()),
             *[pa.array(c, pa.binary()) for c in columns[1:]]],
            names=["bucket", "block", "seeds", "contexts", "halves", "docs"],
        )

    return run


def _in_several(seed: np.ndarray, half: np.ndarray) -> np.ndarray:
    """Which contexts, by the number of their seed, have a half that another context of the seed has."""
    order = np.lexsort((half, seed))
    seed, known = seed[order], half[order]
    equal = (seed[1:] == seed[:-1]) & (known[1:] == known[:-1]) & (known[1:] > 0)
    out = np.zeros(len(seed), bool)
    out[order[1:]] = equal
    out[order[:-1]] |= equal
    return out


def _judge_seeds(table: pa.Table) -> pa.Table:
    seeds = [unpacked_sorted(x.as_py()) for x in table["seeds"]]
    sizes = [len(x) for x in seeds]
    seed = np.concatenate(seeds)
    context = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in table["contexts"]])
    halves = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in table["halves"]])
    doc = np.concatenate([unpacked(x.as_py()) for x in table["docs"]])
    del seeds
    codes = np.zeros(len(seed), np.uint8)
    order = np.argsort(seed, kind="stable")
    ordered = seed[order]
    shared = np.zeros(len(seed), bool)
    equal = ordered[1:] == ordered[:-1]
    shared[1:] |= equal
    shared[:-1] |= equal
    order = order[shared]
    seed, context, doc = seed[order], context[order], doc[order]
    within = np.lexsort((doc, context, seed))
    order, seed, context, doc = order[within], seed[within], context[within], doc[within]
    halves = halves[order]
    if len(seed):
        new_seed = np.r_[True, seed[1:] != seed[:-1]]
        new = new_seed | np.r_[True, context[1:] != context[:-1]]
        group = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        of_seed, half = np.cumsum(new_seed)[first], halves[first]
        meets = _in_several(of_seed, half >> np.uint32(16)) | _in_several(of_seed, half & np.uint32(0xFFFF))
        code = np.where(doc > doc[first][group], COPY, np.where(meets[group], EXTEND, 0))
        codes[order] = code
    parts = np.split(codes, np.cumsum(sizes)[:-1])
    return pa.table(
        {"block": table["block"], "bucket": table["bucket"], "codes": pa.array([p.tobytes() for p in parts], pa.binary())}
    )


def _send_contexts(finder: Finder, buckets: int):
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block.of(texts, finder.by_word)
        number = texts["block"][0].as_py()
        found = finder.seeds(block)
        answers = answers.sort_by("bucket")
        told = np.frombuffer(b"".join(x.as_py() for x in answers["codes"]), np.uint8)
        code = told[found.group] if len(found.group) else np.zeros(0, np.uint8)
        copy = (found.later | (code == COPY)) & (found.end - found.begin >= finder.window)
        begins, ends = spans_of(covered(len(block.codes), found.begin[copy], found.end[copy]))
        rows = [(number % buckets, None, None, None, packed(begins), packed(ends))]
        asked = np.flatnonzero(~found.later & (code == EXTEND) & (found.end - found.begin >= finder.window))
        payload = finder.payload(block, found, asked)
        ids = block.ids[found.row[asked]].view(np.uint64) ^ np.uint64(1 << 63)
        for bucket, a, b in _runs(finder.bucket_of(found.seed[asked], buckets)):
            some = asked[a:b]
            rows.append(
                (bucket, packed_sorted(found.seed[some]), packed(ids[a:b]), packed(found.row[some]),
                 packed(found.begin[some]), payload[a:b].tobytes())
            )
        columns = list(zip(*rows, strict=True))
        return pa.table(
            [pa.array(columns[0], pa.int32()), pa.array([number] * len(rows), pa.int32()),
             *[pa.array(c, pa.binary()) for c in columns[1:]]],
            names=["bucket", "block", "seeds", "docs", "rows", "places", "payload"],
        )

    return run


@dataclass
class Asked:
    """Contexts that meet in a bucket; sender and row together tell texts apart."""

    seed: np.ndarray
    doc: np.ndarray
    sender: np.ndarray
    row: np.ndarray
    place: np.ndarray  # of the context's begin, in its block
    payload: np.ndarray


def _decide(finder: Finder):
    def run(table: pa.Table) -> pa.Table:
        done = table.filter(pc.is_null(table["seeds"]))
        open_ = table.filter(pc.is_valid(table["seeds"]))
        begins, ends = done["places"].to_pylist(), done["payload"].to_pylist()
        blocks = done["block"].to_pylist()
        if open_.num_rows:
            seeds = [unpacked_sorted(x.as_py()) for x in open_["seeds"]]
            sizes = [len(x) for x in seeds]
            number = {name: np.concatenate([unpacked(x.as_py()) for x in open_[name]]) for name in ("docs", "rows", "places")}
            payload = np.frombuffer(b"".join(x.as_py() for x in open_["payload"]), np.uint8).reshape(sum(sizes), -1)
            sender = np.repeat(np.array(open_["block"].to_pylist(), np.int64), sizes)
            entry, shift = finder.decide(
                Asked(np.concatenate(seeds), number["docs"], sender, number["rows"].astype(np.int64),
                      number["places"].astype(np.int64), payload)
            )
            begin = number["places"].astype(np.int64)[entry] + shift
            order = np.lexsort((begin, sender[entry]))
            begin, of = begin[order], sender[entry][order]
            for block, a, b in _runs(of):
                # windows that overlap or touch are one span
                apart = np.flatnonzero(np.diff(begin[a:b]) > finder.window)
                blocks.append(block)
                begins.append(packed(begin[a:b][np.r_[0, apart + 1]]))
                ends.append(packed(begin[a:b][np.r_[apart, b - a - 1]] + finder.window))
        return pa.table(
            {"block": pa.array(blocks, pa.int32()), "begins": pa.array(begins, pa.binary()), "ends": pa.array(ends, pa.binary())}
        )

    return run


def _finish(finder: Finder, output: Callable):
    def run(texts: pa.Table, spans: pa.Table) -> pa.Table:
        block = Block.of(texts, finder.by_word)
        gather = lambda name: np.concatenate(
            [np.zeros(0, np.uint64), *[unpacked(x.as_py()) for x in spans[name]]]
        ).astype(np.int64)
        kept = output(block, covered(len(block.codes), gather("begins"), gather("ends")))
        return kept.append_column("carried", block.table["carried"]) if "carried" in texts.schema.names else kept

    return run


def without_repeats(
    docs: DataFrame, id_col: str, text_col: str, finder: Finder, output: Callable, schema: str, carry: Sequence[str] = ()
) -> DataFrame:
    """output(block, removed symbols) of every block, with the columns of docs named by carry in a struct ``carried``."""
    rest = [F.struct(*[docs[f"`{c}`"] for c in carry]).alias("carried")] if carry else []
    docs = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"), *rest)
    if carry:
        schema += f", carried {docs.schema['carried'].dataType.simpleString()}"
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # a byte is a symbol of its own, a word is several
    parts = 1 if finder.by_word else 2
    # each block sends a message to each bucket: with smaller buckets their number outgrows the texts
    blocks, buckets = max(1, -(-size * parts // BLOCK_BYTES)), max(1, -(-size // BUCKET_BYTES))
    # by id alone: rows that repeat an id are compared inside their block
    blocked = docs.select(F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int").alias("block"), *docs.columns)
    seeds = blocked.groupBy("block").applyInArrow(_send_seeds(finder, buckets), SEEDS)
    codes = seeds.groupBy("bucket").applyInArrow(_judge_seeds, CODES_SENT)
    asked = blocked.groupBy("block").cogroup(codes.groupBy("block")).applyInArrow(_send_contexts(finder, buckets), ASKED)
    # a bucket's work is far more than its bytes, by which Spark would join tasks
    spans = asked.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_decide(finder), SPANS)
    return blocked.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(_finish(finder, output), schema)
