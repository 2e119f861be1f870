"""Byte deduplication over suffix arrays built by two-stage sorting.

Stage one sorts only the suffixes that are smaller than their successor. Stage
two induces the others: a scan over the buckets of first bytes, from the smallest
on, puts each predecessor that is larger than its successor at the front of its
own bucket. Common prefixes of neighbours in that order then show which windows
are equal.

A suffix array of a whole corpus fits no machine, so arrays are built where
equal windows are known to meet: ``repeats`` brings together the surroundings of
shared seeds, one for each distinct text, and every bucket sorts the suffixes of
its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cohortia.llm.repeats import Asked, Block, Finder, Seeds, span_lists, spans_by_text, without_repeats

SCHEMA = "doc_id long, n_bytes long, n_removed long, spans array<struct<begin:long,end:long>>, kept binary"
#: Ends a context; no byte of UTF-8.
END = 0xFF
#: Contexts that one array takes, and all others of its last seed.
CONTEXTS = 1 << 13


def smaller_than_successor(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the one that starts a byte later; the last one is not."""
    n = len(text)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1])
    step[-1:] = -1
    decided = np.where(step != 0, np.arange(n), n)
    nearest = np.minimum.accumulate(decided[::-1])[::-1]
    return step[nearest] > 0


def sort_directly(text: np.ndarray, suffixes: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes in order of their first depth bytes."""
    filled = np.concatenate([text, np.zeros(depth + 8, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(filled, 8)
    word_at = lambda at: np.ascontiguousarray(words[at]).view(">u8")[:, 0].astype(np.uint64)
    order = suffixes[np.argsort(word_at(suffixes), kind="stable")]
    first = word_at(order)
    new = np.r_[True, first[1:] != first[:-1]]
    for at in range(8, depth, 8):
        tied = ~new
        tied[:-1] |= ~new[1:]
        where = np.flatnonzero(tied)
        if not len(where):
            break
        some, group = order[where], np.cumsum(new)[where]
        word = word_at(np.minimum(some + at, len(text)))
        within = np.lexsort((word, group))
        order[where] = some[within]
        word, group = word[within], group[within]
        new[where] = np.r_[True, (word[1:] != word[:-1]) | (group[1:] != group[:-1])]
    return order


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes in order of their first depth bytes."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    small = smaller_than_successor(text)
    direct = sort_directly(text, np.flatnonzero(small), depth)
    edges = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[-1]].append(np.array([n - 1]))
    order = []

    def induce(scanned: np.ndarray, byte: int) -> None:
        before = scanned[scanned > 0] - 1
        before = before[~small[before]]
        bytes_ = text[before]
        by_byte = np.argsort(bytes_, kind="stable")
        before, bytes_ = before[by_byte], bytes_[by_byte]
        cuts = np.flatnonzero(np.diff(bytes_)) + 1
        for part in np.split(before, cuts):
            if len(part):
                waiting[text[part[0]]].append(part)

    for byte in range(256):
        while waiting[byte]:  # grows by runs of this byte
            scanned = np.concatenate(waiting[byte])
            waiting[byte] = []
            order.append(scanned)
            induce(scanned, byte)
        scanned = direct[edges[byte] : edges[byte + 1]]
        if len(scanned):
            order.append(scanned)
            induce(scanned, byte)
    return np.concatenate(order)


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Bytes, up to depth, that each suffix shares with the one before it in the order; 0 for the first."""
    shared = np.zeros(len(order), np.int64)
    same = np.arange(1, len(order))
    for at in range(depth):
        a, b = order[same] + at, order[same - 1] + at
        inside = np.maximum(a, b) < len(text)
        same, a, b = same[inside], a[inside], b[inside]
        same = same[text[a] == text[b]]
        if not len(same):
            break
        shared[same] += 1
    return shared


def _contexts(window: int, seed: int):
    width = 2 * window - seed + 1

    def run(block: Block, found: Seeds, entries: np.ndarray) -> np.ndarray:
        at = found.begin[entries][:, None] + np.arange(width)
        inside = at < found.end[entries][:, None]
        out = np.full(at.shape, END, np.uint8)
        out[inside] = block.texts.data[at[inside]]
        return out

    return run


def _in_smaller(window: int):
    """Windows that a suffix array finds in a smaller document too."""

    def decide(contexts: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = (contexts != END).sum(1)
        text = contexts[np.arange(contexts.shape[1]) <= lengths[:, None]]  # one END each
        starts = np.concatenate([[0], np.cumsum(lengths + 1)])
        context = np.repeat(np.arange(len(contexts)), lengths + 1)
        order = suffix_order(text, window)
        # a window ends before its context does
        order = order[order + window < starts[1:][context[order]]]
        doc = docs[context[order]]
        new = common_prefixes(text, order, window) < window
        new[:1] = True
        if len(order):
            smallest = np.minimum.reduceat(doc, np.flatnonzero(new))[np.cumsum(new) - 1]
            order = order[doc > smallest]
        return context[order], order - starts[context[order]]

    def run(asked: Asked) -> tuple[np.ndarray, np.ndarray]:
        by_seed = np.argsort(asked.seed, kind="stable")
        seed = asked.seed[by_seed]
        starts = np.flatnonzero(np.concatenate([[True], seed[1:] != seed[:-1]]))
        # equal windows share a seed, so arrays over whole seeds find them all
        cuts = np.unique(np.concatenate([starts[np.searchsorted(starts, np.arange(0, starts[-1] + 1, CONTEXTS))], [len(seed)]]))
        entries, shifts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for begin, end in zip(np.r_[0, cuts[cuts > 0]][:-1], cuts[cuts > 0], strict=True):
            some = by_seed[begin:end]
            entry, shift = decide(asked.payload[some], asked.doc[some])
            entries.append(some[entry])
            shifts.append(shift)
        return np.concatenate(entries), np.concatenate(shifts)

    return run


def _kept_bytes(block: Block, removed: np.ndarray) -> pa.Table:
    counts = np.concatenate([[0], np.cumsum(removed)])
    begins, ends = spans_by_text(removed, block.offsets)
    kept = (block.offsets - counts[block.offsets]).astype(np.int32)
    data = block.texts.data[~removed]
    return pa.table(
        {
            "doc_id": block.table["doc_id"],
            "n_bytes": pa.array(np.diff(block.offsets)),
            "n_removed": pa.array(np.diff(counts[block.offsets])),
            "spans": span_lists(begins, ends, block.offsets),
            "kept": pa.Array.from_buffers(
                pa.binary(), len(block.texts), [None, pa.py_buffer(kept), pa.py_buffer(data)]
            ),
        }
    )


def remove_repeated_bytes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, seed: int = 16
) -> DataFrame:
    """Each document's UTF-8 without the bytes of windows that start in a smaller document too.

    Windows have ``window`` bytes, lie in one document and are judged on the
    texts as given. Returns doc_id, n_bytes, n_removed, spans (maximal removed
    runs of bytes, from 0) and kept (the other bytes).

    A null text is empty. A null id comes after all others. Rows that repeat an
    id are documents of their own, neither smaller than the other. Other columns
    are ignored, whatever their names; no rows give no rows.
    """
    finder = Finder(window, seed, False, False, _contexts(window, seed), _in_smaller(window))
    return without_repeats(docs, id_col, text_col, finder, _kept_bytes, SCHEMA)
