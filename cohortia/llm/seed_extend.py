"""Substring deduplication of word windows by seed and extend.

Seeds of a few words, kept by winnowing, join the documents that share them.
From a shared seed a match is extended to both sides, in all ways in which the
words to the left and right make up a window; a window that also starts earlier
is a repeat, and the union of a document's repeats are its maximal repeats over
the length threshold. ``repeats`` has the exchange that brings seeds together.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cohortia.llm.repeats import Asked, Block, Finder, Seeds, span_lists, spans_by_text, without_repeats
from cohortia.llm.sequences import cut_words, joined_words

SCHEMA = "doc_id long, n_words long, n_removed long, spans array<struct<begin:long,end:long>>, kept_text string"


def _extended(window: int, seed: int):
    """For each asked seed, the hash of every window that extends it, in order; 0 beyond the text."""

    def run(block: Block, found: Seeds, entries: np.ndarray) -> np.ndarray:
        left = found.begin[entries][:, None] + np.arange(window - seed + 1)
        fits = (left <= found.place[entries][:, None]) & (left + window <= found.end[entries][:, None])
        hashes = np.zeros(left.shape, np.uint64)
        hashes[fits] = found.stretches(left[fits], left[fits] + window) | np.uint64(1)
        return hashes.view(np.uint8)

    return run


def _earlier(asked: Asked) -> tuple[np.ndarray, np.ndarray]:
    """Windows that start earlier too: in a smaller document, or before in the same text."""
    hashes = asked.payload.view(np.uint64)
    entry, shift = np.nonzero(hashes)
    if not len(entry):
        return entry, shift
    window, doc = hashes[entry, shift], asked.doc[entry]
    sender, row, start = asked.sender[entry], asked.row[entry], asked.place[entry] + shift
    order = np.lexsort((start, row, sender, doc, window))
    window, doc, sender, row = window[order], doc[order], sender[order], row[order]
    new = np.r_[True, window[1:] != window[:-1]]
    smallest = doc[np.flatnonzero(new)][np.cumsum(new) - 1]
    earlier = doc > smallest
    earlier[1:] |= ~new[1:] & (sender[1:] == sender[:-1]) & (row[1:] == row[:-1]) & (np.diff(start[order]) > 0)
    return entry[order][earlier], shift[order][earlier]


def _kept_words(layout: bool):
    def run(block: Block, removed: np.ndarray) -> pa.Table:
        counts = np.concatenate([[0], np.cumsum(removed)])
        begins, ends = spans_by_text(removed, block.offsets)
        texts = (cut_words if layout else joined_words)(block.texts, block.words, ~removed)
        return pa.table(
            {
                "doc_id": block.table["doc_id"],
                "n_words": pa.array(np.diff(block.offsets)),
                "n_removed": pa.array(np.diff(counts[block.offsets])),
                "spans": span_lists(begins, ends, block.offsets),
                "kept_text": texts.cast(pa.string()),
            }
        )

    return run


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 20,
    seed: int = 6,
    layout: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Each document without the words of windows that start earlier too.

    A word is removed if a window of ``window`` words that covers it has the
    words of one that starts in a document of smaller id, or earlier in the same
    document. Windows are judged on the texts as given. Returns doc_id, n_words,
    n_removed, spans (removed runs of words, from 0), kept_text and, if ``carry``
    names columns, these in a struct ``carried``. kept_text has the other words
    joined by one space or, with ``layout``, the text as it was but for the runs.

    A null text has no words. A null id comes after all others. Rows that repeat
    an id are documents of their own, neither before the other. Other columns
    are ignored, whatever their names; no rows give no rows.
    """
    finder = Finder(window, seed, True, True, _extended(window, seed), _earlier)
    return without_repeats(docs, id_col, text_col, finder, _kept_words(layout), SCHEMA, carry)
