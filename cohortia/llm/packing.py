"""Order-preserving packing of tokenised documents into fixed windows.

Each input split is one stream of documents in table order. Windows follow the
stream, so a window's end is the next one's start, and a dynamic program picks
the ends:

    cost(window) = padding + penalty of cutting where it ends
    best[j]      = min over i in [j - capacity, j) of best[i] + capacity - (j - i) + penalty[j]

``best[i] + i`` is kept in a monotone queue, so a transition costs amortised
constant time. Ends are the ends of documents (no penalty) and of sentences; a
sentence is cut inside only at a full window, at a higher penalty. The last
window of a split is cut into powers of two where that is cheaper, as windows of
such lengths need no padding.

Nothing is shuffled. A task holds one Arrow batch of texts and the tokens of
about ``LOOKAHEAD`` stream positions, so memory is bounded by the longest
document. Recomputing a lost task gives the same windows, as they depend on the
split alone.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Cost, in padding tokens, of a window that ends after a sentence, or inside one.
SENTENCE_CUT, INNER_CUT = 4, 16
#: Stream positions over which ends are chosen together.
LOOKAHEAD = 1 << 18
#: Windows that one split can hold; a window's id is the split's number times this plus its rank.
WINDOWS_PER_SPLIT = 1 << 40

#: Runs of white space from this length on are encoded by themselves, as the word pattern needs stack for each character.
LONG_BLANK = 4096
# Fixed value: the characters that the word pattern takes as white space.
BLANK = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def load_encoder(ranks_path: str, end_of_text: int):
    """The byte-level BPE whose ranks lie at ranks_path, and which ids end a sentence.

    Gives the ids of the ``tokenizers`` file of the same vocabulary, several
    times faster; tests compare the two over every code point.
    """
    import base64
    import re

    import tiktoken
    from public_tokenizers import PATTERN

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
    closing = np.zeros(max(max(ranks.values()), end_of_text) + 1, bool)
    for word, rank in ranks.items():
        closing[rank] = word[-1:] in (b".", b"!", b"?", b"\n")
    special = "<|endoftext|>"
    encoder = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={special: end_of_text})
    long_run = re.compile(f"[{BLANK}]{{{LONG_BLANK},}}")

    def encode(text: str) -> np.ndarray:
        """Ids of a text; the pattern takes a run of white space as one word, but for its last character before another."""
        parts, at = [], 0
        for run in long_run.finditer(text):
            last = run.end()
            end = last if last == len(text) or text.startswith(special, last) else last - 1
            parts.append(encoder.encode_to_numpy(text[at : run.start()], allowed_special="all"))
            parts.append(np.array(encoder._encode_single_piece(text[run.start() : end]), np.uint32))
            at = end
        rest = encoder.encode_to_numpy(text[at:], allowed_special="all")
        return np.concatenate([*parts, rest]) if parts else rest

    return encode, closing


def sentence_ends(ids: np.ndarray, closing: np.ndarray) -> np.ndarray:
    """Positions after a closing id that no further closing id follows."""
    last = closing[ids]
    last[:-1] &= ~last[1:]
    return np.flatnonzero(last) + 1


def window_ends(ends: list[int], penalties: list[int], capacity: int) -> list[int]:
    """The cheapest window ends up to ends[-1], which is always one of them.

    ends: increasing positions after 0 at which a window may end, with their
    penalties. Further ends are placed at full windows inside long sentences.
    """
    position, parent = [0], [-1]
    queue = deque([(0, 0, 0)])  # position, best + position, index of the state
    for j, penalty in zip(ends, penalties, strict=True):
        i, key, state = queue[0]
        while j - i > capacity:
            queue.popleft()
            full = i + capacity
            cut = key + capacity + INNER_CUT
            while queue and queue[-1][1] >= cut:
                queue.pop()
            queue.append((full, cut, len(position)))
            position.append(full)
            parent.append(state)
            i, key, state = queue[0]
        reached = key + capacity + penalty
        parent.append(state)
        while queue and queue[-1][1] >= reached:
            queue.pop()
        queue.append((j, reached, len(position)))
        position.append(j)
    chosen, state = [], len(position) - 1
    while state > 0:
        chosen.append(position[state])
        state = parent[state]
    return chosen[::-1]


def power_ends(start: int, end: int, capacity: int) -> list[int]:
    """Ends that cut a last window into powers of two, or just its end if padding it is cheaper."""
    length = end - start
    powers = [1 << k for k in range(length.bit_length()) if length >> k & 1][::-1]
    if length >= capacity or (len(powers) - 1) * INNER_CUT > capacity - length:
        return [end]
    return (start + np.cumsum(powers)).tolist()


class SplitPacker:
    """Packs one split's documents in their order."""

    def __init__(self, split: int, capacity: int, closing: np.ndarray):
        self.next_window, self.capacity, self.closing = split * WINDOWS_PER_SPLIT, capacity, closing
        self.docs, self.held = [], 0  # (doc_id, ids before, ids left, ids in all)

    def add(self, doc_id, ids: np.ndarray):
        self.docs.append((doc_id, 0, ids, len(ids)))
        self.held += len(ids)
        return self.held >= LOOKAHEAD

    def flush(self, last: bool) -> pa.RecordBatch | None:
        """Pieces of all windows but the newest, which stays open unless last."""
        if not self.docs:
            return None
        ids = np.concatenate([doc[2] for doc in self.docs])
        doc_ends = np.cumsum([len(doc[2]) for doc in self.docs])
        ends = np.union1d(sentence_ends(ids, self.closing), doc_ends)
        penalties = np.where(np.isin(ends, doc_ends), 0, SENTENCE_CUT)
        cuts = window_ends(ends.tolist(), penalties.tolist(), self.capacity)
        newest = cuts[-2] if len(cuts) > 1 else 0
        if last:
            cuts = cuts[:-1] + power_ends(newest, cuts[-1], self.capacity)
        elif newest:
            cuts = cuts[:-1]
        else:
            return None
        return self.pieces(ids, doc_ends, np.array(cuts, np.int64))

    def pieces(self, ids: np.ndarray, doc_ends: np.ndarray, cuts: np.ndarray) -> pa.RecordBatch:
        total = int(cuts[-1])
        begin = np.union1d(np.r_[0, cuts, doc_ends], [total])
        begin = begin[begin <= total]
        begin, end = begin[:-1], begin[1:]
        doc = np.searchsorted(doc_ends, begin, side="right")
        window = np.searchsorted(cuts, begin, side="right")
        doc_begin = np.r_[0, doc_ends[:-1]]
        before = np.array([d[1] for d in self.docs], np.int64)
        columns = [
            pa.array([self.docs[d][0] for d in doc.tolist()], pa.int64()),
            pa.array(before[doc] + begin - doc_begin[doc]),
            pa.array(end - begin),
            pa.array(np.array([d[3] for d in self.docs], np.int64)[doc]),
            pa.array(self.next_window + window),
            pa.array(begin - np.r_[0, cuts][window]),
            pa.Array.from_buffers(
                pa.binary(),
                len(begin),
                [None, pa.py_buffer((np.r_[begin, total] * 4).astype(np.int32)), pa.py_buffer(ids[:total].astype("<u4"))],
            ),
        ]
        self.next_window += len(cuts)
        kept = int(np.searchsorted(doc_ends, total, side="right"))
        rest = []
        for k in range(kept, len(self.docs)):
            doc_id, was, left, all_ids = self.docs[k]
            used = max(0, total - int(doc_begin[k]))
            rest.append((doc_id, was + used, left[used:], all_ids))
        self.docs, self.held = rest, len(ids) - total
        return pa.RecordBatch.from_arrays(
            columns, names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
        )


def pack(
    docs: DataFrame,
    ranks_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 1024,
    separator: int = 0,
    end_of_text: int = 50256,
) -> DataFrame:
    """Every document's ids, followed by ``separator``, cut into pieces of windows of at most capacity ids.

    ``ranks_path`` names the vocabulary's rank file on every executor. Returns a
    row per piece: doc_id, start (ids of its document before it), length,
    doc_tokens, sequence_id, offset (ids of the window before it) and ids
    (little-endian unsigned 32-bit). Other columns of docs are ignored, whatever
    their names.

    A null or empty text is the separator alone. A null id stays null. Rows that
    repeat an id, or a whole row, are packed each for itself. No rows give no
    pieces.
    """

    def run(batches):
        from pyspark import TaskContext

        encode, closing = load_encoder(ranks_path, end_of_text)
        packer = SplitPacker(TaskContext.get().partitionId(), capacity, closing)
        mark = np.array([separator], np.uint32)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                ids = np.concatenate([encode(text), mark]) if text else mark
                if packer.add(doc_id, ids):
                    pieces = packer.flush(last=False)
                    if pieces is not None:
                        yield pieces
        pieces = packer.flush(last=True)
        if pieces is not None:
            yield pieces

    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return narrow.mapInArrow(run, SCHEMA)
