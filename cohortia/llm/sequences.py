"""Texts as sequences of bytes or words, with hashes of any stretch in constant time.

All functions work on many texts at once: the bytes of a block of texts lie in
one array, and offsets tell where each begins.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
CODES = np.random.default_rng(20240501).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Stretches:
    """Hashes of stretches of a sequence of 64-bit codes."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        powers = np.full(n, BASE, np.uint64)
        np.multiply.accumulate(powers, out=powers)
        powers *= codes
        self.sums = np.zeros(n + 1, np.uint64)
        np.add.accumulate(powers, out=self.sums[1:])
        powers[:] = INVERSE
        np.multiply.accumulate(powers, out=powers)
        self.inverse = powers

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of each [begin, end); begin lies inside the sequence."""
        raw = (self.sums[end] - self.sums[begin]) * self.inverse[begin]
        return mixed(raw + (end - begin).astype(np.uint64))

    def all_of(self, length: int) -> np.ndarray:
        """Hash of the stretch of this length at each place where one fits."""
        fit = max(len(self.inverse) - length + 1, 0)
        raw = (self.sums[length : length + fit] - self.sums[:fit]) * self.inverse[:fit]
        return mixed(raw + np.uint64(length))


class Texts:
    """The texts of an Arrow array: bytes, and each text's first byte and end. Null texts are empty."""

    def __init__(self, texts: pa.Array | pa.ChunkedArray):
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = texts.fill_null("")
        n = len(texts)
        if not n:
            self.offsets, self.data = np.zeros(1, np.int64), np.zeros(0, np.uint8)
            return
        kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        offsets = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + n + 1].astype(np.int64)
        data = texts.buffers()[2]
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.data = data[offsets[0] : offsets[-1]]
        self.offsets = offsets - offsets[0]

    def __len__(self):
        return len(self.offsets) - 1

    def lower_cased(self) -> Texts:
        """The same with A-Z in lower case."""
        out = object.__new__(Texts)
        upper = (self.data >= 0x41) & (self.data <= 0x5A)
        out.data, out.offsets = self.data | (upper.astype(np.uint8) << 5), self.offsets
        return out


class Words:
    """Words of texts: first byte and end of each, and which words each text has. outer marks the bytes between them."""

    def __init__(self, texts: Texts, outer: np.ndarray = SPACE):
        n = len(texts.data)
        inner = np.zeros(n + 1, bool)
        inner[:n] = ~outer[texts.data]
        begins = inner.copy()
        begins[1:] &= ~inner[:-1]
        starts = texts.offsets[:-1]
        starts = starts[starts < n]
        begins[starts] = inner[starts]
        self.begin = np.flatnonzero(begins)
        ends = inner[:-1] & (~inner[1:] | begins[1:])
        self.end = np.flatnonzero(ends) + 1
        # a text that ends in a word ends that word, even if the next text begins with one
        self.offsets = np.searchsorted(self.begin, texts.offsets)

    def codes(self, texts: Texts) -> np.ndarray:
        """A 64-bit hash of each word."""
        if not len(self.begin):
            return np.zeros(0, np.uint64)
        return Stretches(CODES[texts.data])(self.begin, self.end) | np.uint64(1)


def joined_words(texts: Texts, words: Words, kept: np.ndarray) -> pa.Array:
    """The kept words of each text with one space between them."""
    n = len(texts.data)
    change = np.zeros(n + 2, np.int32)
    change[words.begin[kept]] += 1
    change[words.end[kept]] -= 1
    inside = np.cumsum(change[:-1]) > 0  # one longer than the data
    of_text = np.searchsorted(words.offsets, np.flatnonzero(kept), side="right") - 1
    followed = np.flatnonzero(kept)[:-1][of_text[1:] == of_text[:-1]]
    spaces = words.end[followed]
    data = np.append(texts.data, np.uint8(0x20))
    data[spaces] = 0x20
    inside[spaces] = True
    counts = np.concatenate([[0], np.cumsum(inside[:n])])
    offsets = counts[texts.offsets].astype(np.int64)
    return pa.Array.from_buffers(
        pa.large_string(), len(texts), [None, pa.py_buffer(offsets), pa.py_buffer(data[:n][inside[:n]])]
    )


def cut_words(texts: Texts, words: Words, kept: np.ndarray) -> pa.Array:
    """Each text without its other words; a run of them goes with the white space up to the next word."""
    change = np.zeros(len(texts.data) + 1, np.int32)
    following = np.append(words.begin[1:], len(texts.data))  # or the text's end
    of_text = np.searchsorted(words.offsets, np.arange(len(kept)), side="right") - 1
    following = np.minimum(following, texts.offsets[1:][of_text]) if len(kept) else following[:0]
    change[words.begin[~kept]] += 1
    np.add.at(change, following[~kept], -1)
    inside = np.cumsum(change[:-1]) == 0
    offsets = np.concatenate([[0], np.cumsum(inside)])[texts.offsets].astype(np.int64)
    return pa.Array.from_buffers(
        pa.large_string(), len(texts), [None, pa.py_buffer(offsets), pa.py_buffer(texts.data[inside])]
    )


def sliding(op, values: np.ndarray, span: int) -> np.ndarray:
    """op over each stretch of span values; op is np.minimum or np.maximum."""
    size = 1
    while size * 2 <= span:
        values = op(values[:-size], values[size:])
        size *= 2
    if size < span:
        rest = span - size
        values = op(values[:-rest], values[rest:])
    return values


def winnowed(stretches: Stretches, ends: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the seeds that winnowing keeps, and the first and last window that keeps each.

    ends: for each place the end of its text. Of the seeds (stretches of this
    length) in a window the first of least hash is kept, so every window of one
    text keeps a seed, and equal windows keep the same one at the same place.
    """
    n, span = len(ends), window - seed + 1
    starts = np.flatnonzero(ends - np.arange(n) >= window)
    if not len(starts):
        return starts, starts, starts
    keys = stretches.all_of(seed) & np.uint64(0xFFFFFFFF00000000)
    keys |= np.arange(len(keys), dtype=np.uint64)
    kept = (sliding(np.minimum, keys, span)[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, kept[1:] != kept[:-1]])
    return kept[first], starts[first], starts[np.r_[first[1:], len(kept)] - 1]


def packed(values: np.ndarray) -> bytes:
    """64-bit numbers in as few bytes each as their range allows; first the lowest byte of all, then the next."""
    if not len(values):
        return b""
    values = values.astype(np.uint64)
    least = values.min()
    values = values - least
    width = max(1, -(-int(values.max()).bit_length() // 8))
    low = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + least.tobytes() + low.T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    low = np.frombuffer(data, np.uint8, offset=9).reshape(data[0], -1)
    values = np.zeros((low.shape[1], 8), np.uint8)
    values[:, : data[0]] = low.T
    return values.view("<u8")[:, 0].astype(np.uint64) + np.frombuffer(data, np.uint64, 1, 1)


def packed_sorted(values: np.ndarray) -> bytes:
    """Ascending 64-bit numbers by their differences."""
    if not len(values):
        return b""
    return values[:1].astype(np.uint64).tobytes() + packed(np.diff(values))


def unpacked_sorted(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    return np.cumsum(np.concatenate([np.frombuffer(data, np.uint64, 1), unpacked(data[8:])]), dtype=np.uint64)
