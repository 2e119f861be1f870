"""Words grouped with their single-edit variants by dense prefix-suffix tiling.

Two words are one insertion, deletion or replacement apart exactly if their
common prefix and common suffix together reach the longer length minus one. One
of the two then reaches half of that, so a word meets only the words of its own
or a neighbouring length that share a half of it: their first or their last code
points. Inside such a group, blocks of words are matrices of code points padded
with zeros, once from the front and once from the back, and a tile compares all
words of two blocks position by position.

Groups are split into blocks of at most about ``BLOCK`` words; each pair of blocks
is a tile of its own, so a half that very many words share is spread over tasks. A
pair that shares both halves counts in the group of its first half alone. Only
pairs that are near leave a task, summed up per word.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortia.session import staged

#: Words of a block; a tile compares two blocks.
BLOCK = 4096
#: Cells of a matrix comparison in memory, and words that a task collects before it passes them on.
CELLS, HELD = 1 << 21, 400_000

RUN = re.compile("[a-zÀ-ÿ]+")


def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", typo_every: int = 97, min_length: int = 5, min_count: int = 3
) -> DataFrame:
    """word and n of all lower-cased letter runs of the texts, each counted in its own spelling.

    Where the CRC-32 of ``<id>:<run>`` is divisible by typo_every, the run loses
    its code point at that CRC modulo its length. A null text has no runs; runs of
    a null id lose nothing.
    """

    def run(batches):
        def rows():
            found = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"]
            )
            held.clear()
            return found

        held = Counter()
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                if not text:
                    continue
                start = None if key is None else zlib.crc32(f"{key}:".encode())
                # bytes.lower changes A-Z alone
                for word, n in Counter(RUN.findall(text.encode().lower().decode())).items():
                    if start is not None:
                        code = zlib.crc32(word.encode(), start)
                        if not code % typo_every:
                            at = code % len(word)
                            word = word[:at] + word[at + 1 :]
                    if len(word) >= min_length:
                        held[word] += n
                if len(held) > HELD:
                    yield rows()
        yield rows()

    narrow = docs.select(docs[id_col].cast("string").alias("id"), docs[text_col].cast("string").alias("text"))
    counted = narrow.mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _half(longest):
    """Code points of the half that two words share, by the length of the longer."""
    return F.floor(longest / 2).cast("int")  # the least integer from (longest - 1) / 2


def _tiles(words: DataFrame) -> DataFrame:
    """Each word once per tile: the group's longer length, side and half, the tile's blocks, and the word's own block."""
    size = F.length("word")
    groups = F.array(
        *[
            F.struct(longest.alias("longest"), F.lit(last).alias("last"), half.alias("half"))
            for longest in (size, size + 1)
            for last, half in (
                (False, F.substring("word", F.lit(1), _half(longest))),
                (True, F.substring("word", size - _half(longest) + 1, _half(longest))),
            )
        ]
    )
    members = words.select("word", "n", F.explode(groups).alias("g")).select("word", "n", "g.*")
    key = ["longest", "last", "half"]
    large = members.groupBy(*key).count().where(F.col("count") > BLOCK)
    blocks = large.select(*key, F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    members = members.join(blocks, key, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    members = members.withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    spread = members.select("*", other.alias("other"))
    return spread.select(
        *key, F.least("block", "other").alias("row"), F.greatest("block", "other").alias("col"), "block", "word", "n"
    )


def _matrices(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points from the front and from the back, and lengths."""
    sizes = np.array([len(w) for w in words])
    flat = np.frombuffer("".join(words).encode("utf-16-le"), "<u2")
    width = int(sizes.max())
    ends = np.cumsum(sizes)
    place = np.arange(len(flat)) - np.repeat(ends - sizes, sizes)
    row = np.repeat(np.arange(len(words)), sizes)
    front, back = np.zeros((2, len(words), width), np.uint16)
    front[row, place] = flat
    back[row, np.repeat(sizes, sizes) - 1 - place] = flat
    return front, back, sizes


def _common(left: np.ndarray, right: np.ndarray, width: int) -> np.ndarray:
    """How far every left row and every right row of each group agree from their start."""
    shape = (left.shape[0], left.shape[1], right.shape[1])
    alike, total = np.ones(shape, bool), np.zeros(shape, np.uint8 if width < 256 else np.int32)
    for at in range(width):
        alike &= left[:, :, None, at] == right[:, None, :, at]
        total += alike
    return total


def near_in_tiles(
    front: np.ndarray, back: np.ndarray, sizes: np.ndarray, left: np.ndarray, right: np.ndarray, longest: int, last: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows that are one edit apart; left and right hold the rows of each tile, filled up with -1.

    Every tile belongs to a group of this longer length, by the first or the last
    half. Tiles of equal sides compare a row with itself too, which is never near.
    """
    real = (left >= 0)[:, :, None] & (right >= 0)[:, None, :]
    long_left, long_right = (sizes[left] == longest)[:, :, None], (sizes[right] == longest)[:, None, :]
    width = min(longest, front.shape[1])
    ahead = _common(front[left], front[right], width)
    behind = _common(back[left], back[right], width)
    near = ahead.astype(np.int32) + behind >= longest - 1
    near &= real & (long_left | long_right) & (left[:, :, None] != right[:, None, :])
    if last:  # the group of the first half has the others
        near &= ahead < longest // 2
    else:
        near &= ahead >= longest // 2
    tile, a, b = np.nonzero(near)
    return left[tile, a], right[tile, b]


def _sides(rows: np.ndarray, size: int) -> np.ndarray:
    filled = np.full(size, -1, np.int64)
    filled[: len(rows)] = rows
    return filled


def _near_pairs(words: list[str], start: np.ndarray, end: np.ndarray, longest, last, own: np.ndarray, split: np.ndarray):
    """Pairs of near words of tiles that lie in rows start to end; own tells the rows of a tile's first block.

    split tells the tiles of two different blocks, whose first rows meet the others alone.
    """
    front, back, sizes = _matrices(words)
    lefts, rights = [], []
    small, tall = {}, 512
    for k in range(len(start)):
        rows = np.arange(start[k], end[k])
        kind = (int(longest[k]), bool(last[k]))
        if split[k]:
            pairs = [(rows[own[rows]], rows[~own[rows]])]
        elif len(rows) <= 64:
            side = 1 << int(len(rows) - 1).bit_length()
            small.setdefault((*kind, side), []).append(rows)
            continue
        else:
            cuts = [rows[at : at + tall] for at in range(0, len(rows), tall)]
            pairs = [(a, b) for i, a in enumerate(cuts) for b in cuts[i:]]
        for a, b in pairs:
            for i in range(0, len(a), tall):
                for j in range(0, len(b), tall):
                    x, y = a[i : i + tall], b[j : j + tall]
                    one, two = near_in_tiles(front, back, sizes, x[None], y[None], *kind)
                    keep = one < two if x[0] == y[0] else slice(None)
                    lefts.append(one[keep])
                    rights.append(two[keep])
    for (size, by_last, side), groups in small.items():
        step = max(CELLS // (side * side), 1)
        for at in range(0, len(groups), step):
            tiles = np.stack([_sides(rows, side) for rows in groups[at : at + step]])
            one, two = near_in_tiles(front, back, sizes, tiles, tiles, size, by_last)
            keep = one < two
            lefts.append(one[keep])
            rights.append(two[keep])
    if not lefts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(lefts), np.concatenate(rights)


def _summed(words: pa.Array, n: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Per word of these pairs the number of near words and the one of largest n, first in order."""
    of, other = np.concatenate([a, b]), np.concatenate([b, a])
    rank = np.empty(len(words), np.int64)
    rank[pc.sort_indices(words).to_numpy()] = np.arange(len(words))
    order = np.lexsort((rank[other], -n[other], of))
    of, other = of[order], other[order]
    first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.zeros(0, np.int64)
    counts = np.diff(np.r_[first, len(of)])
    best = other[first]
    return pa.RecordBatch.from_arrays(
        [words.take(pa.array(of[first])), pa.array(counts), pa.array(n[best]), words.take(pa.array(best))],
        names=["word", "n_near", "n", "near"],
    )


def _compare(batches):
    """Near words of tiles that lie one after the other; the last tile of a batch waits for its rest."""
    held = None
    schema = None

    def work(table: pa.Table):
        words = table["word"].combine_chunks()
        marks = np.stack([table[c].to_numpy().astype(np.int64) for c in ("longest", "last", "row", "col")])
        half = table["half"].combine_chunks().dictionary_encode().indices.to_numpy()
        marks = np.vstack([marks, half])
        start = np.flatnonzero(np.r_[True, (marks[:, 1:] != marks[:, :-1]).any(0)])
        end = np.r_[start[1:], len(words)]
        several = end - start > 1
        start, end = start[several], end[several]
        own = table["block"].to_numpy() == marks[2]
        split = marks[2, start] != marks[3, start]
        pairs = _near_pairs(words.to_pylist(), start, end, marks[0, start], marks[1, start], own, split)
        return _summed(words, table["n"].to_numpy(), *pairs)

    for batch in batches:
        schema = batch.schema
        held = batch if held is None else pa.concat_batches([held, batch])
        if held.num_rows < 4 * BLOCK:
            continue
        tile = np.stack([held.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (0, 1, 3, 4)])
        half = held.column(2).dictionary_encode().indices.to_numpy()
        change = np.flatnonzero((np.vstack([tile, half])[:, 1:] != np.vstack([tile, half])[:, :-1]).any(0))
        if len(change):
            cut = int(change[-1]) + 1
            yield work(pa.Table.from_batches([held.slice(0, cut)], schema))
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield work(pa.Table.from_batches([held], schema))


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, and the near word of largest n (near, near_n) of every word that has one.

    words holds distinct words and n. Ties go to the word that is first in code-point order.
    """
    key = ["longest", "last", "half", "row", "col"]
    tiles = _tiles(words).select(*key, "block", "word", "n").repartition(*key).sortWithinPartitions(*key)
    found = tiles.mapInArrow(_compare, "word string, n_near long, n long, near string")
    best = F.min(F.struct((-F.col("n")).alias("less"), "near"))
    near = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return near.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """word and root, the end of its chain of forms; every step at least doubles n, so a few rounds suffice."""
    roots = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = roots.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next")
        moved = staged(moved, "roots")
        if moved.where("next IS NOT NULL").isEmpty():
            return moved.select("word", "root")
        roots = moved.select("word", "root")


def spelling_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", typo_every: int = 97, min_length: int = 5, min_count: int = 3
) -> DataFrame:
    """Each word of the texts with the spelling it is a variant of.

    Returns word, form (its near word of largest n, if that n is at least twice
    its own), root (from the word over forms to the last), n, n_near and form_n.
    Other columns of docs are ignored, whatever their names; ids are read as text.

    A null or empty text has no words, a null id no deleted code points. Rows that
    repeat an id or a whole row count each. Ties between near words go to the one
    first in code-point order. No rows give no words.
    """
    words = staged(word_counts(docs, id_col, text_col, typo_every, min_length, min_count), "words")
    joined = words.join(near_words(words), "word", "left")
    takes = F.col("near_n") >= 2 * F.col("n")
    joined = staged(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(takes, F.col("near")).alias("form"), F.when(takes, F.col("near_n")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(joined.where("form IS NOT NULL"))
    return joined.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
