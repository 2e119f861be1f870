"""Packing: an exact round trip, and the cheapest cuts against brute force."""

import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cohortia.llm import packing
from cases import TEXTS

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(rows, pieces, reference, capacity=1024):
    """Every id of every row lies in one piece, and pieces fill their windows without gaps."""
    windows, docs = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 4 * p.length and p.length > 0
        windows[p.sequence_id].append((p.offset, p.length))
        docs[p.doc_id].append((p.start, p.length, p.doc_tokens, np.frombuffer(p.ids, "<u4").tolist()))
    for parts in windows.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    expected = defaultdict(list)
    for doc_id, text in rows:
        expected[doc_id].append([*reference.encode(text or "", add_special_tokens=False).ids, 0])
    assert set(docs) == set(expected)
    for doc_id, texts in expected.items():
        assert sum(length for _, length, _, _ in docs[doc_id]) == sum(map(len, texts))
        if len(texts) == 1:
            got, at = [], 0
            for start, length, total, ids in sorted(docs[doc_id]):
                assert start == at and total == len(texts[0])
                got += ids
                at += length
            assert got == texts[0]
    return windows


@pytest.mark.parametrize("parts", [1, 3])
def test_round_trip(spark, awkward, reference, parts):
    pieces = packing.pack(awkward.repartition(parts), RANKS).collect()
    check([(i, t) for i, t, *_ in TEXTS], pieces, reference)


def test_little_padding(spark, reference):
    r = random.Random(5)
    rows = [(k, " ".join(r.choice(["the", "of.", "running", "a", "seldom.", "x1"]) for _ in range(r.randint(0, 900)))) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    windows = check(rows, packing.pack(df, RANKS).collect(), reference)
    sizes = [sum(length for _, length in parts) for parts in windows.values()]
    assert sum(1024 - s for s in sizes if s & (s - 1)) < 0.01 * sum(sizes)


def test_ids_equal_those_of_tokenizers_over_all_code_points(reference):
    encode, _ = packing.load_encoder(RANKS, 50256)
    points = [c for c in range(0x20000) if not 0xD800 <= c <= 0xDFFF]
    texts = ["".join(f"a{chr(c)} {chr(c)}1 " for c in points[k : k + 64]) for k in range(0, len(points), 64)]
    texts += ["", "   x\n\n  y ", "<|endoftext|> as <|endoftext|>text", "a" * 5000, " " * 5000]
    for text, ids in zip(texts, reference.encode_batch(texts, add_special_tokens=False), strict=True):
        assert encode(text).tolist() == ids.ids


N = 5_000_000


@pytest.mark.parametrize("text", [" " * N, "\n" * N, " \n\t" * (N // 3), "\r\n" * (N // 2) + "end"])
def test_long_runs_of_white_space_have_the_ids_of_tokenizers(reference, text):
    encode, _ = packing.load_encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), 50256)
    assert encode(text).tolist() == reference.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(3))
def test_runs_of_white_space_among_words(reference, monkeypatch, seed):
    monkeypatch.setattr(packing, "LONG_BLANK", 2)
    encode, _ = packing.load_encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), 50256)
    draw = random.Random(seed)
    for _ in range(500):
        parts = [" ", "  ", "\n", "\t", "\x85", "\u3000", "\x1c", "a", "Bc", "1", ".", "<|endoftext|>", "'s"]
        text = "".join(draw.choices(parts, k=draw.randint(0, 30)))
        assert encode(text).tolist() == reference.encode(text, add_special_tokens=False).ids


def test_no_rows_give_no_pieces(nothing):
    assert packing.pack(nothing, RANKS).count() == 0


def brute_cost(ends, penalties, capacity):
    """The least cost over all cuts at the given ends, and inside at full windows."""
    kinds, cost = dict(zip(ends, penalties, strict=True)), {0: 0}
    for j in range(1, ends[-1] + 1):
        ways = []
        for i in range(max(0, j - capacity), j):
            if i in cost and (j in kinds or j - i == capacity):
                ways.append(cost[i] + capacity - (j - i) + kinds.get(j, packing.INNER_CUT))
        if ways:
            cost[j] = min(ways)
    return cost[ends[-1]]


@pytest.mark.parametrize("seed", range(8))
def test_window_ends_are_the_cheapest(seed):
    r = random.Random(seed)
    capacity = 40
    ends = sorted(r.sample(range(1, 600), r.choice([3, 30, 120])))
    penalties = [r.choice([0, packing.SENTENCE_CUT]) for _ in ends]
    cuts = packing.window_ends(ends, penalties, capacity)
    assert cuts[-1] == ends[-1] and all(0 < b - a <= capacity for a, b in zip([0, *cuts], cuts, strict=False))
    kinds = dict(zip(ends, penalties, strict=True))
    cost = sum(capacity - (b - a) + kinds.get(b, packing.INNER_CUT) for a, b in zip([0, *cuts], cuts, strict=False))
    assert cost == brute_cost(ends, penalties, capacity)


@pytest.mark.parametrize("length", [1, 3, 300, 511, 512, 1000, 1023, 1024])
def test_power_ends(length):
    ends = packing.power_ends(7, 7 + length, 1024)
    sizes = np.diff([7, *ends])
    assert sizes.sum() == length and (len(ends) == 1 or all(s & (s - 1) == 0 for s in sizes))
