import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cohortia.llm import resampling


def runs(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return len(words), [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def brute(docs, target, percent=5, least=20, buckets=10_000):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(bucket, runs(text)[1]))
    for text in target:
        t.update(map(bucket, runs(text)[1]))
    over, under = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log(((t[b] + 1) * over) / ((s[b] + 1) * under)))
    rows = []
    for key, text in docs:
        n, found = runs(text)
        weight = sum(gain(bucket(f)) for f in found)
        h = int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([key, len(found), weight, score, None, n >= least])
    able = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = rank
    return Counter(tuple(r[:5]) for r in rows)


def result(df):
    return Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect())


def frames(spark, docs, target):
    return (
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame([(t,) for t in target], "text string"),
    )


def corpus(seed, n):
    draw = random.Random(seed)
    words = ["the", "of", "Und", "ciónes", "x" * 70, "7", "longer-word", "привет", "ééééééééé", "abcdefgh", "abcdefghi", "q" * 64]
    return [(i, " ".join(draw.choices(words, [30, 20, 10, 5, 1, 5, 5, 5, 3, 3, 3, 1], k=draw.randint(0, 60)))) for i in range(n)]


@pytest.mark.parametrize("room", [4, 1])
def test_equals_brute_force(spark, monkeypatch, room):
    monkeypatch.setattr(resampling, "ROOM", room)  # full tables leave entries out, which changes nothing
    docs, target = corpus(1, 300), [t for _, t in corpus(2, 5)] + [None]
    got = resampling.resample(*frames(spark, docs, target), percent=30)
    assert result(got) == brute(docs, target, percent=30)


@pytest.mark.parametrize("words, pairs", [(0, 0), (3, 2)])
def test_tables_change_no_value(spark, monkeypatch, words, pairs):
    monkeypatch.setattr(resampling, "HEAD_WORDS", words)
    monkeypatch.setattr(resampling, "HEAD_PAIRS", pairs)
    docs, target = corpus(3, 60), ["the of Und the of"]
    assert result(resampling.resample(*frames(spark, docs, target))) == brute(docs, target)


def test_awkward_rows(spark, awkward):
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    target = ["same same quite enough words", None, ""]
    extra = spark.createDataFrame([(t, "x") for t in target], "text string, weight string")
    got = resampling.resample(awkward, extra, percent=50)
    assert result(got) == brute(docs, target, percent=50)


def test_equal_rows_are_ranked_one_by_one(spark):
    docs = [(7, "word " * 25)] * 500 + [(None, "other " * 25)] * 100
    got = [r for r in resampling.resample(*frames(spark, docs, ["word"]), percent=90).collect() if r["rank"]]
    assert sorted(r["rank"] for r in got) == list(range(1, 541))


def test_no_rows_on_either_side(spark, nothing):
    docs = corpus(5, 30)
    left, right = frames(spark, docs, [])
    assert resampling.resample(nothing, right).count() == 0
    assert result(resampling.resample(left, right)) == brute(docs, [])


def test_codes_of_any_length():
    crc, data = resampling.Crc(), np.random.default_rng(1).integers(0, 256, 5000, np.uint8)
    begin = np.arange(0, 400)
    size = np.arange(0, 400) % 130
    expected = [zlib.crc32(data[b : b + s].tobytes()) for b, s in zip(begin, size, strict=True)]
    assert crc.of(data, begin, size).tolist() == expected
    states = np.array(expected, np.uint32)
    carried = crc.carried(states, np.full(400, 9))
    assert [int(c) ^ zlib.crc32(b"ninebytes") for c in carried] == [zlib.crc32(b"ninebytes", s) for s in expected]


def test_slices_cover_all_texts(monkeypatch):
    monkeypatch.setattr(resampling, "SLICE_BYTES", 10)
    texts = pa.array(["abc", None, "", "d" * 50, "e", "f" * 10, "g"])
    parts = list(resampling.sliced(texts))
    assert [a for a, _ in parts] == [0, *[b for _, b in parts[:-1]]] and parts[-1][1] == 7
    assert list(resampling.sliced(texts.slice(0, 0))) == []
