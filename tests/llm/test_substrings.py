"""Byte and word deduplication against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from cohortia.llm import repeats, seed_extend, suffix_dedup
from cases import TEXTS

LAST = float("inf")


def order(doc_id):
    return LAST if doc_id is None else doc_id


def covered(n, begins, width):
    mask = [False] * n
    for b in begins:
        mask[b : b + width] = [True] * len(mask[b : b + width])
    return mask


def brute_words(docs, window=20):
    texts = [(order(i), k, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, (i, t) in enumerate(docs)]
    smallest, earlier = {}, {}
    for i, k, w in texts:
        for at in range(len(w) - window + 1):
            key = tuple(w[at : at + window])
            smallest[key] = min(smallest.get(key, LAST), i)
            earlier.setdefault((k, key), at)
    out = []
    for (i, k, w), (doc_id, _) in zip(texts, docs, strict=True):
        begins = [
            at for at in range(len(w) - window + 1)
            if smallest[key := tuple(w[at : at + window])] < i or earlier[k, key] < at
        ]
        mask = covered(len(w), begins, window)
        kept = " ".join(x for x, gone in zip(w, mask, strict=True) if not gone)
        out.append((doc_id, len(w), sum(mask), kept))
    return sorted(out, key=repr)


def brute_bytes(docs, window=50):
    texts = [(order(i), (t or "").encode()) for i, t in docs]
    smallest = {}
    for i, b in texts:
        for at in range(len(b) - window + 1):
            smallest[b[at : at + window]] = min(smallest.get(b[at : at + window], LAST), i)
    out = []
    for (i, b), (doc_id, _) in zip(texts, docs, strict=True):
        mask = covered(len(b), [at for at in range(len(b) - window + 1) if smallest[b[at : at + window]] < i], window)
        spans = sum(m and (at == 0 or not mask[at - 1]) for at, m in enumerate(mask))
        kept = bytes(x for x, gone in zip(b, mask, strict=True) if not gone)
        out.append((doc_id, len(b), sum(mask), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def words_of(df, **how):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in seed_extend.remove_repeats(df, **how).collect()), key=repr)


def bytes_of(df):
    rows = suffix_dedup.remove_repeated_bytes(df).collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in rows), key=repr)


def made(seed, docs=60):
    """Texts of few words with passages, copies and runs inside and across them."""
    r = random.Random(seed)
    passages = [[r.choice("abcdefgh") * r.randint(1, 4) for _ in range(r.randint(15, 50))] for _ in range(6)]
    rows = []
    for i in range(docs):
        words = []
        for _ in range(r.randint(0, 6)):
            words += r.choice(passages) if r.random() < 0.5 else [f"w{r.randint(0, 5000)}" for _ in range(r.randint(0, 25))]
        if r.random() < 0.1:
            words += ["run"] * r.randint(10, 80)
        rows.append((i, r.choice([" ", "\n", "  "]).join(words)))
    rows += [(docs + k, t) for k, (_, t) in enumerate(rows[:5])]
    r.shuffle(rows)
    return rows


@pytest.fixture(params=[1 << 21, 1500], ids=["one-block", "many-blocks"])
def blocks(request, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", request.param)
    monkeypatch.setattr(repeats, "BUCKET_BYTES", request.param)


@pytest.mark.parametrize("seed", [1, 2])
def test_made_texts(spark, blocks, seed):
    rows = made(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert words_of(df) == brute_words(rows)
    assert bytes_of(df) == brute_bytes(rows)


def test_awkward_rows(awkward, blocks):
    rows = [(i, t) for i, t, *_ in TEXTS]
    assert words_of(awkward) == brute_words(rows)
    assert bytes_of(awkward) == brute_bytes(rows)


def test_nothing(nothing):
    assert words_of(nothing) == [] and bytes_of(nothing) == []


def test_a_passage_between_clean_words_goes_and_the_rest_keeps_its_layout(awkward):
    kept = seed_extend.remove_repeats(awkward, layout=True, carry=["other", "carried"])
    by_id = {r.doc_id: r for r in kept.collect()}
    assert by_id[-3].kept_text == by_id[-3].kept_text.strip() and by_id[-3].n_removed == 0
    assert by_id[2].kept_text == "start one end one" and by_id[3].kept_text == "begin two and more"
    assert by_id[12].kept_text.endswith("línea\nlínea\nlínea") and by_id[12].carried.other == 12
    assert by_id[2].carried.carried == "x"


@pytest.mark.parametrize("alphabet", [1, 2, 4, 200])
def test_suffix_order_and_common_prefixes(alphabet):
    r = np.random.default_rng(alphabet)
    text = r.integers(0, alphabet, 700).astype(np.uint8)
    raw = text.tobytes()
    at = suffix_dedup.suffix_order(text, 60)
    assert sorted(at.tolist()) == list(range(700))
    heads = [raw[i : i + 60] for i in at]
    assert heads == sorted(heads)
    shared = suffix_dedup.common_prefixes(text, at, 60)
    for k in range(1, 700):
        a, b = heads[k - 1], heads[k]
        n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert shared[k] == n


def test_hot_copies_cost_one_message_a_block(spark):
    """Copies inside a block are settled there."""
    import pyarrow as pa

    from cohortia.llm.repeats import _send_seeds

    finder = repeats.Finder(20, 6, True, True, None, None)
    text = " ".join(f"w{i}" for i in range(200))
    one = pa.table({"block": pa.array([0], pa.int32()), "doc_id": [1], "text": [text]})
    many = pa.table({"block": pa.array([0] * 500, pa.int32()), "doc_id": list(range(1, 501)), "text": [text] * 500})
    sent = [_send_seeds(finder, 4)(t) for t in (one, many)]
    assert sent[0].equals(sent[1])


def test_texts_are_shuffled_once(spark, awkward):
    df = seed_extend.remove_repeats(awkward)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReusedExchange") >= 2


def test_texts_that_share_less_than_half_of_a_window_send_no_contexts():
    """A seed shared by chance is settled by the halves around it."""
    import pyarrow as pa

    from cohortia.llm.repeats import EXTEND, _judge_seeds, _send_seeds

    finder = repeats.Finder(50, 16, False, False, None, None)
    r = random.Random(7)
    noise = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))

    def codes(shared):
        texts = [noise(200) + shared + noise(200) for _ in range(20)]
        tables = [pa.table({"block": pa.array([k], pa.int32()), "doc_id": [k], "text": [t]}) for k, t in enumerate(texts)]
        sent = pa.concat_tables([_send_seeds(finder, 1)(t) for t in tables])
        return set(b"".join(x.as_py() for x in _judge_seeds(sent)["codes"]))

    assert codes(noise(30)) == {0}
    assert EXTEND in codes(noise(60))


@pytest.mark.parametrize("bits", [1, 8, 9, 33, 63, 64])
def test_numbers_take_as_few_bytes_as_their_range_allows(bits):
    from cohortia.llm.sequences import packed, unpacked

    values = np.random.default_rng(bits).integers(0, (1 << bits) - 1, 1000, np.uint64, endpoint=True)
    values[:2] = 0, (1 << bits) - 1
    assert (unpacked(packed(values)) == values).all()
    assert len(packed(values)) <= 1000 * -(-bits // 8) + 16
