import hashlib
import itertools
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortia.llm import personal
from cohortia.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"


def plain(text):
    """The fixed patterns as they are stated."""
    luhn = lambda d: sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(d[::-1])) % 10 == 0
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) < 256 for part in m[0].split(".")):
            out.append((1, *m.span()))
    for kind, pattern, least, most in (
        (2, r"[0-9]([\x20-]?[0-9])+", 13, 19), (3, r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)
    ):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if least <= len(digits) <= most and (kind == 3 or luhn(digits)):
                out.append((kind, *m.span()))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_plain_spans_equal_the_stated_patterns(seed):
    draw = random.Random(seed)
    for _ in range(3000):
        text = "".join(draw.choices(["1", "23", "255", "4539578763621486", ".", "@", "a", "b-c", "_", "+", " ", "(", ")", "-", "é"], k=draw.randint(0, 25)))
        assert personal.plain_spans(text) == plain(text), text


@pytest.fixture(scope="module")
def field():
    return personal.train(["some words that stand around here and there", "other words of a text, with more of them."])


def segmentations(n, spans):
    """All sets of spans that do not overlap, in order."""
    def grow(at):
        yield []
        for k, (a, b) in enumerate(spans):
            if a >= at:
                for rest in grow(b):
                    yield [k, *rest]
    return list(grow(0))


def score(field, n, spans, scores, chosen):
    """Score of (span, kind) pairs over n tokens."""
    total, label, t = 0.0, 0, 0
    for k, kind in chosen:
        a, b = spans[k]
        for _ in range(t, a):
            total += field.follow[label, 0]
            label = 0
        total += scores[k, kind] + field.follow[label, kind + 1]
        label, t = kind + 1, b
    for _ in range(t, n):
        total += field.follow[label, 0]
        label = 0
    return total


def all_scored(field, n, spans, scores):
    for chosen in segmentations(n, spans):
        for kinds in itertools.product(range(len(personal.KINDS)), repeat=len(chosen)):
            pairs = list(zip(chosen, kinds, strict=True))
            yield pairs, score(field, n, spans, scores, pairs)


@pytest.mark.parametrize("seed", range(6))
def test_best_segments_equal_brute_force(seed):
    draw = np.random.default_rng(seed)
    field = personal.Field()
    field.follow = draw.normal(size=field.follow.shape)
    spans = [(0, 2), (1, 3), (2, 3), (4, 6), (3, 6), (6, 7)]
    scores = draw.normal(size=(len(spans), len(personal.KINDS)))
    best = max(all_scored(field, 8, spans, scores), key=lambda x: x[1])
    start, stop = np.array(spans).T
    got = personal.best_segments(field, 8, start, stop, scores)
    assert got == [(*spans[k], kind) for k, kind in best[0]]


def test_likelihood_and_gradient_equal_brute_force():
    sentence = personal.Sentence()
    text = "at 41 5551 a"
    sentence.add(text, 0, len(text), 0)
    spans = personal.Spans(sentence, 0, len(sentence.types))
    n, pairs = len(sentence.types), list(zip(spans.start.tolist(), spans.stop.tolist(), strict=True))
    draw, field = np.random.default_rng(1), personal.Field()
    field.weights, field.follow = draw.normal(size=field.weights.shape), draw.normal(size=field.follow.shape)
    gold = {pairs[0]: 2}

    def likelihood():
        every = dict((tuple(p), s) for p, s in all_scored(field, n, pairs, field.scores(spans)))
        return every[((0, 2),)] - np.log(sum(np.exp(s) for s in every.values()))

    value, by_weight, by_follow = personal.gradient(field, n, spans, gold)
    assert value == pytest.approx(likelihood())
    for part, grad in ((field.weights, by_weight), (field.follow, by_follow)):
        for place in [np.unravel_index(np.abs(grad).argmax(), grad.shape), (0, 0), (1, 2)]:
            part[place] += 1e-5
            above = likelihood()
            part[place] -= 2e-5
            below = likelihood()
            part[place] += 1e-5
            assert grad[place] == pytest.approx((above - below) / 2e-5, abs=1e-4)


def test_held_out_sentences(field):
    maker = personal.Maker(1234, ["words that training never saw, in a row"])
    made = [maker.sentence() for _ in range(300)]
    found = personal.found_spans(field, [text for text, _ in made])
    right = said = there = 0
    for (text, gold), spans in zip(made, found, strict=True):
        got = {(a, b, kind) for kind, a, b, _ in spans}
        want = {(a, b, kind) for (a, b), kind in gold.items()} | {(a, b, kind) for kind, a, b in personal.plain_spans(text)}
        right, said, there = right + len(got & want), said + len(got), there + len(want)
    assert right / said > 0.95 and right / there > 0.95


def test_numbers_side_by_side_are_told_apart(field):
    text = "paid with 4539578763621486 4485275742308327 and +1 (323) 555-9830 4485275742308327 then."
    found = [(personal.KINDS[k], text[a:b]) for k, a, b, fixed in personal.found_spans(field, [text])[0] if not fixed]
    assert found == [("card", "4539578763621486"), ("card", "4485275742308327"), ("card", "4485275742308327"), ("phone", "+1 (323) 555-9830")]


def test_clean_texts_have_no_spans(field):
    texts = [
        "licensed under the Apache License, Version 2.0. See version 3. CC BY-NC 4.0.",
        'token = "1eb9c654e721b4f812088970e66a6345cee33dd6" and 1712345678901234 orders on 2021-03-04 at 10:30:45',
        "nothing here", "", "7", "&&& 12 %%%",
    ]
    assert personal.found_spans(field, texts) == [[]] * len(texts)


@pytest.mark.parametrize("text", ["a" * 3_000_000, "1" * 1_000_000, "a@" * 100_000, "1.1." * 50_000, "+1" + " " * 1_000_000, "a.b-" * 500_000 + "@", "1 " * 100_000])
def test_long_texts_take_linear_time(field, text):
    start = time.time()
    personal.found_spans(field, [text])
    assert time.time() - start < 90


def test_windows_cover_what_they_should():
    text = "x" * 500 + " 12 " + "y" * 60 + " 34 " + "z " * 100 + "me@here " + "w " * 300
    parts = personal.windows(text)
    assert all(a < b for a, b in parts) and all(a[1] < b[0] for a, b in zip(parts, parts[1:], strict=False))
    assert all(any(a <= m.start() < b for a, b in parts) for m in personal.NEAR.finditer(text))
    assert personal.windows("") == [] and personal.windows("no numbers") == []


def test_awkward_rows(spark, awkward):
    given = awkward.withColumn("text", F.concat("text", F.lit(" write to me.2@mail.example.com or 10.0.0.7")))
    got = personal.find_personal_data(given, mask=True).collect()
    assert len(got) == given.count()
    texts = {}
    for r in given.collect():
        texts.setdefault(r.doc_id, set()).add(r.text)
    for r in got:
        assert any(
            [(s.kind, s.start, s.end) for s in r.spans if s.fixed] == [(personal.KINDS[k], a, b) for k, a, b in plain(t or "")]
            for t in texts[r.doc_id]
        )
        assert r.masked_text is None or r.masked_text.endswith("write to <EMAIL> or <IP>")


def test_no_rows(nothing):
    assert personal.find_personal_data(nothing).count() == 0


def test_query_digests_what_the_operator_finds(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in REGISTRY["op12_personal_data"][0](spark, SF).collect():
        base = plain(docs[r.doc_id])
        names = ",".join(f"{personal.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(names.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in base) for kind in range(4)]
        assert set(names.split(",")) - {""} <= set(r.spans.split(","))


def test_masked_overlaps_and_repeats():
    assert personal.masked("ab 12 34 cd", [(2, 3, 8, True), (1, 3, 5, True), (0, 9, 11, False)]) == "ab <CARD> <EMAIL>"
    assert personal.masked("ab", []) == "ab"
