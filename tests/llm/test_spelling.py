import random
import re
import zlib
from collections import Counter

import pytest

from cohortia.llm import spelling


def brute(rows, every=97, least=5, often=3):
    counts = Counter()
    for key, text in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for run in re.findall("[a-zA-ZÀ-ÿ]+", lower):
            code = None if key is None else zlib.crc32(f"{key}:{run}".encode())
            if code is not None and code % every == 0:
                at = code % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least and n >= often}

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        short, long = sorted((a, b), key=len)
        return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))

    found = {}
    for word, n in words.items():
        others = [w for w in words if near(word, w)]
        best = min(others, key=lambda w: (-words[w], w), default=None)
        found[word] = (len(others), best if best and words[best] >= 2 * n else None)
    out = Counter()
    for word, (n_near, form) in found.items():
        root = word
        while found[root][1]:
            root = found[root][1]
        out[word, form, root, words[word], n_near, form and words[form]] += 1
    return out


def result(df):
    return Counter((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def variants(seed, n):
    draw = random.Random(seed)
    words = ["".join(draw.choice("abé") for _ in range(draw.randint(4, 9))) for _ in range(n)]
    return [(i, " ".join(draw.choice(words).upper() if i % 7 else draw.choice(words) for _ in range(60))) for i in range(40)]


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rows = variants(seed, 300)
    assert result(spelling.spelling_variants(frame(spark, rows))) == brute(rows)


def test_groups_over_several_blocks_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 8)  # most halves are shared by more words than that
    rows = variants(9, 400)
    got = spelling.spelling_variants(frame(spark, rows))
    assert result(got) == brute(rows)


def test_both_halves_shared_counts_once(spark):
    rows = [(1, "abcXdef abcYdef abcdef abcXXdef " * 3 + "kitten sitten sittin " * 4)]
    assert result(spelling.spelling_variants(frame(spark, rows), typo_every=10**9)) == brute(rows, every=10**9)


def test_chains_lead_to_the_last_form(spark):
    text = " ".join(w for n, w in [(3, "aaaaa"), (6, "aaaab"), (12, "aaabb"), (24, "aabbb"), (48, "abbbb")] for _ in range(n))
    got = {r.word: r for r in spelling.spelling_variants(frame(spark, [(None, text)])).collect()}
    assert {r.root for r in got.values()} == {"abbbb"}
    assert got["aaaaa"].form == "aaaab" and got["abbbb"].form is None and got["aaaab"].n_near == 2


def test_ties_go_to_the_first_word(spark):
    rows = [(None, "zaaaa " * 9 + "aaaaa " * 9 + "ßaaaa " * 9 + "maaaa " * 3)]
    got = {r.word: r for r in spelling.spelling_variants(frame(spark, rows)).collect()}
    assert got["maaaa"].form == "aaaaa" and got["maaaa"].n_near == 3


def test_awkward_rows(spark, awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert result(spelling.spelling_variants(awkward)) == brute(rows)


def test_letters_outside_the_range_end_a_word_and_keep_their_case(spark):
    rows = [(None, "Œuvre œuvres ÉCOLE école Привет straßeñ ábcdefg " * 3)]
    got = spelling.spelling_variants(frame(spark, rows))
    assert result(got) == brute(rows)


def test_no_rows(nothing):
    assert spelling.spelling_variants(nothing).count() == 0


def test_a_very_long_word_and_text(spark):
    rows = [(5, "x" * 5000 + " "), (6, "x" * 4999 + " "), (7, "x" * 5000)] * 3
    assert result(spelling.spelling_variants(frame(spark, rows))) == brute(rows)
