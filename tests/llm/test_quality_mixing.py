"""Quality rules and mixing."""

import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cohortia.llm import mixing, quality
from cases import TEXTS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measured(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    again = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            again.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again),
        sum(any(c.isalpha() for c in w) for w in words), sum(a == b for a, b in zip(words, words[1:], strict=False)),
    )


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_letter_words", "n_stutters"]


def test_measures_of_awkward_rows(awkward):
    judged = quality.judge(awkward).collect()
    assert sorted(tuple(r[n] for n in NAMES) for r in judged) == sorted(measured(t) for _, t, *_ in TEXTS)


def test_any_order_of_rules_keeps_the_same(awkward):
    kept = lambda rules: sorted(r.other or 0 for r in quality.keep(awkward, rules=rules).collect())
    assert kept(quality.RULES) == kept(quality.RULES[::-1])
    assert {1, 2, 3} <= set(kept(quality.RULES)) and 10 not in kept(quality.RULES)
    assert quality.keep(awkward).columns == awkward.columns


def test_rules_go_by_rejections_and_cost(spark):
    rows = [(k, "### *** $$$ %%% " * 5 if k % 2 else "clean words that say quite a lot and go on for a while") for k in range(200)]
    ordered = quality.order_rules(spark.createDataFrame(rows, "doc_id long, text string"))
    names = [rule.name for rule in ordered]
    assert sorted(names) == sorted(r.name for r in quality.RULES)
    assert names[0] in {"symbols", "repeated_words", "no_letters"}  # few_words rejects none of them


def test_no_rows(nothing):
    assert quality.judge(nothing).count() == 0 and quality.keep(nothing).count() == 0
    assert mixing.mix(mixing.word_sizes(nothing)).count() == 0 and mixing.mixed_documents(nothing).count() == 0


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, target, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if level * weight[s] >= most * sizes[s]}
        if not above:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: most * sizes[s] for s in above}
        left -= sum(most * sizes[s] for s in above)
        open_ -= above
    return target


def check_mix(rows, taken):
    sizes = defaultdict(int)
    for r in taken:
        sizes[r.source] += r.size
    target, got, largest = brute_targets(sizes), defaultdict(int), defaultdict(int)
    for r in taken:
        assert r.target == pytest.approx(target[r.source]) and r.source_size == sizes[r.source]
        assert r.taken == r.copies * r.size and r.copies in (0, 1, 2)
        got[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(got[s] - target[s]) <= largest[s] + 1e-6
    assert len(taken) == len(rows)


def test_mix_of_awkward_rows(awkward):
    taken = mixing.mix(mixing.word_sizes(awkward)).collect()
    check_mix(TEXTS, taken)
    counts = Counter((r.doc_id, r.source) for r in taken)
    assert counts[9, "a"] == 2 and counts[None, None] == 1


def test_mix_of_many_documents_is_the_same_on_any_layout(spark):
    rows = [(k, " ".join(["w"] * (1 + k * 7919 % 300)), ["hot", "hot", "a", "b", None][k % 5]) for k in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first = mixing.mix(mixing.word_sizes(df)).collect()
    check_mix(rows, first)
    again = mixing.mix(mixing.word_sizes(df.repartition(7, "text"))).collect()
    assert Counter(first) == Counter(again)
    rates = [r.copies for r in first if r.source == "a"]
    expected = next(r.target / r.source_size for r in first if r.source == "a")
    assert set(rates) <= {math.floor(expected), math.ceil(expected)}


def test_mixed_documents_hold_each_as_often_as_taken(awkward):
    taken = Counter()
    for r in mixing.mix(mixing.word_sizes(awkward)).collect():
        taken[r.doc_id, r.source] += r.copies
    mixed = mixing.mixed_documents(awkward)
    assert mixed.columns == awkward.columns
    assert Counter((r.doc_id, r.source) for r in mixed.collect()) == +taken


def test_operators_stay_in_the_engine(awkward):
    for df in (quality.judge(awkward), quality.keep(awkward), mixing.mix(mixing.word_sizes(awkward))):
        text = df._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", text)
    assert quality.judge(awkward).where(F.col("n_words") < 0).count() == 0
