"""Quality rules as a short-circuit cascade.

A rule rejects a text by one comparison of its measures. All rules form one
``CASE``: the first that rejects ends it, so a text pays only for the rules up
to that one. Their order is chosen on a sample: each rule's cost is timed, its
rejections among the texts that the rules before it leave are counted, and the
rule with the most rejections per second goes next. The order changes the work
and the reported rule, never whether a text is kept.

Everything is a row-wise expression: no shuffle, no Python, one pass over the
table.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortia.session import staged

# Fixed values of the word, symbol and window definitions.
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 5


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body with value computed once, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeated_words(words: Column) -> Column:
    """Words in windows of five that the text holds twice or more."""

    def covered(windows: Column) -> Column:
        ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            def has_equal(x, k):
                return F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(
                    F.get(s, k + 1)["h"] == x["h"], F.lit(False)
                )

            return F.sort_array(F.transform(F.filter(s, has_equal), lambda x: x["i"]))

        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        step = lambda a, i: F.struct(
            (a["n"] + i + WINDOW - F.greatest(a["end"], i)).alias("n"), (i + WINDOW).alias("end")
        )
        return F.aggregate(let(ordered, twice), start, step, lambda a: a["n"])

    pair = lambda a, b: F.xxhash64(a, b)
    shifted = lambda a, by: F.slice(a, F.lit(by + 1), F.size(a))
    of_four = lambda h: let(
        F.zip_with(h, shifted(h, 1), pair), lambda two: F.zip_with(two, shifted(two, 2), pair)
    )
    hashes = let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda h: F.slice(F.zip_with(of_four(h), shifted(h, WINDOW - 1), pair), F.lit(1), F.size(h) - WINDOW + 1),
    )
    some = let(
        hashes, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w))
    )
    return F.when(F.size(words) > WINDOW, some).otherwise(F.lit(0)).cast("long")


def measures(text: Column, words: Column) -> dict[str, Column]:
    """What rules compare, as expressions over a text that is never null and its words."""
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, SYMBOL, ""))).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": _repeated_words(words),
        "n_letter_words": F.size(F.filter(words, lambda w: w.rlike(r"\p{L}"))).cast("long"),
        "n_stutters": F.size(F.filter(words, lambda w, k: F.get(words, k - 1) == w)).cast("long"),
    }


@dataclass(frozen=True)
class Rule:
    """``rejects`` maps the measures, by name, to a condition that is never null."""

    name: str
    rejects: Callable[[dict[str, Column]], Column]


BASE_RULES = (
    Rule("few_words", lambda m: m["n_words"] < 10),
    Rule("repeated_words", lambda m: 100 * m["n_repeat_words"] > 20 * m["n_words"]),
)
RULES = (
    *BASE_RULES,
    Rule("symbols", lambda m: 10 * m["n_symbols"] > m["n_words"]),
    Rule("repeated_lines", lambda m: 100 * m["n_dup_lines"] > 40 * m["n_lines"]),
    Rule("no_letters", lambda m: 100 * m["n_letter_words"] < 55 * m["n_words"]),
    Rule("stutters", lambda m: 100 * m["n_stutters"] > 30 * m["n_words"]),
    Rule("long_words", lambda m: m["word_chars"] > 20 * m["n_words"]),
)

TEXT, WORDS, VERDICT = "_quality_text", "_quality_words", "_quality_verdict"


def _with_words(docs: DataFrame, text_col: str) -> DataFrame:
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return docs.withColumn(TEXT, text).withColumn(WORDS, F.regexp_extract_all(F.col(TEXT), F.lit(WORD), F.lit(0)))


def order_rules(docs: DataFrame, text_col: str = "text", rules=RULES, sample_rows: int = 1000) -> list[Rule]:
    """The rules by rejections per second among the texts that earlier ones leave.

    Costs and rejections come from about sample_rows rows, at most twice as
    many. An empty table leaves the order as it is; ties keep it too.
    """
    total = docs.count()
    if not total:
        return list(rules)
    texts = docs.select(docs[text_col].cast("string").alias("text"))
    picked = texts.sample(min(1.0, sample_rows / total), seed=17).limit(2 * sample_rows)
    sample = _with_words(staged(picked.coalesce(1), "quality-sample"), "text")
    known = measures(F.col(TEXT), F.col(WORDS))

    def seconds(condition: Column) -> float:
        start = time.perf_counter()
        sample.select(F.count_if(condition)).collect()
        return time.perf_counter() - start

    seconds(F.size(WORDS) > 0)
    without = seconds(F.size(WORDS) > 0)
    cost = {rule.name: max(seconds(rule.rejects(known)) - without, 1e-3) for rule in rules}
    flags = sample.select(*[rule.rejects(known).alias(f"r{k}") for k, rule in enumerate(rules)])
    outcomes = flags.groupBy(*flags.columns).count().collect()  # at most a row per sampled text
    left, ordered = list(outcomes), []
    remaining = list(enumerate(rules))
    while remaining:
        best = max(remaining, key=lambda r: sum(o["count"] for o in left if o[f"r{r[0]}"]) / cost[r[1].name])
        remaining.remove(best)
        ordered.append(best[1])
        left = [o for o in left if not o[f"r{best[0]}"]]
    return ordered


def cascade(rules: list[Rule], known: dict[str, Column]) -> Column:
    """Name of the first rule that rejects, or null."""
    verdict = F
    for rule in rules:
        verdict = verdict.when(rule.rejects(known), F.lit(rule.name))
    return verdict.otherwise(F.lit(None).cast("string"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """A row per document: its id, all measures, and ``rejected_by``, the rule that rejects it or null.

    A null text has no words and lines, as has an empty one. Rows that repeat
    are judged each for itself. Other columns of docs are ignored, whatever
    their names.
    """
    narrow = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    ordered = order_rules(narrow, "text", rules)
    known = measures(F.col(TEXT), F.col(WORDS))
    measured = _with_words(narrow, "text").select("doc_id", *[c.alias(name) for name, c in known.items()])
    columns = {name: F.col(name) for name in known}
    return measured.withColumn("rejected_by", cascade(ordered, columns))


def keep(docs: DataFrame, text_col: str = "text", rules=RULES) -> DataFrame:
    """The rows whose text no rule rejects, with their columns as they were.

    Measures are computed only up to the rule that rejects. Null and empty texts
    are rejected by the rule on few words, if it is among the rules.
    """
    ordered = order_rules(docs, text_col, rules)
    verdict = cascade(ordered, measures(F.col(TEXT), F.col(WORDS)))
    # a generator, as a filter on the verdict would be evaluated with the words it depends on, once for every word
    passed = F.explode(F.when(verdict.isNull(), F.array(F.lit(1))).otherwise(F.array().cast("array<int>")))
    judged = _with_words(docs, text_col).select("*", passed.alias(VERDICT))
    return judged.select(*[F.col(f"`{c}`") for c in docs.columns])
