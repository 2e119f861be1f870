"""Chat collapse against brute force, and licence scans on held-out notices."""

import random
import re

import pytest

from cohortia.llm import chat, licenses

SCHEMA = "conv_id long, turn long, role string, text string, place long, n_turns long"


def key(value):
    return (value is not None, value if value is not None else 0)


def brute(rows):
    chats = {}
    for conv, turn, role, text in {r for r in rows if r[0] is not None}:
        chats.setdefault(conv, []).append((turn, role, text))
    lists = {c: tuple((r, x) for _, r, x in sorted(t, key=lambda t: (key(t[0]), (t[1] is not None, t[1] or ""), (t[2] is not None, t[2] or "")))) for c, t in chats.items()}
    out = []
    for c, turns in lists.items():
        same = [d for d, other in lists.items() if other == turns]
        if c != min(same) or any(len(o) > len(turns) and o[: len(turns)] == turns for o in lists.values()):
            continue
        text, spans = "", []
        for role, said in turns:
            text += f"<|{role or ''}|>\n"
            if role == "assistant":
                spans.append((len(text), len(text) + len(said or "")))
            text += (said or "") + "\n"
        out.append((c, len(turns), len(same), text, spans))
    return sorted(out)


def found(spark, rows):
    df = spark.createDataFrame([(*r, 1, 1) for r in rows], SCHEMA)
    kept = chat.format_chats(df).collect()
    return sorted((r.conv_id, r.n_turns, r.n_copies, r.text, [tuple(s) for s in r.loss_spans]) for r in kept)


@pytest.mark.parametrize("seed", range(3))
def test_snapshots_collapse(spark, seed):
    r = random.Random(seed)
    rows, conv = [], 0
    for _ in range(15):
        turns = [(["user", "assistant"][k % 2], f"said {r.randint(0, 3)} é\n") for k in range(r.randint(1, 7))]
        for n in r.sample(range(1, len(turns) + 1), r.randint(1, len(turns))):
            conv += 1
            start = r.choice([0, 1, 10])
            rows += [(conv, start + k, *turn) for k, turn in enumerate(turns[:n])]
    r.shuffle(rows)
    assert found(spark, rows) == brute(rows)


def test_awkward_turns(spark):
    rows = [(1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, 0, "assistant", None), (2, None, None, "x"), (2, None, "x", None),
            (3, 0, None, ""), (4, 0, "", None), (None, 0, "user", "lost"), (5, 0, "user", "hi"), (6, 1, "user", "y" * 100_000),
            (7, 0, None, ""), (8, 0, "assistant", "hi")]
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows[:0]) == []


def test_chats_stay_in_the_engine(spark):
    df = chat.format_chats(spark.createDataFrame([(1, 0, "user", "hi", 1, 1)], SCHEMA))
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", df._jdf.queryExecution().toString())


@pytest.fixture(scope="module")
def scanner(spark):
    r = random.Random(2)
    plain = [(k, "\n".join(" ".join(r.choice("alpha beta gamma of the under this work project released terms".split())
                                    for _ in range(r.randint(2, 20))) for _ in range(5))) for k in range(300)]
    return licenses.train(spark.createDataFrame(plain, "doc_id long, text string"))


HELD_OUT = [
    ("mit", "We publish this package, released under the MIT License, as it is."),
    ("apache", "The code below is licensed under the Apache License, Version 2.0"),
    ("gpl", "Note: this work is licensed under the GNU General Public License, version 2!"),
    ("cc-by-nc", "Text and pictures: licensed under CC BY-NC 3.0."),
    ("cc-by-sa", "All pages are licensed under CC BY-SA 4.0."),
    ("mpl", "This file is subject to the terms of the Mozilla Public License, version 1.1"),
    ("bsd", "This software is distributed under the BSD 3-Clause License by its authors."),
]
NOT_KNOWN = ["All rights reserved by the owner.", "Licensed under the Other Vendor Agreement."]
PLAIN = ["the alpha of this work under the terms of beta", "a project released", "Nothing to see here, move along."]


def test_held_out_notices(spark, scanner):
    lines = [n for _, n in HELD_OUT] + NOT_KNOWN + PLAIN
    docs = spark.createDataFrame([(1, "\n".join(lines), "x")], "doc_id long, text string, family string")
    got = {r.paragraph: r for r in scanner.scan(docs).collect()}
    for k, (family, _) in enumerate(HELD_OUT):
        assert got[k].family == family and got[k].confirmed
    for k in range(len(HELD_OUT), len(HELD_OUT) + len(NOT_KNOWN)):
        assert k not in got or not got[k].confirmed
    assert not [k for k in got if k >= len(HELD_OUT) + len(NOT_KNOWN) and got[k].confirmed]


def test_notices_of_no_family_are_unknown(spark, scanner):
    others = ["All rights reserved.", "Copyright 2019 the authors. All rights reserved.", *NOT_KNOWN, "alpha beta gamma: all rights reserved."]
    docs = spark.createDataFrame([(1, "\n".join(others + PLAIN))], "doc_id long, text string")
    got = {r.paragraph: (r.family, r.confirmed) for r in scanner.scan(docs).collect()}
    assert got == {k: ("unknown", False) for k in range(len(others))}


def test_awkward_texts(spark, scanner):
    long = "word " * 50_000 + "\n" + licenses.TEMPLATES["mit"][0]
    rows = [(1, None, "x"), (2, "", "x"), (None, licenses.TEMPLATES["mit"][0], "x"), (3, "\n\n...\n1 2 3\n", "x"), (4, long, "x"), (4, long, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, family string")
    got = [(r.doc_id, r.paragraph, r.family) for r in scanner.scan(docs).collect() if r.confirmed]
    assert sorted(got, key=repr) == sorted([(4, 1, "mit"), (4, 1, "mit"), (None, 0, "mit")], key=repr)
    assert scanner.scan(docs.where("1 = 0")).count() == 0
    assert licenses.train(docs.where("1 = 0")).cut >= 0.5


def test_scans_stay_in_the_engine(spark, scanner):
    df = scanner.scan(spark.createDataFrame([(1, "x", "x")], "doc_id long, text string, family string"))
    assert not re.search("PythonUDF|BatchEvalPython|ArrowEvalPython|MapInPandas|CartesianProduct", df._jdf.queryExecution().toString())
