"""Near duplicates against all pairs."""

import random
import re

import pytest

from cohortia.llm import graphs, minhash
from cases import TEXTS


def brute(docs, shingle, percent):
    def shingles(text):
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", lower)
        return {tuple(w[i : i + shingle]) for i in range(max(len(w) - shingle + 1, 1))} if w else set()

    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    root[find(a)] = find(b)
    groups = {}
    for k, (doc_id, _) in enumerate(docs):
        groups.setdefault(find(k), []).append(doc_id)
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return sorted(((docs[k][0], len(sets[k]), least[find(k)]) for k in range(len(docs))), key=repr)


def found(df, **how):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in minhash.near_duplicates(df, **how).collect()), key=repr)


def made(seed):
    """Chains, hubs and copies: texts that differ from a common one in a few words."""
    r = random.Random(seed)
    rows = []
    for _ in range(6):
        base = [f"w{r.randint(0, 10_000)}" for _ in range(r.choice([4, 40, 120, 400]))]
        for _ in range(r.randint(1, 40)):
            words = list(base)
            for _ in range(r.randint(0, 6)):
                words[r.randrange(len(words))] = f"x{r.randint(0, 10_000)}"
            rows.append(" ".join(words).title() if r.random() < 0.2 else " ".join(words))
            if r.random() < 0.3:
                base = words
    rows += rows[:7]
    r.shuffle(rows)
    return list(enumerate(rows, 100))


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("chunk", [1024, 5])
def test_made_texts(spark, monkeypatch, seed, chunk):
    monkeypatch.setattr(minhash, "CHUNK", chunk)
    rows = made(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(df, shingle=3, percent=85, tuples=8) == brute(rows, 3, 85)
    assert found(df) == brute(rows, 5, 80)


def test_awkward_rows(awkward):
    assert found(awkward) == brute([(i, t) for i, t, *_ in TEXTS], 5, 80)


def test_nothing(nothing):
    assert found(nothing) == []
    assert minhash.one_of_each(nothing).columns == nothing.columns


def test_one_of_each_keeps_columns_and_every_group(awkward):
    kept = minhash.one_of_each(awkward)
    assert kept.columns == awkward.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [-3, 1, 4, 5, 6, 7, 8, 10, 12]  # 2, 3 and -3 share a passage that is nearly all of them


def test_one_of_each_decides_by_row(spark):
    t, u, v = ("one two three four five six seven", "a text of its own that no other row has", "copies of rows that have no id at all")
    rows = [(3, t, "x"), (5, t, "x"), (5, u, "x"), (6, u, "x"), (None, v, "x"), (None, v, "y"), (None, t, "x"), (7, None, "x"), (7, "", "x"),
            (8, v + " but longer by far than that one was", "z"), (8, v + " but longer by far than that one was", "z")]
    kept = minhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=repr) == sorted(
        [(3, t), (5, u), (None, v), (7, None), (7, ""), (8, rows[-1][1])], key=repr
    )


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(50)] + [(1000, k) for k in range(1001, 1100)]
    labels = graphs.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.root for r in labels if r.node < 100} == {0} and {r.root for r in labels if r.node > 100} == {1000}
    assert graphs.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("run", [minhash.near_duplicates, minhash.one_of_each])
def test_rows_of_tables_are_not_broadcast(spark, monkeypatch, run):
    """Each node has a row a table, which Spark's estimate leaves out."""
    plans = []

    def noted(edges):
        plans.append(edges._jdf.queryExecution().executedPlan().toString())
        return graphs.components(edges)

    monkeypatch.setattr(minhash, "components", noted)
    rows = made(5)[:40]
    assert run(spark.createDataFrame(rows, "doc_id long, text string")).count() > 0
    assert "Generate posexplode" in plans[0] and "Broadcast" not in plans[0]
