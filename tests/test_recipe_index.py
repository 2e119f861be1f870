"""Labels through the inverted index equal those of the expressions."""

import random
import time

import pytest
from pyspark.sql import functions as F
from tests.conftest import day, rows

from cohortia import schemas
from cohortia.operators.recipe_index import RecipeIndex, label_rows
from cohortia.operators.recipes import (
    Behavior, ColumnAsTarget, Dataset, MatchesAllExcept, MatchesAny, MatchesPercentage, label_users,
)

GROUPS = ["g0", "g1", "g2", "7", None]
ASPECTS = ["{}", '{"age":"30"}', '{"age":30}', '{"age":41.5}', '{"ok":true}', '{"age":"x"}', None, "not json"]


@pytest.fixture(scope="module")
def targets(spark):
    rnd = random.Random(5)
    data = [
        (
            f"u{rnd.randrange(60)}", day("2021-01-31"), rnd.choice(["ncs", "dfp", "adobe"]), rnd.choice(["a", "b", None]),
            rnd.choice(GROUPS), rnd.choice(ASPECTS), rnd.choice([0.0, -0.0, 1.0, 0.1, 2.5, float("nan"), None]),
        )
        for _ in range(400)
    ]
    return spark.createDataFrame(data, schemas.TARGETS)


def random_behavior(rnd):
    attributes, aspects = {}, {}
    general = rnd.random() < 0.4
    for name, values in {
        "vendor": ["ncs", "dfp", "adobe", "none"], "source": ["a", "b", None], "group": ["g0", "g1", "g2", 7, None],
        "value": [0, 1, 0.1, 2.5, None, float("nan")],
    }.items():
        if rnd.random() < 0.45:
            attributes[name] = rnd.choice(values)
    if not attributes:
        attributes["group"] = "g1"
    if general and rnd.random() < 0.6:
        attributes["value"] = {"value": rnd.choice([0, 1, 0.1]), "direction": rnd.choice(["greater_than", "less_than"])}
    if rnd.random() < 0.3:
        values = [30, "30", 41.5, "x"]
        if general:
            values.append({"value": 30, "direction": rnd.choice(["greater_than", "less_than"])})
        aspects["age"] = rnd.choice(values)
    elif rnd.random() < 0.2:
        aspects["ok"] = rnd.choice([True, "true"])
    return Behavior(attributes, aspects, general)


def random_class(rnd):
    inner = [MatchesAny([random_behavior(rnd)])] if rnd.random() < 0.2 else []
    return MatchesAny([random_behavior(rnd) for _ in range(rnd.randrange(1, 4))], inner)


def as_rows(wide, names):
    """The columns of ``label_users`` as rows."""
    found = []
    for row in wide.collect():
        found += [(row.xid, name, str(row[name])) for name in names if row[name] is not None]
    return sorted(found)


def as_text(long):
    return sorted((r.xid, r.name, str(r.target)) for r in long.select("xid", F.col("name"), "target").collect())


def test_random_recipes_agree_with_expressions(targets):
    rnd = random.Random(11)
    datasets = {}
    for i in range(30):
        if i % 2:
            datasets[f"d{i}"] = Dataset("binary", {"positive": random_class(rnd), "negative": random_class(rnd)})
        else:
            order = rnd.sample(["low", "mid", "top", "x'y"], 3)
            datasets[f"d{i}"] = Dataset("multiclass", {name: random_class(rnd) for name in order})
    index = RecipeIndex(targets.schema)
    taken = [name for name, d in datasets.items() if index.add(name, d)]
    assert len(taken) >= 25
    assert as_text(label_rows(targets, datasets)) == as_rows(label_users(targets, datasets), datasets)


def test_other_logics_go_by_expressions(targets):
    any_of = MatchesAny([Behavior({"vendor": "ncs", "group": "g1"})])
    top = MatchesPercentage(Behavior({"vendor": "dfp"}), 0.3)
    rest = MatchesAllExcept([Behavior({"vendor": "dfp"})], [Behavior({"group": "g2"})])
    bare = MatchesAny([Behavior({"value": {"value": 1, "direction": "greater_than"}}, {}, True)])
    datasets = {
        "plain": Dataset("binary", {"positive": any_of, "negative": MatchesAny([Behavior({"vendor": "adobe"})])}),
        "share": Dataset("binary", {"positive": top, "negative": any_of}),
        "every": Dataset("binary", {"positive": rest, "negative": any_of}),
        "bare": Dataset("binary", {"positive": bare, "negative": any_of}),
    }
    index = RecipeIndex(targets.schema)
    assert [name for name, d in datasets.items() if index.add(name, d)] == ["plain"]
    long = label_rows(targets, datasets)
    assert dict(long.dtypes)["target"] == "int"
    assert as_text(long) == as_rows(label_users(targets, datasets), datasets)
    column = {"c": Dataset("multiclass", column=ColumnAsTarget(Behavior({"vendor": "ncs"}), "group")), **datasets}
    assert as_text(label_rows(targets, column)) == as_rows(label_users(targets, column), column)


def test_faulty_data_sets_are_left_out(targets):
    fine = MatchesAny([Behavior({"group": "g1"})])
    bad = MatchesAny([Behavior({"value": {"value": 1, "direction": "sideways"}, "group": "g1"}, {}, True)])
    datasets = {
        "fine": Dataset("binary", {"positive": fine, "negative": MatchesAny([Behavior({"group": "g2"})])}),
        "direction": Dataset("binary", {"positive": bad, "negative": fine}),
        "half": Dataset("binary", {"positive": fine}),
        "column": Dataset("binary", {"positive": MatchesAny([Behavior({"no_such": 1})]), "negative": fine}),
        "every": Dataset("binary", {"positive": MatchesAllExcept([Behavior({"group": "g1"})], [Behavior({"group": "g2"})]), "negative": fine}),
        "none": None,
    }
    faults = {}
    found = as_text(label_rows(targets, datasets, faults))
    sound = {name: datasets[name] for name in ("fine", "every")}
    assert sorted(faults) == ["column", "direction", "half", "none"]
    assert found == as_rows(label_users(targets, sound), sound)
    with pytest.raises(Exception):
        label_rows(targets, datasets)


def test_empty_tables_and_no_data_sets(spark, targets):
    one = {"d": Dataset("binary", {"positive": MatchesAny([Behavior({"group": "g1"})]),
                                   "negative": MatchesAny([Behavior({"group": "g2"})])})}
    assert rows(label_rows(targets.limit(0), one)) == {}
    assert rows(label_rows(targets, {})) == {}


def test_five_thousand_data_sets_plan_in_seconds_with_one_scan(spark, folder, targets):
    path = f"{folder}/targets"
    targets.write.parquet(path)
    stored = spark.read.parquet(path)
    datasets = {
        f"w{i}": Dataset("binary", {
            "positive": MatchesAny([Behavior({"vendor": "ncs", "group": f"g{i}"}), Behavior({"vendor": "dfp", "group": f"g{i}", "value": 1})]),
            "negative": MatchesAny([Behavior({"vendor": "adobe", "source": "a", "group": f"g{i % 7}"})]),
        })
        for i in range(5000)
    }
    begin = time.time()
    long = label_rows(stored, datasets)
    plan = long._jdf.queryExecution().executedPlan().toString()
    assert time.time() - begin < 20
    assert plan.count("FileScan parquet") == 1
    assert plan.count("Exchange hashpartitioning") == 1
    few = {name: datasets[name] for name in ["w0", "w1", "w2", "w8", "w4000"]}
    got = as_text(long.filter(F.col("name").isin(list(few))))
    assert got == as_rows(label_users(stored, few), few)


def shuffled_rows(df):
    """Rows written by the exchanges of a frame that was run."""
    def below(node):
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return below(node.executedPlan())
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            return below(node.plan())
        some = node.metrics().get("shuffleRecordsWritten")
        children = node.children()
        return (some.get().value() if some.isDefined() else 0) + sum(below(children.apply(i)) for i in range(children.size()))

    return below(df._jdf.queryExecution().executedPlan())


def test_rows_travel_as_bits_not_as_a_row_for_each_data_set(spark):
    """A row that hundreds of data sets ask for is a few words of bits, however its value is bound."""
    data = [
        (f"u{i}", day("2021-01-31"), ["dfp", "adobe", "ncs"][i % 3], "click", "g1", '{"k":"7"}', float(i)) for i in range(90)
    ]
    targets = spark.createDataFrame(data, schemas.TARGETS)
    datasets = {}
    for i in range(300):
        bound = {"value": i // 4, "direction": "greater_than"}
        clicks = Behavior({"vendor": "dfp", "group": "g1", "value": bound}, general=True)
        bought = Behavior({"vendor": "ncs", "group": "g1"}, {"k": str(i // 2)})
        datasets[f"d{i}"] = Dataset("binary", {
            "positive": MatchesAny([bought if i % 2 else clicks]),
            "negative": MatchesAny([Behavior({"vendor": "adobe", "group": "g1"})]),
        })
    long = label_rows(targets, datasets)
    got = as_text(long)
    assert len(got) > 90 * 100
    assert got == as_rows(label_users(targets, datasets), datasets)
    written = label_rows(targets, datasets)
    written.collect()
    assert 0 < shuffled_rows(written) <= 90 * 10


def test_many_classes_aspects_and_missing_ids(spark, targets):
    """More classes than a word has bits, more sets of aspects than are looked up, and rows without an id."""
    names = [f"a{i}" for i in range(12)]
    data = [
        (None if i % 5 == 0 else f"u{i % 7}", day("2021-01-31"), "ncs", "a", f"g{i % 80}", f'{{"a{i % 12}":"{i % 3}"}}', float(i % 9))
        for i in range(400)
    ]
    table = spark.createDataFrame(data, schemas.TARGETS)
    label = [f"c{i * 37 % 80}" for i in range(80)]
    many = {label[i]: MatchesAny([Behavior({"group": f"g{i}"}), Behavior({"group": f"g{i + 1}"})]) for i in range(80)}
    several = {name: many[name] for name in label[:63]}
    falling = {name: many[name] for name in sorted(many, reverse=True)}
    by_hand = {"many": many, "several": several, "falling": falling}
    datasets = {name: Dataset("multiclass", classes) for name, classes in by_hand.items()}
    index = RecipeIndex(table.schema)
    assert all(index.add(name, d) for name, d in datasets.items())
    expected = {}
    for xid, *_, group, _, _ in data:  # the first class that has the group, and of a user's the largest
        for name, classes in by_hand.items():
            first = next((x for x, c in classes.items() if {"group": group} in [b.attributes for b in c.behaviors]), None)
            if first:
                expected[xid, name] = max(first, expected.get((xid, name), ""))
    others = {}
    for name in names:
        bound = {"value": 4, "direction": "less_than"}
        others[name] = Dataset("multiclass", {
            "low": MatchesAny([Behavior({"vendor": "ncs"}, {name: "1"}), Behavior({"vendor": "ncs", "value": bound}, {name: "0"}, True)]),
            "high": MatchesAny([Behavior({"vendor": "ncs"}, {name: "0"})]),
        })
    for row in label_users(table, others).collect():
        expected |= {(row.xid, name): row[name] for name in others if row[name] is not None}
    got = label_rows(table, {**datasets, **others}).select("xid", "name", "target").collect()
    assert len(got) == len(expected)
    assert {(xid, name): target for xid, name, target in got} == expected
    assert any(row.xid is None for row in got)


def test_a_data_set_without_classes_labels_nobody(targets):
    plain = {"d": Dataset("binary", {"positive": MatchesAny([Behavior({"group": "g1"})]),
                                     "negative": MatchesAny([Behavior({"group": "g2"})])})}
    found = as_text(label_rows(targets, {"bare": Dataset("multiclass", {}), **plain}))
    assert found and found == as_text(label_rows(targets, plain))
