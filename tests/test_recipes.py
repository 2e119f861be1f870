"""Recipe parsing, round trips and label semantics."""

import pytest
from pyspark.sql import functions as F
from tests.conftest import day, rows

from cohortia import schemas
from cohortia.errors import InsufficientData, InvalidDefinition
from cohortia.operators import recipe_defaults as defaults
from cohortia.operators import requirements as req
from cohortia.operators.recipes import (
    Behavior, ColumnAsTarget, Dataset, MatchesAllExcept, MatchesAny, MatchesAnyWithout, MatchesPercentage,
    TargetClass, any_behavior, label_one, label_users,
)

D = day("2021-01-31")


@pytest.fixture(scope="module")
def targets(spark):
    data = [
        ("a", D, "ncs", "custom", "g1", '{"age":"30"}', 1.0),
        ("a", D, "ncs", "custom", "g2", '{"age":"x"}', 0.0),
        ("b", D, "ncs", "custom", "g1", "{}", 0.0),
        ("b", D, "dfp", "clicks", "7", '{"age":30}', 1.0),
        ("c", D, "dfp", "clicks", "8", '{"age":41.5}', None),
        ("c", D, "adobe", None, "9", "{}", 1.0),
        ("d", D, "adobe", "mcid", "9", "{}", 1.0),
    ]
    return spark.createDataFrame(data, schemas.TARGETS)


def users(df, condition):
    return sorted(r.xid for r in df.filter(condition).select("xid").distinct().collect())


def test_behavior_tests_attributes_nulls_and_aspects(targets):
    def found(recipe):
        return users(targets, Behavior.from_dict(recipe).condition(targets.schema))

    assert found({"vendor": "ncs", "group": "g1", "value": 1}) == ["a"]
    assert found({"vendor": "adobe", "source": None}) == ["c"]
    assert found({"vendor": "dfp", "group": 7}) == ["b"]  # number against a text column
    assert found({"vendor": "ncs", "aspect": {"age": 30}}) == ["a"]
    assert found({"vendor": "dfp", "aspect": {"age": "30"}}) == ["b"]


def test_general_behavior_bounds_are_inclusive_and_skip_bad_numbers(targets):
    def found(**recipe):
        condition = Behavior.from_dict({"logic": "general_behavior", **recipe}).condition(targets.schema)
        return users(targets, condition)

    assert found(aspect={"age": {"value": 30, "direction": "greater_than"}}) == ["a", "b", "c"]
    assert found(aspect={"age": {"value": 30, "direction": "less_than"}}) == ["a", "b"]
    assert found(value={"value": 0, "direction": "less_than"}) == ["a", "b"]
    with pytest.raises(InvalidDefinition):
        found(value={"value": 0, "direction": "sideways"})


@pytest.mark.parametrize("broken", [
    {"args": {}}, {"logic": "matches_any"}, {"logic": "unknown", "args": {}},
    {"logic": "matches_any", "args": {}}, {"logic": "matches_all_except", "args": {"behaviors": []}},
    {"logic": "matches_percentage", "args": {"behavior": {}, "value_col": "value", "percentage": 1}},
    {"logic": "matches_percentage", "args": {"behavior": {}, "value_col": "v", "percentage": 1, "direction": "x"}},
    {"logic": "column_as_target", "args": {"behavior": {}}},
])
def test_broken_recipes_are_refused(broken):
    with pytest.raises(InvalidDefinition):
        TargetClass.from_dict(broken)


def behavior(**kw):
    return {"aspect": {}, **kw}


@pytest.mark.parametrize("recipe", [
    {"logic": "matches_any", "args": {"behaviors": [behavior(vendor="x")], "classes": [
        {"logic": "matches_percentage", "args": {"behavior": behavior(vendor="y"), "value_col": "value",
                                                 "percentage": 0.9, "direction": "less_than"}}]}},
    {"logic": "matches_all_except", "args": {"behaviors": [behavior(vendor="x")], "excluded_behaviors": [behavior(group="g")]}},
    {"logic": "column_as_target", "args": {"behavior": behavior(vendor="x"), "target": "group"}},
    {"logic": "matches_any", "args": {"behaviors": [
        {**behavior(value={"value": 3, "direction": "less_than"}), "logic": "general_behavior"}]}},
])
def test_recipes_round_trip(recipe):
    assert TargetClass.from_dict(recipe).to_dict() == recipe


def boat_owners(value):
    behavior = {"vendor": "custom", "source": "survey_a", "group": "owns_boat", "value": value, "aspect": {}}
    return {"logic": "matches_any", "args": {"behaviors": [behavior]}}


CUSTOM = {
    "family": "binary",
    "classes": {"positive": boat_owners(1), "negative": boat_owners(0)},
    "data_requirements": req.DEFAULTS["binary"],
}


def test_default_custom_recipe():
    made = defaults.dataset_for("custom", source="survey_a", groups=["owns_boat"])
    assert made.to_dict() == CUSTOM
    assert Dataset.from_dict(CUSTOM).to_dict() == CUSTOM


def test_every_vendor_has_a_default():
    for vendor, source in (("ncs", "custom"), ("ncs", "syndicated"), ("adobe", None), ("dfp", None), ("nielsen", "dar")):
        made = defaults.dataset_for(vendor, source, groups=["g"])
        assert Dataset.from_dict(made.to_dict()).to_dict() == made.to_dict()
    assert defaults.dataset_for("own", first_party="own", groups=["g"]).family == "binary"
    with pytest.raises(InvalidDefinition):
        defaults.dataset_for("nobody", groups=["g"])


def test_listed_values_default_to_missing_negatives():
    made = defaults.dataset_for("ncs", "custom", groups=["g"]).to_dict()["classes"]
    assert made["positive"]["args"]["behaviors"][0]["value"] == 1
    assert made["negative"]["args"]["behaviors"][0]["value"] is None
    old = defaults.dataset_for("ncs", "custom", groups=["g"], old=True).to_dict()["classes"]
    assert old["negative"]["args"]["classes"][0]["args"]["percentage"] == 0.1


def binary(positive, negative):
    return Dataset("binary", {"positive": positive, "negative": negative},
                   req.Requirements("binary"))


def test_positive_wins_and_unlabelled_users_are_absent(targets):
    data = binary(MatchesAny([Behavior({"group": "g1", "value": 1})]), MatchesAny([Behavior({"vendor": "ncs"})]))
    assert rows(label_one(targets, data)) == {("a", 1): 1, ("b", 0): 1}
    per_row = targets.select("xid", data.target(targets)).groupBy("xid").agg(F.max("target").alias("t"))
    assert rows(per_row.filter("t IS NOT NULL")) == {("a", 1): 1, ("b", 0): 1}


def test_all_except_needs_every_row_of_the_user(targets):
    recipe = MatchesAllExcept([Behavior({"vendor": "dfp"})], [Behavior({"vendor": "ncs"})])
    flags = targets.groupBy("xid").agg(recipe.compile(targets).user.alias("m"))
    assert rows(flags) == {("a", True): 1, ("b", False): 1, ("c", False): 1, ("d", False): 1}
    data = binary(recipe, MatchesAny([Behavior({"vendor": "adobe"})]))
    assert rows(label_one(targets, data)) == {("a", 1): 1, ("c", 0): 1, ("d", 0): 1}


def test_all_except_consults_behaviors_where_the_test_is_null(targets):
    # the excluded test is NULL for the row without a value
    recipe = MatchesAllExcept([Behavior({"vendor": "dfp"})], [Behavior({"value": 1})])
    flags = targets.filter("xid = 'c'").groupBy("xid").agg(recipe.compile(targets).user.alias("m"))
    assert rows(flags) == {("c", True): 1}


def test_multi_class_takes_the_first_match_per_row_then_the_largest(targets):
    everyone = MatchesAllExcept([Behavior({"vendor": "adobe"})], [Behavior({"vendor": "adobe"})])
    data = Dataset("multiclass", {
        "z_clicks": MatchesAny([Behavior({"vendor": "dfp"})]),
        "only_adobe": everyone,
        "any": MatchesAny([Behavior({"vendor": "ncs"}), Behavior({"vendor": "adobe"})]),
    })
    assert rows(label_one(targets, data)) == {
        ("a", "any"): 1, ("b", "z_clicks"): 1, ("c", "z_clicks"): 1, ("d", "only_adobe"): 1}


def test_column_as_target(targets):
    recipe = {"family": "multiclass", "data_requirements": {"logic": "no_requirements"},
              "logic": "column_as_target", "args": {"behavior": behavior(vendor="ncs"), "target": "group"}}
    data = Dataset.from_dict(recipe)
    assert isinstance(data.column, ColumnAsTarget)
    assert data.to_dict() == recipe
    assert rows(label_one(targets, data)) == {("a", "g2"): 1, ("b", "g1"): 1}


def test_many_recipes_equal_each_recipe_alone(targets):
    recipes = {
        "x": binary(MatchesAny([Behavior({"group": "g1", "value": 1})]), MatchesAny([Behavior({"vendor": "ncs"})])),
        "y": binary(MatchesAny([Behavior({"vendor": "dfp"})]), MatchesAny([Behavior({"vendor": "adobe"})])),
    }
    together = label_users(targets, recipes)
    for name, data in recipes.items():
        alone = together.select("xid", name).filter(F.col(name).isNotNull())
        assert rows(alone) == rows(label_one(targets, data))


def test_percentage_inside_matches_any(spark):
    data = [(f"u{i}", D, "ncs", "custom", "g", "{}", float(i)) for i in range(100)]
    many = spark.createDataFrame(data, schemas.TARGETS)
    labels = label_one(many, defaults.by_percentile(["g"]))
    found = {r.xid: r.target for r in labels.collect()}
    assert found == {**{f"u{i}": 1 for i in range(94, 100)}, **{f"u{i}": 0 for i in range(10)}}
    assert MatchesPercentage(Behavior({"vendor": "none"}), 0.5).mask(many) is not None


def test_requirements():
    wanted = req.Requirements.from_dict({"logic": "min_max_provided", "min_positive": 5, "min_negative": 5,
                                         "max_positive": 10, "max_negative": 20}, "binary")
    assert wanted.check({1: 5, 0: 9}) == {"positive": 5, "negative": 9}
    assert wanted.ratios({1: 40, 0: 20}) == {1: 0.25, 0: 1.0}
    for counts in ({1: 4, 0: 9}, {1: 9}, {0: 9}, {None: 1, 1: 9, 0: 9}):
        with pytest.raises(InsufficientData):
            wanted.check(counts)
    multi = req.Requirements.from_dict({"logic": "min_max_provided", "max_a": 5}, "multiclass")
    assert multi.ratios({"a": 10, "b": 3}) == {"a": 0.5, "b": 1.0}  # limits apply to named classes too
    with pytest.raises(InvalidDefinition):
        req.Requirements.from_dict({"logic": "something"}, "binary")


def test_sampling_is_the_same_on_any_layout(spark):
    df = spark.range(4000).select(F.md5(F.col("id").cast("string")).alias("xid"), (F.col("id") % 2).cast("int").alias("target"))
    wanted = req.Requirements.from_dict({"logic": "min_max_provided", "max_positive": 300, "max_negative": 9999}, "binary")
    one, counts = wanted.meet(df.repartition(1))
    many, _ = wanted.meet(df.repartition(9))
    assert counts == {"positive": 2000, "negative": 2000}
    assert rows(one) == rows(many)
    kept = rows(one.groupBy("target").count())
    assert kept[(0, 2000)] == 1 and 240 < one.filter("target = 1").count() < 360


def test_wide_recipes_and_many_workflows_plan(targets):
    wide = defaults.dataset_for("adobe", groups=range(10_000))
    assert label_one(targets, wide).count() == 2
    many = {f"w{k}": defaults.dataset_for("adobe", groups=range(k, k + 50)) for k in range(200)}
    assert label_users(targets, many).count() == 2


def test_folded_behaviors_equal_single_ones(targets):
    recipes = [
        {"vendor": "ncs", "group": "g1"}, {"vendor": "ncs", "group": "g2"}, {"vendor": "ncs", "group": None},
        {"vendor": "dfp", "group": 7}, {"vendor": "adobe", "source": None}, {"vendor": "ncs", "aspect": {"age": 30}},
        {"vendor": "ncs", "aspect": {"age": "x"}}, {"vendor": "ncs", "aspect": {"age": "y"}},
        {"vendor": "it's \\ quoted"}, {"value": 1.0}, {"value": 2.0},
    ]
    behaviors = [Behavior.from_dict(r) for r in recipes]
    each = behaviors[0].condition(targets.schema)
    for behavior in behaviors[1:]:
        each = each | behavior.condition(targets.schema)
    both = targets.select(any_behavior(behaviors, targets.schema).alias("a"), each.alias("b"))
    assert both.where("NOT (a <=> b)").isEmpty()


def test_matches_any_without(targets):
    recipe = {"logic": "matches_any_without", "args": {
        "behaviors": [{"vendor": "ncs", "group": "g1", "aspect": {}}, {"vendor": "dfp", "aspect": {}}],
        "excluded_behaviors": [{"group": "8", "aspect": {}}, {"value": 0.0, "source": "custom", "aspect": {}}]}}
    without = TargetClass.from_dict(recipe)
    assert without.to_dict() == recipe
    matched = targets.groupBy("xid").agg(without.compile(targets).user.alias("m")).where("m")
    assert sorted(r.xid for r in matched.collect()) == []
    assert rows(targets.groupBy("xid").agg(MatchesAnyWithout(without.behaviors, without.behaviors[:0] or [Behavior({"group": "8"})]).compile(targets).user.alias("m")).where("m").select("xid")) == {("a",): 1, ("b",): 1}
