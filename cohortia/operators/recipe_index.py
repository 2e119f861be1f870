"""Labels of any number of data sets through an inverted index of their recipes.

One aggregate expression for each data set makes a plan that grows with the data
sets: thousands of them take minutes to analyse.  Here the values that recipes
ask for become a table of postings instead: a row for each combination of values,
with the data sets and classes that ask for it.  Target rows find their postings
by one join for each set of columns that recipes test together, of which there
are few, so the plan has one scan and one shuffle whatever the number of data sets.

A row may belong to hundreds of data sets, so what it finds travels as bits: data
sets asked for by the same values share a word, with a bit for each label, and a
user's words are merged by ``bit_or`` before and after the shuffle.  Labels become
rows of their own after the last merge.  Data sets whose classes do not come in the
order of their labels, or that have more labels than a word has bits, travel alone.
"""

from __future__ import annotations

import json
from collections import Counter
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortia.operators import requirements as req
from cohortia.operators.recipes import (
    DIRECTIONS, ID, Behavior, Dataset, MatchesAny, TargetClass, _is_bound, compiled_labels, find_keys,
)

#: Data sets outside the index that share one pass of ``compiled_labels``.
AT_ONCE = 200
#: Whole numbers below this size are exact as doubles.
EXACT = 1 << 53
#: Bits of a word: a long without its sign.
WORD = 63
#: Sets of columns that may be looked up together with texts in the aspect; each is one more join.
ASPECT_SETS = 8

TEST = pa.struct([
    ("kind", pa.string()), ("name", pa.string()), ("text", pa.string()), ("number", pa.float64()),
])
ENTRY = pa.struct([
    ("word", pa.int32()), ("place", pa.int32()), ("bits", pa.int64()),
    ("tested", pa.list_(pa.struct([("bits", pa.int64()), ("tests", pa.list_(TEST))]))),
])
SLOT = "name: string, mask: bigint, shift: int, labels: array<string>"


class NotIndexed(Exception):
    """A recipe that only an expression can state."""


def _is_number(value) -> bool:
    return isinstance(value, (int, float)) and not isinstance(value, bool)


def _key_kind(kind: T.DataType) -> str | None:
    """The type in which values of a column are looked up."""
    if isinstance(kind, T.StringType):
        return "string"
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return "double"
    return "bigint" if isinstance(kind, T.IntegralType) else None


def _key_value(value, kind: str):
    """A recipe's value as a key, equal to a column's key where the column equals the value."""
    if value is None:
        return None
    if kind == "string":
        return str(value)
    if not _is_number(value) or isinstance(value, int) and abs(value) >= EXACT:
        raise NotIndexed
    if kind == "bigint":
        if value != value or value in (float("inf"), float("-inf")) or value != int(value):
            raise NotIndexed
        return int(value)
    return float(value) + 0.0


def _bound_test(kind: str, name: str, wanted: dict) -> dict:
    value, direction = wanted["value"], wanted["direction"]
    if direction not in DIRECTIONS or not _is_number(value) or abs(value) >= EXACT:
        raise NotIndexed
    return {"kind": f"{kind}_{direction}", "name": name, "text": None, "number": float(value)}


def _aspect_test(name: str, value, general: bool) -> dict:
    path = f"$.{name}"
    if general and _is_bound(value):
        return _bound_test("aspect", path, value)
    if _is_number(value):
        return {"kind": "aspect_number", "name": path, "text": None, "number": float(value)}
    if not isinstance(value, (bool, str)):
        raise NotIndexed
    text = str(value).lower() if isinstance(value, bool) else value
    return {"kind": "aspect_text", "name": path, "text": text, "number": None}


@dataclass
class RecipeIndex:
    """What data sets ask of target rows of one schema.

    ``asked`` has a list for each data set: place and label of a class, the keys to
    look up, their values, and the tests left.  A key is ``("column", name)`` or
    ``("aspect", path)``.
    """

    schema: T.StructType
    names: list[str] = field(default_factory=list)
    asked: list[list[tuple]] = field(default_factory=list)
    aspect_sets: set[tuple] = field(default_factory=set)

    def _posting(self, behavior: Behavior) -> tuple[tuple, tuple, list[dict]]:
        """Keys, their values, and what else a row of these values must pass."""
        key, tests = {}, []
        for name, value in behavior.attributes.items():
            kind = _key_kind(self.schema[name].dataType) if name in self.schema.names else None
            if kind is None:
                raise NotIndexed
            if behavior.general and _is_bound(value):
                if kind == "string":
                    raise NotIndexed
                tests.append(_bound_test("column", name, value))
            else:
                key["column", name] = _key_value(value, kind)
        if not key:
            raise NotIndexed  # every row would have to try it
        parts = [_aspect_test(name, value, behavior.general) for name, value in behavior.aspects.items()]
        texts = {("aspect", test["name"]): test["text"] for test in parts if test["kind"] == "aspect_text"}
        together = tuple(sorted({**key, **texts}))
        if texts and (together in self.aspect_sets or len(self.aspect_sets) < ASPECT_SETS):
            self.aspect_sets.add(together)
            key.update(texts)
            parts = [test for test in parts if test["kind"] != "aspect_text"]
        columns = tuple(sorted(key))
        return columns, tuple(key[c] for c in columns), tests + parts

    def _behaviors(self, target_class: TargetClass) -> list[Behavior]:
        if type(target_class) is not MatchesAny or not (target_class.behaviors or target_class.classes):
            raise NotIndexed
        inner = [b for c in target_class.classes for b in self._behaviors(c)]
        return target_class.behaviors + inner

    def add(self, name: str, dataset: Dataset) -> bool:
        """Whether the data set could be taken in: row logic over listed values, bounds and aspects."""
        try:
            if dataset.column:
                raise NotIndexed
            found = [
                (place, str(label), *self._posting(behavior))
                for place, (label, target_class) in enumerate(dataset._ordered())
                for behavior in self._behaviors(target_class)
            ]
        except NotIndexed:
            return False
        self.names.append(name)
        self.asked.append(found)
        return True

    def _layout(self) -> tuple[list[list[dict]], dict[tuple, dict[tuple, list[dict]]]]:
        """The data sets of each word, and ``{keys: {values: [entry]}}``.

        A data set's bits are its labels, the largest one lowest.  This holds where the
        first class that matches a row also has the largest label, so that all classes
        may set their bits, and a word has room.  Any other data set has a word of its
        own and no mask: its entries have the class's place, by which a row keeps the
        first one (it is -1 elsewhere), and for bits the label's number from 1, of
        which a user keeps the smallest.
        """
        keys = [{(columns, values) for _, _, columns, values, _ in asked} for asked in self.asked]
        listed = Counter(key for some in keys for key in some)
        order = {key: i for i, key in enumerate(sorted(listed, key=lambda key: (-listed[key], repr(key))))}

        words, used, postings = [], WORD, {}
        # those with the most common keys in common come together
        for number in sorted(range(len(self.names)), key=lambda number: sorted(order[key] for key in keys[number])):
            asked = self.asked[number]
            if not asked:
                continue  # no classes, no labels
            labels = sorted({label for _, label, *_ in asked}, reverse=True)
            ranks = [labels.index(label) for _, label, *_ in asked]
            plain = ranks == sorted(ranks) and len(labels) <= WORD
            if not plain or used + len(labels) > WORD:
                words.append([])
                used = 0
            word, shift = len(words) - 1, used
            used = used + len(labels) if plain else WORD
            mask = ((1 << len(labels)) - 1) << shift if plain else 0
            words[-1].append({"name": self.names[number], "mask": mask, "shift": shift, "labels": labels})
            for rank, (place, _, columns, values, tests) in zip(ranks, asked):
                entries = postings.setdefault(columns, {}).setdefault(values, {})
                held = entries.setdefault((word, -1 if plain else place), {})
                _, bits = held.get(repr(tests), (tests, 0))
                held[repr(tests)] = tests, bits | (1 << (shift + rank) if plain else 1 + rank)

        def entry(word, place, held):
            return {
                "word": word, "place": place, "bits": sum(bits for tests, bits in held if not tests),
                "tested": [{"bits": bits, "tests": tests} for tests, bits in held if tests],
            }

        return words, {
            columns: {
                values: [entry(*at, held.values()) for at, held in entries.items()]
                for values, entries in by_values.items()
            }
            for columns, by_values in postings.items()
        }

    def _key(self, key: tuple) -> tuple[str, Column]:
        """The type of a key and its value in a target row."""
        kind, name = key
        if kind == "aspect":
            return "string", F.get_json_object(self._aspect(), name)
        kind = _key_kind(self.schema[name].dataType)
        return kind, F.col(name).cast(kind)

    def _aspect(self) -> Column:
        return F.col("aspect") if "aspect" in self.schema.names else F.lit(None).cast("string")

    def _table(self, spark, position: int, columns: tuple, by_values: dict) -> DataFrame:
        kinds = {"string": pa.string(), "double": pa.float64(), "bigint": pa.int64()}
        types = [kinds[self._key(key)[0]] for key in columns]
        arrays = [pa.array([values[i] for values in by_values], kind) for i, kind in enumerate(types)]
        # an Arrow table becomes a local relation, whose size Spark knows when it picks the join
        return spark.createDataFrame(pa.table(
            [*arrays, pa.array(list(by_values.values()), pa.list_(ENTRY))],
            names=[*(f"_key_{position}_{i}" for i in range(len(columns))), f"_found_{position}"],
        ))

    def _passes(self, tests: Column, used: set[tuple]) -> Column:
        """Whether a row passes all of an entry's tests, whose kinds and names are among those used."""
        kinds = {kind for kind, _ in used}
        bounded = {name for kind, name in used if kind.startswith("column")}
        numbers = [f.name for f in self.schema if f.name in bounded and _key_kind(f.dataType) in ("double", "bigint")]

        def holds(test: Column) -> Column:
            kind, number = test["kind"], test["number"]
            text = F.call_function("get_json_object", self._aspect(), test["name"])
            value = F.coalesce(
                F.lit(None).cast("double"),
                *[F.when(test["name"] == name, F.col(name).cast("double")) for name in numbers],
            )
            part = text.try_cast("float").cast("double")
            passed = {
                "column_greater_than": value >= number,
                "column_less_than": value <= number,
                "aspect_text": text == test["text"],
                "aspect_number": text.try_cast("double") == number,
                "aspect_greater_than": part >= number,
                "aspect_less_than": part <= number,
            }
            branches = [F.when(kind == k, wanted) for k, wanted in passed.items() if k in kinds]
            return F.coalesce(*branches, F.lit(False))

        return F.forall(tests, holds)

    def labels(self, targets: DataFrame) -> DataFrame:
        """``xid, name, target`` of every labelled user and data set; labels as texts."""
        spark, found = targets.sparkSession, []
        words, postings = self._layout()
        rows = targets
        for position, columns in enumerate(sorted(postings)):
            table = self._table(spark, position, columns, postings[columns])
            same = [self._key(key)[1].eqNullSafe(F.col(f"_key_{position}_{i}")) for i, key in enumerate(columns)]
            rows = rows.join(table, same, "left")
            found.append(F.coalesce(F.col(f"_found_{position}"), F.expr("array()").cast(table.schema[-1].dataType)))
        entries = [entry for by_values in postings.values() for some in by_values.values() for entry in some]
        used = {(t["kind"], t["name"]) for e in entries for held in e["tested"] for t in held["tests"]}

        def bits(entry: Column) -> Column:
            if not used:
                return entry["bits"]
            return F.aggregate(
                entry["tested"], entry["bits"],
                lambda sofar, held: F.when(self._passes(held["tests"], used), sofar.bitwiseOR(held["bits"])).otherwise(sofar),
            )

        met = F.transform(
            F.flatten(F.array(*found)),
            lambda e: F.struct(e["word"].alias("word"), e["place"].alias("place"), bits(e).alias("bits")),
        )
        if any(entry["place"] >= 0 for entry in entries):
            # a row's label in a data set is its first class that matches
            rows = rows.select(ID, F.array_sort(F.filter(met, lambda e: e["bits"] != 0)).alias("met"))
            met = F.filter("met", lambda e, i: (e["place"] < 0) | (i == 0) | (F.get("met", i - 1)["word"] != e["word"]))
        # the outer form, without a filter on the size that would state the tests twice
        hits = rows.select(ID, F.inline_outer(met)).filter(F.col("bits") != 0)
        best = hits.groupBy(ID, "word").agg(F.bit_or("bits").alias("bits"), F.min("bits").alias("least"))
        slots = F.from_json(F.lit(json.dumps(words)), f"array<array<struct<{SLOT}>>>")
        best = best.select(ID, "bits", "least", F.explode(F.get(slots, F.col("word"))).alias("slot"))
        mask = F.col("slot.mask")
        own = F.col("bits").bitwiseAND(mask)
        # the lowest bit is the largest label
        rank = F.bit_count(own.bitwiseAND(-own) - 1) - F.col("slot.shift")
        rank = F.when(mask == 0, F.col("least").cast("int") - 1).otherwise(rank)
        return best.filter((own != 0) | (mask == 0)).select(
            ID, F.col("slot.name").alias("name"), F.get(F.col("slot.labels"), rank).alias("target")
        )


def _long(wide: DataFrame, names: list[str]) -> DataFrame:
    entries = [F.struct(F.lit(n).alias("name"), F.col(f"`{n}`").cast("string").alias("target")) for n in names]
    return wide.select(ID, F.inline(F.array(*entries))).filter("target IS NOT NULL")


def label_type(schema: T.StructType, datasets: dict[str, Dataset]) -> str:
    """The type that labels of all data sets have, or text where they differ."""

    def kind(dataset: Dataset) -> str:
        if dataset.column:
            return schema[dataset.column.target].dataType.simpleString()
        return "int" if dataset.family == req.BINARY else "string"

    kinds = {kind(dataset) for dataset in datasets.values()}
    return kinds.pop() if len(kinds) == 1 else "string"


def label_rows(targets: DataFrame, datasets: dict[str, Dataset], faults: dict | None = None) -> DataFrame:
    """``xid, name, target``: the label of every user in every data set that labels it.

    The same labels as ``recipes.label_users`` has in its columns, as rows.  Labels
    are texts where the data sets differ in the type of their labels.  Recipes that
    need all rows of a user, a percentage, a column's value, or no listed value at
    all are stated as expressions, in passes of ``AT_ONCE``.  A data set that does
    not compile raises, or is left out and its exception put into ``faults``.
    Without data sets there are no rows.
    """
    index, others, compiled = RecipeIndex(targets.schema), {}, {}

    def tried(name, step):
        try:
            return step()
        except Exception as fault:
            if faults is None:
                raise
            faults[name] = fault

    for name, dataset in datasets.items():
        if tried(name, lambda: index.add(name, dataset)) is False:
            others[name] = dataset
    try:
        keys = find_keys(targets, [share for d in others.values() for share in d.shares()])
    except Exception:
        if faults is None:
            raise
        keys = None  # some recipe is faulty: each finds its own
    for name, dataset in others.items():
        label = tried(name, lambda: dataset.user_label(targets, keys))
        if label:
            compiled[name] = label
    parts = [index.labels(targets)] if index.names else []
    names = list(compiled)
    for begin in range(0, len(names), AT_ONCE):
        some = {name: compiled[name] for name in names[begin : begin + AT_ONCE]}
        try:
            wide = compiled_labels(targets, some)
        except Exception:  # a recipe may name a column that the targets lack
            if faults is None:
                raise
            some = {n: c for n, c in some.items() if tried(n, lambda: compiled_labels(targets, {n: c}))}
            if not some:
                continue
            wide = compiled_labels(targets, some)
        parts.append(_long(wide, list(some)))
    kind = label_type(targets.schema, {name: d for name, d in datasets.items() if name not in (faults or {})})
    if not parts:
        return targets.sparkSession.createDataFrame([], f"{ID} string, name string, target {kind}")
    rows = reduce(DataFrame.unionByName, parts)
    return rows.withColumn("target", F.col("target").cast(kind))
