"""Label recipes: dictionaries that compile to Spark columns.

A recipe says which target rows make a user positive or negative.  Each class
compiles to two optional columns:

* ``row``  - a boolean per target row;
* ``user`` - a boolean aggregate over all rows of one user.

A row belongs to the class when either holds.  Labels of many recipes are then
plain aggregates of one ``groupBy("xid")``: one scan, partial aggregation, and
no window over a user's rows, so a user with very many rows costs nothing extra.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortia import schemas
from cohortia.errors import InvalidDefinition
from cohortia.functions.aspects import all_of, any_of, aspect_value
from cohortia.operators import requirements as req
from cohortia.operators.ranking import Edge, beyond, boundary_keys

ID = "xid"
DIRECTIONS = ("greater_than", "less_than")


def _need(args: dict, *keys: str) -> list:
    for key in keys:
        if key not in args:
            raise InvalidDefinition(f"recipe lacks {key!r}: {args}")
    return [args[key] for key in keys]


def _is_bound(value) -> bool:
    return isinstance(value, dict) and {"value", "direction"} <= set(value)


def _compare(column: Column, value, direction: str) -> Column:
    if direction not in DIRECTIONS:
        raise InvalidDefinition(f"direction must be one of {DIRECTIONS}")
    return column >= value if direction == "greater_than" else column <= value


def _literal(name: str, value, schema: T.StructType) -> Column:
    """Literal in the column's own type: ANSI mode refuses ``string = int``."""
    kind = schema[name].dataType if name in schema.names else None
    if isinstance(kind, T.StringType):
        return F.lit(str(value))
    if isinstance(kind, T.DateType):
        return F.lit(value).cast("date")
    return F.lit(value)


def _is_one_of(name: str, values: list, schema: T.StructType) -> Column:
    """Texts go over as one expression: a call for each of thousands of literals takes seconds."""
    if name in schema.names and isinstance(schema[name].dataType, T.StringType):
        texts = (str(value).replace("\\", "\\\\").replace("'", "\\'") for value in values)
        return F.expr(f"`{name}` IN ({', '.join(f"'{text}'" for text in texts)})")
    return F.col(name).isin([_literal(name, value, schema) for value in values])


def _aspect_equals(name: str, value) -> Column:
    text = aspect_value(name)
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return text.try_cast("double") == F.lit(float(value))
    return text == F.lit(str(value).lower() if isinstance(value, bool) else value)


@dataclass
class Behavior:
    """All attribute and aspect conditions hold; ``None`` means IS NULL.

    A value may also be ``{"value": v, "direction": "greater_than"|"less_than"}``
    (inclusive bounds) when the behaviour is ``general``.
    """

    attributes: dict = field(default_factory=dict)
    aspects: dict = field(default_factory=dict)
    general: bool = False

    @classmethod
    def from_dict(cls, recipe: dict) -> Behavior:
        attributes = {k: v for k, v in recipe.items() if k != "aspect"}
        general = attributes.get("logic") == "general_behavior"
        if general:
            attributes.pop("logic")
        return cls(attributes, dict(recipe.get("aspect", {})), general)

    def to_dict(self) -> dict:
        recipe = {"aspect": dict(self.aspects), **self.attributes}
        return {**recipe, "logic": "general_behavior"} if self.general else recipe

    def _attribute(self, name, value, schema) -> Column:
        if value is None:
            return F.col(name).isNull()
        if self.general and _is_bound(value):
            return _compare(F.col(name), _literal(name, value["value"], schema), value["direction"])
        return F.col(name) == _literal(name, value, schema)

    def _aspect(self, name, value) -> Column:
        if self.general and _is_bound(value):
            number = aspect_value(name).try_cast("float")
            return _compare(number, F.lit(float(value["value"])), value["direction"])
        return _aspect_equals(name, value)

    def condition(self, schema=schemas.TARGETS) -> Column:
        tests = [self._attribute(k, v, schema) for k, v in self.attributes.items()]
        tests += [self._aspect(k, v) for k, v in self.aspects.items()]
        if not tests:
            raise InvalidDefinition("a behavior needs at least one condition")
        return all_of(tests)


def any_behavior(behaviors: list[Behavior], schema=schemas.TARGETS) -> Column:
    """Whether any behaviour holds.

    Behaviours that differ in one value alone become one ``IN``, whose cost does
    not grow with the number of values: real recipes list thousands of groups.
    """

    def parts(behavior: Behavior) -> dict:
        found = {("attribute", name): value for name, value in behavior.attributes.items()}
        return found | {("aspect", name): value for name, value in behavior.aspects.items()}

    def listable(key, value) -> bool:
        number = isinstance(value, (int, float)) and not isinstance(value, bool)
        return not (value is None or isinstance(value, (dict, list)) or key[0] == "aspect" and number)

    def apart(key) -> dict:
        """Behaviours by all but their value for key."""
        groups: dict = {}
        for behavior in behaviors:
            values = parts(behavior)
            one = key in values and listable(key, values[key])
            rest = {k: repr(v) for k, v in values.items() if not (one and k == key)}
            groups.setdefault((one, behavior.general, frozenset(rest.items())), []).append(behavior)
        return groups

    keys = dict.fromkeys(key for behavior in behaviors for key in parts(behavior))
    if len(behaviors) < 2 or not keys:
        return any_of([behavior.condition(schema) for behavior in behaviors])
    kind, name = key = min(keys, key=lambda key: len(apart(key)))
    conditions = []
    for (one, general, _), alike in apart(key).items():
        if not one or len(alike) == 1:
            conditions += [behavior.condition(schema) for behavior in alike]
            continue
        rest = Behavior(dict(alike[0].attributes), dict(alike[0].aspects), general)
        values = [(b.attributes if kind == "attribute" else b.aspects)[name] for b in alike]
        if kind == "attribute":
            del rest.attributes[name]
            member = _is_one_of(name, values, schema)
        else:
            del rest.aspects[name]
            member = aspect_value(name).isin([str(v).lower() if isinstance(v, bool) else v for v in values])
        conditions.append(rest.condition(schema) & member if rest.attributes or rest.aspects else member)
    return any_of(conditions)


@dataclass
class Membership:
    """Compiled class: a row is a member when ``row`` or ``user`` holds."""

    row: Column | None = None
    user: Column | None = None


class TargetClass:
    """One side of a recipe; subclasses register under their ``logic`` name."""

    logic: str
    kinds: dict[str, type[TargetClass]] = {}

    def __init_subclass__(cls, **kwargs):
        super().__init_subclass__(**kwargs)
        TargetClass.kinds[cls.logic] = cls

    @staticmethod
    def from_dict(recipe: dict) -> TargetClass:
        logic, args = _need(recipe, "logic", "args")
        if logic not in TargetClass.kinds:
            raise InvalidDefinition(f"logic must be one of {sorted(TargetClass.kinds)}")
        return TargetClass.kinds[logic].from_args(args)

    def to_dict(self) -> dict:
        return {"logic": self.logic, "args": self.args()}

    def args(self) -> dict:
        raise NotImplementedError

    @classmethod
    def from_args(cls, args: dict) -> TargetClass:
        raise NotImplementedError

    def shares(self) -> list[MatchesPercentage]:
        """Percentage classes at or below this one."""
        return []

    def compile(self, targets: DataFrame, keys: dict | None = None) -> Membership:
        """``keys`` holds boundaries that were found beforehand, see ``find_keys``."""
        raise NotImplementedError

    def mask(self, targets: DataFrame) -> Column:
        """Row-level condition, where the class has one."""
        membership = self.compile(targets)
        if membership.user is not None:
            raise InvalidDefinition(f"{self.logic} depends on all rows of a user")
        return membership.row


@dataclass
class MatchesAny(TargetClass):
    """Any behaviour or any inner class matches."""

    logic = "matches_any"
    behaviors: list[Behavior] = field(default_factory=list)
    classes: list[TargetClass] = field(default_factory=list)

    @classmethod
    def from_args(cls, args):
        (behaviors,) = _need(args, "behaviors")
        return cls(
            [Behavior.from_dict(b) for b in behaviors],
            [TargetClass.from_dict(c) for c in args.get("classes", [])],
        )

    def args(self):
        args = {"behaviors": [b.to_dict() for b in self.behaviors]}
        if self.classes:
            args["classes"] = [c.to_dict() for c in self.classes]
        return args

    def shares(self):
        return [share for c in self.classes for share in c.shares()]

    def compile(self, targets, keys=None):
        rows = [any_behavior(self.behaviors, targets.schema)] if self.behaviors else []
        users = []
        keys = find_keys(targets, self.shares()) if keys is None else keys
        for inner in (c.compile(targets, keys) for c in self.classes):
            if inner.row is not None:
                rows.append(inner.row)
            if inner.user is not None:
                users.append(inner.user)
        if not rows and not users:
            raise InvalidDefinition("matches_any needs a behavior or an inner class")
        return Membership(any_of(rows) if rows else None, any_of(users) if users else None)


@dataclass
class MatchesAllExcept(TargetClass):
    """Every row of the user satisfies the excluded test.

    The behaviours are consulted only for rows where the excluded test is NULL;
    this is the recorded meaning of the recipe and is kept as it is.
    """

    logic = "matches_all_except"
    behaviors: list[Behavior]
    excluded_behaviors: list[Behavior]

    @classmethod
    def from_args(cls, args):
        behaviors, excluded = _need(args, "behaviors", "excluded_behaviors")
        return cls(
            [Behavior.from_dict(b) for b in behaviors],
            [Behavior.from_dict(b) for b in excluded],
        )

    def args(self):
        return {
            "behaviors": [b.to_dict() for b in self.behaviors],
            "excluded_behaviors": [b.to_dict() for b in self.excluded_behaviors],
        }

    def compile(self, targets, keys=None):
        included = any_behavior(self.behaviors, targets.schema)
        excluded = any_behavior(self.excluded_behaviors, targets.schema)
        return Membership(user=F.min(F.coalesce(excluded, included)))


@dataclass
class MatchesAnyWithout(TargetClass):
    """Any behaviour matches, on rows of users none of whose rows is excluded."""

    logic = "matches_any_without"
    behaviors: list[Behavior]
    excluded_behaviors: list[Behavior]

    @classmethod
    def from_args(cls, args):
        behaviors, excluded = _need(args, "behaviors", "excluded_behaviors")
        return cls(
            [Behavior.from_dict(b) for b in behaviors],
            [Behavior.from_dict(b) for b in excluded],
        )

    def args(self):
        return {
            "behaviors": [b.to_dict() for b in self.behaviors],
            "excluded_behaviors": [b.to_dict() for b in self.excluded_behaviors],
        }

    def compile(self, targets, keys=None):
        included = F.max(F.coalesce(any_behavior(self.behaviors, targets.schema), F.lit(False)))
        excluded = F.max(F.coalesce(any_behavior(self.excluded_behaviors, targets.schema), F.lit(False)))
        return Membership(user=included & ~excluded)


@dataclass
class MatchesPercentage(TargetClass):
    """Rows in the top or bottom share of a behaviour's rows, by a value column.

    Ties on the value are ordered by md5 of the user id, so that the answer does
    not depend on the layout.  A user's copies of the boundary key count alike.
    """

    logic = "matches_percentage"
    behavior: Behavior
    percentage: float
    value_col: str = "value"
    direction: str = "greater_than"

    @classmethod
    def from_args(cls, args):
        behavior, column, share, direction = _need(
            args, "behavior", "value_col", "percentage", "direction"
        )
        if direction not in DIRECTIONS:
            raise InvalidDefinition(f"direction must be one of {DIRECTIONS}")
        return cls(Behavior.from_dict(behavior), share, column, direction)

    def args(self):
        return {
            "behavior": self.behavior.to_dict(),
            "value_col": self.value_col,
            "percentage": self.percentage,
            "direction": self.direction,
        }

    def shares(self):
        return [self]

    def edge(self, targets) -> Edge:
        condition = self.behavior.condition(targets.schema)
        return Edge(condition, self.value_col, self.percentage, self.direction == "greater_than")

    def compile(self, targets, keys=None):
        keys = find_keys(targets, [self]) if keys is None else keys
        edge = self.edge(targets)
        far_side = beyond(F.col(self.value_col), F.col(ID), keys[id(self)], edge.from_top)
        return Membership(row=edge.condition & far_side)


def find_keys(targets: DataFrame, shares: list[MatchesPercentage]) -> dict[int, dict | None]:
    """Boundary keys of percentage classes, all found in one set of jobs."""
    if not shares:
        return {}
    found = boundary_keys(targets, [share.edge(targets) for share in shares], ID)
    return {id(share): key for share, key in zip(shares, found)}


@dataclass
class ColumnAsTarget(TargetClass):
    """The label is a column's value on the behaviour's rows."""

    logic = "column_as_target"
    behavior: Behavior
    target: str

    @classmethod
    def from_args(cls, args):
        behavior, target = _need(args, "behavior", "target")
        return cls(Behavior.from_dict(behavior), target)

    def args(self):
        return {"behavior": self.behavior.to_dict(), "target": self.target}

    def value(self, targets) -> Column:
        return F.when(self.behavior.condition(targets.schema), F.col(self.target))


@dataclass
class Dataset:
    """A labelled data set: named classes, or one column, and its requirements."""

    family: str
    classes: dict[str, TargetClass] = field(default_factory=dict)
    requirements: req.Requirements | None = None
    column: ColumnAsTarget | None = None

    def __post_init__(self):
        if self.family not in req.DEFAULTS:
            raise InvalidDefinition(f"family must be one of {sorted(req.DEFAULTS)}")
        if self.requirements is None:
            self.requirements = req.Requirements.from_dict(req.DEFAULTS[self.family], self.family)

    @classmethod
    def from_dict(cls, recipe: dict) -> Dataset:
        family, wanted = _need(recipe, "family", "data_requirements")
        classes = {
            name: TargetClass.from_dict(body) for name, body in recipe.get("classes", {}).items()
        }
        column = TargetClass.from_dict(recipe) if recipe.get("logic") == ColumnAsTarget.logic else None
        return cls(family, classes, req.Requirements.from_dict(wanted, family), column)

    def to_dict(self) -> dict:
        recipe = {"family": self.family}
        if self.classes:
            recipe["classes"] = {name: c.to_dict() for name, c in self.classes.items()}
        if self.column:
            recipe.update(self.column.to_dict())
        recipe["data_requirements"] = self.requirements.to_dict()
        return recipe

    def _ordered(self) -> list[tuple[object, TargetClass]]:
        """Label value and class, in the order the first match wins."""
        if self.family == req.BINARY:
            return [(1, self.classes["positive"]), (0, self.classes["negative"])]
        return list(self.classes.items())

    def target(self, targets: DataFrame, name="target") -> Column:
        """Label of each row: the first class that matches, else NULL."""
        if self.column:
            return self.column.value(targets).alias(name)
        labels = [F.when(c.mask(targets), F.lit(value)) for value, c in self._ordered()]
        return F.coalesce(*labels).alias(name)

    def shares(self) -> list[MatchesPercentage]:
        return [share for c in self.classes.values() for share in c.shares()]

    def user_label(self, targets: DataFrame, keys=None) -> tuple[Column, Column | None]:
        """Aggregate giving a user's largest row label, and a row pre-filter.

        The filter is None when rows outside every class matter too.
        """
        keys = find_keys(targets, self.shares()) if keys is None else keys
        if self.column:
            value = self.column.value(targets)
            return F.max(value), value.isNotNull()

        false = F.lit(False)
        seen_row, seen_user = false, false
        labels, useful, needs_all = [], [], False
        for value, target_class in self._ordered():
            member = target_class.compile(targets, keys)
            row = false if member.row is None else F.coalesce(member.row, false)
            user = false if member.user is None else F.coalesce(member.user, false)
            here = F.max(row & ~seen_row)
            if member.user is not None:
                here = here | (user & F.max(~seen_row))
                needs_all = True
            labels.append(F.when(here & ~seen_user, F.lit(value)))
            if member.row is not None:
                seen_row = seen_row | row
                useful.append(member.row)
            if member.user is not None:
                seen_user = seen_user | user
        label = F.greatest(*labels) if len(labels) > 1 else labels[0]
        return label, None if needs_all else any_of(useful)


def compiled_labels(targets: DataFrame, compiled: dict[str, tuple]) -> DataFrame:
    """Label columns from the ``Dataset.user_label`` of each name, in one pass."""
    filters = [row_filter for _, row_filter in compiled.values()]
    if all(row_filter is not None for row_filter in filters):
        targets = targets.filter(any_of(filters))
    labels = targets.groupBy(ID).agg(*[label.alias(name) for name, (label, _) in compiled.items()])
    return labels.filter(any_of([F.col(f"`{name}`").isNotNull() for name in compiled]))


def label_users(targets: DataFrame, datasets: dict[str, Dataset]) -> DataFrame:
    """``xid`` and one label column per data set, all from one pass.

    Users that no data set labels are left out.
    """
    keys = find_keys(targets, [share for d in datasets.values() for share in d.shares()])
    return compiled_labels(
        targets, {name: d.user_label(targets, keys) for name, d in datasets.items()}
    )


def label_one(targets: DataFrame, dataset: Dataset, name="target") -> DataFrame:
    """``xid`` and the label of one data set (the largest label wins)."""
    return label_users(targets, {name: dataset})
