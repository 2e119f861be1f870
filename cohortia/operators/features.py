"""User features: nested records to flat numeric columns."""

import json
import zlib
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortia.functions.ids import column_slug, topic_slug
from cohortia.sources.tables import columns_containing, known_features

USER = "infinity_id"

# The feature families of the flat and the nested feature tables.
FLAT_FAMILIES = [
    "feature_brand",
    "feature_hal_topic",
    "feature_activity",
    "feature_dma",
    "feature_zip",
    "feature_lifespan",
    "feature_days_since_last_seen",
]
ARRAY_FAMILIES = [
    "feature_brands",
    "feature_dma",
    "feature_zip",
    "feature_route",
    "feature_platform",
]
STRUCT_FAMILIES = {
    "feature_duration": ["lifespan", "days_since_last_seen"],
    "feature_session": ["unique_sessions", "unique_pageviews", "total_pageviews"],
}
TOPIC_FAMILY = "feature_admantx"


def select_and_explode(df: DataFrame, feature: str, user=USER) -> DataFrame:
    return df.select(user, F.explode(feature).alias(feature))


def field_columns(df: DataFrame, feature: str, fields: list[str], user=USER) -> DataFrame:
    """``<feature>_<field>`` columns of a struct."""
    return df.select(user, *[F.col(feature)[f].alias(f"{feature}_{f}") for f in fields])


def struct_fields(column: str, fields: list[str]) -> list[Column]:
    return [F.col(column)[f].alias(f) for f in fields]


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it occurs in there."""
    return F.transform(F.array(value), use)[0]


def slot_array(items: Column, names: list[str], name, value, default: Column) -> Column:
    """One element per name: the first known value among the items of that name, else the default.

    ``name`` and ``value`` make columns of an item.  An item finds its slot through
    a constant hash table of the names, and the gaps between filled slots are
    repeated defaults, so a row takes time in proportion to its items plus the
    names, without explode, shuffle or a limit on how many names there are.
    """
    n = len(names)
    buckets: list[list[dict]] = [[] for _ in range(max(n, 1))]
    for slot, known in enumerate(names):
        buckets[zlib.crc32(known.encode()) % len(buckets)].append({"name": known, "slot": slot})
    table = F.from_json(F.lit(json.dumps(buckets)), "array<array<struct<name:string,slot:int>>>")

    def slot_of(spelled):
        held = F.get(table, (F.crc32(spelled) % len(buckets)).cast("int"))
        return F.get(F.filter(held, lambda entry: entry["name"] == spelled), F.lit(0))["slot"]

    placed = F.transform(
        items,
        lambda item, at: F.struct(
            _bound(name(item), slot_of).alias("slot"), at.alias("at"), value(item).alias("value")
        ),
    )
    placed = F.array_sort(F.filter(placed, lambda p: p["slot"].isNotNull() & p["value"].isNotNull()))
    firsts = _bound(
        placed, lambda all_: F.filter(all_, lambda p, k: (k == 0) | (F.get(all_, k - 1)["slot"] != p["slot"]))
    )

    def filled(firsts):
        def up_to_next(p, k):
            following = F.coalesce(F.get(firsts, k + 1)["slot"], F.lit(n))
            return F.concat(F.array(p["value"]), F.array_repeat(default, following - p["slot"] - 1))

        before = F.coalesce(F.get(firsts, F.lit(0))["slot"], F.lit(n))
        return F.concat(F.array_repeat(default, before), F.flatten(F.transform(firsts, up_to_next)))

    return _bound(firsts, filled)


def item_names(df: DataFrame, feature: str, name) -> list[str]:
    """Distinct item names of an array column, sorted: the columns it becomes."""
    found = df.select(F.explode(F.transform(feature, name)).alias("name")).distinct()
    return [r.name for r in found.filter("name IS NOT NULL").sort("name").collect()]


def _item_kind(df: DataFrame, feature: str, field: str):
    return df.schema[feature].dataType.elementType[field].dataType


def _count_slots(df: DataFrame, feature: str, names: list[str] | None):
    """Column names, and the slots of an array of ``(name, count)``."""
    if names is None:
        names = item_names(df, feature, lambda item: item["name"])
    none = F.lit(0).cast(_item_kind(df, feature, "count"))
    slots = slot_array(F.col(feature), names, lambda item: item["name"], lambda item: item["count"], none)
    return [f"{feature}_{name}" for name in names], slots


def _topic_slots(df: DataFrame, feature: str, topics: list[str] | None):
    """Column names, and the slots of an array of ``(name, score_sum)``; NULL where there is no score."""
    slug = lambda item: topic_slug(feature, item["name"])
    if topics is None:
        topics = item_names(df, feature, slug)
    topics = [t for t in topics if "topics_" in t]
    none = F.lit(None).cast(_item_kind(df, feature, "score_sum"))
    return topics, slot_array(F.col(feature), topics, slug, lambda item: item["score_sum"], none)


def _laid_out(df: DataFrame, user: str, arrays: dict, others=()):
    """The user, other columns and slots of arrays, and the columns to take from these.

    Users without items in one of the arrays are left out.
    """
    for feature in arrays:
        df = df.filter(F.size(feature) > 0)
    held = df.select(user, *others, *[slots.alias(f"_slots_{f}") for f, (_, slots) in arrays.items()])
    columns = {f: [F.get(f"_slots_{f}", F.lit(i)).alias(c) for i, c in enumerate(names)] for f, (names, _) in arrays.items()}
    return held, columns


def pivot_array(df: DataFrame, feature: str, names=None, user=USER) -> DataFrame:
    """Array of ``(name, count)`` to one ``<feature>_<name>`` column per name; one row per user, as in the table.

    Give ``names`` whenever they are known: it saves a pass over the data.
    """
    held, columns = _laid_out(df, user, {feature: _count_slots(df, feature, names)})
    return held.select(user, *columns[feature])


def pivot_topics(df: DataFrame, topics: list[str] | None = None, feature=TOPIC_FAMILY, user=USER):
    """Topic scores as columns; ``topics`` are slugs and fix the columns."""
    held, columns = _laid_out(df, user, {feature: _topic_slots(df, feature, topics)})
    return held.select(user, *columns[feature])


def topic_slugs(topics: DataFrame, feature=TOPIC_FAMILY) -> DataFrame:
    """Slugs of a frame of topic names, one column ``topic``."""
    return topics.select(topic_slug(feature, F.col("name")).alias("topic")).distinct()


def counts_by_name(array: Column, names: list[str]) -> list[Column]:
    """One column per known name: its last count in the array, else 0.

    Unknown names and NULL arrays are ignored; all inside generated code.
    """

    def of(name):
        same = F.filter(array, lambda item: item["name"] == name)
        return F.coalesce(F.try_element_at(same, F.lit(-1))["count"], F.lit(0))

    return [of(name) for name in names]


def unpack_arrays(df: DataFrame, names: dict[str, list[str]]) -> DataFrame:
    """Add ``<array>_<name>`` columns for the known names of each array."""
    columns = [
        count.alias(f"{array}_{name}")
        for array, known in names.items()
        for name, count in zip(known, counts_by_name(F.col(array), known))
    ]
    return df.select("*", *columns)


def tidy_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[column_slug(c) for c in df.columns])


def join_frames(frames: list[DataFrame], on=USER) -> DataFrame:
    """Inner join of feature frames on the user."""
    return reduce(lambda left, right: left.join(right, on), frames)


def flat_features(df: DataFrame, families: list[str], user=USER) -> DataFrame:
    """Columns of the wanted families of a flat table, joined per user.

    The families are columns of one table, so one projection replaces the join.
    """
    known_features(families, FLAT_FAMILIES)
    wanted = [c for f in families for c in columns_containing(df, f, user).columns if c != user]
    return df.select(user, *dict.fromkeys(wanted))


def nested_features(df: DataFrame, families: list[str], topics=None, names=None, user=USER):
    """Flat columns of the wanted families of a nested table, which has one row per user.

    ``names`` lists the known item names per array family.  All families are
    columns of one table, so one projection replaces explodes, pivots and joins;
    users without items in a wanted array are left out, as the joins did.
    """
    known_features(families, [*ARRAY_FAMILIES, *STRUCT_FAMILIES, TOPIC_FAMILY])
    names = names or {}
    arrays = {}
    for family in families:
        if family == TOPIC_FAMILY:
            arrays[family] = _topic_slots(df, family, topics)
        elif family not in STRUCT_FAMILIES:
            arrays[family] = _count_slots(df, family, names.get(family))
    structs = [f for f in families if f in STRUCT_FAMILIES]
    held, columns = _laid_out(df, user, arrays, structs)
    for family in structs:
        columns[family] = [F.col(family)[f].alias(f"{family}_{f}") for f in STRUCT_FAMILIES[family]]
    return held.select(user, *[c for family in families for c in columns[family]])
