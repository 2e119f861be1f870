"""Identity resolution joins.

Every step keeps only distinct keys before the next join, so a visitor with
many ids never multiplies rows beyond the distinct pairs of the result; hot
keys are split by adaptive skew joins (see ``session``).
"""

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortia.functions.ids import OFFLINE_ID_KINDS, keep_valid_xids

#: Segments in one whole number.
BITS = 64


def user_ids(ids: DataFrame) -> DataFrame:
    """``date, xid, fullvisitor_id`` of valid user ids."""
    xids = ids.filter(F.col("type") == "infinity_id").withColumnRenamed("mapped_id", "xid")
    return keep_valid_xids(xids).select("date", "xid", "fullvisitor_id").distinct()


def offline_ids(ids: DataFrame) -> DataFrame:
    """``date, fullvisitor_id, type, id`` of the offline id kinds."""
    return (
        ids.filter(F.col("type").isin(OFFLINE_ID_KINDS))
        .select("date", "fullvisitor_id", "type", F.col("mapped_id").alias("id"))
        .distinct()
    )


def users_with_offline_ids(ids: DataFrame) -> DataFrame:
    """Distinct ``xid, type, id, date`` linked through the same visitor and day."""
    linked = user_ids(ids).join(offline_ids(ids), ["date", "fullvisitor_id"])
    return linked.select("xid", "type", "id", "date").distinct()


def join_offline_table(users: DataFrame, kind: str, table: DataFrame) -> DataFrame:
    """``xid, universal_id, date`` of one id kind joined to its offline table."""
    return resolve(users.filter(F.col("type") == kind), {kind: table})


def stacked(tables: dict[str, DataFrame]) -> DataFrame:
    """All ``{id kind: offline table}`` as one distinct ``type, id, universal_id``."""
    keyed = [
        table.select(F.lit(kind).alias("type"), "id", "universal_id")
        for kind, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, keyed).distinct()


def resolve(users: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Distinct ``xid, universal_id, date`` over all ``{id kind: offline table}``.

    The tables are stacked with their kind as part of the key, so the users are
    joined once, whatever the number of tables.
    """
    linked = users.join(stacked(tables), ["type", "id"])
    return linked.select("xid", "universal_id", "date").distinct()


def universal_ids(ids: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Identity rows straight to ``xid, universal_id, date``.

    Equal to resolving ``users_with_offline_ids``, but the offline ids are
    resolved per visitor first: the many ids of one person collapse to few
    universal ids before they meet the visitor's user ids.
    """
    per_visitor = (
        offline_ids(ids)
        .join(stacked(tables), ["type", "id"])
        .select("date", "fullvisitor_id", "universal_id")
        .distinct()
    )
    return (
        user_ids(ids)
        .join(per_visitor, ["date", "fullvisitor_id"])
        .select("xid", "universal_id", "date")
        .distinct()
    )


def with_universal_id(users: DataFrame, vendor: DataFrame) -> DataFrame:
    return users.join(vendor, "universal_id")


def bridge_segments(
    selected: DataFrame, mcid: DataFrame, xid: DataFrame, known: list[int] | None = None
) -> DataFrame:
    """Distinct ``processing_start_date, xid, group`` over mcid, visitor and xid.

    See ``user_segments``; segments become rows only after the last merge.
    """
    users = user_segments(selected, mcid, xid, known)
    return users.select("processing_start_date", "xid", F.explode("segment_select").alias("group"))


def user_segments(
    selected: DataFrame, mcid: DataFrame, xid: DataFrame, known: list[int] | None = None
) -> DataFrame:
    """One row per day and user with the sorted segments as an array.

    ``selected`` holds ``processing_start_date, mcid, segment_select``; ``known``
    the segments that occur there, looked up if it is not given.  They are a list
    of active segments, short whatever the traffic.  A set of segments travels
    as bits of a few whole numbers and is merged by ``bit_or``, in part before every
    shuffle: no shuffle carries a row for each segment, and a visitor with very
    many ids or days is merged where its rows are read.
    """
    if known is None:
        found = selected.select(F.explode("segment_select").alias("segment")).distinct().collect()
        known = [row.segment for row in found]
    known = sorted({segment for segment in known if segment is not None})
    words = [f"_word_{i}" for i in range(-(-len(known) // BITS) or 1)]
    keys = ["processing_start_date", "fullvisitor_id"]
    places = selected.select("processing_start_date", "mcid", _places("segment_select", known).alias("places"))
    bits = places.select("processing_start_date", "mcid", *_packed("places", words))
    merged = [F.bit_or(word).alias(word) for word in words]
    visitors = (
        bits.join(mcid.select("mcid", "fullvisitor_id").distinct(), "mcid").groupBy(*keys).agg(*merged)
    )
    users = visitors.join(xid.select("xid", "fullvisitor_id").distinct(), "fullvisitor_id")
    return (
        users.groupBy("processing_start_date", "xid")
        .agg(*merged)
        .select("processing_start_date", "xid", _unpacked(known, words).alias("segment_select"))
        .filter(F.size("segment_select") > 0)
    )


def _places(column: str, known: list[int]) -> Column:
    """The place of each segment of an array among the known ones, by a constant hash table."""
    buckets: list[list[dict]] = [[] for _ in range(len(known) or 1)]
    for place, segment in enumerate(known):
        buckets[segment % len(buckets)].append({"id": segment, "place": place})
    table = F.from_json(F.lit(json.dumps(buckets)), "array<array<struct<id:long,place:int>>>")

    def place(segment):
        held = F.get(table, F.pmod(segment, F.lit(len(buckets))).cast("int"))
        found = F.get(F.filter(held, lambda entry: entry["id"] == segment), F.lit(0))["place"]
        unknown = F.raise_error(F.concat(F.lit("unknown segment "), segment.cast("string")))
        return F.coalesce(found, unknown.cast("int"))

    return F.transform(F.filter(column, lambda segment: segment.isNotNull()), place)


def _packed(places: str, words: list[str]) -> list[Column]:
    """Places as bits of whole numbers."""
    none, one = F.lit(0).cast("long"), F.lit(1).cast("long")

    def bits(word):
        here = F.filter(places, lambda p: p.between(word * BITS, word * BITS + BITS - 1))
        return F.aggregate(
            here, none, lambda held, p: held.bitwiseOR(F.call_function("shiftleft", one, p - word * BITS))
        )

    return [bits(i).alias(name) for i, name in enumerate(words)]


def _unpacked(known: list[int], words: list[str]) -> Column:
    """The segments whose bits are set, sorted."""
    listed = [{"id": segment, "word": place // BITS, "bit": place % BITS} for place, segment in enumerate(known)]
    entries = F.from_json(F.lit(json.dumps(listed)), "array<struct<id:int,word:int,bit:int>>")
    held = F.array(*words)

    def is_set(entry):
        shifted = F.call_function("shiftright", F.get(held, entry["word"]), entry["bit"])
        return shifted.bitwiseAND(F.lit(1).cast("long")) == 1

    return F.transform(F.filter(entries, is_set), lambda entry: entry["id"])
