"""Chat logs as training texts, without snapshots of conversations that went on.

A logger that writes a conversation after every turn leaves all its prefixes. A
prefix is known by its length and a rolling hash, the exclusive or of a hash of
each turn with its position. A conversation whose length and hash are a proper
prefix's of another is a snapshot of it; an anti-join leaves the maximal ones.
Of equal conversations the one of smallest id stays.

Turns are shuffled once, by conversation; one window orders, numbers, hashes and
measures them. What is joined are hashes, one a conversation, against distinct
prefixes, so a first turn or a whole conversation that is very common is one row
after the map side's aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _rows(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, template: Column) -> DataFrame:
    """Turns with their place, prefix hash, rendered text and last character's place."""
    named = turns.select(
        turns[conv_col].alias("conv_id"), turns[turn_col].alias("turn"),
        turns[role_col].cast("string").alias("role"), turns[text_col].cast("string").alias("text"),
    ).where("conv_id is not null")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.lag(F.struct("turn", "role", "text")).over(order)
    once = named.withColumn("again", before == F.struct("turn", "role", "text")).where("again is null or not again")
    numbered = once.withColumn("place", F.row_number().over(order).cast("long")).withColumn("rendered", template)
    of_turn = [F.col("place"), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    return numbered.select(
        "conv_id", "place", "role", "rendered",
        F.length(F.coalesce("text", F.lit(""))).alias("chars"),
        F.bit_xor(F.xxhash64(F.lit(1), *of_turn)).over(running).alias("high"),
        F.bit_xor(F.xxhash64(F.lit(2), *of_turn)).over(running).alias("low"),
        F.sum(F.length("rendered")).over(running).alias("end"),
        F.lead("place").over(order).isNull().alias("last"),
    )


def format_chats(
    turns: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text", trained_role="assistant"
) -> DataFrame:
    """Maximal conversations: conv_id, n_turns, n_copies, text and loss_spans.

    text has ``<|role|>``, a line feed, the turn's text and a line feed for every
    turn. loss_spans are the characters, from 0, of the turns of trained_role.
    n_copies counts the conversations that are equal to this one.

    Turns are ordered by number, null first; ties by role, then text. A null role
    or text is rendered as an empty one but differs from it. Rows of a
    conversation that agree in all four columns are one turn. Rows without a
    conversation id belong to none and are left out. Other columns are ignored,
    whatever their names; no rows give no rows.
    """
    blank = lambda name: F.coalesce(F.col(name), F.lit(""))
    template = F.concat(F.lit("<|"), blank("role"), F.lit("|>\n"), blank("text"), F.lit("\n"))
    rows = _rows(turns, conv_col, turn_col, role_col, text_col, template)
    state = ["place", "high", "low"]
    whole = rows.where("last").groupBy(*state).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    prefixes = rows.where("not last").select(*state).distinct()
    maximal = whole.join(prefixes, state, "left_anti").select("conv_id", F.col("place").alias("n_turns"), "n_copies")
    span = F.struct(
        (F.col("end") - F.col("chars") - 1).alias("begin"), (F.col("end") - 1).alias("end"),
    )
    turn = F.struct("place", "rendered", F.when(F.col("role") == trained_role, span).alias("span"))
    rendered = rows.join(maximal, "conv_id").groupBy("conv_id", "n_turns", "n_copies").agg(
        F.sort_array(F.collect_list(turn)).alias("all")
    )
    return rendered.select(
        "conv_id", "n_turns", "n_copies",
        F.array_join(F.col("all.rendered"), "").alias("text"),
        F.filter(F.col("all.span"), lambda s: s.isNotNull()).alias("loss_spans"),
    )
