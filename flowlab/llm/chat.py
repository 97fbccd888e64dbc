"""Chat formatting of logged conversations, after cumulative snapshots collapsed.

Logs often hold a conversation again and again as it grows. A rolling hash over the turns gives
every prefix of every conversation a key; a conversation whose whole key is the key of a proper
prefix of a longer one is a snapshot and goes (anti-join); of identical ones the smallest id
stays. What is left is rendered. SQL functions only; text moves only to be rendered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlab.operators.ranking import cumulative_within_group, rank_within_group

#: How one turn is written: before the role, between role and text, behind the text.
TEMPLATE = ("<|im_start|>", "\n", "<|im_end|>\n")


def prefix_keys(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """(conv_id, position, turns, key) for every prefix of every conversation. A turn's number is
    its hash (96 bits) with its position; the key of a prefix is the sum of its turns' numbers,
    so each follows from the one before. Long conversations are cut over tasks."""
    role, text = (F.coalesce(turns[c].cast("string"), F.lit("")) for c in (role_col, text_col))
    narrow = turns.select(turns[conv_col].alias("conv_id"), turns[turn_col].alias("turn"),
                          F.xxhash64(role, text).alias("h1"), F.hash(text, role).alias("h2"))
    placed = rank_within_group(narrow, "conv_id", ["turn", "h1", "h2"], rank_col="position", size_col="turns")
    high = F.shiftrightunsigned(F.xxhash64("position", "h1", "h2"), 1).cast("decimal(38,0)")
    low = F.pmod(F.hash("h2", "position", "h1").cast("long"), F.lit(1 << 32)).cast("decimal(38,0)")
    numbered = placed.select("conv_id", "position", "turns", (high * F.lit(1 << 32).cast("decimal(11,0)") + low).cast("decimal(38,0)").alias("number"))
    return cumulative_within_group(numbered, ["conv_id"], ["position"], "number", cum_col="key", total_col="__all") \
        .select("conv_id", "position", "turns", "key")


def maximal_conversations(turns: DataFrame, **columns) -> DataFrame:
    """(conv_id, turns, copies) of the conversations that no longer one continues; copies counts
    the logs with exactly these turns, of which the smallest id is named."""
    keys = prefix_keys(turns, **columns)
    whole = keys.where("position = turns").groupBy("turns", "key").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
    proper = keys.where("position < turns").select(F.col("position").alias("p_turns"), F.col("key").alias("p_key")).distinct()
    return whole.join(proper, (F.col("turns") == F.col("p_turns")) & (F.col("key") == F.col("p_key")), "left_anti") \
        .select("conv_id", "turns", "copies")


def rendered_turn(role: Column, text: Column, template=TEMPLATE) -> Column:
    before, between, behind = template
    return F.concat(F.lit(before), F.coalesce(role, F.lit("")), F.lit(between), F.coalesce(text, F.lit("")), F.lit(behind))


def render_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", template=TEMPLATE) -> DataFrame:
    """One row per maximal conversation: conv_id, turns, copies, rendered.

    Turns are taken by their number, missing numbers first; turns that share a number by a hash
    of role and text; repeated rows are turns of their own. Null roles and texts count as empty.
    Rows without a conv_id are one conversation, named null, which yields its place to a copy
    that has an id. Other columns are not looked at. Empty in, empty out."""
    names = {"conv_col": conv_col, "turn_col": turn_col, "role_col": role_col, "text_col": text_col}
    kept = maximal_conversations(turns, **names).select(F.col("conv_id").alias("__kept"), "turns", "copies")
    role, text = (F.coalesce(turns[c].cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = turns.select(turns[conv_col].alias("__conv"), F.struct(
        turns[turn_col].alias("turn"), F.xxhash64(role, text).alias("h1"), F.hash(text, role).alias("h2"), rendered_turn(role, text, template).alias("shown")).alias("t"))
    # a rendered conversation is one value, so its turns have to meet; the others were dropped first
    return rows.join(kept, F.col("__conv").eqNullSafe(F.col("__kept"))).groupBy("__kept", "turns", "copies") \
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list("t")), lambda t: t["shown"]), "").alias("rendered")) \
        .select(F.col("__kept").alias("conv_id"), "turns", "copies", "rendered")
