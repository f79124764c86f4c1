"""Conversations logged as growing snapshots: only those that no longer one begins with are kept.

DataFrame functions only. A turn-prefix has a rolling hash: two sums, over its turns, of 40-bit
hashes of (place, role, text). Sums need no state, so the turns of a long conversation are spread
over slots: each slot is summed on its own, and one row a slot carries the sums along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SLOT_TURNS = 256
BITS = 40


def turn_hash() -> Column:
    parts = [c for name in ("role", "text") for c in (F.col(name).isNull(), F.coalesce(name, F.lit("")))]
    return F.xxhash64(*parts)


def prefix_hashes(conversations: DataFrame) -> DataFrame:
    """(conv_id, slot, place, total, s1, s2) for each turn: the rolling hash of the conversation up to
    its place (from 1), and the conversation's number of turns."""
    turns = (
        conversations.where("conv_id IS NOT NULL AND turn IS NOT NULL")
        .select("conv_id", "turn", turn_hash().alias("h"), F.floor(F.col("turn") / SLOT_TURNS).alias("slot"))
        .distinct()
    )
    in_slot = W.partitionBy("conv_id", "slot").orderBy("turn", "h")
    turns = turns.withColumn("r", F.row_number().over(in_slot))
    whole = W.partitionBy("conv_id")
    before = whole.orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    slots = turns.groupBy("conv_id", "slot").agg(F.count(F.lit(1)).alias("n"))
    slots = slots.select(
        "conv_id", "slot",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
        F.sum("n").over(whole).alias("total"),
    )
    placed = turns.join(slots, ["conv_id", "slot"]).withColumn("place", F.col("offset") + F.col("r"))
    bits = F.lit(2**BITS)
    placed = placed.withColumns(
        {"t1": F.pmod(F.xxhash64("place", "h"), bits), "t2": F.pmod(F.xxhash64("h", "place", F.lit(1)), bits)}
    )
    sums = placed.groupBy("conv_id", "slot").agg(F.sum("t1").alias("a1"), F.sum("t2").alias("a2"))
    sums = sums.select(
        "conv_id", "slot",
        F.coalesce(F.sum("a1").over(before), F.lit(0)).alias("b1"),
        F.coalesce(F.sum("a2").over(before), F.lit(0)).alias("b2"),
    )
    upto = in_slot.rowsBetween(W.unboundedPreceding, 0)
    return placed.join(sums, ["conv_id", "slot"]).select(
        "conv_id", "slot", "place", "total",
        (F.col("b1") + F.sum("t1").over(upto)).alias("s1"), (F.col("b2") + F.sum("t2").over(upto)).alias("s2"),
    )


def maximal_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns) of the conversations that are no prefix of a longer one; of equal
    conversations the smallest conv_id. See ``collapse_snapshots`` for odd rows."""
    prefixes = prefix_hashes(conversations)
    whole = (
        prefixes.where("place = total")
        .groupBy("place", "s1", "s2")
        .agg(F.min("conv_id").alias("conv_id"))
    )
    proper = prefixes.where("place < total").select("place", "s1", "s2").distinct()
    return whole.join(proper, ["place", "s1", "s2"], "left_anti").select("conv_id", F.col("place").alias("n_turns"))


def collapse_snapshots(conversations: DataFrame) -> DataFrame:
    """Maximal conversations, rendered: (conv_id, part, n_turns, text).

    Turns are taken in order of ``turn``; where several rows of a conversation have one turn, in
    order of a hash of role and text. Rows that repeat another count once. Rows without conv_id or
    turn belong to no conversation and are left out. A null role or text differs from an empty one
    but is rendered like it. Each turn is rendered as ``<|im_start|>role\\ntext<|im_end|>\\n``;
    conversations of many turns are rendered in parts, one for each 256 values of ``turn``
    (n_turns is that of the whole conversation), so no task holds an unbounded one.
    """
    kept = maximal_conversations(conversations).hint("shuffle_hash")
    turns = (
        conversations.where("conv_id IS NOT NULL AND turn IS NOT NULL")
        .select("conv_id", F.floor(F.col("turn") / SLOT_TURNS).alias("part"), "turn", "role", "text")
        .join(kept, "conv_id")
    )
    rendered = F.transform(
        F.array_sort(F.collect_set(F.struct("turn", turn_hash().alias("h"), "role", "text"))),
        lambda x: F.concat(
            F.lit("<|im_start|>"), F.coalesce(x["role"], F.lit("")), F.lit("\n"),
            F.coalesce(x["text"], F.lit("")), F.lit("<|im_end|>\n"),
        ),
    )
    return turns.groupBy("conv_id", "part", "n_turns").agg(F.array_join(rendered, "").alias("text"))
