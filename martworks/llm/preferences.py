"""Preference pairs as chat segments.

A pair is a chosen and a rejected conversation. Turns are compared by number; the longest common prefix ends before the first
turn that differs. Equal turns of both sides meet in one aggregation, so the prefix is rendered once, and no conversation is
ever gathered: every turn stays a row, however long its conversation is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The markers around a turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
TRAINED_ROLE = "assistant"


def segments(turns: DataFrame) -> DataFrame:
    """Rendered segments of the pairs in `turns` (pair, turn, role, text, in_chosen, in_rejected; the last two booleans).

    Returns pair, part (`prompt`, `chosen` or `rejected`), turn, role, segment (rendered text), mask_start and mask_length
    (code points of the segment that count for the loss: text and closing marker of an assistant's turn in a completion;
    0 and 0 elsewhere), and copies.

    A prompt's segments stand once for both sides. Rows of a side that are equal in turn, role and text are one row with
    `copies` above 1; a different number of copies is a difference. Rows of one turn that differ all belong to the turn, in
    the order of role and text. A null turn comes before all others, a null role is an empty one, a null text is empty, a null
    pair is a pair. If both sides are equal all is prompt; if one side is missing all is completion of the other."""
    turn, role, text = F.col("turn").cast("long"), F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    counted = turns.groupBy("pair", turn.alias("turn"), role.alias("role"), text.alias("text")).agg(
        F.count_if("in_chosen").alias("n_chosen"), F.count_if("in_rejected").alias("n_rejected"))
    place = F.coalesce("turn", F.lit(-(1 << 63)))
    differs = F.col("n_chosen") != F.col("n_rejected")
    ends = counted.groupBy(F.col("pair").alias("pair_")).agg(F.min(F.when(differs, place)).alias("end"))
    joined = counted.join(ends, F.col("pair").eqNullSafe(F.col("pair_")), "left")
    prompt = F.col("end").isNull() | (place < F.col("end"))
    part = lambda name, copies: F.struct(F.lit(name).alias("part"), copies.alias("copies"))
    parts = F.when(prompt, F.array(part("prompt", F.col("n_chosen")))).otherwise(
        F.array(part("chosen", F.col("n_chosen")), part("rejected", F.col("n_rejected"))))
    rows = joined.select("pair", "turn", "role", "text", F.inline(parts)).filter(F.col("copies") > 0)
    head = F.concat(F.lit(OPEN), "role", F.lit("\n"))
    trained = (F.col("part") != "prompt") & (F.col("role") == TRAINED_ROLE)
    return rows.select(
        "pair", "part", "turn", "role", F.concat(head, "text", F.lit(f"{CLOSE}\n")).alias("segment"),
        F.when(trained, F.length(head)).otherwise(0).cast("long").alias("mask_start"),
        F.when(trained, F.length("text") + len(CLOSE)).otherwise(0).cast("long").alias("mask_length"), "copies")


def swapped_answers(conversations: DataFrame) -> DataFrame:
    """Pairs for `segments` from conversations (conv_id, turn, role, text): every conversation is chosen, and rejected with
    its last answer exchanged for that of the conversation with the next id (an empty one if there is none)."""
    answers = conversations.filter(F.col("role") == TRAINED_ROLE).groupBy("conv_id").agg(
        F.max(F.struct(F.coalesce("turn", F.lit(-(1 << 63))).alias("turn"), "text")).alias("last"))
    others = answers.select((F.col("conv_id") - 1).alias("conv_id"), F.col("last")["text"].alias("other"))
    swaps = answers.join(others, "conv_id", "left").select(F.col("conv_id").alias("conv_id_"), "last", "other")
    joined = conversations.join(swaps, F.col("conv_id").eqNullSafe(F.col("conv_id_")), "left")
    is_last = (F.col("role") == TRAINED_ROLE) & F.coalesce("turn", F.lit(-(1 << 63))).eqNullSafe(F.col("last")["turn"]) & (
        F.col("text").eqNullSafe(F.col("last")["text"]))
    side = lambda text, chosen, rejected: F.struct(text.alias("said"), F.lit(chosen).alias("in_chosen"), F.lit(rejected).alias("in_rejected"))
    sides = F.when(F.coalesce(is_last, F.lit(False)), F.array(
        side(F.col("text"), True, False), side(F.coalesce("other", F.lit("")), False, True),
    )).otherwise(F.array(side(F.col("text"), True, True)))
    return joined.select(F.col("conv_id").alias("pair"), "turn", "role", F.inline(sides)).withColumnRenamed("said", "text")
