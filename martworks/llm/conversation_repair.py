"""Repair of conversations: the cheapest edits that make the roles an optional system turn and pairs of user and assistant.

Faults of a row, the first that fits: blank (no character but separators), duplicate (role and text seen earlier in the
conversation), truncated (the last character that is no separator is none of `.!?`). Edits and costs: Keep 0, Rerole to user or
assistant 2, Delete 3 (blank and duplicate rows must go), Insert an empty user or assistant turn 2; a truncated row that stays
costs 1 more. The edits' initials in order are the audit. The cheapest edits win, of equal ones the ASCII-least audit.

The method is weighted CYK over intervals. Symbols of the grammar stand for a way between two of four places (`^` nothing kept yet, `s`
after the system turn, `u` after a user turn, `a` after an assistant turn): symbol `pq` derives what leads from p to q. In Chomsky
normal form: pq -> pr rq; a row is a terminal of pp (Delete), ^s (Keep), ^u su au (a user turn), ua (an assistant turn). Insertions are unit
rules and closed over the terminals. A cell of the chart has for a span the minimum (cost, audit) of each symbol. Every
point that splits a span derives the same strings of a symbol pq, so one split is enough: the chart only has spans of 1, 2, 4, ... rows and
is filled in order of their length. `FAN` neighbouring cells at a time meet in a task, so a conversation of any length is spread over tasks.
Minima are enough: two audits of one span, symbol and cost are never a prefix of each other, as each row has one letter and every further
insertion costs.

What a span also carries: counts of faults, of distinct turns, of adjacent illegal roles, and its ends.

Order: by turn, nulls first; rows of one turn by role and SHA-256 of the text. A null role or text counts as one space. A null
conversation id is a conversation like others."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martworks.llm.common import SEPARATORS, prepare
from martworks.operators.ordered import sequence_no
from martworks.session import written

DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
# Neighbouring cells that meet in one task: a power of two.
FAN = 64
PLACES = "^sua"
SYMBOLS = ("^^", "^s", "^u", "^a", "ss", "su", "sa", "uu", "ua", "au", "aa")
RULES = [(pq, pq[0] + r, r + pq[1]) for pq in SYMBOLS for r in PLACES if {pq[0] + r, r + pq[1]} <= set(SYMBOLS)]
# Inserted turns on the way between two places; longer ways than these are never cheapest.
INSERTED = {"^u": "I", "su": "I", "au": "I", "ua": "I", "^a": "II", "sa": "II"}
LEGAL = ("su", "ua", "au")
# Rows that a task makes of audits at a time.
EDITS = 100_000


def numbered(turns: DataFrame) -> DataFrame:
    """Rows of `turns` (conv_id, turn, role, text) with their place in the conversation, from 1 on, as `pos`, and the fault that its text
    alone has. Rows of one conversation may be any share of the table; copies of a row take places next to each other."""
    filled = turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    ending = F.substring(F.regexp_replace("text", f"{SEPARATORS}$", ""), -1, 1)
    alone = F.when(F.regexp_replace("text", SEPARATORS, "") == "", "blank").when(~ending.isin(".", "!", "?"), "truncated")
    keyed = filled.withColumns({"digest": F.unhex(F.sha2("text", 256)), "own_fault": alone})
    return written(sequence_no(keyed, ["conv_id"], ["turn", "role", "digest"], "pos"), "repair-rows")


def with_faults(rows: DataFrame) -> DataFrame:
    """`rows` of `numbered`, without their texts, with `fault`: blank, duplicate, truncated or null."""
    narrow = rows.select("conv_id", "turn", "role", "digest", "own_fault", "pos")
    firsts = narrow.groupBy("conv_id", "role", "digest").agg(F.min("pos").alias("first_pos")).select(
        F.col("conv_id").alias("first_conv"), "first_pos")
    # A row is a duplicate unless it is the first of its kind. Joined by place, as one text may be repeated very often.
    seen = narrow.join(firsts, F.col("conv_id").eqNullSafe(F.col("first_conv")) & (F.col("pos") == F.col("first_pos")), "left")
    repeated = F.col("first_pos").isNull() & ~F.coalesce(F.col("own_fault") == "blank", F.lit(False))
    return seen.withColumn("fault", F.when(repeated, "duplicate").otherwise(F.col("own_fault"))).drop("first_conv", "first_pos")


def _closed_terminals(initial: str, stays: bool, late: bool) -> list[dict | None]:
    """The chart of one row, closed under insertion before and after it."""
    terminals = {p + p: (DELETE, "D") for p in PLACES}
    if stays:
        for to, symbols in (("u", ("^u", "su", "au")), ("a", ("ua",))):
            terminals |= dict.fromkeys(symbols, (late * TRUNCATED + (0 if initial == to else REROLE), "K" if initial == to else "R"))
        if initial == "s":
            terminals["^s"] = (late * TRUNCATED, "K")
    empty = {p + p: "" for p in PLACES} | INSERTED
    found = []
    for symbol in SYMBOLS:
        ways = [(cost + INSERT * len(before + after), before + letter + after)
                for middle, (cost, letter) in terminals.items() for first, before in empty.items() for last, after in empty.items()
                if first == symbol[0] + middle[0] and last == middle[1] + symbol[1]]
        found.append(dict(zip(("cost", "audit"), min(ways))) if ways else None)
    return found


# The charts of single rows, by initial (s, u, a, others), whether the row may stay, and whether it is truncated.
_ROWS = [_closed_terminals(initial, bool(stays), bool(late)) for initial in ("s", "u", "a", "") for stays in (0, 1) for late in (0, 1)]


def _leaf() -> Column:
    table = F.from_json(F.lit(json.dumps(_ROWS)), "array<array<struct<cost:bigint,audit:string>>>")
    initial = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    stays = ~F.coalesce(F.col("fault").isin("blank", "duplicate"), F.lit(False))
    late = F.coalesce(F.col("fault") == "truncated", F.lit(False))
    return F.get(table, initial * 4 + stays.cast("int") * 2 + late.cast("int"))


def _joined_chart() -> str:
    """SQL: the chart of the spans `p.l` and `p.r` after each other. Only `^s` may be impossible in a row, and then is null."""

    def pair(x: str, y: str) -> str:
        left, right = f"p.l.chart[{SYMBOLS.index(x)}]", f"p.r.chart[{SYMBOLS.index(y)}]"
        joined = f"named_struct('cost', {left}.cost + {right}.cost, 'audit', concat({left}.audit, {right}.audit))"
        optional = [part for part, symbol in ((left, x), (right, y)) if symbol == "^s"]
        return f"if({optional[0]} IS NULL, NULL, {joined})" if optional else joined

    least = (", ".join(pair(x, y) for to, x, y in RULES if to == symbol) for symbol in SYMBOLS)
    return f"array({', '.join(f'array_min(array({ways}))' for ways in least)})"


SUMS = ("blank", "duplicate", "truncated", "illegal", "turns")


def _leaves(rows: DataFrame) -> DataFrame:
    """(conv_id, place, span): spans of one row, places from 0 on."""
    counted = {fault: F.coalesce(F.col("fault") == fault, F.lit(False)).cast("long") for fault in ("blank", "duplicate", "truncated")}
    counted |= {"illegal": F.lit(0).cast("long"), "turns": F.col("turn").isNotNull().cast("long")}
    plain = rows.withColumn("initial", F.substring("role", 1, 1))
    return plain.select("conv_id", (F.col("pos") - 1).alias("place"), F.struct(
        _leaf().alias("chart"), *(value.alias(name) for name, value in counted.items()),
        F.col("initial").alias("first_initial"), F.col("initial").alias("last_initial"),
        F.col("turn").alias("first_turn"), F.col("turn").alias("last_turn")).alias("span"))


def _joined_span() -> str:
    """SQL: the span of `p.l` and `p.r` after each other."""
    sums = {name: f"p.l.{name} + p.r.{name}" for name in SUMS}
    legal = ", ".join(f"'{pair}'" for pair in LEGAL)
    sums["illegal"] += f" + if(concat(p.l.last_initial, p.r.first_initial) IN ({legal}), 0, 1)"
    # Turns ascend, nulls first, so a turn that both sides have is the last of one and the first of the other.
    sums["turns"] += " - if(p.l.last_turn = p.r.first_turn, 1, 0)"
    ends = {"first_initial": "p.l.first_initial", "last_initial": "p.r.last_initial",
            "first_turn": "coalesce(p.l.first_turn, p.r.first_turn)", "last_turn": "coalesce(p.r.last_turn, p.l.last_turn)"}
    fields = {"chart": _joined_chart()} | sums | ends
    return f"named_struct({', '.join(f"'{name}', {value}" for name, value in fields.items())})"


def _longer_spans(spans: DataFrame) -> DataFrame:
    """`FAN` neighbouring spans become one, in order of length: each pass joins neighbours."""
    found = spans.groupBy("conv_id", F.expr(f"place div {FAN}").alias("place")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "span"))), lambda x: x["span"]).alias("spans"))
    for _ in range(FAN.bit_length() - 1):
        found = found.withColumn("spans", F.expr(
            "transform(sequence(0, (size(spans) - 1) div 2), i -> named_struct('l', get(spans, int(2 * i)), 'r', get(spans, int(2 * i + 1))))"))
        found = found.withColumn("spans", F.expr(f"transform(spans, p -> if(p.r IS NULL, p.l, {_joined_span()}))"))
    return found.select("conv_id", "place", F.get("spans", F.lit(0)).alias("span"))


def cheapest(rows: DataFrame) -> DataFrame:
    """One row per conversation of `numbered`: conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit."""
    spans = _leaves(with_faults(rows))
    most = rows.agg(F.coalesce(F.max("pos"), F.lit(1))).first()[0]
    length = 1
    while length == 1 or length < most:
        spans = _longer_spans(spans if length == 1 else written(spans, "repair-spans"))
        length *= FAN
    span = F.col("span")
    ways = F.array(*(span["chart"][SYMBOLS.index(symbol)] for symbol in ("^^", "^a")))
    gaps = F.coalesce(span["last_turn"] - span["first_turn"] + 1 - span["turns"], F.lit(0).cast("long"))
    return spans.select("conv_id", gaps.alias("gaps"), *(span[c].alias(c) for c in ("blank", "duplicate", "truncated", "illegal")),
                        F.array_min(ways).alias("best")).select("*", "best.cost", "best.audit").drop("best")


def _edit_batches(batches):
    """A row for each letter of an audit but D: its place in the repaired conversation, the row it stands for (null: inserted), and
    the role it is given (null: its own)."""
    for batch in batches:
        kind = batch.column(0).type
        for conv, audit in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            letters = np.frombuffer(audit.encode(), np.uint8)
            inserted, stays = letters == ord("I"), letters != ord("D")
            pos, place = np.cumsum(~inserted), np.cumsum(stays) - 1
            odd = int(stays.sum()) & 1  # pairs only, unless a system turn leads
            user = (place - odd) % 2 == 0
            for begin in range(0, len(letters), EDITS):
                here = begin + np.flatnonzero(stays[begin:begin + EDITS])
                own = letters[here] == ord("K")
                yield pa.RecordBatch.from_arrays([
                    pa.array([conv] * len(here), kind), pa.array(place[here]), pa.array(pos[here], mask=inserted[here]),
                    pa.array(np.where(user[here], "user", "assistant"), pa.string(), mask=own)], names=["conv_id", "place", "pos", "new_role"])


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired conversations, (conv_id, place, role, text), from `numbered` rows and their `cheapest` edits."""
    prepare(rows.sparkSession)
    kind = dict(rows.dtypes)["conv_id"]
    edits = found.select("conv_id", "audit").mapInArrow(_edit_batches, f"conv_id {kind}, place long, pos long, new_role string")
    texts = rows.select(F.col("conv_id").alias("of"), F.col("pos").alias("at"), "role", "text")
    joined = edits.join(texts, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("pos") == F.col("at")), "left")
    return joined.select(
        "conv_id", "place", F.coalesce("new_role", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def _hash_batches(batches: Iterator[pa.RecordBatch]):
    """SHA-256 of the lines of each conversation, which come in order, one after the other."""
    current, digest, kind = None, None, pa.null()
    for batch in batches:
        found, kind = [], batch.column(0).type
        for conv, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if digest is not None and conv == current:
                digest.update(b"\n" + line.encode())
                continue
            if digest is not None:
                found.append((current, digest.hexdigest()))
            current, digest = conv, hashlib.sha256(line.encode())
        yield _digests(found, kind)
    if digest is not None:
        yield _digests([(current, digest.hexdigest())], kind)


def _digests(found: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([conv for conv, _ in found], kind), pa.array([x for _, x in found], pa.string())], names=["conv_id", "sha256"])


def hashed(lines: DataFrame) -> DataFrame:
    """(conv_id, sha256) of the lines of each conversation of (conv_id, place, line), joined by newlines. A hash of one text cannot be
    computed in parts, so the lines of a conversation run through one task, but none holds them all."""
    prepare(lines.sparkSession)
    ordered = lines.repartition("conv_id").sortWithinPartitions("conv_id", "place").select("conv_id", "line")
    return ordered.mapInArrow(_hash_batches, f"conv_id {dict(lines.dtypes)['conv_id']}, sha256 string")


def repair(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """One row per conversation id of `conversations` (of `turns` where it is None): conv_id, gaps (turns missing between the first and the
    last), blank, duplicate, truncated (rows by first fault), illegal (adjacent roles whose initials are not su, ua or au), cost, audit,
    and repaired_sha256, of the repaired lines `role:text` joined by newlines. A conversation without rows has zeros, an
    empty audit and the hash of the empty string."""
    rows = numbered(turns)
    found = written(cheapest(rows), "repair-found")
    lines = repaired(rows, found).select("conv_id", "place", F.concat("role", F.lit(":"), "text").alias("line"))
    digests = hashed(lines).select(F.col("conv_id").alias("of"), "sha256")
    ids = (turns if conversations is None else conversations).select(F.col("conv_id").alias("id")).distinct()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    whole = ids.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left").join(digests, F.col("id").eqNullSafe(F.col("of")), "left")
    return whole.select(
        F.col("id").alias("conv_id"), *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def damaged(turns: DataFrame) -> DataFrame:
    """`turns` (conv_id, turn, role, text) with faults made by crc32 of `conv_id:turn` modulo 20: 0 drops the row, 1 empties its text, 2 removes
    `.!?` from it, 3 repeats the row, 4 makes it a user turn. Nulls become one space first."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(F.encode(key, "UTF-8")) % 20
    text, role = F.coalesce(F.col("text").cast("string"), space), F.coalesce(F.col("role").cast("string"), space)
    changed = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).filter("kind <> 0")
    return changed.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy")).drop("copy")
