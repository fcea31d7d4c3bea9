"""Audit of filters: what each removes at each place of every possible order, and its Shapley share.

What a filter does to a row depends only on which filters the row fails, its mask. Rows become counted cells (part, mask), at most
2^n masks for n filters. Each cell is folded over the array of all orders, a constant of the plan that every task has: within an order a fold carries
what is left of the cell's counts, and yields a struct for each step. The cells of a part are merged by elementwise sums. Only
cells are gathered by part, so work and memory do not depend on the rows.

Five filters make 120 orders and 600 structs; n filters make n * n! of them."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martworks.llm.common import SEPARATORS
from martworks.session import written


def audit(rows: DataFrame, part: Column, failures: Mapping[str, Column], losses: Mapping[str, Column], times: Column | None = None) -> DataFrame:
    """One row per part, order of the filters and step: part, filter_order, step, and as longs kept (after the step), removed
    (by it), redundant (failing its filter, but removed before), unique_fails (failing its filter only), one column per name in
    `losses` (removed rows that meet the condition) and shapley (what its filter removes, summed over all orders).

    `failures` has a condition for each filter, named by one letter; `times` says how many rows a row stands for. A part appears
    if it has a row; a null part is the empty string; an unknown condition is not met. A table without rows has no parts."""
    letters = list(failures)
    one = F.lit(1).cast("long") if times is None else times
    met = lambda condition: F.coalesce(condition, F.lit(False))
    bits = (F.when(met(failed), F.lit(1 << i)).otherwise(0) for i, failed in enumerate(failures.values()))
    masked = rows.select(
        F.coalesce(part.cast("string"), F.lit("")).alias("part"), reduce(Column.__add__, bits).alias("mask"), one.alias("rows"),
        *(F.when(met(lost), one).otherwise(0).alias(f"lost_{name}") for name, lost in losses.items()))
    weights = ["rows", *(f"lost_{name}" for name in losses)]
    cells = masked.groupBy("part", "mask").agg(*(F.sum(w).alias(w) for w in weights))
    by_part = cells.groupBy("part").agg(F.collect_list(F.struct("mask", *weights)).alias("cells"))
    merged = by_part.select("part", _merged(F.col("cells"), letters, list(losses)).alias("steps"))
    shares = F.map_from_arrays(
        F.array(*map(F.lit, letters)), F.array(*(_removed_by(F.col("steps"), letter) for letter in letters)))
    found = merged.select("part", "steps", shares.alias("shares")).select("part", "shares", F.inline("steps"))
    share = F.element_at("shares", F.col("filter")).alias("shapley")
    return found.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", *losses, share)


def _removed_by(steps: Column, letter: str) -> Column:
    return F.aggregate(
        steps, F.lit(0).cast("long"), lambda total, s: total + F.when(s["filter"] == letter, s["removed"]).otherwise(0))


def _orders(letters: list[str]) -> Column:
    return F.split(F.lit(" ".join("".join(order) for order in permutations(letters))), " ")


def _merged(cells: Column, letters: list[str], losses: list[str]) -> Column:
    """The steps of all orders, summed over the cells of a part, with their names."""
    counts = ["kept", "removed", "redundant", "unique_fails", *losses]
    nothing = F.struct(F.lit(0).alias("mask"), *(F.lit(0).cast("long").alias(w) for w in ("rows", *(f"lost_{n}" for n in losses))))
    add = lambda x, y: F.struct(*((x[c] + y[c]).alias(c) for c in counts))
    summed = F.aggregate(
        cells, _folded(nothing, letters, losses), lambda total, cell: F.zip_with(total, _folded(cell, letters, losses), add))
    named = F.flatten(F.transform(_orders(letters), lambda order: F.transform(
        F.split(order, ""), lambda letter, i: F.struct(order.alias("filter_order"), (i + 1).alias("step"), letter.alias("filter")))))
    return F.zip_with(named, summed, lambda name, count: F.struct(
        *(name[n].alias(n) for n in ("filter_order", "step", "filter")), *(count[c].alias(c) for c in counts)))


def _folded(cell: Column, letters: list[str], losses: list[str]) -> Column:
    """The steps of all orders for one cell: within an order, a fold over its filters that carries what is left of the cell."""
    zero = F.lit(0).cast("long")
    fields = "".join(f",{name}:bigint" for name in ("kept", "removed", "redundant", "unique_fails", *losses))
    none = F.array().cast(f"array<struct<{fields[1:]}>>")
    weights = ["rows", *(f"lost_{name}" for name in losses)]

    def step(state: Column, letter: Column) -> Column:
        bit = F.call_function("shiftleft", F.lit(1), F.instr(F.lit("".join(letters)), letter) - 1)
        fails = cell["mask"].bitwiseAND(bit) != 0
        here = F.struct(
            F.when(fails, zero).otherwise(state["rows"]).alias("kept"),
            F.when(fails, state["rows"]).otherwise(zero).alias("removed"),
            F.when(fails, cell["rows"] - state["rows"]).otherwise(zero).alias("redundant"),
            F.when(cell["mask"] == bit, cell["rows"]).otherwise(zero).alias("unique_fails"),
            *(F.when(fails, state[f"lost_{name}"]).otherwise(zero).alias(name) for name in losses))
        left = (F.when(fails, zero).otherwise(state[w]).alias(w) for w in weights)
        return F.struct(*left, F.concat(state["steps"], F.array(here)).alias("steps"))

    start = F.struct(*(cell[w].alias(w) for w in weights), none.alias("steps"))
    return F.flatten(F.transform(
        _orders(letters), lambda order: F.aggregate(F.split(order, ""), start, step, lambda state: state["steps"])))


def text_rules(text: Column) -> dict[str, Column]:
    """Conditions that a text fails, by letter: A under 200 words; B distinct words under half of the words; C more than 2 % of
    its characters in A-Z; D any of `#$%&*|`. A null counts as empty, and so fails A only. Whole texts are split in memory,
    so a text of n bytes takes a few times n there."""
    filled = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(filled, SEPARATORS), "")
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * F.regexp_count(filled, F.lit("[A-Z]")) > 2 * F.length(filled),
        "D": filled.rlike("[#$%&*|]"),
    }


def documents_audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of `text_rules` and of E, a text identical to that of a smaller doc_id anywhere in the table, by source.

    documents: doc_id, text, source; labels: doc_id, quality, toxic. `good_lost` counts removed rows with a label of quality 1,
    `toxic_lost` with one of toxic 1. Rows with the same doc_id count one by one, and are no copies of each other. A row without doc_id
    has no labels, is no copy and makes none. Texts are compared by their SHA-256."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rules = text_rules(text)
    read = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.unhex(F.sha2(text, 256)).alias("digest"), *(failed.alias(f"fails_{letter}") for letter, failed in rules.items()))
    narrow = written(read, "audit-rows")
    firsts = narrow.groupBy(F.col("digest").alias("of")).agg(F.min("doc_id").alias("first"))
    # Joined by text and id, so that the copies of one text do not meet in one task; copies of one id are counted before.
    keys = ["doc_id", "source", "digest", *(f"fails_{letter}" for letter in rules)]
    counted = narrow.groupBy(*keys).agg(F.count(F.lit(1)).alias("times"))
    seen = counted.join(firsts, (F.col("digest") == F.col("of")) & (F.col("doc_id") == F.col("first")), "left")
    known = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    marked = seen.join(known, F.col("doc_id") == F.col("labelled"), "left")
    failures = {letter: F.col(f"fails_{letter}") for letter in rules}
    failures["E"] = F.col("doc_id").isNotNull() & F.col("first").isNull()
    losses = {"good_lost": F.col("good"), "toxic_lost": F.col("toxic")}
    return audit(marked, F.col("source"), failures, losses, F.col("times"))
