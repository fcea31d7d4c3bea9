"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws an exponential key, -ln(u) / weight, from a hash of its id, so reruns agree. Within its source, documents
in key order fill the source's token budget. A source below its budget is taken whole as often as it fits; only the rest
is sampled. Key order is never established by sorting a source: word counts are summed per source and key range first, the
ranges before the budget's end are taken, and only the range that holds the end is sorted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martworks.llm.common import WORD, fresh, hash_bits, set_aside, unit, with_results
from martworks.session import written

MAX_EPOCHS = 3
RANGES = 4096
# Labels up to this number are broadcast (about 64 MB), so that documents need not be shuffled; more are joined.
MAX_BROADCAST_LABELS = 1_000_000
# Weights of the sources in order of their names, repeated from the start.
SOURCE_WEIGHTS = (5.0, 2.0, 1.0)
NAME, SIZE, PLACE, PLAN, TIMES = "_mix_source", "_mix_size", "_mix_place", "_mix_plan", "_mix_times"


def word_count(text: Column) -> Column:
    """Number of words; 0 for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """`target` for rows (source, source_size), one per source: weights 5, 2, 1 by code point of the name, null last, share
    the total; none gets more than `max_epochs` times its size, and what is cut is shared by weight among the others.

    A source is cut when the common level, words per unit of weight, exceeds its limit per weight. In ascending order of
    those limits the first sources are cut, so running sums find the level."""
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    weights = F.array(*map(F.lit, SOURCE_WEIGHTS))
    weighted = sizes.withColumn("weight", F.get(weights, (F.row_number().over(by_name) - 1) % len(SOURCE_WEIGHTS)))
    most = (F.col("source_size") * max_epochs).cast("double")
    by_limit = Window.orderBy(most / F.col("weight"), F.col("source").isNull(), "source")
    earlier, later = by_limit.rowsBetween(Window.unboundedPreceding, -1), by_limit.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    level = (total - F.coalesce(F.sum(most).over(earlier), F.lit(0.0))) / F.sum("weight").over(later)
    ranked = weighted.withColumns({"most": most, "level": level})
    # Every source before the first uncut one is cut, every one from there on gets that one's level.
    uncut = F.col("most") > F.col("level") * F.col("weight")
    first_level = F.first(F.when(uncut, F.col("level")), ignorenulls=True).over(
        by_limit.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    target = F.least(F.col("most"), F.coalesce(first_level * F.col("weight"), F.col("most")))
    return ranked.select("source", "source_size", "weight", target.alias("target"))


def mix(docs: DataFrame, key: str, size: str, source: str, weight: Column | None = None) -> DataFrame:
    """The rows of `docs` with `size` (words), `source_size`, `target`, and `taken`, the words the mix takes of the row,
    repeats counted: `size` times a whole number of 0 to 3. `size` names the column with the row's words.

    `weight` favours documents in the sampled rest; null or not above 0 counts as the least weight, 1e-6. A row without key
    is drawn by a hash of all its columns. Rows of one key follow each other by size. The row at the budget's end is
    taken when at least half of its words fit. Rows without words are taken 0 times. An empty table gives no rows."""
    weight_name = fresh(docs, "weight_of_row")
    docs = docs.withColumn(weight_name, F.lit(1.0) if weight is None else weight.cast("double"))
    weight = F.col(weight_name)
    safe = F.when(weight > 1e-6, weight).otherwise(1e-6)
    docs, aside = set_aside(docs, "_mix_")
    all_columns = F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns))
    chance = unit(hash_bits(F.coalesce(F.col(f"`{key}`").cast("string"), F.concat(F.lit("row "), all_columns.cast("string")))))
    # The logarithm of the key as a place within (0, 1): finer near each end of the key order than any equal steps.
    place = (F.log(-F.log(chance) / safe) + 40) / 80
    words = F.coalesce(F.col(f"`{size}`"), F.lit(0)).cast("long")
    rows = written(docs.withColumns({NAME: F.col(f"`{source}`"), SIZE: words, PLACE: place}), "mix-rows")
    return with_results(_taken(rows), size=F.col(SIZE), source_size=F.col(PLAN)["source_size"], target=F.col(PLAN)["target"],
                        taken=F.col(SIZE) * F.col(TIMES)).drop(NAME, SIZE, PLACE, PLAN, TIMES, weight_name).withColumnsRenamed(aside)


def _taken(rows: DataFrame) -> DataFrame:
    narrow = rows.select(F.col(NAME).alias("source"), F.col(SIZE).alias("size"), F.col(PLACE).alias("place"))
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = written(targets(sizes).withColumn("epochs", epochs).withColumn(
        "budget", F.col("target") - F.col("epochs") * F.col("source_size")), "mix-plan")
    coarse = _end_of_budget(narrow, plan.select("source", "budget"), RANGES)
    inner = _joined(narrow, coarse.select("source", "first", "after"), "source").filter(
        F.floor(F.col("place") * RANGES) == F.col("first"))
    fine = _end_of_budget(inner, coarse.select("source", F.col("rest").alias("budget")), RANGES * RANGES)
    ends = plan.join(fine.select(F.col("source").alias("source_"), "first", "rest"),
                     F.col("source").eqNullSafe(F.col("source_")), "left").drop("source_")
    ends = written(ends, "mix-ends")
    at = F.floor(F.col(PLACE) * (RANGES * RANGES))
    joined = rows.join(ends.select(F.struct(*ends.columns).alias(PLAN)), F.col(NAME).eqNullSafe(F.col(PLAN)["source"]))
    end, rest = F.col(PLAN)["first"], F.col(PLAN)["rest"]
    inside = end.isNotNull() & (at == end)
    sure = joined.filter(~inside).withColumn(TIMES, F.col(PLAN)["epochs"] + F.when(end.isNull(), 0).when(at < end, 1).otherwise(0))
    order = Window.partitionBy(NAME).orderBy(PLACE, SIZE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fits = F.sum(SIZE).over(order) - F.col(SIZE) / 2 <= rest
    cut = joined.filter(inside).withColumn("_mix_fits", fits).withColumn(
        TIMES, F.col(PLAN)["epochs"] + F.when(F.col("_mix_fits"), 1).otherwise(0)).drop("_mix_fits")
    return sure.unionByName(cut)


def _joined(left: DataFrame, right: DataFrame, name: str) -> DataFrame:
    other = right.withColumnRenamed(name, f"{name}_")
    return left.join(other, F.col(name).eqNullSafe(F.col(f"{name}_"))).drop(f"{name}_")


def _end_of_budget(rows: DataFrame, budgets: DataFrame, ranges: int) -> DataFrame:
    """Per source the key range `first` in which its budget ends, the words before it (`after`) and the `rest` of the budget
    in it. No row for a source whose rows all fit."""
    summed = rows.groupBy("source", F.floor(F.col("place") * ranges).alias("first")).agg(F.sum("size").alias("words"))
    so_far = Window.partitionBy("source").orderBy("first").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = _joined(summed.withColumn("upto", F.sum("words").over(so_far)), budgets, "source")
    after = F.col("upto") - F.col("words")
    return placed.filter((after <= F.col("budget")) & (F.col("budget") < F.col("upto"))).select(
        "source", "first", after.alias("after"), (F.col("budget") - after).alias("rest"))


def weighted_by_quality(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, str, str, str, Column]:
    """Arguments for `mix`: documents (doc_id, source, size) with weight 2 where labelled good, 0.5 where labelled bad, 1 else."""
    of, name = fresh(docs, "label_doc_id"), fresh(docs, "label_quality")
    quality = written(labels.groupBy(F.col("doc_id").alias(of)).agg(F.max("quality").alias(name)), "mix-labels")
    if quality.count() <= MAX_BROADCAST_LABELS:
        quality = F.broadcast(quality)
    joined = docs.join(quality, docs["doc_id"] == F.col(of), "left").drop(of)
    weight = F.when(F.col(name) == 1, 2.0).when(F.col(name) == 0, 0.5).otherwise(1.0)
    return joined, "doc_id", "size", "source", weight
