"""Sharding by extendible hashing.

A shard is a prefix of the key's hash bits. The directory starts with one shard for everything; a shard above its byte
limit is split on the next bit, and only such a shard, until all fit. Sizes per hash prefix are summed before anything is
shuffled, twelve bits at a time, so the work is one pass over narrow rows for every twelve bits of depth, and a directory
of about total bytes / limit rows that stays distributed. No key is ever sorted or gathered in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martworks.llm.common import hash_bits, set_aside, with_results
from martworks.session import written

HASH_BITS = 60
ROUND_BITS = 12
BITS, SIZE, LEAF, ROOT, PART = "_shard_bits", "_shard_size", "_shard_leaf", "_shard_root", "_shard_within"


def shard(docs: DataFrame, key: str, text: str, limit: int) -> DataFrame:
    """The rows of `docs` with `shard` (hash prefix in binary digits, empty for the only shard), `shard_part` and
    `shard_bytes` (bytes of all texts in that shard and part).

    `shard_part` is 0 unless splitting on bits cannot help: rows of one equal hash that exceed the limit together (equal or
    null keys) are cut into parts 1, 2, ..., and a text above the limit is a part of its own, the only kind of shard that
    exceeds it. Which of several equal rows gets which part is arbitrary. An empty table gives no rows."""
    docs, aside = set_aside(docs, "_shard_")
    size = F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long")
    rows = docs.withColumns({BITS: hash_bits(F.col(f"`{key}`")), SIZE: size})
    narrow = written(rows.select(F.col(BITS).alias("bits"), F.col(SIZE).alias("size")), "shard-sizes")
    leaves, closed = directory(narrow.filter(F.col("size") <= limit), limit)
    if leaves is None:
        leaves = narrow.sparkSession.createDataFrame([], "prefix long, depth int, total long")
    # Rows meet the directory by the bits that every leaf has; the few leaves below such a prefix are told apart by their own.
    least = leaves.agg(F.coalesce(F.min("depth"), F.lit(0))).first()[0]
    root = F.expr(f"shiftright(prefix, depth - {least})").alias(ROOT)
    leaf = F.struct("prefix", "depth", "total").alias(LEAF)
    same = (F.shiftright(BITS, HASH_BITS - least) == F.col(ROOT)) & (
        F.expr(f"shiftright({BITS}, {HASH_BITS} - {LEAF}.depth)") == F.col(LEAF)["prefix"])
    found = rows.join(leaves.select(root, leaf), same & (F.col(SIZE) <= limit), "left").drop(ROOT)
    if closed and narrow.filter(F.col("size") > limit).isEmpty():
        return _result(found, F.lit(0).cast("long"), F.col(LEAF)["total"]).withColumnsRenamed(aside)
    alone = F.col(LEAF).isNull()
    return _result(found.filter(~alone), F.lit(0).cast("long"), F.col(LEAF)["total"]).unionByName(
        _result(_parts(found.filter(alone), limit), F.col(PART)["number"], F.col(PART)["bytes"])).withColumnsRenamed(aside)


def _result(df: DataFrame, part: Column, size: Column) -> DataFrame:
    prefix, depth = F.col(LEAF)["prefix"], F.col(LEAF)["depth"]
    name = F.when(depth.isNull(), _digits(F.col(BITS), F.lit(HASH_BITS))).otherwise(_digits(prefix, depth))
    return with_results(df, shard=name, shard_part=part, shard_bytes=size).drop(BITS, SIZE, LEAF, PART)


def _digits(prefix: Column, depth: Column) -> Column:
    return F.when(depth == 0, F.lit("")).otherwise(F.lpad(F.bin(prefix), depth, F.lit("0")))


def directory(narrow: DataFrame, limit: int) -> tuple[DataFrame | None, bool]:
    """Leaves of the directory over rows (bits, size), and whether they cover all rows: those of one hash that exceed the
    limit are in no leaf. Columns: `prefix`, `depth` and `total` bytes."""
    open_rows, leaves = narrow.select("bits", "size"), None
    for known in range(0, HASH_BITS, ROUND_BITS):
        if open_rows.isEmpty():
            return leaves, True
        low = known + ROUND_BITS
        cells = open_rows.groupBy(F.shiftright("bits", HASH_BITS - low).alias("cell")).agg(F.sum("size").alias("size"))
        # A prefix that was open before needs another bit at least.
        depths = F.explode(F.sequence(F.lit(known + 1 if known else 0), F.lit(low))).alias("depth")
        paths = cells.select("cell", "size", depths).withColumn("prefix", F.expr(f"shiftright(cell, {low} - depth)"))
        totals = paths.groupBy("depth", "prefix").agg(F.sum("size").alias("total"), F.collect_list("cell").alias("cells"))
        fits = totals.filter(F.col("total") <= limit).select("depth", "prefix", "total", F.explode("cells").alias("cell"))
        shallowest = F.min(F.struct("depth", "prefix", "total")).alias("leaf")
        level = written(fits.groupBy("cell").agg(shallowest).select("cell", "leaf.*"), "shard-directory")
        here = level.select("prefix", "depth", "total").distinct()
        leaves = here if leaves is None else leaves.unionByName(here)
        rest = open_rows.withColumn("cell", F.shiftright("bits", HASH_BITS - low)).join(level.select("cell"), "cell", "left_anti")
        open_rows = written(rest.drop("cell"), "shard-open")
    return leaves, open_rows.isEmpty()


def _parts(rows: DataFrame, limit: int) -> DataFrame:
    """Rows that bits cannot separate, cut by running sums: per task first, then over the tasks' sums. Texts above half the
    limit get an even part each; the others fill odd parts up to half the limit and one more text."""
    placed = rows.withColumns({"_shard_task": F.spark_partition_id(), "_shard_at": F.monotonically_increasing_id()})
    frozen = written(placed, "shard-parts")
    half = max(limit // 2, 1)
    small = F.when(F.col(SIZE) <= half, F.col(SIZE)).otherwise(0)
    large = F.when(F.col(SIZE) > half, 1).otherwise(0)
    tasks = frozen.groupBy(BITS, "_shard_task").agg(F.sum(small).alias("small"), F.sum(large).alias("large"))
    earlier = Window.partitionBy(BITS).orderBy("_shard_task").rowsBetween(Window.unboundedPreceding, -1)
    before = tasks.select(BITS, "_shard_task", F.struct(*(
        F.coalesce(F.sum(kind).over(earlier), F.lit(0)).alias(kind) for kind in ("small", "large"))).alias("_shard_before"))
    within = Window.partitionBy(BITS, "_shard_task").orderBy("_shard_at")
    run = F.struct(F.sum(small).over(within).alias("small"), F.sum(large).over(within).alias("large"))
    joined = frozen.withColumn("_shard_run", run).join(before, [BITS, "_shard_task"])
    reached = {kind: F.col("_shard_before")[kind] + F.col("_shard_run")[kind] for kind in ("small", "large")}
    number = F.when(F.col(SIZE) > half, reached["large"] * 2).otherwise(F.floor(reached["small"] / half) * 2 + 1).cast("long")
    numbered = joined.withColumn("_shard_number", number)
    sizes = numbered.groupBy(BITS, "_shard_number").agg(F.sum(SIZE).alias("_shard_total"))
    part = F.struct(F.col("_shard_number").alias("number"), F.col("_shard_total").alias("bytes"))
    return numbered.join(sizes, [BITS, "_shard_number"]).withColumn(PART, part).drop(
        "_shard_task", "_shard_at", "_shard_before", "_shard_run", "_shard_number", "_shard_total")
