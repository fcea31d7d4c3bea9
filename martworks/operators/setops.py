from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martworks.operators.columns import quoted

LEFT_ONLY = "a_minus_b"
RIGHT_ONLY = "b_minus_a"

# Ranges of row hashes whose digests are compared. One row each is broadcast at most.
DIGEST_RANGES = 4096


def symmetric_diff(a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows found on one side only, labelled by side in `which_diff`; nulls compare equal.

    Rows are cut into ranges by a hash, and of each range both sides add up digests of their rows: sums do not depend on
    order, and cross the shuffle as a few numbers per task. Only rows of ranges that differ are then compared, in one
    aggregation over both sides. So equal tables exchange no rows; tables that differ are read twice.

    A digest has 128 bits, added up in four parts of 32. Columns of nested types are compared without digests."""
    names = list(columns or a.columns)
    sides = [
        df.select(*(quoted(n) for n in names), F.lit(side).alias("_side")) for df, side in ((a, 1), (b, -1))
    ]
    both = _in_differing_ranges(sides[0].union(sides[1]), names)
    seen = both.groupBy(*(quoted(n) for n in names)).agg(
        F.max(F.col("_side") > 0).alias("_in_a"), F.max(F.col("_side") < 0).alias("_in_b")
    )
    label = F.when(F.col("_in_a"), LEFT_ONLY).otherwise(RIGHT_ONLY)
    return seen.filter(F.col("_in_a") != F.col("_in_b")).select(
        label.alias("which_diff"), *(quoted(n) for n in names)
    )


def row_digest(df: DataFrame, names: Sequence[str]) -> list[Column] | None:
    """Two 64-bit hashes of a row that tell nulls apart, or None where a type does not allow it: hashes of nested values pass over
    the nulls within."""
    nested = (T.ArrayType, T.StructType, T.MapType, T.VariantType)
    if any(isinstance(df.schema[n].dataType, nested) for n in names):
        return None
    parts = [part for n in names for part in (quoted(n), quoted(n).isNull())]
    return [F.xxhash64(F.lit(seed), *parts) for seed in (17, 71)]


def _in_differing_ranges(both: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows of (names, `_side`: 1 or -1) whose range of hashes does not hold the same rows on both sides."""
    hashes = row_digest(both, names)
    if hashes is None:
        return both
    ranged = both.withColumn("_range", F.pmod(hashes[0], F.lit(DIGEST_RANGES)))
    halves = [half for h in hashes for half in (h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32))]
    side = F.col("_side").cast("long")
    sums = [F.sum(side), *(F.sum(side * half) for half in halves)]
    digests = ranged.groupBy("_range").agg(*(value.alias(f"_sum{i}") for i, value in enumerate(sums)))
    differs = " OR ".join(f"_sum{i} <> 0" for i in range(len(sums)))
    differing = digests.filter(differs).select("_range")
    return ranged.join(F.broadcast(differing), "_range", "left_semi").drop("_range")
