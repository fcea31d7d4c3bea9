"""Checks that compare two tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martworks import fixed_values as fixed
from martworks.operators.columns import filtered_columns, quoted, type_of
from martworks.operators.ordered import repeat_rows
from martworks.operators.setops import LEFT_ONLY, RIGHT_ONLY, symmetric_diff


def relationships(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """Rows whose key has no parent, as `from_field`; null keys pass."""
    return repeat_rows(orphans(df, column, to, field), "n_records").select(F.col("_key").alias("from_field"))


def relationships_where(
    df: DataFrame, column: str, to: DataFrame, field: str, from_condition: str = "1=1", to_condition: str = "1=1"
) -> DataFrame:
    """`relationships` after filtering both sides: `id` of each orphan, and `right_id`, always null."""
    found = repeat_rows(orphans(df.filter(from_condition), column, to.filter(to_condition), field), "n_records")
    return found.select(F.col("_key").alias("id"), F.lit(None).cast(type_of(to, field)).alias("right_id"))


def orphans(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """Keys without a parent and how many rows have them (`_key`, `n_records`).

    Both sides are reduced to distinct keys before the join, children with a count. So a frequent key crosses the
    shuffle once per task on either side, and the join finds both sides partitioned by key already."""
    children = df.groupBy(F.expr(column).alias("_key")).agg(F.count(F.lit(1)).alias("n_records"))
    parents = to.select(F.expr(field).alias("_key")).distinct()
    return children.filter(F.col("_key").isNotNull()).join(parents, "_key", "left_anti")


def cardinality_equality(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """(value, count) pairs found on one side only. Both sides are counted in one aggregation; where the counts differ
    there is one row per side that has the value."""
    marked = [
        frame.select(F.expr(name).alias(column), F.lit(ours).alias("_ours"), F.lit(1 - ours).alias("_theirs"))
        for frame, name, ours in ((df, column, 1), (to, field, 0))
    ]
    counts = marked[0].union(marked[1]).groupBy(quoted(column)).agg(
        F.sum("_ours").alias("_ours"), F.sum("_theirs").alias("_theirs")
    )
    sides = F.explode(F.array("_ours", "_theirs")).alias("num_rows")
    return counts.filter(F.col("_ours") != F.col("_theirs")).select(quoted(column), sides).filter("num_rows > 0")


def _paired_counts(a: DataFrame, b: DataFrame, group_by: Sequence[str], name_a: str, name_b: str) -> DataFrame:
    """Counts of both tables side by side. Groups line up by plain equality, so a null group of one side never meets
    the null group of the other."""
    if not group_by:
        # One aggregation over both tables; an empty table has no count rather than a count of zero.
        marked = [df.select(F.lit(n).alias("_a"), F.lit(1 - n).alias("_b")) for df, n in ((a, 1), (b, 0))]
        counts = marked[0].union(marked[1]).agg(
            *(F.nullif(F.sum(side), F.lit(0)).alias(name) for side, name in (("_a", name_a), ("_b", name_b)))
        )
        return counts.filter(F.col(name_a).isNotNull() | F.col(name_b).isNotNull())
    sides = [
        df.groupBy(*group_by).agg(F.count(F.lit(1)).alias(name)).withColumnsRenamed({k: k + suffix for k in group_by})
        for df, name, suffix in ((a, name_a, "_a"), (b, name_b, "_b"))
    ]
    joined = sides[0].join(sides[1], [F.col(f"{k}_a") == F.col(f"{k}_b") for k in group_by], "full")
    return joined.select(*(F.col(f"{k}{s}") for k in group_by for s in ("_a", "_b")), name_a, name_b)


def equal_rowcount(a: DataFrame, b: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Row counts of both tables per group and their difference: a report, not only failures. A group found on one
    side only has no difference and passes."""
    counts = _paired_counts(a, b, group_by, "count_a", "count_b")
    return counts.withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b")))


def equal_rowcount_failures(report: DataFrame) -> DataFrame:
    return report.agg(F.sum(F.coalesce(F.col("diff_count"), F.lit(0))).alias("failures"))


def fewer_rows_than(a: DataFrame, b: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Per group by how much `a` fails to be smaller than `b`: the surplus, 1 when equal, 0 when smaller. A group found
    on one side only passes."""
    counts = _paired_counts(a, b, group_by, "count_our_model", "count_comparison_model")
    ours, theirs = F.col("count_our_model"), F.col("count_comparison_model")
    delta = F.when(ours > theirs, ours - theirs).when(ours == theirs, 1).otherwise(0)
    return counts.withColumn("row_count_delta", delta.cast("bigint"))


def fewer_rows_than_failures(report: DataFrame) -> DataFrame:
    return report.agg(F.sum(F.coalesce(F.col("row_count_delta"), F.lit(0))).alias("failures"))


def _rounded(field: T.StructField, precision: int) -> Column:
    if isinstance(field.dataType, T.FractionalType):
        return F.round(quoted(field.name).cast(fixed.NUMERIC), precision).alias(field.name)
    return quoted(field.name)


def equality(
    a: DataFrame,
    b: DataFrame,
    compare_columns: Sequence[str] | None = None,
    exclude_columns: Sequence[str] | None = None,
    precision: int | None = None,
) -> DataFrame:
    """Distinct rows found on one side only. Both tables need the same columns unless some are chosen or excluded;
    with `precision` (0 means none) fractional numbers are rounded first. Repeated rows do not show (see `expect_rows`)."""
    if compare_columns and exclude_columns:
        raise ValueError("equality: pass compare_columns or exclude_columns, not both")
    if compare_columns:
        wanted = {n.lower() for n in compare_columns}
        names = [n for n in a.columns if n.lower() in wanted]
    else:
        names = filtered_columns(a, exclude_columns or ())
        others = filtered_columns(b, exclude_columns or ())
        if {n.lower() for n in names} != {n.lower() for n in others}:
            raise ValueError(f"equality: the tables differ in columns: {sorted(names)} and {sorted(others)}")
    if precision:
        types = {f.name: f for f in a.schema.fields}
        a, b = (df.select(*(_rounded(types[n], precision) for n in names)) for df in (a, b))
    return symmetric_diff(a, b, names)


def equality_failures(diff: DataFrame) -> DataFrame:
    """Differing rows, plus by how much one side has more of them."""
    sides = [F.count_if(F.col("which_diff") == side) for side in (LEFT_ONLY, RIGHT_ONLY)]
    return diff.agg((F.count(F.lit(1)) + F.abs(sides[0] - sides[1])).alias("failures"))


def expect_rows(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Fixture check: rows of `expected` missing from `actual` and rows of `actual` not expected, with how often.
    Only the columns of `expected` count, and repeated rows must repeat as often."""
    names = expected.columns
    types = {f.name: f.dataType for f in expected.schema.fields}
    sides = [
        df.select(*(quoted(n).cast(types[n]).alias(n) for n in names), F.lit(weight).alias("_weight"))
        for df, weight in ((actual, 1), (expected, -1))
    ]
    balance = sides[0].union(sides[1]).groupBy(*(quoted(n) for n in names)).agg(F.sum("_weight").alias("surplus"))
    return balance.filter(F.col("surplus") != 0)
