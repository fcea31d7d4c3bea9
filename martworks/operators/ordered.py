"""Operators that depend on row order: first per group, sequence numbers, neighbours.

A window sorts each group in one task, which is wrong for a group holding a large share of the table. So rows are cut into
slices of the sort order (group first), as many as there are shuffle partitions, and the window runs per group and slice. At
most one group reaches from one slice into the next, so what a slice must know of earlier ones is about one row: a count, or the
sort key at the edge. The plan is the same for every size of table and group. The cut is written once and read by both the
rows and the summary, so that they cannot disagree."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martworks.operators.columns import quoted
from martworks.session import written

# Rows one generator call makes at a time when copies are written out.
COPIES_PER_ROW = 1_000_000


def deduplicate(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """The first row of every group in the given order, rows with nulls included. Pass an order without ties.

    Filtering on row number 1 lets Spark keep only each task's first row per group before the shuffle
    (`WindowGroupLimit`), so a huge group shrinks to one row per task."""
    first = F.row_number().over(Window.partitionBy(*partition_by).orderBy(*order_by))
    return df.withColumn("_rn", first).filter(F.col("_rn") == 1).drop("_rn")


def sequence_no(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str], name: str) -> DataFrame:
    """Number the rows of every group 1, 2, … in ascending order. End `order_by` with a unique column: ties are numbered
    arbitrarily otherwise, and all rows of one sort key are in one slice."""
    slices = _Slices(df, partition_by, order_by)
    within = F.row_number().over(slices.window())
    sizes = slices.of_spanning_groups(F.count(F.lit(1)))
    earlier = slices.across().rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn(_EDGE, F.sum(_EDGE).over(earlier))
    number = (F.col(_WITHIN) + F.coalesce(F.col(_EDGE), F.lit(0))).cast("bigint")
    return slices.attach(slices.rows.withColumn(_WITHIN, within), starts).select(*map(quoted, df.columns), number.alias(name))


def with_previous(
    df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str], name: str, where: Column | None = None
) -> DataFrame:
    """Add the sort key of the preceding row in the group as a struct `name`, null for the first row. `where`, which may
    use `name`, says which rows to return."""
    return _with_neighbour(df, partition_by, order_by, name, where, F.lag, F.max)


def with_next(
    df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str], name: str, where: Column | None = None
) -> DataFrame:
    """Like `with_previous`, for the following row in the group, null for the last row."""
    return _with_neighbour(df, partition_by, order_by, name, where, F.lead, F.min)


def _with_neighbour(df, partition_by, order_by, name, where, shift: Callable, edge: Callable) -> DataFrame:
    where = F.lit(True) if where is None else where
    if not set(df.columns) <= {*partition_by, *order_by}:
        found, nearest = _neighbours(df, partition_by, order_by, shift, edge)
        return found.select(*map(quoted, df.columns), nearest.alias(name)).filter(where)
    # Rows without further columns repeat their sort key: one row for each key takes part, however many copies there are.
    # Copies are neighbours of each other, so all but one point at their own key.
    distinct = df.groupBy(*map(quoted, df.columns)).agg(F.count(F.lit(1)).alias("_copies"))
    found, nearest = _neighbours(distinct, partition_by, order_by, shift, edge)
    key = F.struct(*(quoted(c) for c in order_by))
    one = F.struct(nearest.alias(name), F.lit(1).cast("bigint").alias("_times"))
    others = F.struct(key.alias(name), (F.col("_copies") - 1).alias("_times"))
    split = found.select(*map(quoted, df.columns), F.inline(F.array(one, others)))
    return repeat_rows(split.filter(where), "_times")


def _neighbours(df, partition_by, order_by, shift, edge) -> tuple[DataFrame, Column]:
    slices = _Slices(df, partition_by, order_by)
    key = F.struct(*(quoted(c) for c in order_by))
    edges = slices.of_spanning_groups(edge(key))
    across = edges.withColumn(_EDGE, shift(_EDGE).over(slices.across()))
    found = slices.attach(slices.rows.withColumn(_WITHIN, shift(key).over(slices.window())), across)
    return found, F.coalesce(F.col(_WITHIN), F.col(_EDGE))


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Every row as often as column `times` says; the column is dropped. Large counts are spread over tasks in blocks
    before the rows are written out."""
    block = F.lit(COPIES_PER_ROW).cast("bigint")
    columns = [c for c in df.columns if c != times]
    count = F.col(times).cast("bigint")
    last_block = F.expr(f"(`{times}` - 1) div {COPIES_PER_ROW}")
    numbers = F.explode(F.sequence(F.lit(0).cast("bigint"), last_block))
    blocks = df.filter(count > 0).select(*columns, count.alias("_count"), numbers.alias("_block"))
    spread = blocks.repartition(F.xxhash64(*columns, "_block"))
    left = F.least(block, F.col("_count") - F.col("_block") * block)
    return spread.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), left))).select(*columns)


_SLICE, _WITHIN, _EDGE = "_slice", "_within", "_edge"


class _Slices:
    """Rows of a table with the number of their slice of the sort order."""

    def __init__(self, df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str]):
        self.groups, self.order_by = [quoted(c) for c in partition_by], [quoted(c) for c in order_by]
        self.keys = [f"_key{i}" for i in range(len(partition_by))]
        ranged = df.repartitionByRange(*self.groups, *self.order_by)
        self.rows = written(ranged.withColumn(_SLICE, F.spark_partition_id()), "slices", "zstd")

    def window(self):
        return Window.partitionBy(*self.groups, _SLICE).orderBy(*self.order_by)

    def across(self):
        """A window over the slices of a group, for what `of_spanning_groups` returns."""
        return Window.partitionBy(*self.keys).orderBy(_SLICE)

    def of_spanning_groups(self, summary: Column) -> DataFrame:
        """(keys, slice, edge): a summary per slice of all groups that reach into a slice from an earlier one. Such a group
        is the first of that slice; there are at most as many as slices."""
        keyed = self.rows.withColumns(dict(zip(self.keys, self.groups)))
        if self.keys:
            group = F.struct(*self.keys)
            firsts = keyed.groupBy(_SLICE).agg(F.min(group).alias("_first")).select("_first").distinct()
            # Compared as one struct, so that null groups match.
            keyed = keyed.withColumn("_group", group).join(firsts, F.col("_group").eqNullSafe(F.col("_first")), "left_semi")
        return keyed.groupBy(*self.keys, _SLICE).agg(summary.alias(_EDGE))

    def attach(self, rows: DataFrame, per_slice: DataFrame) -> DataFrame:
        """Bring a summary per group and slice to the rows. It has about one row per slice and is broadcast, so that rows stay."""
        right = F.broadcast(per_slice.withColumnRenamed(_SLICE, "_slice_r"))
        matches = reduce(
            Column.__and__, (group.eqNullSafe(F.col(key)) for group, key in zip(self.groups, self.keys)),
            F.col(_SLICE) == F.col("_slice_r"))
        return rows.join(right, matches, "left")
