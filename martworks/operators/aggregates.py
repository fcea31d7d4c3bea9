from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martworks import fixed_values as fixed
from martworks.functions.scalar import ColumnOrName, as_column


def count_where(condition: Column) -> Column:
    """How many rows meet the condition: 0, not null, when none does."""
    return F.sum(F.when(condition, 1).otherwise(0))


def not_null_share(column: ColumnOrName) -> Column:
    """Share of non-null rows in a group."""
    return F.count(as_column(column)) / F.count(F.lit(1)).cast(fixed.NUMERIC)


def group_by_first(df: DataFrame, n: int, *aggregates: Column) -> DataFrame:
    """Group by the first `n` columns."""
    return df.groupBy(*df.columns[:n]).agg(*aggregates)


def join_summary(
    left: DataFrame,
    detail: DataFrame,
    key: str,
    *aggregates: Column,
    store: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Collapse `detail` to one row per key, then left-join it. Collapsing first keeps the join from multiplying rows,
    and the partial aggregation before its shuffle keeps a key that is frequent in `detail` harmless.

    Where keys repeat on the left, pass `store` (e.g. `session.written`) on large data: a summary that was written is
    broadcast only when its size allows, and otherwise adaptive execution can split frequent keys, which it cannot do
    above an aggregation."""
    summary = detail.groupBy(key).agg(*aggregates)
    return left.join(store(summary) if store else summary, key, "left")


# Values that a task's summary tracks, and the largest top list that is found by summaries.
TRACKED, LARGEST_TOP = 4096, 1000
# Types that the summary takes.
_SUMMARIZED = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def column_values(
    df: DataFrame,
    column: str,
    order_by: Sequence[Column] | None = None,
    limit: int | None = None,
    where: str | None = None,
) -> DataFrame:
    """Distinct values of a column with their counts (`value`, `n`), most frequent first, ties by value. `order_by` may
    use `value` and `n`.

    A short list of the most frequent values is found without bringing all values together: tasks summarize, and what the merged
    summary cannot rule out is counted exactly (`_most_frequent`). Where it rules out too little, all values are counted."""
    kept = df.filter(where) if where else df
    values = kept.select(as_column(column).alias("value"))
    if order_by is None and limit is not None and 0 < limit <= LARGEST_TOP and isinstance(values.schema["value"].dataType, _SUMMARIZED):
        counts = _most_frequent(values, limit)
    else:
        counts = None
    if counts is None:
        counts = values.groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    ranked = counts.orderBy(*(order_by or (F.desc("n"), F.col("value"))))
    return ranked.limit(limit) if limit is not None else ranked


def _most_frequent(values: DataFrame, limit: int, tracked: int = TRACKED) -> DataFrame | None:
    """Exact counts of some values, among them the `limit` most frequent, or None if the summary does not tell.

    The summary (`approx_top_k`, merged from one per task) counts up to `tracked` values and is off by at most 3.5 / tracked of all rows;
    a value that it does not list has at most twice that, or no more than the last that it lists. So values are complete once the last
    one wanted has more."""
    wanted = min(4 * limit, tracked)
    summary = values.agg(F.expr(f"approx_top_k(value, {wanted}, {tracked})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    listed = summary["top"]
    unlisted = max(2 * 3.5 / tracked * summary["n"], listed[-1]["count"] if len(listed) == wanted else 0)
    if len(listed) < limit or listed[limit - 1]["count"] <= unlisted:
        return None  # counts of the summary are never too low
    candidates = [row["item"] for row in listed if row["item"] is not None]
    value = F.col("value")
    # A null is counted in any case.
    counts = values.filter(value.isNull() | value.isin(candidates)).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    rows = [(row["value"], row["n"]) for row in counts.collect()]
    exact = sorted((n for _, n in rows), reverse=True)
    if len(exact) < limit or exact[limit - 1] <= unlisted:
        return None
    return values.sparkSession.createDataFrame(rows, counts.schema)


def column_value_list(
    df: DataFrame | None,
    column: str,
    order_by: Sequence[Column] | None = None,
    limit: int | None = None,
    default: list | None = None,
    where: str | None = None,
    most: int = 10_000,
) -> list:
    """The values as a Python list, to name pivot columns. `default` answers for a missing (None) or empty table.
    More than `most` values raise instead of flooding the driver."""
    if df is None:
        if default is None:
            raise ValueError("column_value_list: no table and no default")
        return default
    found = column_values(df, column, order_by, most + 1 if limit is None else min(limit, most + 1), where).collect()
    if len(found) > most:
        raise ValueError(f"column {column!r} has more than {most} values; pass a limit or a larger `most`")
    return [row["value"] for row in found] or (default if default is not None else [])
