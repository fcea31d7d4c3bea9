"""Checks on groups of rows: one aggregation each, with partial results before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martworks.functions.dates import add_units, moment
from martworks.operators.aggregates import not_null_share
from martworks.operators.columns import type_of


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count; a repeated null counts."""
    return _repeated(df, [column])


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations of values that occur more than once."""
    return _repeated(df, columns).drop("n_records")


def _repeated(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    counts = df.groupBy(*(F.expr(c) for c in columns)).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.filter(F.col("n_records") > 1)


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Distinct values outside the list, with their count; null passes."""
    counts = df.groupBy(F.expr(column).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.filter(~F.col("value_field").isin(list(values)))


def not_accepted_values(df: DataFrame, column: str, values: Sequence, quote: bool = True) -> DataFrame:
    """Distinct values inside the list. Without `quote` the entries are SQL expressions."""
    listed = list(values) if quote else [F.expr(str(v)) for v in values]
    distinct = df.select(F.expr(column).alias("value_field")).distinct()
    return distinct.filter(F.col("value_field").isin(*listed))


def not_null_proportion(
    df: DataFrame, column: str, at_least: float, at_most: float = 1, group_by: Sequence[str] = ()
) -> DataFrame:
    """Groups (or the whole table) whose share of non-null values is out of bounds."""
    shares = df.groupBy(*group_by).agg(not_null_share(F.expr(column)).alias("not_null_proportion"))
    share = F.col("not_null_proportion")
    return shares.filter((share < at_least) | (share > at_most))


def _distinct_is_one(column: Column, type_: T.DataType) -> Column:
    # The least value equals the greatest exactly when one distinct value exists: no shuffle of the distinct values. For
    # values without a fixed width the least one would cost a sort.
    if isinstance(type_, (T.NumericType, T.DatetimeType, T.BooleanType, T.NullType)):
        return F.coalesce(F.min(column) == F.max(column), F.lit(False))
    return F.count_distinct(column) == 1


def not_constant(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups (or the whole table) with exactly one distinct value; all-null groups pass."""
    constant = _distinct_is_one(F.expr(column), type_of(df, column))
    found = df.groupBy(*group_by).agg(constant.alias("_constant")).filter("_constant")
    return found.withColumn("filler_column", F.lit(1).cast("bigint")).drop("_constant")


def at_least_one(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups (or the whole table) without any non-null value. Ungrouped, the scan stops at the first value found."""
    rows = df.select(*group_by, F.expr(column).alias("_value"))
    if not group_by:
        rows = rows.filter(F.col("_value").isNotNull()).limit(1)
    counts = rows.groupBy(*group_by).agg(F.count("_value").alias("filler_column"))
    return counts.filter(F.col("filler_column") == 0)


def recency(
    df: DataFrame,
    field: str,
    datepart: str,
    interval: int,
    ignore_time_component: bool = False,
    group_by: Sequence[str] = (),
    as_of: datetime | Column | None = None,
) -> DataFrame:
    """Groups (or the whole table) whose latest `field` is older than `as_of - interval`, or missing. `as_of` is now
    unless given."""
    type_ = "date" if ignore_time_component else type_of(df, field)
    now = F.current_timestamp() if as_of is None else moment(as_of)
    threshold = add_units(datepart, -interval, now.cast("timestamp_ntz")).cast(type_)
    latest = df.groupBy(*group_by).agg(F.max(F.expr(field)).cast(type_).alias("most_recent"))
    found = latest.withColumn("threshold", threshold)
    return found.filter((F.col("most_recent") < F.col("threshold")) | F.col("most_recent").isNull())

