"""Checks that look at one row at a time. Each has a `*_fails` condition, so that many of them can be counted in one
scan (see `suite`), and a function returning the failing rows. An unknown (null) condition does not fail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martworks.functions.scalar import as_value


def _bound(value) -> Column:
    return F.expr(value) if isinstance(value, str) else as_value(value)


def null_fails(column: str) -> Column:
    return F.expr(column).isNull()


def expression_fails(expression: str, column: str | None = None) -> Column:
    """With `column`, the expression is the part behind it, e.g. `"> 0"`."""
    return ~F.expr(expression if column is None else f"{column} {expression}")


def range_fails(column: str, min_value=None, max_value=None, inclusive: bool = True) -> Column:
    value, fails = F.expr(column), F.lit(False)
    if min_value is not None:
        low = _bound(min_value)
        fails = fails | ~(value >= low if inclusive else value > low)
    if max_value is not None:
        high = _bound(max_value)
        fails = fails | ~(value <= high if inclusive else value < high)
    return fails


def empty_string_fails(column: str, trim_whitespace: bool = True) -> Column:
    return (F.trim(F.expr(column)) if trim_whitespace else F.expr(column)) == ""


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(null_fails(column))


def expression_is_true(df: DataFrame, expression: str, column: str | None = None) -> DataFrame:
    return df.filter(expression_fails(expression, column))


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None, inclusive: bool = True) -> DataFrame:
    """Rows outside the bounds. A bound is a number, SQL text or a Column."""
    return df.filter(range_fails(column, min_value, max_value, inclusive))


def not_empty_string(df: DataFrame, column: str, trim_whitespace: bool = True) -> DataFrame:
    """The empty values themselves, trimmed."""
    value = F.trim(F.expr(column)) if trim_whitespace else F.expr(column)
    return df.filter(empty_string_fails(column, trim_whitespace)).select(value.alias(column))
