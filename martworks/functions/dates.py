from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from martworks.functions.scalar import ColumnOrName, as_column, as_value

DATE_PARTS = ("day", "week", "month", "quarter", "year")
TIME_PARTS = ("hour", "minute", "second")


def _check(part: str) -> str:
    part = part.lower()
    if part not in DATE_PARTS + TIME_PARTS:
        raise ValueError(f"date part must be one of {DATE_PARTS + TIME_PARTS}, got {part!r}")
    return part


def moment(value: Column | date | datetime | str) -> Column:
    """A moment as a column: Python dates and naive timestamps as they read, strings as SQL expressions."""
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        return F.lit(value.isoformat(sep=" ")).cast("timestamp" if value.tzinfo else "timestamp_ntz")
    return F.lit(value) if isinstance(value, date) else F.expr(value)


def truncated(value: ColumnOrName, part: str = "day") -> Column:
    """Start of the period: a date from `day` upwards, a timestamp below. Cuts off, never rounds up."""
    part, value = _check(part), as_column(value)
    if part == "day":
        return value.cast("date")
    return F.trunc(value, part) if part in DATE_PARTS else F.date_trunc(part, value)


def add_units(part: str, count: ColumnOrName | int, value: ColumnOrName) -> Column:
    """`value` moved by `count` periods; month ends are clipped. Dates come back as timestamps: cast if needed."""
    return F.timestamp_add(_check(part), as_value(count), as_column(value))


def boundaries_between(part: str, start: ColumnOrName, end: ColumnOrName) -> Column:
    """How many period starts lie between two moments. Weeks start on Sunday."""
    part, start, end = _check(part), as_column(start), as_column(end)
    if part == "week":
        # Shift by one day so that the Monday-based truncation cuts on Sundays.
        start, end = (F.date_add(moment.cast("date"), 1) for moment in (start, end))
    first, last = truncated(start, part), truncated(end, part)
    if part == "day":
        return F.datediff(last, first).cast("bigint")
    return F.timestamp_diff(part, first.cast("timestamp_ntz"), last.cast("timestamp_ntz"))
