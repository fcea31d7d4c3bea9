"""Checks on neighbouring rows, searched in slices of the sort order (see `operators.ordered`)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martworks.functions.dates import add_units
from martworks.functions.scalar import slug_name
from martworks.operators.ordered import with_next, with_previous

# Per kind of gap rule: how an upper bound must compare to the next lower bound, and the words naming that.
GAP_RULES = {
    "not_allowed": (lambda upper, lower: upper == lower, "equal_to"),
    "allowed": (lambda upper, lower: upper <= lower, "less_than_or_equal_to"),
    "required": (lambda upper, lower: upper < lower, "less_than"),
}


def sequential_values(
    df: DataFrame,
    column: str,
    interval: int = 1,
    datepart: str | None = None,
    group_by: Sequence[str] = (),
) -> DataFrame:
    """Rows that do not follow the next smaller value of their group by exactly `interval` (of `datepart` for dates and
    timestamps). The first row passes, a repeated value fails."""
    previous_name = f"previous_{slug_name(column)}"
    rows = df.select(*group_by, F.expr(column).alias("_value"))
    value, previous = F.col("_value"), F.col("_previous._value")
    if datepart:
        expected = add_units(datepart, interval, previous.cast("timestamp_ntz"))
        follows = value.cast("timestamp_ntz") == expected
    else:
        follows = value == previous + interval
    failing = with_previous(rows, group_by, ["_value"], "_previous", ~follows)
    return failing.select(*group_by, value.alias(column), previous.alias(previous_name))


def mutually_exclusive_ranges(
    df: DataFrame,
    lower_bound: str,
    upper_bound: str,
    partition_by: str | None = None,
    gaps: str = "allowed",
    zero_length_range_allowed: bool = False,
) -> DataFrame:
    """Ranges that are empty or reversed, or that reach past the next range of their group. A null bound fails.
    `partition_by` is an SQL expression; `gaps` is `allowed`, `not_allowed` or `required`."""
    if gaps not in GAP_RULES:
        raise ValueError(f"gaps must be one of {sorted(GAP_RULES)}, got {gaps!r}")
    meets_next, gap_words = GAP_RULES[gaps]
    group = ["partition_by_col"] if partition_by else []
    rows = df.select(
        *([F.expr(partition_by).alias("partition_by_col")] if partition_by else []),
        F.expr(lower_bound).alias("lower_bound"),
        F.expr(upper_bound).alias("upper_bound"),
    )
    # The last range of a group is the one without a next; so no second sort, in the other direction, is needed.
    lower, upper, next_lower = F.col("lower_bound"), F.col("upper_bound"), F.col("_next.lower_bound")
    is_last = F.col("_next").isNull()
    forward = lower <= upper if zero_length_range_allowed else lower < upper
    runs_forward = F.coalesce(forward, F.lit(False))
    keeps_distance = F.coalesce(meets_next(upper, next_lower), is_last, F.lit(False))
    failing = with_next(
        rows, group, ["lower_bound", "upper_bound"], "_next", ~(runs_forward & keeps_distance)
    )
    length_words = "less_than_or_equal_to" if zero_length_range_allowed else "less_than"
    return failing.select(
        *group,
        lower,
        upper,
        next_lower.alias("next_lower_bound"),
        is_last.alias("is_last_record"),
        runs_forward.alias(f"lower_bound_{length_words}_upper_bound"),
        keeps_distance.alias(f"upper_bound_{gap_words}_next_lower_bound"),
    )
