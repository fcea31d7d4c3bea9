from __future__ import annotations

import re
from collections.abc import Sequence
from decimal import Decimal
from functools import reduce
from operator import add, sub

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martworks import fixed_values as fixed

ColumnOrName = Column | str


def as_column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_value(value: ColumnOrName | int | float | Decimal) -> Column:
    """Like `as_column`, but numbers become literals."""
    return value if isinstance(value, Column) else F.col(value) if isinstance(value, str) else F.lit(value)


def cents_to_dollars(cents: ColumnOrName) -> Column:
    """Rounded once, half up. Whole cents are exact and take a way that is several times faster than a division; the type
    decides, so only one of the two is left in a plan."""
    amount = as_column(cents)
    whole = (amount.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(fixed.MONEY)
    return F.when(F.typeof(amount).isin("tinyint", "smallint", "int", "bigint"), whole).otherwise((amount / 100).cast(fixed.MONEY))


def to_bool(condition: Column) -> Column:
    """A condition as a flag: unknown counts as false, so the result is never null."""
    return F.coalesce(condition, F.lit(False))


def is_true(flag: ColumnOrName) -> Column:
    """A flag as a predicate: null is not true."""
    return as_column(flag)


def surrogate_key(columns: Sequence[ColumnOrName], nulls_as_empty: bool = False) -> Column:
    """md5 over the text of the columns joined by `-`. Nulls keep their place (`concat_ws` would skip them)."""
    null_text = F.lit("" if nulls_as_empty else fixed.NULL_KEY_TEXT)
    parts = [F.coalesce(as_column(c).cast("string"), null_text) for c in columns]
    joined = [piece for part in parts for piece in (F.lit("-"), part)][1:]
    return F.md5(F.concat(*joined))


def _null_as_zero(columns: Sequence[ColumnOrName]) -> list[Column]:
    if isinstance(columns, (str, Column)):
        raise TypeError("pass a list of columns")
    return [F.coalesce(as_column(c), F.lit(0)) for c in columns]


def safe_add(columns: Sequence[ColumnOrName]) -> Column:
    return reduce(add, _null_as_zero(columns))


def safe_subtract(columns: Sequence[ColumnOrName]) -> Column:
    return reduce(sub, _null_as_zero(columns))


def safe_divide(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """Null on a zero denominator, also in ANSI mode."""
    return as_value(numerator) / F.nullif(as_value(denominator), F.lit(0))


def haversine(lat1: ColumnOrName, lon1: ColumnOrName, lat2: ColumnOrName, lon2: ColumnOrName, unit: str = "mi") -> Column:
    """Great-circle distance between two points in degrees, in miles (`mi`) or kilometres (`km`)."""
    if unit not in ("mi", "km"):
        raise ValueError(f"unit must be 'mi' or 'km', got {unit!r}")
    lat1, lon1, lat2, lon2 = map(as_value, (lat1, lon1, lat2, lon2))

    def half_chord(start: Column, end: Column) -> Column:
        return F.pow(F.sin(F.radians((end - start) / 2)), 2)

    chord = half_chord(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_chord(lon1, lon2)
    return 2 * fixed.EARTH_RADIUS_MILES * F.asin(F.sqrt(chord)) * (fixed.KM_PER_MILE if unit == "km" else 1)


def width_bucket(value: ColumnOrName, low, high, buckets: int) -> Column:
    """The standard equi-width bucket: 0 below `low`, `buckets + 1` from `high` on."""
    return F.width_bucket(as_value(value), as_value(low), as_value(high), F.lit(buckets))


def width_bucket_macro(value: ColumnOrName, low, high, buckets: int) -> Column:
    """Parity form. It differs from the standard one: the edge test looks at `value` itself instead of its distance
    from `low`, adds its bonus after the upper clamp, and there is no lower clamp."""
    value, low, high = as_value(value), as_value(low), as_value(high)
    width = (high - low) / F.lit(buckets)
    on_edge = F.try_mod(value.try_cast(fixed.NUMERIC), width.try_cast(fixed.NUMERIC)) == 0
    return F.least(F.ceil((value - low) / width), F.lit(buckets + 1)) + F.when(on_edge, 1).otherwise(0)


def slugify(text: ColumnOrName) -> Column:
    """A name usable as an identifier: lower case, `_` for blanks and dashes, other signs dropped, no leading digit."""
    words = F.regexp_replace(F.lower(as_column(text)), "[ -]+", "_")
    kept = F.regexp_replace(words, "[^a-z0-9_]+", "")
    return F.coalesce(F.regexp_replace(kept, "^([0-9])", "_$1"), F.lit(""))


def slug_name(text: str) -> str:
    """`slugify` for a name known while the plan is built."""
    words = re.sub("[ -]+", "_", text.lower())
    return re.sub("^(?=[0-9])", "_", re.sub("[^a-z0-9_]+", "", words))


def customer_type(is_repeat_buyer: ColumnOrName) -> Column:
    return F.when(is_true(is_repeat_buyer), fixed.RETURNING_CUSTOMER).otherwise(fixed.NEW_CUSTOMER)


def single_value(df: DataFrame, default=None) -> Column:
    """First row, first column of `df` as a scalar subquery, or `default` when `df` has no rows (a null in the first
    row stays null). Usable in any select without a join. Sort `df` first if it has more than one row."""
    first = df.columns[0]
    picked = df.select(F.col(first).alias("value")).limit(1).agg(
        F.when(F.count(F.lit(1)) == 0, F.lit(default)).otherwise(F.first("value")).alias("value")
    )
    return picked.scalar()
