from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martworks import fixed_values as fixed
from martworks.functions.scalar import ColumnOrName, as_column, as_value, slug_name
from martworks.operators.columns import quoted

# What may stand as an aggregate's or an operator's name in `pivot`.
_NAME, _OPERATOR = re.compile(r"[a-z_][a-z0-9_]*", re.IGNORECASE), re.compile(r"[a-z<>=!]+( [a-z]+)*", re.IGNORECASE)


def _literal(value) -> str:
    """A value as SQL text; a list or tuple as the right side of `in`."""
    if isinstance(value, (list, tuple)):
        return f"({', '.join(map(_literal, value))})"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(value, date):
        return f"{'TIMESTAMP' if isinstance(value, datetime) else 'DATE'} '{value}'"
    return "NULL" if value is None else f"{value!r}D" if isinstance(value, float) else str(value)


def pivot(
    df: DataFrame,
    group: Sequence[str],
    column: ColumnOrName,
    values: Sequence,
    agg: str = "sum",
    cmp: str = "=",
    prefix: str = "",
    suffix: str = "",
    then_value: ColumnOrName | int = 1,
    else_value: ColumnOrName | int | None = 0,
    quote_identifiers: bool = True,
    distinct: bool = False,
) -> DataFrame:
    """Values to columns: one conditional aggregate per value. The defaults count rows, with 0 where a value is absent. Sums, counts,
    minima and maxima by equality (`=`, `in`) group by value first and place one cell per group and value, so their cost
    does not grow with values times rows; all else is conditional aggregates in one grouping. `agg` is any aggregate function of one argument, `cmp` any comparison (`ilike`, `not in`, `<=>`, …).
    Columns are named `prefix + value + suffix`, or its slug without `quote_identifiers`."""
    if not _NAME.fullmatch(agg) or not _OPERATOR.fullmatch(cmp.strip()):
        raise ValueError(f"pivot: {agg!r} is no aggregate or {cmp!r} no comparison")
    names = [f"{prefix}{value}{suffix}" for value in values]
    if not quote_identifiers:
        names = [slug_name(name) for name in names]
    rows = df.select(*group, as_column(column).alias("_pivot_name"), as_value(then_value).alias("_pivot_then"),
                     as_value(else_value).alias("_pivot_else"))
    constant_else = None if isinstance(else_value, (str, Column)) else (else_value,)
    lists = _equality_lists(cmp, values, rows.schema["_pivot_name"].dataType)
    if lists is not None and constant_else and not (distinct and else_value is not None):
        cells = _place_cells(rows, group, lists, agg.lower(), distinct, else_value)
        if cells is not None:
            return cells.toDF(*group, *names)
    matches = [F.expr(f"_pivot_name {cmp} {_literal(value)}") for value in values]
    if distinct and else_value is None:
        # Rows reduced to (matched value, result) are distinct by column, so plain aggregates do. Distinct aggregates would
        # multiply all rows by the number of values.
        hits = F.array_compact(F.array(*(F.when(match, F.lit(i)) for i, match in enumerate(matches))))
        rows = rows.select(*group, "_pivot_then", F.explode_outer(hits).alias("_pivot_hit")).distinct()
        cells = [F.when(F.col("_pivot_hit") == i, F.col("_pivot_then")) for i in range(len(names))]
        distinct = False
    else:
        cells = [F.when(match, F.col("_pivot_then")).otherwise(F.col("_pivot_else")) for match in matches]
    placed = rows.select(*group, *(cell.alias(f"_pivot_{i}") for i, cell in enumerate(cells)))
    return placed.groupBy(*group).agg(*(
        F.expr(f"{agg}({'DISTINCT ' if distinct else ''}_pivot_{i})").alias(name) for i, name in enumerate(names)))


# Aggregates whose result over some rows follows from their results over parts of them.
_PARTIAL = ("sum", "count", "min", "max")
# Types of results that Spark places by value; for others its pivot tests every value on every row.
_PLACED = (T.NumericType, T.BooleanType)
_KINDS = {str: T.StringType, bool: T.BooleanType, int: T.IntegralType, date: T.DateType, datetime: (T.TimestampType, T.TimestampNTZType)}


def _equality_lists(cmp: str, values: Sequence, type_: T.DataType) -> list[list] | None:
    """For each value of a comparison by equality, the cells it stands for; None for other comparisons and types."""
    if cmp.strip().lower() not in ("=", "==", "in"):
        return None
    lists = [list(v) if isinstance(v, (list, tuple)) else [v] for v in values]
    if any(v is not None and not isinstance(type_, _KINDS.get(type(v), ())) for v in sum(lists, [])):
        return None
    return [list(dict.fromkeys(v for v in each if v is not None)) for each in lists]


def _place_cells(
    rows: DataFrame, group: Sequence[str], lists: list[list], agg: str, distinct: bool, else_value
) -> DataFrame | None:
    """Aggregate by group and value first, then place the cells of a group: a row costs the same for any number of values.

    Rows whose value is not asked for share one more cell, so a group has one cell more than values at most. A column
    of the result is made of its cells and, where `else_value` is not null, of the number of all other rows."""
    asked = list(dict.fromkeys(v for each in lists for v in each))
    if agg not in _PARTIAL or not asked:
        return None
    # One type for both results of the condition, as in a CASE.
    rows = rows.withColumn("_pivot_then", F.expr("CASE WHEN true THEN _pivot_then ELSE _pivot_else END"))
    result = rows.select(F.expr(f"{agg}(_pivot_then)").alias("r")).schema["r"].dataType
    other = _absent(asked)
    if other is None or not isinstance(result, _PLACED):
        return None
    name = F.col("_pivot_name")
    rows = rows.withColumn("_pivot_name", F.when(name.isin(asked), name).otherwise(F.lit(other)))
    if distinct:
        rows = rows.select(*group, "_pivot_name", "_pivot_then").distinct()
    placed = rows.groupBy(*group).pivot("_pivot_name", [*asked, other]).agg(
        F.expr(f"{agg}(_pivot_then)").alias("r"), F.count(F.lit(1)).alias("n"))
    numbered = placed.toDF(*group, *(f"_pivot_{kind}{i}" for i in range(len(asked) + 1) for kind in "rn"))
    place = {value: i for i, value in enumerate(asked)}
    type_, other_value = result.simpleString(), None if else_value is None else _literal(else_value)
    # SQL texts, as there may be thousands of columns.
    counts = ", ".join(f"coalesce(_pivot_n{i}, 0L)" for i in range(len(asked) + 1))
    whole = numbered.withColumn("_pivot_all", F.expr(f"aggregate(array({counts}), 0L, (total, n) -> total + n)"))

    def column(values: list) -> str:
        cells = [f"_pivot_r{place[v]}" for v in values]
        others = " - ".join(["_pivot_all", *(f"coalesce(_pivot_n{place[v]}, 0L)" for v in values)])
        if agg == "count":
            return " + ".join([*(f"coalesce({cell}, 0L)" for cell in cells), *([] if other_value is None else [others]), "0L"])
        rest = other_value if agg in ("min", "max") else f"({others}) * {other_value}"
        parts = [*cells, *([] if other_value is None else [f"if({others} > 0, CAST({rest} AS {type_}), NULL)"])]
        listed = f"filter(CAST(array({', '.join(parts)}) AS array<{type_}>), x -> x IS NOT NULL)"
        if agg in ("min", "max"):
            return f"array_{agg}({listed})"
        return f"aggregate({listed}, CAST(NULL AS {type_}), (total, x) -> CAST(coalesce(total, 0) + x AS {type_}))"

    return whole.select(*map(quoted, group), *(F.expr(column(values)).alias(f"_{i}") for i, values in enumerate(lists)))


def _absent(values: list):
    """A value of the same kind that is not among them."""
    first = values[0]
    if isinstance(first, bool):
        return None
    if isinstance(first, str):
        return "_" * (max(map(len, values)) + 1)
    if isinstance(first, int):
        return next(n for n in range(len(values) + 1) if n not in set(values))
    step = timedelta(days=1)
    return next(v + step for v in values if v + step not in values)


def unpivot(
    df: DataFrame,
    exclude: Sequence[str] = (),
    remove: Sequence[str] = (),
    cast_to: str = "string",
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """Columns to rows in one scan: `exclude` stays as columns, `remove` is dropped, every other column becomes rows
    of (name, value cast to `cast_to`). Null values are kept, booleans read `true` and `false`."""
    skipped = {name.lower() for name in (*exclude, *remove)}
    fields = [f for f in df.schema.fields if f.name.lower() not in skipped]

    def as_text(field: T.StructField) -> Column:
        value = quoted(field.name)
        return (value.cast("string") if isinstance(field.dataType, T.BooleanType) else value).cast(cast_to)

    kept = [quoted(n) for n in exclude]
    narrow = df.select(*kept, *(as_text(f).alias(f.name) for f in fields))
    return narrow.unpivot(kept, [quoted(f.name) for f in fields], field_name, value_name)


def union_relations(
    relations: Mapping[str, DataFrame],
    column_override: Mapping[str, str] | None = None,
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    source_column_name: str | None = fixed.SOURCE_COLUMN,
    where: str | None = None,
) -> DataFrame:
    """Union of named tables with differing columns. The result has every column seen in any of them (within
    `include`, or without `exclude`), typed as first seen or as `column_override` says; a table lacking a column gives
    nulls. `source_column_name` holds the table's name. Columns match without case."""
    if include and exclude:
        raise ValueError("union_relations: pass include or exclude, not both")
    wanted = {n.lower() for n in include}
    unwanted = {n.lower() for n in exclude}
    overrides = {n.lower(): t for n, t in (column_override or {}).items()}

    types: dict[str, tuple[str, str]] = {}
    for df in relations.values():
        for field in df.schema.fields:
            key = field.name.lower()
            if key in unwanted or (wanted and key not in wanted):
                continue
            types.setdefault(key, (field.name, overrides.get(key, field.dataType.simpleString())))
    if not types:
        raise ValueError(f"union_relations: no columns to union in {list(relations)}")

    def aligned(label: str, df: DataFrame) -> DataFrame:
        own = {n.lower() for n in df.columns}
        rows = df.filter(where) if where else df
        cells = [
            (quoted(name) if key in own else F.lit(None)).cast(type_).alias(name)
            for key, (name, type_) in types.items()
        ]
        if source_column_name is not None:
            cells.insert(0, F.lit(label).alias(source_column_name))
        return rows.select(*cells)

    return reduce(DataFrame.union, (aligned(label, df) for label, df in relations.items()))
