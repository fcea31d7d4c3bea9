from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> Column:
    """A column by its exact name, also when the name holds dots or blanks."""
    return F.col("`" + name.replace("`", "``") + "`")


def type_of(df: DataFrame, expression: str) -> T.DataType:
    """The type of an SQL expression over the columns of `df`."""
    return df.select(F.expr(expression).alias("x")).schema["x"].dataType


def _lower(names: Sequence[str]) -> set[str]:
    return {name.lower() for name in names}


def filtered_columns(df: DataFrame, except_: Sequence[str] = ()) -> list[str]:
    """Column names but some, compared without case."""
    dropped = _lower(except_)
    return [name for name in df.columns if name.lower() not in dropped]


def star(
    df: DataFrame,
    except_: Sequence[str] = (),
    prefix: str = "",
    suffix: str = "",
    rename: Mapping[str, str] | None = None,
) -> DataFrame:
    """All columns but some, renamed by prefix and suffix; an entry in `rename` wins over both."""
    names = filtered_columns(df, except_)
    if not names:
        raise ValueError("star: every column is excluded")
    renamed = {old.lower(): new for old, new in (rename or {}).items()}
    return df.select(*(quoted(n).alias(renamed.get(n.lower(), f"{prefix}{n}{suffix}")) for n in names))


def nullcheck(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Empty strings as nulls for the string columns among `columns`; the others unchanged."""
    types = {field.name: field.dataType for field in df.schema.fields}
    return [
        F.nullif(quoted(n), F.lit("")).alias(n) if isinstance(types[n], T.StringType) else quoted(n) for n in columns
    ]


def nullcheck_table(df: DataFrame) -> DataFrame:
    return df.select(*nullcheck(df, df.columns))
