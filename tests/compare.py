"""Run registered queries and their SQL side by side. As a script: `python tests/compare.py <folder> [name …]`."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def normal(value):
    if isinstance(value, decimal.Decimal):
        return ("n", f"{value.normalize():f}")
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, int):
        return ("n", str(value))
    if isinstance(value, float):
        return ("f", "nan" if math.isnan(value) else repr(value + 0.0))
    if isinstance(value, dt.datetime):
        return ("t", value.isoformat())
    if isinstance(value, dt.date):
        return ("d", value.isoformat())
    return ("s", value)


# Spark type names by DuckDB type name; the others agree once lower-cased.
SPARK_TYPES = {
    "varchar": "string", "integer": "int", "timestamp": "timestamp_ntz", '"null"': "void",
}


def table(columns, types, found) -> tuple[list[tuple[str, str]], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [(columns[i], types[i]) for i in order], sorted(
        (tuple(normal(row[i]) for i in order) for row in found), key=lambda row: tuple(map(str, row))
    )


def from_spark(df: DataFrame):
    return table(df.columns, [type_ for _, type_ in df.dtypes], df.collect())


def from_duckdb(folder: str, sql: str):
    with duckdb.connect() as con:
        for path in Path(folder).glob("*.parquet"):
            con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
        result = con.execute(sql)
        types = [str(c[1]).lower() for c in result.description]
        return table([c[0] for c in result.description], [SPARK_TYPES.get(t, t) for t in types], result.fetchall())


def difference(ours, theirs) -> str | None:
    if ours[0] != theirs[0]:
        return f"columns {set(ours[0]) - set(theirs[0])} and {set(theirs[0]) - set(ours[0])}"
    if ours[1] == theirs[1]:
        return None
    left, right = set(ours[1]), set(theirs[1])
    return f"{len(ours[1])} and {len(theirs[1])} rows; left {list(left - right)[:2]}; right {list(right - left)[:2]}"


def main(folder: str, names: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracle, bad = entry.queries(), entry.oracle_sql(), 0
    for name in names or queries:
        start = time.time()
        try:
            ours = from_spark(queries[name](spark, folder))
            took = time.time() - start
            wrong = difference(ours, from_duckdb(folder, oracle[name])) if name in oracle else "no SQL"
        except Exception as error:  # report every query, then fail
            ours, took, wrong = ([], []), time.time() - start, f"{type(error).__name__}: {str(error)[:600]}"
        bad += wrong is not None
        print(f"{'ok ' if wrong is None else 'BAD'} {name} {len(ours[1])} rows {took:.2f}s {wrong or ''}", flush=True)
    print(f"{bad} differ")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
