from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martworks import fixed_values as fixed


def load_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header as a typed table. Nothing is inferred (an id of digits stays a string), blanks inside values
    are kept, and a value that does not fit its type fails the read."""
    return (
        spark.read.schema(schema)
        .options(header=True, mode="FAILFAST", escape='"', enforceSchema=False)
        .csv(path)
    )


def source(spark: SparkSession, name: str, root: str | None = None) -> DataFrame:
    """One of the raw tables: Parquet under `root`, or the catalog table `raw.<name>`."""
    if name not in fixed.RAW_SCHEMAS:
        raise ValueError(f"unknown raw table {name!r}, expected one of {sorted(fixed.RAW_SCHEMAS)}")
    return spark.read.parquet(f"{root.rstrip('/')}/{name}") if root else spark.table(f"raw.{name}")
