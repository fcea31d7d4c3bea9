"""Small helpers shared by the operators."""

from __future__ import annotations

import tempfile
import zipfile
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import martworks

# Characters that separate words, as a pattern of both Java's and DuckDB's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"
SEPARATORS = r"[\x20\x09-\x0D]+"

# Rows that the Parquet reader holds at once, of Spark's 4096.
READER_ROWS = 256


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return df.select(*columns) if columns else df


def with_results(df: DataFrame, **columns: Column) -> DataFrame:
    """Add or replace columns, whatever the case of the names in `df`."""
    taken = {name.lower() for name in columns}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    return df.select(*kept, *(value.alias(name) for name, value in columns.items()))


def fresh(df: DataFrame, name: str) -> str:
    """`name`, with underscores before it until no column of `df` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def set_aside(df: DataFrame, prefix: str) -> tuple[DataFrame, dict[str, str]]:
    """`df` with the columns that begin with `prefix` renamed, and the names to give back afterwards."""
    clashing = {fresh(df, f"aside_{i}"): c for i, c in enumerate(df.columns) if c.lower().startswith(prefix)}
    return df.withColumnsRenamed({c: name for name, c in clashing.items()}), clashing


def hash_bits(key: Column) -> Column:
    """60 bits of the MD5 hash of a key, as a non-negative long; a null counts as an empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def unit(bits: Column) -> Column:
    """A number within (0, 1) from `hash_bits`."""
    return (F.shiftright(bits, 8) + F.lit(0.5)) / F.lit(float(1 << 52))


def prepare(spark: SparkSession) -> None:
    """For operators with Python on executors: send them this package, and bound batches, as texts can be long: Arrow's, and those of the
    Parquet reader, which holds the texts of a batch in one array and doubles it as it fills."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(READER_ROWS))
    _send_package(spark.sparkContext)


@cache
def _send_package(context) -> None:
    package = Path(martworks.__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="martworks-")) / "martworks.zip"
    with zipfile.ZipFile(path, "w") as target:
        for file in sorted(package.rglob("*.py")):
            target.write(file, file.relative_to(package.parent))
    context.addPyFile(str(path))
