"""Batches of texts that tasks read in place, and messages between batches and segments of a space of hashes.

Rows are written once, dealt into batches of about `BATCH_BYTES` of text, and bucketed by batch, so that any number of passes over the
texts need no shuffle. What a batch has to count or ask travels in messages, one for each segment of the hashes that it has: packed arrays
of distinct keys in order. A key that is frequent comes once from each batch. Answers come back to the batch in the same order."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martworks.llm import tokens
from martworks.llm.common import fresh
from martworks.session import fresh_path

# Text of a batch, or one longer text; a task holds about twenty times as much.
BATCH_BYTES = 8 << 20
# Text of a bucket, that is of a task's input.
BUCKET_BYTES = 32 << 20


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the number of their batch and their place in it. Runs of rows within a task are a batch."""
    batch, row, held = (TaskContext.get().partitionId() << 32) - 1, 0, BATCH_BYTES
    for rows in batches:
        _, offsets = tokens.text_bytes(rows.column("_text"))
        number, place = np.zeros(rows.num_rows, np.int64), np.zeros(rows.num_rows, np.int64)
        for i, length in enumerate(np.diff(offsets)):
            if held and held + length > BATCH_BYTES:
                batch, row, held = batch + 1, 0, 0
            number[i], place[i] = batch, row
            row, held = row + 1, held + int(length)
        yield pa.RecordBatch.from_arrays(
            [pa.array(number), pa.array(place), *rows.columns], names=["_batch", "_row", *rows.schema.names])


def stored(df: DataFrame, text: str, **extra: Column) -> tuple[DataFrame, int]:
    """(_batch, _row, _text, _others, extra columns) of the rows of `df`, bucketed by batch, and the bytes of all texts. `_others` has
    the columns of `df` but the text. No catalog entry remains."""
    spark = df.sparkSession
    others = [F.col(f"`{c}`") for c in df.columns if c != text]
    marker = fresh(df, "no_other_column")
    rows = df.select(
        F.col(f"`{text}`").cast("string").alias("_text"), F.struct(*(others or [F.lit(True).alias(marker)])).alias("_others"),
        *(value.alias(name) for name, value in extra.items()))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()[0]
    buckets = min(50_000, max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // BUCKET_BYTES))
    kinds = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    dealt = rows.mapInArrow(_dealt, f"_batch long, _row long, {kinds}")
    name = f"text_batches_{uuid.uuid4().hex}"
    dealt.write.format("parquet").bucketBy(buckets, "_batch").option("path", fresh_path(spark, "text-batches")).saveAsTable(name)
    found = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return found, int(total)


def in_order(rows: pa.Table) -> pa.Table:
    """The rows of a batch by their places: the same order in every pass."""
    return rows.take(pa.array(np.argsort(rows["_row"].to_numpy(), kind="stable")))


def runs(ascending: np.ndarray) -> Iterator[tuple]:
    """(value, begin, end) of runs of equal values."""
    cuts = np.flatnonzero(np.diff(ascending)) + 1
    for begin, end in zip([0, *cuts], [*cuts, len(ascending)]) if len(ascending) else ():
        yield ascending[begin], int(begin), int(end)


def segments_of(keys: np.ndarray, segments: int) -> Iterator[tuple]:
    """(segment, begin, end) of ascending 64-bit keys; `segments` is a power of two."""
    yield from runs(keys >> np.uint64(65 - segments.bit_length()) if segments > 1 else np.zeros(len(keys), np.uint64))


def table(rows: list[tuple], schema: str) -> pa.Table:
    """Rows as an Arrow table of a schema like `a int, b long, c binary, d double`."""
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64()}
    fields = [field.split() for field in schema.split(", ")]
    columns = zip(*rows) if rows else [[]] * len(fields)
    return pa.table([pa.array(list(x), types[kind]) for x, (_, kind) in zip(columns, fields)], names=[name for name, _ in fields])
