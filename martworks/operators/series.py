from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martworks.functions.dates import DATE_PARTS, add_units, boundaries_between, moment


PERIODS_PER_ROW = 1_000_000


def generate_series(spark: SparkSession, upper: int) -> DataFrame:
    """1 to `upper` as `generated_number`, ascending; made in parallel, each task a stretch of the series in turn."""
    if upper <= 0:
        raise ValueError("upper bound must be positive")
    return spark.range(1, upper + 1).select(F.col("id").alias("generated_number"))


def _period(part: str, offset: Column, start: Column) -> Column:
    moved = add_units(part, offset, start.cast("timestamp_ntz"))
    return moved.cast("date") if part in DATE_PARTS else moved


def date_spine(spark: SparkSession, part: str, start, end) -> DataFrame:
    """One row per period from `start` up to but without `end`, column `date_<part>`. `start` and `end` are Python
    dates, timestamps or SQL expressions of constants. Empty when no period start lies between them."""
    first, last = moment(start), moment(end)
    periods = spark.range(1).select(boundaries_between(part, first, last).alias("n")).first()["n"]
    name = f"date_{part}"
    spine = spark.range(max(periods or 0, 0)).select(_period(part, F.col("id"), first).alias(name))
    return spine.filter(F.col(name) <= last)


def date_spine_between(bounds: DataFrame, part: str, start: str, end: str) -> DataFrame:
    """The same spine for every row of `bounds`, e.g. a table's first and last date; the row's columns are kept. Long spines
    are spread over tasks in blocks of `PERIODS_PER_ROW`."""
    name = f"date_{part}"
    periods = boundaries_between(part, start, end)
    counted = bounds.withColumn("_periods", periods.cast("bigint")).filter("_periods > 0")
    last_block = F.expr(f"(_periods - 1) div {PERIODS_PER_ROW}")
    blocks = counted.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)))
    begin = F.col("_block") * PERIODS_PER_ROW
    steps = F.sequence(begin, F.least(begin + PERIODS_PER_ROW, F.col("_periods")) - 1)
    spread = blocks.hint("rebalance").withColumn("_step", F.explode(steps)).drop("_periods", "_block")
    return (
        spread.withColumn(name, _period(part, F.col("_step"), F.col(start))).drop("_step")
        .filter(F.col(name) <= F.col(end))
    )
