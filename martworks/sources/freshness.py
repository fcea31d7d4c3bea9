from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martworks.functions.dates import add_units, moment
from martworks.operators.columns import quoted

Age = tuple[int, str]


def freshness(
    df: DataFrame,
    loaded_at: str,
    warn_after: Age | None = None,
    error_after: Age | None = None,
    as_of: datetime | Column | None = None,
) -> DataFrame:
    """How old the newest row is: `max_loaded_at, snapshotted_at, age_seconds, status`. The limits are pairs such as
    `(12, "hour")`; a table without rows is an error as soon as a limit is set. Only one column is scanned, and Parquet
    statistics answer it where Spark may push the aggregate down."""
    now = (F.current_timestamp() if as_of is None else moment(as_of)).cast("timestamp_ntz")
    newest = df.agg(F.max(quoted(loaded_at)).cast("timestamp_ntz").alias("max_loaded_at"))
    dated = newest.withColumn("snapshotted_at", now)

    def older_than(age: Age | None) -> Column:
        if age is None:
            return F.lit(False)
        limit = add_units(age[1], -age[0], F.col("snapshotted_at"))
        return F.coalesce(F.col("max_loaded_at") < limit, F.lit(True))

    status = F.when(older_than(error_after), "error").when(older_than(warn_after), "warn").otherwise("pass")
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), F.col("snapshotted_at"))
    return dated.withColumns({"age_seconds": age, "status": status})
