"""Session settings the plans rely on, and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Joins on keys where one value may hold a large share of the rows lean on adaptive skew splitting. Forcing it allows
# the split even where it costs one more exchange after the join, e.g. under an aggregate on the same key.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@cache
def _temporary_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="martworks-")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: `spark.checkpoint.dir` of the session, or a temporary one where none is set
    and the master is local."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _temporary_folder(spark.sparkContext.applicationId)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path nothing was written to before."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# Rows of a small table that one task writes, where their number is known to be bounded.
ROWS_PER_TASK = 50_000


def written(df: DataFrame, name: str, compression: str | None = None, at_most: int | None = None) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage, survives lost executors, and readers prune columns.
    `zstd` as `compression` halves keys that are hashes in hexadecimal digits; the session's unless given. `at_most`, a counted
    bound of narrow rows, lets no more tasks write than they are worth: on a local disk Hadoop starts processes for every file,
    and each is a copy of the executor for a moment."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    if at_most is not None:
        df = df.coalesce(max(1, -(-at_most // ROWS_PER_TASK)))
    df.write.parquet(path, compression=compression)
    found = spark.read.schema(df.schema).parquet(path)
    setattr(found, _PATH, path)
    return found


_PATH = "_martworks_path"


def release(*frames: DataFrame) -> None:
    """Delete what `written` stored for these tables. For intermediates that a later one has replaced: nothing may read them any more, also
    no table that is still lazily made of them. Other tables are left alone."""
    for df in frames:
        path = getattr(df, _PATH, None)
        if path:
            spark = df.sparkSession
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
