"""Views, tables and incremental loads.

Plain Parquet has no transactions, so nothing is overwritten where it is read. A table is a catalog view over a catalog entry, its
version: a load writes files to a path of its own, makes a new version of them, and points the view at it by one `ALTER VIEW`. Readers see
the old or the new version, never parts of both, and always find one. A version may take partitions over from the one before, where they
are, so that a load writes what it changes; it may be cut by a column that the view does not show. The entry of the version before is
kept for readers who looked the view up just then; older ones are dropped. Their files stay: deleting them is the operator's job.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martworks.operators.columns import quoted
from martworks.session import release, written

# In the names of version entries, and the property of the views over them.
VERSION, PROPERTY = "__martworks_version_", "martworks.versions"
# The hidden column of tables that are merged by key, and how many parts they have unless told otherwise.
PART, PARTS = "_martworks_part", 16


def as_view(df: DataFrame, name: str) -> DataFrame:
    """A named lazy relation, computed on every read."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


Buckets = tuple[int, Sequence[str]]


def _write(df: DataFrame, path: str, partition_by: Sequence[str] = (), bucket_by: Buckets | None = None) -> None:
    if bucket_by:
        # Rows are brought together by bucket, so that a bucket has few files; a bucket that is far too large is split
        # by adaptive execution into several. Only the catalog knows buckets, hence the passing entry.
        count, keys = bucket_by
        entry = f"martworks_passing_{uuid.uuid4().hex}"
        writer = df.hint("rebalance", count, *keys).write.bucketBy(count, *keys).sortBy(*keys)
        writer.format("parquet").option("path", path).saveAsTable(entry)
        df.sparkSession.sql(f"DROP TABLE {entry}")
    elif partition_by:
        # Without bringing them together, every task would write a file into every partition.
        df.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(path)
    else:
        df.write.parquet(path)


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    return {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}


def is_versioned(spark: SparkSession, name: str) -> bool:
    """Whether `name` is a view over versions."""
    described = _described(spark, name)
    return described.get("Type") == "VIEW" and PROPERTY in described.get("Table Properties", "")


def version_of(spark: SparkSession, name: str) -> str:
    """The catalog entry that holds the rows of `name`: its version, or itself where it is a plain table."""
    described = _described(spark, name)
    return described["View Text"].rpartition(" FROM ")[2] if described.get("Type") == "VIEW" else name


def _layout(spark: SparkSession, name: str) -> tuple[list[str], Buckets | None]:
    """Partition columns and buckets of a catalog table."""
    version = version_of(spark, name)
    columns = spark.catalog.listColumns(version)
    partitions = [c.name for c in columns if c.isPartition]
    keys = [c.name for c in columns if c.isBucket]
    return partitions, (int(_described(spark, version)["Num Buckets"]), keys) if keys else None


def _create(spark: SparkSession, name: str, path: str, df: DataFrame, partition_by, bucket_by: Buckets | None, note: str = "") -> None:
    """A version entry over the files at `path`. `note` is kept with the last column."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]
    if note:
        fields[-1] += f" COMMENT {_text(note)}"
    layout = f"PARTITIONED BY ({', '.join(map(quoted_name, partition_by))})" if partition_by else ""
    if bucket_by:
        keys = ", ".join(bucket_by[1])
        layout = f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {bucket_by[0]} BUCKETS"
    spark.sql(f"CREATE TABLE {name} ({', '.join(fields)}) USING parquet {layout} LOCATION '{path}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name} ADD PARTITIONS")


def quoted_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _next_version(spark: SparkSession, name: str) -> str:
    """A name for the entry of a new version, in the schema of `name`."""
    schema, _, bare = name.rpartition(".")
    return f"{schema or quoted_name(spark.catalog.currentDatabase())}.{bare}{VERSION}{uuid.uuid4().hex}"


def _take_over(spark: SparkSession, version: str, name: str, columns: Sequence[str]) -> None:
    """`name` serves `version` from now on. The entry of the version before stays; older ones go, their files stay."""
    query = f"SELECT {', '.join(map(quoted_name, columns))} FROM {version}"
    before = None
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE VIEW {name} TBLPROPERTIES ('{PROPERTY}' = 'true') AS {query}")
    elif is_versioned(spark, name):
        before = version_of(spark, name)
        spark.sql(f"ALTER VIEW {name} AS {query}")
    else:
        spark.sql(f"DROP TABLE {name}")
        spark.sql(f"CREATE VIEW {name} TBLPROPERTIES ('{PROPERTY}' = 'true') AS {query}")
    _drop_versions(spark, name, [v for v in (version, before) if v])


def _drop_versions(spark: SparkSession, name: str, kept: Collection[str] = ()) -> None:
    schema, _, bare = name.rpartition(".")
    schema = schema or quoted_name(spark.catalog.currentDatabase())
    for row in spark.sql(f"SHOW TABLES IN {schema} LIKE '{bare.lower()}{VERSION}*'").collect():
        entry = f"{schema}.{row['tableName']}"
        if entry.lower() not in {v.lower() for v in kept}:
            spark.sql(f"DROP TABLE IF EXISTS {entry}")


def drop_table(spark: SparkSession, name: str) -> None:
    """Take `name` and its versions out of the catalog. Files stay."""
    if spark.catalog.tableExists(name):
        versioned = is_versioned(spark, name)
        spark.sql(f"DROP {'VIEW' if versioned else 'TABLE'} {name}")
        if versioned:
            _drop_versions(spark, name)


def as_table(
    df: DataFrame, name: str, folder: str, partition_by: Sequence[str] = (), bucket_by: Buckets | None = None
) -> DataFrame:
    """Full rebuild of catalog table `name`: a new version under `folder`, then the switch.

    `partition_by` makes folders by value. `bucket_by`, a number and key columns, lets later joins and groupings on
    these keys go without a shuffle, between tables of the same number of buckets."""
    if partition_by and bucket_by:
        raise ValueError("as_table: pass partition_by or bucket_by, not both")
    return new_version(df, name, folder, partition_by, bucket_by)


def new_version(
    df: DataFrame, name: str, folder: str, partition_by: Sequence[str] = (), bucket_by: Buckets | None = None,
    hidden: str | None = None, note: str = "", kept: Collection[str] | None = None,
) -> DataFrame:
    """Write `df` and switch `name` to it. The view does not show column `hidden`. `kept`: partitions of the version before, by value, that the new
    one takes over where they are; `df` then has the rows of the others."""
    spark = df.sparkSession
    path = f"{folder.rstrip('/')}/{name}/{uuid.uuid4().hex}"
    _write(df, path, partition_by, bucket_by)
    ordered = df.select(*(quoted(c) for c in df.columns if c not in partition_by), *(quoted(c) for c in partition_by))
    version = _next_version(spark, name)
    _create(spark, version, path, ordered, partition_by, bucket_by, note)
    if kept:
        _add_partitions(spark, version, version_of(spark, name), partition_by[0], kept)
    _take_over(spark, version, name, [c for c in ordered.columns if c != hidden])
    return spark.table(name)


def partition_values(spark: SparkSession, version: str) -> list[str | None]:
    """Values of the only partition column of an entry, as text."""
    found = (unquote(row[0].partition("=")[2]) for row in spark.sql(f"SHOW PARTITIONS {version}").collect())
    return [None if value == "__HIVE_DEFAULT_PARTITION__" else value for value in found]


def _add_partitions(spark: SparkSession, version: str, before: str, column: str, values: Collection[str | None]) -> None:
    """Partitions of the entry `before` become partitions of `version`, where they are."""
    added = []
    for value in values:
        spec = f"PARTITION (`{column}` = {'NULL' if value is None else _text(value)})"
        location = spark.sql(f"DESCRIBE TABLE EXTENDED {before} {spec}").filter("col_name = 'Location'").first()["data_type"]
        added.append(f"{spec} LOCATION {_text(location)}")
    if added:
        spark.sql(f"ALTER TABLE {version} ADD {' '.join(added)}")


def _same_columns(name: str, table: DataFrame, new: DataFrame) -> None:
    """Neither gained nor lost columns pass without a word."""
    have, come = {c.lower() for c in table.columns}, {c.lower() for c in new.columns}
    if have != come:
        raise ValueError(f"{name}: the load has other columns: missing {sorted(have - come)}, new {sorted(come - have)}; "
                         "rebuild the table with as_table")


def incremental_append(new: DataFrame, name: str, folder: str) -> DataFrame:
    """Create the table on the first run, add the new rows on later ones. Only new rows are written. Rows with other columns
    than the table's are refused."""
    spark = new.sparkSession
    if not spark.catalog.tableExists(name):
        return as_table(new, name, folder)
    _same_columns(name, spark.table(name), new)
    version = version_of(spark, name)
    stored = spark.table(version)
    if PART in stored.columns:
        count, key = _parts(spark, version)
        new = new.withColumn(PART, _part(new, stored, key, count))
    new.select(*(quoted(c) for c in stored.columns)).write.insertInto(version)
    spark.catalog.refreshTable(version)
    return spark.table(name)


def merged(target: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """`target` with the rows of `new` in place of those with the same key. The new rows must be unique by key."""
    keys = new.select(*(quoted(k) for k in key)).distinct()
    kept = target.join(keys, list(key), "left_anti")
    return kept.unionByName(new.select(*(quoted(c) for c in target.columns)))


def _part(new: DataFrame, target: DataFrame, key: Sequence[str], count: int) -> Column:
    """The part of a row: of keys as the target has them."""
    types = {f.name.lower(): f.dataType for f in target.schema.fields}
    return F.pmod(F.xxhash64(*(quoted(k).cast(types[k.lower()]) for k in key)), F.lit(count)).cast("int")


def _parts(spark: SparkSession, version: str) -> tuple[int, list[str]]:
    """How many parts an entry has, and the key they are made by."""
    note = next(c.description for c in spark.catalog.listColumns(version) if c.name == PART)
    count, *key = note.split(" ")
    return int(count), [unquote(k) for k in key]


def _by_key(df: DataFrame, name: str, folder: str, key: Sequence[str], count: int) -> DataFrame:
    """A full version of `name` in parts by key."""
    note = " ".join([str(count), *(k.replace("%", "%25").replace(" ", "%20") for k in key)])
    return new_version(df.withColumn(PART, _part(df, df, key, count)), name, folder, [PART], hidden=PART, note=note)


def incremental_merge(
    new: DataFrame, name: str, folder: str, key: Sequence[str], partition_by: str | None = None, parts: int = PARTS
) -> DataFrame:
    """Create the table on the first run, replace and add rows by key on later ones. The new rows must be unique by key. Rows with other
    columns than the table's are refused.

    A load writes what it touches; the new version takes everything else over where it is. With `partition_by`, that is by
    partitions that hold one of the keys, before or after the load. Without it the table is kept in `parts` by a hash of the key, and
    parts without a key of the load are neither read nor written. Take so many that one part is some hundred megabytes. Tables with another
    layout are brought into parts by the first merge; those in buckets stay so, and are written anew as a whole. The driver handles
    partition values, as the catalog does."""
    spark = new.sparkSession
    if not spark.catalog.tableExists(name):
        return as_table(new, name, folder, [partition_by]) if partition_by else _by_key(new, name, folder, key, parts)
    target = spark.table(name)
    _same_columns(name, target, new)
    version = version_of(spark, name)
    stored = spark.table(version)
    if partition_by is None:
        buckets = _layout(spark, name)[1]
        if buckets:
            return as_table(merged(target, new, key), name, folder, bucket_by=buckets)
        if PART not in stored.columns or _parts(spark, version)[1] != list(key):
            return _by_key(merged(target, new, key), name, folder, key, parts)
        count, _ = _parts(spark, version)
        new = written(new.withColumn(PART, _part(new, stored, key, count)), "merge-load")
        values = {str(row[0]) for row in new.select(PART).distinct().collect()}
        touched = quoted(PART).isin([int(v) for v in values])
        note = next(c.description for c in spark.catalog.listColumns(version) if c.name == PART)
        column, hidden = PART, PART
    else:
        new = written(new, "merge-load")
        keys = new.select(*(quoted(k) for k in key)).distinct()
        part = quoted(partition_by)
        before = stored.join(keys, list(key), "left_semi").select(part)
        values = {row[0] for row in before.union(new.select(part)).distinct().select(part.cast("string")).collect()}
        touched = part.cast("string").isin([v for v in values if v is not None])
        if None in values:
            touched = touched | part.isNull()
        column, hidden, note = partition_by, None, ""
    if not values:
        return target
    kept = [v for v in partition_values(spark, version) if v not in values]
    changed = merged(stored.filter(touched), new, key)
    found = new_version(changed, name, folder, [column], hidden=hidden, note=note, kept=kept)
    release(new)
    return found


def store_failures(failing: DataFrame, path: str) -> DataFrame:
    """Keep the rows a check returned, all their columns."""
    _write(failing, path)
    return failing.sparkSession.read.schema(failing.schema).parquet(path)
