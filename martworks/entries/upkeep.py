from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martworks import checks, sources
from martworks import fixed_values as fixed
from martworks.entries.mapping import table
from martworks.session import fresh_path, shared_folder, written

FIRST_RUN, SECOND_RUN = datetime(2024, 1, 1), datetime(2024, 2, 1)


def _table_name(kind: str) -> str:
    return f"martworks_{kind}_{uuid.uuid4().hex[:12]}"


def _without_entry(loaded: DataFrame, name: str) -> DataFrame:
    """The rows of a table whose catalog entry was only made for a query: kept, while the entry goes."""
    found = written(loaded, "loaded")
    sources.drop_table(loaded.sparkSession, name)
    return found


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("day"))


def _corrected(orders: DataFrame) -> DataFrame:
    """A later delivery: urgent corrections of known orders, and new ones."""
    corrections = orders.filter("o_orderstatus = 'P'").withColumn("o_orderstatus", F.lit("D"))
    return corrections.union(orders.filter("o_custkey % 10 = 3").withColumn("o_orderkey", -F.col("o_orderkey") - 1))


def incremental_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, name = _orders(spark, sf_dir), _table_name("append")
    for status in ("F", "O", "P"):
        loaded = sources.incremental_append(orders.filter(F.col("o_orderstatus") == status), name, shared_folder(spark))
    return _without_entry(loaded, name)


def incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, name = _orders(spark, sf_dir), _table_name("merge")
    for delivery in (orders, _corrected(orders)):
        loaded = sources.incremental_merge(delivery, name, shared_folder(spark), ["o_orderkey"])
    return _without_entry(loaded, name)


def incremental_merge_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir).withColumn("year", F.year("day"))
    moved = _corrected(orders.filter("year in (1995, 1996)")).withColumn("year", F.lit(1995))
    name = _table_name("merge_by_year")
    for delivery in (orders, moved):
        loaded = sources.incremental_merge(delivery, name, shared_folder(spark), ["o_orderkey"], "year")
    return _without_entry(loaded, name)


def table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table rebuilt from scratch, read through a view."""
    orders, name = _orders(spark, sf_dir), _table_name("orders")
    sources.as_table(orders, name, shared_folder(spark))
    rebuilt = sources.as_table(orders.withColumn("year", F.year("day")), name, shared_folder(spark))
    return _without_entry(sources.as_view(rebuilt, "martworks_orders_with_year"), name)


def table_rebuild_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned table rebuilt: one partition is gone, one is new, the others have other rows."""
    orders, name = _orders(spark, sf_dir), _table_name("by_status")
    sources.as_table(orders, name, shared_folder(spark), ["o_orderstatus"])
    renamed = orders.withColumn("o_orderstatus", F.when(F.col("o_orderstatus") == "P", "N").otherwise(F.col("o_orderstatus")))
    rebuilt = sources.as_table(renamed.withColumn("o_custkey", -F.col("o_custkey")), name, shared_folder(spark), ["o_orderstatus"])
    return _without_entry(rebuilt, name)


def source_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw table read by its name."""
    root = fresh_path(spark, "raw")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"))
    customers.write.parquet(f"{root}/raw_customers")
    return sources.source(spark, "raw_customers", root)


def csv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("00"), F.col("c_custkey")).alias("id"), F.concat(F.col("c_name"), F.lit(', "x" ')).alias("name"),
        "c_nationkey", "c_acctbal", (F.col("c_nationkey") > 12).alias("is_far"),
    )
    path = fresh_path(spark, "customers_csv")
    customers.write.csv(path, header=True, escape='"', ignoreTrailingWhiteSpace=False)
    return sources.load_csv(spark, path, "id string, name string, c_nationkey int, c_acctbal double, is_far boolean")


def store_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    failing = checks.accepted_range(table(spark, sf_dir, "part"), "p_retailprice", max_value=950)
    return sources.store_failures(failing, fresh_path(spark, "failures"))


def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.freshness(
        table(spark, sf_dir, "events"), "ts", warn_after=(12, "hour"), error_after=(3, "day"), as_of=datetime(2024, 2, 1)
    )


def _customers(spark: SparkSession, sf_dir: str, version: int) -> DataFrame:
    """Customers as delivered: from version 2 on every seventh has moved, and a few appear or leave."""
    customers = table(spark, sf_dir, "customer")
    moved = (F.col("c_custkey") % 7 == 0) & F.lit(version > 1)
    kept = F.col("c_custkey") % 11 != (5 if version > 1 else 6)
    return customers.filter(kept).select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.when(moved, F.lit(99)).otherwise(F.col("c_nationkey")).alias("nation"),
        F.when(moved, F.lit("2024-01-15")).otherwise(F.lit("2023-12-01")).cast("timestamp_ntz").alias("changed_at"),
    )


def _history_by_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    def source(version: int) -> DataFrame:
        return _customers(spark, sf_dir, version).drop("changed_at")

    first = sources.snapshot(None, source(1), ["id"], check_cols=["name", "nation"], as_of=FIRST_RUN)
    return sources.snapshot(written(first, "history"), source(2), ["id"], check_cols=["name", "nation"], as_of=SECOND_RUN)


def snapshot_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs of a history kept as a table; the last one finds nothing new."""
    name = _table_name("history")
    for version in (1, 2, 2):
        history = sources.snapshot_table(_customers(spark, sf_dir, version), name, shared_folder(spark), ["id"], updated_at="changed_at")
    return _without_entry(history, name)


def snapshot_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history_by_check(spark, sf_dir)


def snapshot_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source gains a column: versions of before have nulls there."""
    first = _customers(spark, sf_dir, 1).drop("nation")
    history = written(sources.snapshot(None, first, ["id"], updated_at="changed_at"), "history")
    return sources.snapshot(history, _customers(spark, sf_dir, 2), ["id"], updated_at="changed_at")


def snapshot_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row without key, the same at both runs: nothing is added."""
    source = _customers(spark, sf_dir, 1).withColumn("id", F.expr("nullif(id, 1)"))
    history = written(sources.snapshot(None, source, ["id"], updated_at="changed_at"), "history")
    return sources.snapshot(history, source, ["id"], updated_at="changed_at").select("id", "name", fixed.VALID_FROM, fixed.VALID_TO)


def snapshot_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = _history_by_check(spark, sf_dir)
    now = sources.current(history).groupBy(F.lit("now").alias("picture"), "nation")
    then = sources.as_of(history, datetime(2024, 1, 20)).groupBy(F.lit("then").alias("picture"), "nation")
    return now.agg(F.count(F.lit(1)).alias("customers")).union(then.agg(F.count(F.lit(1)).alias("customers")))


QUERIES = {
    "incremental_append": incremental_append,
    "incremental_merge": incremental_merge,
    "incremental_merge_partitioned": incremental_merge_partitioned,
    "table_roundtrip": table_roundtrip,
    "table_rebuild_partitioned": table_rebuild_partitioned,
    "source_scan": source_scan,
    "snapshot_new_column": snapshot_new_column,
    "snapshot_null_key": snapshot_null_key,
    "csv_load": csv_load,
    "store_failures": store_failures,
    "freshness": freshness,
    "snapshot_timestamp": snapshot_timestamp,
    "snapshot_check": snapshot_check,
    "snapshot_as_of": snapshot_as_of,
}

ORDERS = "select o_orderkey, o_custkey, o_orderstatus, cast(o_orderdate as date) as day from orders"
HISTORY = """
with one as (select c_custkey as id, c_name as name, c_nationkey as nation from customer where c_custkey % 11 <> 6),
     two as (select c_custkey as id, c_name as name, case when c_custkey % 7 = 0 then 99 else c_nationkey end as nation
             from customer where c_custkey % 11 <> 5),
     history as (
        select one.*, timestamp '2024-01-01' as valid_from,
               case when two.nation <> one.nation then timestamp '2024-02-01' end as valid_to
        from one left join two on one.id = two.id
        union all
        select two.*, timestamp '2024-02-01', null from two left join one on one.id = two.id
        where one.id is null or two.nation <> one.nation)"""


def _bookkeeping(start: str, end: str) -> str:
    text = f"strftime({start}, '%Y-%m-%d %H:%M:%S')"
    return (
        f"md5(concat(cast(id as varchar), '|', {text})) as {fixed.VERSION_ID}, {start} as {fixed.UPDATED_AT}, "
        f"{start} as {fixed.VALID_FROM}, {end} as {fixed.VALID_TO}"
    )


ORACLE = {
    "incremental_append": ORDERS,
    "incremental_merge": f"""
        select o_orderkey, o_custkey, case when o_orderstatus = 'P' then 'D' else o_orderstatus end as o_orderstatus, day
        from ({ORDERS})
        union all select -o_orderkey - 1, o_custkey, o_orderstatus, day from ({ORDERS}) where o_custkey % 10 = 3""",
    "incremental_merge_partitioned": f"""
        with o as (select *, cast(year(day) as integer) as year from ({ORDERS}))
        select o_orderkey, o_custkey,
               case when o_orderstatus = 'P' and year in (1995, 1996) then 'D' else o_orderstatus end as o_orderstatus, day,
               case when o_orderstatus = 'P' and year in (1995, 1996) then 1995 else year end as year
        from o
        union all select -o_orderkey - 1, o_custkey, o_orderstatus, day, 1995 from o
        where o_custkey % 10 = 3 and year in (1995, 1996)""",
    "table_roundtrip": f"select *, cast(year(day) as integer) as year from ({ORDERS})",
    "table_rebuild_partitioned": f"""
        select o_orderkey, -o_custkey as o_custkey, replace(o_orderstatus, 'P', 'N') as o_orderstatus, day from ({ORDERS})""",
    "source_scan": "select cast(c_custkey as varchar) as id, c_name as name from customer",
    "snapshot_null_key": f"""
        select nullif(c_custkey, 1) as id, c_name as name, timestamp '2023-12-01' as {fixed.VALID_FROM},
               cast(null as timestamp) as {fixed.VALID_TO} from customer where c_custkey % 11 <> 6""",
    "csv_load": """
        select concat('00', cast(c_custkey as varchar)) as id, concat(c_name, ', "x" ') as name, c_nationkey, c_acctbal,
               c_nationkey > 12 as is_far
        from customer""",
    "store_failures": "select * from part where not p_retailprice <= 950",
    "freshness": """
        select max(ts) as max_loaded_at, timestamp '2024-02-01' as snapshotted_at,
               cast(floor(epoch(timestamp '2024-02-01' - max(ts))) as bigint) as age_seconds,
               case when max(ts) < timestamp '2024-01-29' then 'error'
                    when max(ts) < timestamp '2024-01-31 12:00:00' then 'warn' else 'pass' end as status
        from events""",
    "snapshot_timestamp": f"""
        with one as (select c_custkey as id, c_name as name, c_nationkey as nation, timestamp '2023-12-01' as changed_at
                     from customer where c_custkey % 11 <> 6),
             two as (select c_custkey as id, c_name as name,
                            case when c_custkey % 7 = 0 then 99 else c_nationkey end as nation,
                            case when c_custkey % 7 = 0 then timestamp '2024-01-15' else timestamp '2023-12-01' end
                                as changed_at
                     from customer where c_custkey % 11 <> 5),
             history as (
                select one.*, case when two.changed_at > one.changed_at then two.changed_at end as valid_to
                from one left join two on one.id = two.id
                union all
                select two.*, null from two left join one on one.id = two.id
                where one.id is null or two.changed_at > one.changed_at)
        select id, name, nation, changed_at, {_bookkeeping("changed_at", "valid_to")} from history""",
    "snapshot_new_column": f"""
        with one as (select c_custkey as id, c_name as name, timestamp '2023-12-01' as changed_at
                     from customer where c_custkey % 11 <> 6),
             two as (select c_custkey as id, c_name as name,
                            case when c_custkey % 7 = 0 then 99 else c_nationkey end as nation,
                            case when c_custkey % 7 = 0 then timestamp '2024-01-15' else timestamp '2023-12-01' end
                                as changed_at
                     from customer where c_custkey % 11 <> 5),
             history as (
                select one.*, null as nation, case when two.changed_at > one.changed_at then two.changed_at end as valid_to
                from one left join two on one.id = two.id
                union all
                select two.id, two.name, two.changed_at, two.nation, null from two left join one on one.id = two.id
                where one.id is null or two.changed_at > one.changed_at)
        select id, name, nation, changed_at, {_bookkeeping("changed_at", "valid_to")} from history""",
    "snapshot_check": f"{HISTORY} select id, name, nation, {_bookkeeping('valid_from', 'valid_to')} from history",
    "snapshot_as_of": f"""{HISTORY}
        select 'now' as picture, nation, count(*) as customers from history where valid_to is null group by nation
        union all
        select 'then' as picture, nation, count(*) as customers from history
        where timestamp '2024-01-20' between valid_from and coalesce(valid_to, timestamp '9999-12-31') group by nation""",
}
