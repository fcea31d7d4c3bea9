from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martworks import fixed_values as fixed
from martworks import functions as fn
from martworks import operators as op
from martworks import sources
from martworks.entries.mapping import table
from martworks.session import fresh_path, written


def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        fn.surrogate_key(["o_custkey", status, "o_orderpriority"]).alias("key"),
        fn.surrogate_key([status, "o_custkey"], nulls_as_empty=True).alias("key_nulls_empty"),
    )


def safe_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.nullif(F.col("l_linenumber"), F.lit(1))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        fn.safe_add([number, "l_partkey", "l_suppkey"]).alias("added"),
        fn.safe_subtract(["l_partkey", number]).alias("subtracted"),
        F.round(fn.safe_divide("l_partkey", F.col("l_suppkey") % 5), 6).alias("divided"),
    )


def money_and_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        fn.cents_to_dollars(cents).alias("dollars"),
        fn.to_bool(F.nullif(F.col("o_orderstatus"), F.lit("P")) == "O").alias("is_open"),
        *(fn.truncated("o_orderdate", part).alias(f"order_{part}") for part in ("day", "month", "quarter", "year")),
        fn.add_units("month", 1, "o_orderdate").cast("date").alias("next_month"),
        *(
            fn.boundaries_between(part, F.lit("1995-06-15").cast("timestamp_ntz"), "o_orderdate").alias(f"{part}s")
            for part in ("day", "month", "year")
        ),
    )


def haversine(spark: SparkSession, sf_dir: str) -> DataFrame:
    def degrees(key: str, span: int):
        return (F.col(key) % span - span / 2).cast("double")

    points = degrees("l_partkey", 180), degrees("l_orderkey", 360), degrees("l_suppkey", 170), degrees("l_linenumber", 7)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.round(fn.haversine(*points), 4).alias("miles"),
        F.round(fn.haversine(*points, unit="km"), 4).alias("kilometres"),
    )


def width_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", fn.width_bucket("value", 5.0, 45.0, 8).cast("bigint").alias("bucket")
    )


def width_bucket_macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        fn.width_bucket_macro("l_quantity", 1, 41, 8).cast("bigint").alias("bucket"),
    )


def slugify(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat_ws(" - ", F.col("p_size").cast("string"), "p_name", "p_brand")
    return table(spark, sf_dir, "part").select(
        "p_partkey", fn.slugify(text).alias("slug"), fn.slugify("p_brand").alias("brand_slug")
    )


def single_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    dearest = orders.orderBy(F.desc("o_totalprice"), "o_orderkey").select("o_orderkey")
    nothing = orders.filter("o_orderstatus = 'none'").select("o_orderkey")
    return table(spark, sf_dir, "nation").select(
        "n_nationkey", fn.single_value(dearest).alias("dearest_order"), fn.single_value(nothing, -1).alias("fallback")
    )


def _urls(spark: SparkSession, sf_dir: str, *columns) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", *columns)


def url_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _urls(spark, sf_dir, fn.url_host("url").alias("host"))


def url_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    bare = F.replace(F.split_part(F.col("url"), F.lit("/"), F.lit(3)), F.lit("."), F.lit("?"))
    return _urls(spark, sf_dir, fn.url_path("url").alias("path"), fn.url_path(bare).alias("path_without_slash"))


def url_parameter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _urls(spark, sf_dir, *(fn.url_parameter("url", name).alias(name) for name in ("page", "ref")))


def star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.star(
        table(spark, sf_dir, "part"), except_=["P_TYPE", "p_size"], prefix="the_", suffix="_x", rename={"P_PARTKEY": "id"}
    )


def nullcheck_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    blanked = F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment"))
    return op.nullcheck_table(table(spark, sf_dir, "customer").withColumn("c_mktsegment", blanked))


def group_by_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    return op.group_by_first(
        lines, 2, F.count(F.lit(1)).alias("lines"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
        op.count_where(F.col("l_quantity") > 25).alias("large"),
        F.round(op.not_null_share(F.nullif(F.col("l_quantity"), F.lit(1.0))).cast("double"), 6).alias("known_share"),
    )


def column_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.column_values(table(spark, sf_dir, "orders"), "o_custkey", limit=25, where="o_orderstatus <> 'F'")


def join_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    # One more customer, who never ordered.
    customers = customers.union(customers.agg(F.max("custkey") + 1_000_000, F.lit("newcomer")))
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "custkey")
    return op.join_summary(
        customers, orders, "custkey", F.count(F.lit(1)).alias("orders"), F.max("o_orderdate").alias("latest")
    )


def sequence_no(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id")
    return op.sequence_no(events, ["user_id"], ["ts", "event_id"], "visit")


def pivot_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    values = op.column_value_list(events, "event_type")
    return op.pivot(events, ["user_id"], "event_type", values, prefix="n_")


def pivot_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    return op.pivot(
        parts, ["p_brand"], "p_size", [10, 20, 40], agg="max", cmp="<=", prefix="Dearest up to ", suffix=" - price",
        then_value="p_retailprice", else_value=None, quote_identifiers=False,
    )


EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def pivot_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.pivot(
        table(spark, sf_dir, "events"), ["user_id"], "event_type", EVENT_TYPES, agg="count", suffix=" days",
        then_value=F.to_date("ts"), else_value=None, distinct=True,
    )


def pivot_stddev(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op.pivot(
        table(spark, sf_dir, "part"), ["p_brand"], "p_type", ["p%", "s%"], agg="stddev_pop", cmp="not ilike", prefix="not ",
        then_value="p_size", else_value=None, quote_identifiers=False,
    )
    return found.select("p_brand", *(F.round(c, 6).alias(c) for c in found.columns[1:]))


def sequence_no_whole_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines in one group, numbered by order, line, part and supplier."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return op.sequence_no(table(spark, sf_dir, "lineitem").select(*keys), [], keys, "n")


def union_of_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two schemas with a table of one name each: both are in the union, told apart by their full names."""
    tag = f"martworks_{uuid.uuid4().hex[:8]}"
    partners = dict(zip(("north", "south"), _partners(spark, sf_dir).values()))
    schemas = [f"{tag}_{name}" for name in partners]
    try:
        for schema, df in zip(schemas, partners.values()):
            spark.sql(f"CREATE DATABASE {schema} LOCATION '{fresh_path(spark, schema)}'")
            path = fresh_path(spark, "partners")
            df.write.parquet(path)
            spark.sql(f"CREATE TABLE {schema}.partners USING parquet LOCATION '{path}'")
        found = sources.relations_by_pattern(spark, f"{tag}%", "partners")
        union = op.union_relations(sources.read_relations(spark, found), include=["key", "name"], source_column_name="source")
        return written(union.withColumn("source", F.replace("source", F.lit(f"{tag}_"), F.lit(""))), "union")
    finally:
        for schema in schemas:
            spark.sql(f"DROP DATABASE IF EXISTS {schema} CASCADE")


def unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_name", "c_acctbal", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"),
        (F.col("c_nationkey") > 10).alias("is_far"),
    )
    return op.unpivot(customers, exclude=["c_custkey"], remove=["C_ACCTBAL"], field_name="field", value_name="val")


def deduplicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("o_orderpriority", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")))
    return op.deduplicate(orders, ["o_custkey", "o_orderstatus"], [F.desc("o_orderdate"), "o_orderkey"])


def generate_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities from 1 to the largest one, with how many lines have each."""
    lines = table(spark, sf_dir, "lineitem")
    upper = int(lines.agg(F.max("l_quantity")).first()[0]) + 5
    counts = lines.groupBy(F.col("l_quantity").cast("bigint").alias("generated_number")).agg(
        F.count(F.lit(1)).alias("lines")
    )
    return op.generate_series(spark, upper).join(counts, "generated_number", "left").select(
        "generated_number", F.coalesce("lines", F.lit(0)).alias("lines")
    )


def date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hour of the events, also those without one, to the end of the last day."""
    events = table(spark, sf_dir, "events")
    first, end = events.agg(F.min(F.to_date("ts")), F.date_add(F.max(F.to_date("ts")), 1)).first()
    counts = events.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("date_hour")).agg(
        F.count(F.lit(1)).alias("events")
    )
    return op.date_spine(spark, "hour", first, end).filter(F.col("date_hour") < F.lit(end)).join(counts, "date_hour", "left").select(
        "date_hour", F.coalesce("events", F.lit(0)).alias("events")
    )


def date_spine_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every month from a customer's first to the last order, the last month included."""
    bounds = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.trunc(F.min("o_orderdate"), "month").alias("first_month"),
        F.add_months(F.trunc(F.max("o_orderdate"), "month"), 1).alias("end_month"),
    )
    spine = op.date_spine_between(bounds, "month", "first_month", "end_month")
    return spine.filter(F.col("date_month") < F.col("end_month"))


def _partners(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_nationkey").alias("nation"), F.col("c_name").alias("name"), "c_mktsegment"
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("KEY"), F.col("s_name").alias("name"), "s_acctbal"
    )
    return {"customer": customers, "supplier": suppliers}


def union_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.union_relations(
        _partners(spark, sf_dir), column_override={"nation": "bigint"}, exclude=["s_acctbal"], source_column_name="source",
        where="key % 3 <> 0",
    )


def union_by_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    for name, df in _partners(spark, sf_dir).items():
        sources.as_view(df, f"martworks_partner_{name}")
    found = sources.relations_by_prefix(spark, "%", "MARTWORKS_partner_", exclude="%_other")
    return op.union_relations(
        sources.read_relations(spark, found), include=["key", "name"], source_column_name="source"
    )


def symmetric_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return op.symmetric_diff(
        orders.filter("o_orderstatus = 'O'").select(F.col("o_custkey").alias("customer")),
        orders.filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("customer")),
    )


QUERIES = {
    "surrogate_key": surrogate_key,
    "safe_math": safe_math,
    "money_and_dates": money_and_dates,
    "haversine": haversine,
    "width_bucket": width_bucket,
    "width_bucket_macro": width_bucket_macro,
    "slugify": slugify,
    "single_value": single_value,
    "url_host": url_host,
    "url_path": url_path,
    "url_parameter": url_parameter,
    "star": star,
    "nullcheck_table": nullcheck_table,
    "group_by_first": group_by_first,
    "column_values": column_values,
    "join_summary": join_summary,
    "sequence_no": sequence_no,
    "sequence_no_whole_table": sequence_no_whole_table,
    "pivot_counts": pivot_counts,
    "pivot_custom": pivot_custom,
    "pivot_distinct": pivot_distinct,
    "pivot_stddev": pivot_stddev,
    "unpivot": unpivot,
    "deduplicate": deduplicate,
    "generate_series": generate_series,
    "date_spine": date_spine,
    "date_spine_between": date_spine_between,
    "union_relations": union_relations,
    "union_by_prefix": union_by_prefix,
    "union_of_schemas": union_of_schemas,
    "symmetric_diff": symmetric_diff,
}

HAVERSINE = """2 * 3961 * asin(sqrt(
    power(sin(radians((lat2 - lat1) / 2)), 2)
    + cos(radians(lat1)) * cos(radians(lat2)) * power(sin(radians((lon2 - lon1) / 2)), 2)))"""
BARE = "regexp_replace({0}, 'https?://', '', 'g')"
PATH = (
    f"case when contains({BARE}, '/') then split_part(substr({BARE}, instr({BARE}, '/') + 1), '?', 1) "
    f"when contains({BARE}, '?') then '' else {BARE} end"
)
BARE_URL = "replace(split_part(url, '/', 3), '.', '?')"
SLUG = (
    "regexp_replace(regexp_replace(regexp_replace(lower({0}), '[ -]+', '_', 'g'), '[^a-z0-9_]+', '', 'g'), "
    "'^([0-9])', '_\\1')"
)
PARTNERS = """
with customers as (select c_custkey as key, c_nationkey as nation, c_name as name, c_mktsegment from customer),
     suppliers as (select s_suppkey as key, s_name as name from supplier)"""

ORACLE = {
    "surrogate_key": f"""
        select o_orderkey,
               md5(concat(cast(o_custkey as varchar), '-',
                          coalesce(nullif(o_orderstatus, 'P'), '{fixed.NULL_KEY_TEXT}'), '-', o_orderpriority))
                   as key,
               md5(concat(coalesce(nullif(o_orderstatus, 'P'), ''), '-', cast(o_custkey as varchar))) as key_nulls_empty
        from orders""",
    "safe_math": """
        select l_orderkey, l_linenumber, l_partkey, l_suppkey,
               coalesce(nullif(l_linenumber, 1), 0) + coalesce(l_partkey, 0) + coalesce(l_suppkey, 0) as added,
               coalesce(l_partkey, 0) - coalesce(nullif(l_linenumber, 1), 0) as subtracted,
               round(l_partkey / nullif(l_suppkey % 5, 0), 6) as divided
        from lineitem""",
    "money_and_dates": """
        select o_orderkey, cast(cast(round(o_totalprice * 100) as bigint) / 100.0 as decimal(16,2)) as dollars,
               coalesce(nullif(o_orderstatus, 'P') = 'O', false) as is_open,
               cast(o_orderdate as date) as order_day, cast(date_trunc('month', o_orderdate) as date) as order_month,
               cast(date_trunc('quarter', o_orderdate) as date) as order_quarter,
               cast(date_trunc('year', o_orderdate) as date) as order_year,
               cast(o_orderdate + interval 1 month as date) as next_month,
               date_diff('day', timestamp '1995-06-15', o_orderdate) as days,
               date_diff('month', timestamp '1995-06-15', o_orderdate) as months,
               date_diff('year', timestamp '1995-06-15', o_orderdate) as years
        from orders""",
    "haversine": f"""
        select l_orderkey, l_linenumber, l_partkey, l_suppkey, round({HAVERSINE}, 4) as miles,
               round({HAVERSINE} * 1.60934e0, 4) as kilometres
        from (select *, l_partkey % 180 - 90e0 as lat1, l_orderkey % 360 - 180e0 as lon1, l_suppkey % 170 - 85e0 as lat2,
                     l_linenumber % 7 - 3.5e0 as lon2 from lineitem)""",
    "width_bucket": """
        select event_id, cast(case when value < 5 then 0 when value >= 45 then 9
                                   else floor((value - 5) * 8 / 40e0) + 1 end as bigint) as bucket
        from events""",
    "width_bucket_macro": """
        select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
               cast(case when try_cast(l_quantity as decimal(28,6)) % cast(5 as decimal(28,6)) = 0 then 1 else 0 end
                    + least(ceil((l_quantity - 1) / ((41 - 1) / 8)), 8 + 1) as bigint) as bucket
        from lineitem""",
    "slugify": f"""
        select p_partkey, {SLUG.format("concat_ws(' - ', cast(p_size as varchar), p_name, p_brand)")} as slug,
               {SLUG.format("p_brand")} as brand_slug
        from part""",
    "single_value": """
        select n_nationkey, (select o_orderkey from orders order by o_totalprice desc, o_orderkey limit 1) as dearest_order,
               cast(-1 as bigint) as fallback
        from nation""",
    "url_host": """
        select page_id, regexp_extract(regexp_replace(url, 'android-app://|https?://', '', 'g'), '^[^/?]*') as host
        from pages""",
    "url_path":
        f"select page_id, {PATH.format('url')} as path, {PATH.format(BARE_URL)} as path_without_slash from pages",
    "url_parameter": """
        select page_id, nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') as page,
               nullif(split_part(split_part(url, 'ref=', 2), '&', 1), '') as ref
        from pages""",
    "star": """
        select p_partkey as id, p_name as the_p_name_x, p_brand as the_p_brand_x, p_retailprice as the_p_retailprice_x
        from part""",
    "nullcheck_table": """
        select c_custkey, nullif(c_name, '') as c_name, c_nationkey, c_acctbal,
               nullif(c_mktsegment, 'BUILDING') as c_mktsegment
        from customer""",
    "group_by_first": """
        select l_returnflag, l_linestatus, count(*) as lines, cast(sum(cast(l_quantity as bigint)) as bigint) as quantity,
               cast(sum(case when l_quantity > 25 then 1 else 0 end) as bigint) as large,
               round(count(nullif(l_quantity, 1)) / cast(count(*) as double), 6) as known_share
        from lineitem group by 1, 2""",
    "column_values": """
        select o_custkey as value, count(*) as n from orders where o_orderstatus <> 'F'
        group by o_custkey order by n desc, value limit 25""",
    "join_summary": """
        with people as (select c_custkey as custkey, c_name from customer
                        union all select max(c_custkey) + 1000000, 'newcomer' from customer)
        select custkey, c_name, count(o_orderkey) filter (o_orderkey is not null) as orders, max(o_orderdate) as latest
        from people join orders on custkey = o_custkey group by all
        union all
        select custkey, c_name, null, null from people where custkey not in (select o_custkey from orders)""",
    "sequence_no": """
        select user_id, ts, event_id, row_number() over (partition by user_id order by ts, event_id) as visit
        from events""",
    "sequence_no_whole_table": """
        select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, row_number() over (
                   order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) as n
        from lineitem""",
    "pivot_counts": """
        select user_id, """ + ", ".join(
            f"cast(sum(case when event_type = '{t}' then 1 else 0 end) as bigint) as n_{t}"
            for t in ("click", "error", "purchase", "signup", "view")
        ) + " from events group by user_id",
    "pivot_custom": """
        select p_brand, """ + ", ".join(
            f"max(case when p_size <= {n} then p_retailprice end) as dearest_up_to_{n}_price" for n in (10, 20, 40)
        ) + " from part group by p_brand",
    "pivot_distinct": """
        select user_id, """ + ", ".join(
            f"count(distinct case when event_type = '{t}' then cast(ts as date) end) as \"{t} days\"" for t in EVENT_TYPES
        ) + " from events group by user_id",
    "pivot_stddev": """
        select p_brand, round(stddev_pop(p_size) filter (p_type not ilike 'p%'), 6) as not_p,
               round(stddev_pop(p_size) filter (p_type not ilike 's%'), 6) as not_s
        from part group by p_brand""",
    "unpivot": """
        select c_custkey, 'c_nationkey' as field, cast(c_nationkey as varchar) as val from customer
        union all select c_custkey, 'c_name', c_name from customer
        union all select c_custkey, 'segment', nullif(c_mktsegment, 'BUILDING') from customer
        union all select c_custkey, 'is_far', cast(c_nationkey > 10 as varchar) from customer""",
    "deduplicate": """
        select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
               nullif(o_orderpriority, '5-LOW') as o_orderpriority
        from orders
        qualify row_number() over (partition by o_custkey, o_orderstatus order by o_orderdate desc, o_orderkey) = 1""",
    "generate_series": """
        select n as generated_number, count(l_quantity) as lines
        from (select unnest(range(1, cast((select max(l_quantity) from lineitem) as bigint) + 6)) as n) as series
        left join lineitem on l_quantity = n group by n""",
    "date_spine": """
        select date_hour, count(event_id) as events
        from (select unnest(range((select cast(min(cast(ts as date)) as timestamp) from events),
                                  (select cast(max(cast(ts as date)) + 1 as timestamp) from events), interval 1 hour))
                     as date_hour) as spine
        left join events on date_trunc('hour', ts) = date_hour group by date_hour""",
    "date_spine_between": """
        select o_custkey, first_month, end_month, cast(unnest(range(cast(first_month as timestamp), cast(end_month as timestamp),
                                                                    interval 1 month)) as date) as date_month
        from (select o_custkey, cast(date_trunc('month', min(o_orderdate)) as date) as first_month,
                     cast(date_trunc('month', max(o_orderdate)) + interval 1 month as date) as end_month
              from orders group by o_custkey)""",
    "union_relations": f"""{PARTNERS}
        select 'customer' as source, key, cast(nation as bigint) as nation, name, c_mktsegment from customers
        where key % 3 <> 0
        union all select 'supplier', key, null, name, null from suppliers where key % 3 <> 0""",
    "union_by_prefix": f"""{PARTNERS}
        select 'martworks_partner_customer' as source, key, name from customers
        union all select 'martworks_partner_supplier', key, name from suppliers""",
    "union_of_schemas": f"""{PARTNERS}
        select 'north.partners' as source, key, name from customers union all select 'south.partners', key, name from suppliers""",
    "symmetric_diff": """
        with a as (select o_custkey as customer from orders where o_orderstatus = 'O'),
             b as (select o_custkey as customer from orders where o_orderpriority = '1-URGENT')
        select 'a_minus_b' as which_diff, * from (select * from a except select * from b)
        union all select 'b_minus_a', * from (select * from b except select * from a)""",
}
