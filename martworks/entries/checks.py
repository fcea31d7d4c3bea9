from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martworks import checks
from martworks.entries.mapping import table

AS_OF = datetime(2024, 1, 30)


def nulled(column: str, value) -> F.Column:
    """The test tables hold no nulls, so queries about null rules turn one value into null."""
    return F.nullif(F.col(column), F.lit(value)).alias(column)


def not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.not_null(
        table(spark, sf_dir, "orders").select("o_orderkey", nulled("o_orderpriority", "5-LOW")), "o_orderpriority"
    )


def unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.unique(table(spark, sf_dir, "lineitem"), "l_orderkey")


def accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(nulled("event_type", "signup"))
    return checks.accepted_values(events, "event_type", ["click", "purchase", "view"])


def relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    parents = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'F'")
    return checks.relationships(table(spark, sf_dir, "lineitem"), "l_orderkey", parents, "o_orderkey")


def expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", nulled("l_quantity", 50.0)
    )
    return checks.expression_is_true(lines, "l_quantity <= l_linenumber * 10")


def expression_on_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return checks.expression_is_true(customers, "> 0", "c_acctbal")


def accepted_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "value")
    return checks.accepted_range(events, "value", 1, 20)


def accepted_range_exclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    return checks.accepted_range(lines, "l_quantity", min_value="l_linenumber", inclusive=False)


def not_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.not_accepted_values(table(spark, sf_dir, "part"), "p_type", ["PROMO", "SMALL", "MISSING"])


def not_empty_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    blanked = F.when(F.col("c_mktsegment") == "HOUSEHOLD", "  ").otherwise(F.col("c_mktsegment"))
    return checks.not_empty_string(table(spark, sf_dir, "customer").select(blanked.alias("segment")), "segment")


def not_null_proportion(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", nulled("event_type", "error"))
    found = checks.not_null_proportion(events, "event_type", at_least=0.81, group_by=["user_id"])
    return found.withColumn("not_null_proportion", F.round(F.col("not_null_proportion").cast("double"), 6))


def not_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", nulled("o_orderstatus", "P"))
    return checks.not_constant(orders, "o_orderstatus", ["o_custkey"])


def not_constant_whole_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = table(spark, sf_dir, "events").select(F.year("ts").alias("event_year"))
    return checks.not_constant(years, "event_year")


def at_least_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid = F.when(F.col("event_type") == "purchase", F.col("value")).alias("paid")
    events = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"), paid)
    return checks.at_least_one(events, "paid", ["user_id", "day"])


def at_least_one_whole_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    absent = F.when(F.col("event_type") == "absent", F.col("value")).alias("paid")
    return checks.at_least_one(table(spark, sf_dir, "events").select(absent), "paid")


def unique_combination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.unique_combination(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def cardinality_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return checks.cardinality_equality(
        orders.withColumn("day", F.to_date("o_orderdate")), "day",
        orders.filter("o_orderpriority <> '1-URGENT'").withColumn("ordered", F.to_date("o_orderdate")), "ordered",
    )


def _by_nation(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    customers = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"))
    return customers.filter("nation <> 3"), suppliers.filter("nation <> 5")


def equal_rowcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.equal_rowcount(*_by_nation(spark, sf_dir), ["nation"])


def equal_rowcount_whole_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.equal_rowcount_failures(
        checks.equal_rowcount(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"))
    )


def fewer_rows_than(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, suppliers = _by_nation(spark, sf_dir)
    return checks.fewer_rows_than(suppliers, customers, ["nation"])


def _altered_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    ours = table(spark, sf_dir, "orders").select("o_custkey", nulled("o_orderstatus", "P"), "o_totalprice")
    theirs = ours.select(
        "o_custkey", F.when(F.col("o_custkey") % 10 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        (F.col("o_totalprice") + F.when(F.col("o_custkey") % 7 == 0, 0.5).otherwise(0.0)).alias("o_totalprice"),
    )
    return ours, theirs


def equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ours, theirs = _altered_orders(spark, sf_dir)
    return checks.equality(ours, theirs, exclude_columns=["o_totalprice"])


def equality_with_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    ours, theirs = _altered_orders(spark, sf_dir)
    found = checks.equality(ours, theirs, compare_columns=["o_custkey", "o_totalprice"], precision=1)
    return checks.equality_failures(found)


def relationships_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.relationships_where(
        table(spark, sf_dir, "orders"), "o_custkey", table(spark, sf_dir, "customer"), "c_custkey",
        "o_orderstatus = 'O'", "c_mktsegment <> 'BUILDING'",
    )


def recency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.recency(table(spark, sf_dir, "events"), "ts", "hour", 12, group_by=["user_id"], as_of=AS_OF)


def recency_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.recency(
        table(spark, sf_dir, "orders"), "o_orderdate", "month", 300, ignore_time_component=True, group_by=["o_custkey"],
        as_of=AS_OF,
    )


def sequential_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.sequential_values(table(spark, sf_dir, "lineitem"), "l_linenumber", group_by=["l_orderkey"])


def sequential_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return checks.sequential_values(days, "day", 1, "day")


def sequential_values_whole_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys of all lines without groups: repeated keys and gaps fail."""
    return checks.sequential_values(table(spark, sf_dir, "lineitem"), "l_orderkey")


def mutually_exclusive_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = table(spark, sf_dir, "events").select(
        "user_id", "ts", F.timestamp_add("HOUR", F.lit(6), F.col("ts")).alias("ends")
    )
    return checks.mutually_exclusive_ranges(visits, "ts", "ends", "user_id")


def singular(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any query that should find nothing: here, conversations with a gap in their turns, or longer than six turns."""
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("turns"), (F.max("turn") + 1).alias("expected_turns")
    ).filter((F.col("turns") != F.col("expected_turns")) | (F.col("turns") > 6))


QUERIES = {
    "check_not_null": not_null,
    "check_unique": unique,
    "check_accepted_values": accepted_values,
    "check_relationships": relationships,
    "check_expression": expression,
    "check_expression_on_column": expression_on_column,
    "check_accepted_range": accepted_range,
    "check_accepted_range_exclusive": accepted_range_exclusive,
    "check_not_accepted_values": not_accepted_values,
    "check_not_empty_string": not_empty_string,
    "check_not_null_proportion": not_null_proportion,
    "check_not_constant": not_constant,
    "check_not_constant_whole_table": not_constant_whole_table,
    "check_at_least_one": at_least_one,
    "check_at_least_one_whole_table": at_least_one_whole_table,
    "check_unique_combination": unique_combination,
    "check_cardinality_equality": cardinality_equality,
    "check_equal_rowcount": equal_rowcount,
    "check_equal_rowcount_whole_table": equal_rowcount_whole_table,
    "check_fewer_rows_than": fewer_rows_than,
    "check_equality": equality,
    "check_equality_with_precision": equality_with_precision,
    "check_relationships_where": relationships_where,
    "check_recency": recency,
    "check_recency_by_day": recency_by_day,
    "check_sequential_values": sequential_values,
    "check_sequential_dates": sequential_dates,
    "check_sequential_values_whole_table": sequential_values_whole_table,
    "check_mutually_exclusive_ranges": mutually_exclusive_ranges,
    "check_singular": singular,
}

BY_NATION = """
with a as (select c_nationkey as nation, count(*) as n from customer where c_nationkey <> 3 group by c_nationkey),
     b as (select s_nationkey as nation, count(*) as n from supplier where s_nationkey <> 5 group by s_nationkey)"""

ALTERED_ORDERS = """
with ours as (select o_custkey, nullif(o_orderstatus, 'P') as o_orderstatus, o_totalprice from orders),
     theirs as (select o_custkey, case when o_custkey % 10 = 0 then 'X' else o_orderstatus end as o_orderstatus,
                       o_totalprice + case when o_custkey % 7 = 0 then 0.5e0 else 0e0 end as o_totalprice
                from ours)"""

ORACLE = {
    "check_not_null": """
        select * from (select o_orderkey, nullif(o_orderpriority, '5-LOW') as o_orderpriority from orders)
        where o_orderpriority is null""",
    "check_unique": "select l_orderkey, count(*) as n_records from lineitem group by l_orderkey having count(*) > 1",
    "check_accepted_values": """
        select event_type as value_field, count(*) as n_records
        from (select nullif(event_type, 'signup') as event_type from events)
        group by event_type having event_type not in ('click', 'purchase', 'view')""",
    "check_relationships": """
        select l.l_orderkey as from_field
        from lineitem as l left join (select * from orders where o_orderstatus <> 'F') as o on l.l_orderkey = o.o_orderkey
        where l.l_orderkey is not null and o.o_orderkey is null""",
    "check_expression": """
        select * from (select l_orderkey, l_partkey, l_suppkey, l_linenumber, nullif(l_quantity, 50) as l_quantity
                       from lineitem)
        where not (l_quantity <= l_linenumber * 10)""",
    "check_expression_on_column": "select c_custkey, c_acctbal from customer where not (c_acctbal > 0)",
    "check_accepted_range": "select event_id, value from events where not value >= 1 or not value <= 20",
    "check_accepted_range_exclusive": """
        select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity from lineitem
        where not l_quantity > l_linenumber""",
    "check_not_accepted_values":
        "select distinct p_type as value_field from part where p_type in ('PROMO', 'SMALL', 'MISSING')",
    "check_not_empty_string": "select '' as segment from customer where c_mktsegment = 'HOUSEHOLD'",
    "check_not_null_proportion": """
        select user_id, round(share, 6) as not_null_proportion
        from (select user_id, sum(case when event_type = 'error' then 0 else 1 end) / cast(count(*) as double) as share
              from events group by user_id)
        where share < 0.81 or share > 1""",
    "check_not_constant": """
        select o_custkey, count(distinct nullif(o_orderstatus, 'P')) as filler_column from orders
        group by o_custkey having count(distinct nullif(o_orderstatus, 'P')) = 1""",
    "check_not_constant_whole_table": """
        select count(distinct year(ts)) as filler_column from events having count(distinct year(ts)) = 1""",
    "check_at_least_one": """
        select user_id, cast(ts as date) as day, count(case when event_type = 'purchase' then value end) as filler_column
        from events
        group by 1, 2 having count(case when event_type = 'purchase' then value end) = 0""",
    "check_at_least_one_whole_table": """
        select count(case when event_type = 'absent' then value end) as filler_column from events
        having count(case when event_type = 'absent' then value end) = 0""",
    "check_unique_combination": """
        select l_orderkey, l_linenumber from lineitem group by l_orderkey, l_linenumber having count(*) > 1""",
    "check_cardinality_equality": """
        with a as (select cast(o_orderdate as date) as day, count(*) as num_rows from orders group by 1),
             b as (select cast(o_orderdate as date) as day, count(*) as num_rows from orders
                   where o_orderpriority <> '1-URGENT' group by 1)
        (select * from a except select * from b) union all (select * from b except select * from a)""",
    "check_equal_rowcount": f"""{BY_NATION}
        select a.nation as nation_a, b.nation as nation_b, a.n as count_a, b.n as count_b, abs(a.n - b.n) as diff_count
        from a full join b on a.nation = b.nation""",
    "check_equal_rowcount_whole_table": """
        select cast(abs((select count(*) from lineitem) - (select count(*) from orders)) as bigint) as failures""",
    "check_fewer_rows_than": f"""{BY_NATION}
        select b.nation as nation_a, a.nation as nation_b, b.n as count_our_model, a.n as count_comparison_model,
               cast(case when b.n > a.n then b.n - a.n when b.n = a.n then 1 else 0 end as bigint) as row_count_delta
        from b full join a on a.nation = b.nation""",
    "check_equality": f"""{ALTERED_ORDERS}
        select 'a_minus_b' as which_diff, * from (
            select o_custkey, o_orderstatus from ours except select o_custkey, o_orderstatus from theirs)
        union all
        select 'b_minus_a' as which_diff, * from (
            select o_custkey, o_orderstatus from theirs except select o_custkey, o_orderstatus from ours)""",
    "check_equality_with_precision": f"""{ALTERED_ORDERS},
        a as (select o_custkey, round(cast(o_totalprice as decimal(28,6)), 1) as p from ours),
        b as (select o_custkey, round(cast(o_totalprice as decimal(28,6)), 1) as p from theirs),
        joined as (select a.o_custkey is null as only_b, b.o_custkey is null as only_a
                 from (select distinct * from a) as a full join (select distinct * from b) as b
                 on a.o_custkey = b.o_custkey and a.p is not distinct from b.p)
        select 2 * greatest(count(*) filter (only_a), count(*) filter (only_b)) as failures from joined""",
    "check_relationships_where": """
        select o.o_custkey as id, c.c_custkey as right_id
        from (select * from orders where o_orderstatus = 'O' and o_custkey is not null) as o
        left join (select * from customer where c_mktsegment <> 'BUILDING') as c on o.o_custkey = c.c_custkey
        where c.c_custkey is null""",
    "check_recency": """
        select user_id, max(ts) as most_recent, timestamp '2024-01-29 12:00:00' as threshold
        from events group by user_id having max(ts) < timestamp '2024-01-29 12:00:00' or max(ts) is null""",
    "check_recency_by_day": """
        select o_custkey, cast(max(o_orderdate) as date) as most_recent, date '1999-01-30' as threshold
        from orders group by o_custkey
        having cast(max(o_orderdate) as date) < date '1999-01-30' or max(o_orderdate) is null""",
    "check_sequential_values": """
        select * from (
            select l_orderkey, l_linenumber,
                   lag(l_linenumber) over (partition by l_orderkey order by l_linenumber) as previous_l_linenumber
            from lineitem)
        where not (l_linenumber = previous_l_linenumber + 1)""",
    "check_sequential_dates": """
        select * from (
            select day, lag(day) over (order by day) as previous_day
            from (select distinct cast(o_orderdate as date) as day from orders))
        where not (cast(day as timestamp) = cast(previous_day as timestamp) + interval 1 day)""",
    "check_sequential_values_whole_table": """
        select l_orderkey, previous_l_orderkey from (
            select l_orderkey, lag(l_orderkey) over (order by l_orderkey) as previous_l_orderkey from lineitem)
        where l_orderkey <> previous_l_orderkey + 1""",
    "check_mutually_exclusive_ranges": """
        select visit.user_id as partition_by_col, visit.ts as lower_bound, visit.ts + interval 6 hour as upper_bound,
               min(later.ts) as next_lower_bound, count(later.ts) = 0 as is_last_record,
               true as lower_bound_less_than_upper_bound, false as upper_bound_less_than_or_equal_to_next_lower_bound
        from events as visit join events as later on later.user_id = visit.user_id and later.ts > visit.ts
        group by visit.user_id, visit.ts having min(later.ts) < visit.ts + interval 6 hour""",
    "check_singular": """
        select conv_id, count(*) as turns, max(turn) + 1 as expected_turns
        from conversations group by conv_id having count(*) <> max(turn) + 1 or count(*) > 6""",
}
