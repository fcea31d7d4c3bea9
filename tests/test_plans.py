"""Plans that must stay as they are, read from the physical plan before it runs."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
from martworks.checks import cardinality_equality, equality, orphans, run_checks
from martworks.checks.suite import Expression, NotNull, Unique
from martworks.entries import mapping
from martworks.plans import marts
from martworks.session import fresh_path, written

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[-1]


def shuffles(text: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning", text))


@pytest.fixture
def tables(spark):
    a = spark.range(100).selectExpr("id as k", "id % 7 as v", "cast(id as string) as s")
    return {"a": written(a, "a"), "b": written(a, "b")}


def test_equality_shuffles_differing_rows_once_and_reads_two_columns(tables):
    text = plan(equality(tables["a"], tables["b"], compare_columns=["k", "v"]))
    assert len(re.findall(r"Exchange hashpartitioning\(k", text)) == 1 and "ReadSchema: struct<k:bigint,v:bigint>" in text
    # All other exchanges are of digests; rows come to theirs through a semi-join with the ranges that differ.
    assert shuffles(text) == 1 + len(re.findall(r"Exchange hashpartitioning\(_range", text)) and "LeftSemi" in text


def test_cardinality_equality_shuffles_once(tables):
    assert shuffles(plan(cardinality_equality(tables["a"], "v", tables["b"], "v"))) == 1


def test_row_checks_ride_along_with_the_key_check(tables):
    text = plan(run_checks(tables, [Unique("a", "k"), NotNull("a", "v"), Expression("a", "v < 9")]))
    assert text.count("FileScan") == 1 and shuffles(text) == 1


def test_orphans_are_joined_after_both_sides_shrank(tables):
    text = plan(orphans(tables["a"], "v", tables["b"], "k"))
    assert text.count("partial_count(1)") == 1 and shuffles(text) == 2


def test_filters_and_columns_reach_the_scan(tables):
    text = plan(marts.customer_type_summary(tables["a"].selectExpr("s as customer_type", "v as lifetime_spend").filter("lifetime_spend > 3")))
    assert "PushedFilters: [IsNotNull(v), GreaterThan(v,3)]" in text and "ReadSchema: struct<v:bigint,s:string>" in text


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data here")
def test_customer_totals_come_from_order_facts(spark):
    """The totals read no item column, and order facts join items by a unique key: Spark itself leaves that join out."""
    query = entry.queries()["mart_customers"](spark, FOLDER)
    assert "lineitem" in query._jdf.queryExecution().analyzed().toString() or "product_id" in query._jdf.queryExecution().analyzed().toString()
    text = plan(query)
    assert text.count("FileScan") == 2 and "Window" not in text


def test_frequent_products_are_split(spark):
    """Items of one product hold a third of all rows, and product facts are too large to broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
        # Several map tasks, so that one reduce partition has parts to be split by.
        "spark.sql.files.maxPartitionBytes": "256KB",
        "spark.sql.files.openCostInBytes": "0",
    }
    before = {k: spark.conf.get(k) for k in settings}
    path = fresh_path(spark, "items")
    spark.range(300_000).selectExpr(
        "md5(cast(id as string)) as order_item_id", "id % 50000 as order_id", "if(id % 3 = 0, 7, id % 1000) as product_id"
    ).repartition(12).write.parquet(path)
    orders = written(spark.range(50_000).selectExpr("id as order_id", "date'2024-01-01' as ordered_at"), "orders")
    products = spark.range(1000).selectExpr(
        "id as product_id", "'x' as product_name", "cast(1 as decimal(16,2)) as product_price", "true as is_food_item",
        "false as is_drink_item",
    )
    supplies = spark.range(3000).selectExpr("id % 1000 as product_id", "cast(id as decimal(16,2)) as supply_cost")
    try:
        for key, setting in settings.items():
            spark.conf.set(key, setting)
        items = marts.order_items(
            spark.read.parquet(path), orders, products, supplies, store=lambda facts: written(facts, "product_facts")
        )
        assert items.selectExpr("count(*) as n", "count(distinct order_item_id) as d").first().asDict() == {"n": 300_000, "d": 300_000}
        described = items.drop("ordered_at")
        described.collect()
        assert "SortMergeJoin(skew=true)" in described._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, setting in before.items():
            spark.conf.set(key, setting)


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data here")
def test_item_keys_are_made_after_the_joins(spark):
    """No join carries the hash, and the items are those of the plain step."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        found = entry.queries()["mart_order_items"](spark, FOLDER)
        text = plan(found)
        assert "md5(" in text and "md5(" not in text[text.index("Join"):]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    tables = mapping.staged(spark, FOLDER, "stg_order_items", "stg_orders", "stg_products", "stg_supplies")
    plain = marts.order_items(*(tables[n] for n in ("stg_order_items", "stg_orders", "stg_products", "stg_supplies")))
    assert found.schema == plain.schema and found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty()
