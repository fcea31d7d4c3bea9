"""Logic checks of three models. Only the expected columns are compared, with repetition.

The rows are made up; each set proves one rule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from martworks.checks.compare import expect_rows
from martworks.plans import marts, staging
from martworks.plans.build import Fixture

# Staging columns as the marts read them; a fixture row gives some of them, the others are null.
STAGED = {
    "raw_stores": "id string, name string, opened_at timestamp_ntz, tax_rate double",
    "stg_order_items": "order_item_id string, order_id string, product_id string",
    "stg_orders": (
        "order_id string, location_id string, customer_id string, subtotal_cents int, tax_paid_cents int, "
        "order_total_cents int, subtotal decimal(16,2), tax_paid decimal(16,2), order_total decimal(16,2), "
        "ordered_at date"
    ),
    "stg_products": (
        "product_id string, product_name string, product_type string, product_description string, "
        "product_price decimal(16,2), is_food_item boolean, is_drink_item boolean"
    ),
    "stg_supplies": (
        "supply_uuid string, supply_id string, product_id string, supply_name string, supply_cost decimal(16,2), "
        "is_perishable_supply boolean"
    ),
    "order_items": (
        "order_item_id string, order_id string, product_id string, ordered_at date, product_name string, "
        "product_price decimal(16,2), is_food_item boolean, is_drink_item boolean, supply_cost decimal(38,2)"
    ),
}


def given(spark: SparkSession, name: str, columns: Sequence[str], rows: Sequence[tuple]) -> DataFrame:
    """Fixed rows of a known table. Values are written as text and cast to the column types."""
    types = T.StructType.fromDDL(STAGED[name])
    return expected(spark, columns, rows, types)


def expected(spark: SparkSession, columns: Sequence[str], rows: Sequence[tuple], types: T.StructType) -> DataFrame:
    texts = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    df = spark.createDataFrame(rows, texts)
    return df.selectExpr(
        *(
            f"cast({f.name if f.name in columns else 'null'} as {f.dataType.simpleString()}) as {f.name}"
            for f in types.fields
        )
    )


def location_dates_are_cut_off(spark: SparkSession) -> DataFrame:
    stores = given(
        spark, "raw_stores", ("id", "name", "tax_rate", "opened_at"),
        [
            ("n", "North Pier", "0.15", "2020-02-29T08:30:00"),
            ("s", "South Gate", "0.0", "2031-12-31T23:59:59.9999"),
        ],
    )
    wanted = expected(
        spark, ("location_id", "location_name", "tax_rate", "opened_date"),
        [("n", "North Pier", "0.15", "2020-02-29"), ("s", "South Gate", "0.0", "2031-12-31")],
        T.StructType.fromDDL("location_id string, location_name string, tax_rate double, opened_date date"),
    )
    return expect_rows(staging.stg_locations(stores), wanted)


def supply_costs_are_summed_once(spark: SparkSession) -> DataFrame:
    items = marts.order_items(
        given(spark, "stg_order_items", ("order_id", "product_id"), [("a", "tea"), ("b", "pie"), ("b", "pie"), ("b", "tea")]),
        given(spark, "stg_orders", ("order_id",), [("a",), ("b",)]),
        given(spark, "stg_products", ("product_id",), [("tea",), ("pie",)]),
        given(spark, "stg_supplies", ("product_id", "supply_cost"), [("tea", "0.35"), ("pie", "1.20"), ("pie", "0.95"), ("pie", "2.10")]),
    )
    wanted = expected(
        spark, ("order_id", "product_id", "supply_cost"),
        [("a", "tea", "0.35"), ("b", "pie", "4.25"), ("b", "pie", "4.25"), ("b", "tea", "0.35")],
        T.StructType.fromDDL("order_id string, product_id string, supply_cost decimal(38,2)"),
    )
    return expect_rows(items, wanted)


def order_flags_are_never_null(spark: SparkSession) -> DataFrame:
    found = marts.orders(
        given(spark, "stg_orders", ("order_id",), [("a",), ("b",)]),
        given(
            spark, "order_items", ("order_id", "order_item_id", "is_drink_item", "is_food_item"),
            [("a", "i", "true", "false"), ("b", "j", "true", "false"), ("b", "k", "false", "true"), ("b", "l", "false", "true")],
        ),
    )
    columns = ("order_id", "count_food_items", "count_drink_items", "is_drink_order", "is_food_order")
    wanted = expected(
        spark, columns,
        [("a", "0", "1", "true", "false"), ("b", "2", "1", "true", "true")],
        T.StructType.fromDDL(
            "order_id string, count_food_items bigint, count_drink_items bigint, is_drink_order boolean, "
            "is_food_order boolean"
        ),
    )
    return expect_rows(found, wanted)


FIXTURES = [
    Fixture("stg_locations", "location dates are cut off", location_dates_are_cut_off),
    Fixture("order_items", "supply costs are summed once", supply_costs_are_summed_once),
    Fixture("orders", "order flags are never null", order_flags_are_never_null),
]
