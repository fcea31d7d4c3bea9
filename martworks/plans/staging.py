"""Staging: one projection per raw table. Names, units and precision are settled here once, one row out per row in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martworks import fixed_values as fixed
from martworks.functions import cents_to_dollars, surrogate_key, to_bool, truncated


def stg_customers(raw_customers: DataFrame) -> DataFrame:
    return raw_customers.select(F.col("id").alias("customer_id"), F.col("name").alias("customer_name"))


def stg_locations(raw_stores: DataFrame) -> DataFrame:
    return raw_stores.select(
        F.col("id").alias("location_id"),
        F.col("name").alias("location_name"),
        "tax_rate",
        truncated("opened_at").alias("opened_date"),
    )


def stg_order_items(raw_items: DataFrame) -> DataFrame:
    return raw_items.select(F.col("id").alias("order_item_id"), "order_id", F.col("sku").alias("product_id"))


def stg_orders(raw_orders: DataFrame) -> DataFrame:
    """Amounts are kept in cents and added in dollars."""
    amounts = ("subtotal", "tax_paid", "order_total")
    return raw_orders.select(
        F.col("id").alias("order_id"),
        F.col("store_id").alias("location_id"),
        F.col("customer").alias("customer_id"),
        *(F.col(a).alias(f"{a}_cents") for a in amounts),
        *(cents_to_dollars(a).alias(a) for a in amounts),
        truncated("ordered_at").alias("ordered_at"),
    )


def stg_products(
    raw_products: DataFrame, food_type: str = fixed.FOOD_TYPE, drink_type: str = fixed.DRINK_TYPE
) -> DataFrame:
    return raw_products.select(
        F.col("sku").alias("product_id"),
        F.col("name").alias("product_name"),
        F.col("type").alias("product_type"),
        F.col("description").alias("product_description"),
        cents_to_dollars("price").alias("product_price"),
        to_bool(F.col("type") == food_type).alias("is_food_item"),
        to_bool(F.col("type") == drink_type).alias("is_drink_item"),
    )


def stg_supplies(raw_supplies: DataFrame) -> DataFrame:
    """One row per supply and product, so the key is made of both."""
    return raw_supplies.select(
        surrogate_key(["id", "sku"]).alias("supply_uuid"),
        F.col("id").alias("supply_id"),
        F.col("sku").alias("product_id"),
        F.col("name").alias("supply_name"),
        cents_to_dollars("cost").alias("supply_cost"),
        F.col("perishable").alias("is_perishable_supply"),
    )
