"""Marts: facts and dimensions built from staging. Details are collapsed to the target grain before they are joined,
and every join keeps its left rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martworks import fixed_values as fixed
from martworks.functions import customer_type, is_true, to_bool
from martworks.operators import count_where, join_summary, sequence_no

# Writes an intermediate table and returns it as read back, e.g. `session.written`.
Store = Callable[[DataFrame], DataFrame]


def product_facts(stg_products: DataFrame, stg_supplies: DataFrame) -> DataFrame:
    """What items take from products and supplies, one row per product that either of them knows."""
    products = stg_products.select("product_id", "product_name", "product_price", "is_food_item", "is_drink_item")
    costs = stg_supplies.groupBy("product_id").agg(F.sum("supply_cost").cast(fixed.MONEY_SUM).alias("supply_cost"))
    return products.join(costs, "product_id", "full")


def described_items(
    stg_order_items: DataFrame,
    stg_products: DataFrame,
    stg_supplies: DataFrame,
    store: Store | None = None,
    late: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Items with what their products and supplies say: all of `order_items` but the date, and all that order facts need.
    `late` as in `order_items`."""
    facts = product_facts(stg_products, stg_supplies)
    return stg_order_items.join(store(facts) if store else facts, "product_id", "left").withColumns(dict(late or {}))


def order_items(
    stg_order_items: DataFrame,
    stg_orders: DataFrame,
    stg_products: DataFrame,
    stg_supplies: DataFrame,
    store: Store | None = None,
    late: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per item. Product and supply columns come in by one join, as both are keyed by product. The join with
    orders comes last and leaves the rows partitioned by order, as `order_facts` needs them.

    Items repeat products, some of them very often. Pass `store` on large data: product facts that were written are
    broadcast only when their size allows, and otherwise adaptive execution can split frequent products, which it
    cannot do above an aggregation.

    `late` names columns of `stg_order_items` that are made of its other columns after the joins, which then need not carry
    them: a key that is a hash is wider than the numbers it is made of, and does not compress. With it, the item columns are
    those of `late`, the order and the product."""
    described = described_items(stg_order_items, stg_products, stg_supplies, store)
    dated = described.join(stg_orders.select("order_id", "ordered_at"), "order_id", "left").withColumns(dict(late or {}))
    columns = [*late, "order_id", "product_id"] if late else stg_order_items.columns
    return dated.select(
        *columns, "ordered_at", "product_name", "product_price", "is_food_item", "is_drink_item",
        "supply_cost",
    )


def order_facts(stg_orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """`orders` without the customer's running order number: all that the customer totals need."""
    summary = join_summary(
        stg_orders,
        order_items,
        "order_id",
        F.sum("supply_cost").cast(fixed.MONEY_SUM).alias("order_cost"),
        F.sum("product_price").cast(fixed.MONEY_SUM).alias("order_items_subtotal"),
        count_where(is_true("is_food_item")).alias("count_food_items"),
        count_where(is_true("is_drink_item")).alias("count_drink_items"),
        F.count("order_item_id").alias("count_order_items"),
    )
    extras = [c for c in summary.columns if c not in stg_orders.columns]
    return summary.select(
        *stg_orders.columns,
        *extras,
        to_bool(F.col("count_food_items") > 0).alias("is_food_order"),
        to_bool(F.col("count_drink_items") > 0).alias("is_drink_order"),
    )


def orders(stg_orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """One row per order, with item counts and the running number of the customer's orders (same-day orders by id).

    The number needs only staging columns, so it is made before the join. Of the items only product and supply columns are
    read, so `described_items` will do."""
    numbered = sequence_no(stg_orders, ["customer_id"], ["ordered_at", "order_id"], "customer_order_number")
    facts = order_facts(numbered, order_items)
    return facts.select(*(c for c in facts.columns if c != "customer_order_number"), "customer_order_number")


def customers(stg_customers: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per customer with lifetime totals. A customer without orders has null totals and counts as new."""
    joined = join_summary(
        stg_customers,
        orders,
        "customer_id",
        F.count_distinct("order_id").alias("count_lifetime_orders"),
        F.min("ordered_at").alias("first_ordered_at"),
        F.max("ordered_at").alias("last_ordered_at"),
        F.sum("subtotal").cast(fixed.MONEY_SUM).alias("lifetime_spend_pretax"),
        F.sum("tax_paid").cast(fixed.MONEY_SUM).alias("lifetime_tax_paid"),
        F.sum("order_total").cast(fixed.MONEY_SUM).alias("lifetime_spend"),
    )
    return joined.withColumn("customer_type", customer_type(to_bool(F.col("count_lifetime_orders") > 1)))


def locations(stg_locations: DataFrame) -> DataFrame:
    return stg_locations.select("*")


def products(stg_products: DataFrame) -> DataFrame:
    return stg_products.select("*")


def supplies(stg_supplies: DataFrame) -> DataFrame:
    return stg_supplies.select("*")


def customer_type_summary(customers: DataFrame) -> DataFrame:
    """Customers and lifetime spend per customer type."""
    return customers.groupBy("customer_type").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("lifetime_spend").cast(fixed.MONEY_SUM).alias("lifetime_spend"),
    )
