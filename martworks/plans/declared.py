"""The project as declared: its build steps from the six raw tables, and the checks on its tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame

from martworks import fixed_values as fixed
from martworks.checks.suite import AcceptedValues, Check, Expression, NotNull, Relationship, Unique
from martworks.plans import marts, staging
from martworks.plans.build import Step, Tables
from martworks.session import written


def _step(name: str, kind: str, build, *needs: str) -> Step:
    """A step whose function takes the needed tables in order."""
    return Step(name, kind, needs, lambda tables: build(*(tables[n] for n in needs)))


def _order_items(*staged: DataFrame) -> DataFrame:
    return marts.order_items(*staged, store=partial(written, name="product_facts"))


STEPS: list[Step] = [
    _step("stg_customers", "view", staging.stg_customers, "raw_customers"),
    _step("stg_locations", "view", staging.stg_locations, "raw_stores"),
    _step("stg_order_items", "view", staging.stg_order_items, "raw_items"),
    _step("stg_orders", "view", staging.stg_orders, "raw_orders"),
    _step("stg_products", "view", staging.stg_products, "raw_products"),
    _step("stg_supplies", "view", staging.stg_supplies, "raw_supplies"),
    _step("locations", "table", marts.locations, "stg_locations"),
    _step("products", "table", marts.products, "stg_products"),
    _step("supplies", "table", marts.supplies, "stg_supplies"),
    _step("order_items", "table", _order_items, "stg_order_items", "stg_orders", "stg_products", "stg_supplies"),
    _step("orders", "table", marts.orders, "stg_orders", "order_items"),
    _step("customers", "table", marts.customers, "stg_customers", "orders"),
]


def with_step(step: Step, steps: list[Step] = STEPS) -> list[Step]:
    """The steps with one of them replaced by name."""
    return [step if s.name == step.name else s for s in steps]


def downstream(name: str, steps: list[Step] = STEPS) -> list[Step]:
    """A step and all that depend on it, in build order."""
    chosen = {name}
    for step in steps:
        if chosen.intersection(step.needs):
            chosen.add(step.name)
    return [s for s in steps if s.name in chosen]


def run_with(tables: Tables, steps: list[Step]) -> dict[str, DataFrame]:
    """All steps as lazy tables on top of the given ones."""
    built = dict(tables)
    for step in steps:
        built[step.name] = step.build(built)
    return built


def _key(model: str, column: str) -> list[Check]:
    return [NotNull(model, column), Unique(model, column)]


CHECKS: list[Check] = [
    *_key("stg_customers", "customer_id"),
    *_key("stg_locations", "location_id"),
    *_key("stg_order_items", "order_item_id"),
    NotNull("stg_order_items", "order_id"),
    Relationship("stg_order_items", "order_id", "stg_orders", "order_id"),
    Expression("stg_orders", "order_total - tax_paid = subtotal"),
    *_key("stg_orders", "order_id"),
    *_key("stg_products", "product_id"),
    *_key("stg_supplies", "supply_uuid"),
    *_key("order_items", "order_item_id"),
    Relationship("order_items", "order_id", "orders", "order_id"),
    Expression("orders", "order_items_subtotal = subtotal"),
    Expression("orders", "order_total = subtotal + tax_paid"),
    *_key("orders", "order_id"),
    Relationship("orders", "customer_id", "stg_customers", "customer_id"),
    Expression("customers", "lifetime_spend_pretax + lifetime_tax_paid = lifetime_spend"),
    *_key("customers", "customer_id"),
    AcceptedValues("customers", "customer_type", (fixed.NEW_CUSTOMER, fixed.RETURNING_CUSTOMER)),
    *_key("locations", "location_id"),
    *_key("products", "product_id"),
    *_key("supplies", "supply_uuid"),
]
