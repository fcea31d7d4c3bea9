from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martworks.checks import expression_is_true, run_checks
from martworks.checks.suite import AcceptedValues, Expression, NotNull, Relationship, Unique
from martworks.entries.mapping import (
    PROJECT,
    RAW,
    RAW_ORDERS_OF_ITEMS,
    SQL,
    STAGING,
    item_key,
    lines,
    raw_orders_of_items,
    staged,
    with_tables,
)
from martworks.plans import marts, staging
from martworks.plans.build import Step, gated_build
from martworks.plans.declared import CHECKS, downstream, run_with, with_step
from martworks.plans.fixtures import FIXTURES
from martworks.session import written

BIG_MARTS = ("order_items", "orders", "customers")
TAX_CHECK = "order_total - tax_paid = subtotal"


def _items(tables: dict[str, DataFrame]) -> DataFrame:
    return marts.described_items(lines(tables["raw_items"]), tables["stg_products"], tables["stg_supplies"], late=item_key())


def mart_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = staged(spark, sf_dir, "stg_order_items", "stg_orders", "stg_products", "stg_supplies")
    return run_with(tables, [s for s in PROJECT if s.name == "order_items"])["order_items"]


def mart_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = staged(spark, sf_dir, "stg_order_items", "stg_orders", "stg_products", "stg_supplies")
    return marts.orders(tables["stg_orders"], _items(tables))


def _staged(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, sf_dir, name)[name]


def _passed_on(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    step = next(s for s in PROJECT if s.name == name)
    return step.build(staged(spark, sf_dir, *step.needs))


def mart_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer totals over the orders mart, without its running numbers, which they do not read."""
    tables = staged(spark, sf_dir, "stg_customers", "stg_order_items", "stg_orders", "stg_products", "stg_supplies")
    return marts.customers(tables["stg_customers"], marts.order_facts(tables["stg_orders"], _items(tables)))


def customer_type_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.customer_type_summary(mart_customers(spark, sf_dir))


def check_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All declared checks. What is computed (the big marts, and supplies in this data) is written first, so that it is
    computed once for all its checks and readers."""
    tables = {name: table(spark, sf_dir) for name, table in RAW.items()}
    tables["raw_supplies"] = written(tables["raw_supplies"], "raw_supplies", "zstd")
    for step in PROJECT:
        df = step.build(tables)
        tables[step.name] = written(df, step.name, "zstd") if step.name in BIG_MARTS else df
    return run_checks(tables, CHECKS)


def _tax_left_in_cents(stg_orders: DataFrame) -> DataFrame:
    return stg_orders.withColumn("tax_paid", F.col("tax_paid_cents").cast("decimal(16,2)"))


def broken_tax_scenario(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many orders stop adding up when their tax is left in cents."""
    broken = _tax_left_in_cents(staged(spark, sf_dir, "stg_orders")["stg_orders"])
    return expression_is_true(broken, TAX_CHECK).agg(F.count(F.lit(1)).alias("failing_orders"))


def _publish(step: Step, df: DataFrame) -> DataFrame:
    return df if step.kind == "view" else written(df, step.name, "zstd")


def gated_build_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build orders and everything after them with tax left in cents: the failing check stops the marts."""
    broken = Step(
        "stg_orders", "view", ("raw_orders",), lambda tables: _tax_left_in_cents(staging.stg_orders(tables["raw_orders"]))
    )
    steps = downstream("stg_orders", with_step(broken, PROJECT))
    built = {s.name for s in steps}
    given = {name: df for name, df in staged(spark, sf_dir).items() if name not in built}
    checks = [c for c in CHECKS if built.intersection(c.models)]
    fixtures = [f for f in FIXTURES if f.model in built]
    return gated_build(spark, steps, checks, fixtures, given, _publish)


def full_build_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build and check the whole project, on orders that add up with their items."""
    raw = {name: table(spark, sf_dir) for name, table in RAW.items()}
    raw["raw_orders"] = written(raw_orders_of_items(spark, sf_dir), "raw_orders", "zstd")
    raw["raw_supplies"] = written(raw["raw_supplies"], "raw_supplies", "zstd")
    return gated_build(spark, PROJECT, CHECKS, FIXTURES, raw, _publish)


QUERIES = {
    **{step.name: partial(_staged, step.name) for step in STAGING},
    "mart_order_items": mart_order_items,
    "mart_orders": mart_orders,
    "mart_customers": mart_customers,
    "mart_locations": partial(_passed_on, "locations"),
    "mart_products": partial(_passed_on, "products"),
    "mart_supplies": partial(_passed_on, "supplies"),
    "customer_type_summary": customer_type_summary,
    "check_suite": check_suite,
    "broken_tax_scenario": broken_tax_scenario,
    "gated_build_status": gated_build_status,
    "full_build_status": full_build_status,
}


def _failures_sql(check) -> str:
    """The failure count of a declared check in plain SQL."""
    def relation(model: str) -> str:
        return model if model.startswith("stg_") else f"mart_{model}"

    table = relation(check.model)
    match check:
        case NotNull():
            return f"select count(*) from {table} where {check.column} is null"
        case Unique():
            repeated = f"select {check.column} from {table} group by {check.column} having count(*) > 1"
            return f"select count(*) from ({repeated})"
        case Expression():
            return f"select count(*) from {table} where not ({check.expression})"
        case AcceptedValues():
            listed = ", ".join(f"'{v}'" for v in check.values)
            return f"select count(distinct {check.column}) from {table} where {check.column} not in ({listed})"
        case Relationship():
            return (
                f"select count(*) from {table} as child where child.{check.column} is not null and not exists "
                f"(select 1 from {relation(check.to)} as parent where parent.{check.field} = child.{check.column})"
            )
    raise TypeError(check)


def _suite_sql() -> str:
    counted = "\nunion all\n".join(
        f"select '{c.model}' as model, '{c.name}' as \"check\", ({_failures_sql(c)}) as failures" for c in CHECKS
    )
    return with_tables(
        'select model, "check", failures, case when failures = 0 then \'pass\' else \'error\' end as status '
        f"from ({counted}) as counted"
    )


BROKEN_TAX = f"""
select count(*) as failing_orders
from (select order_total, subtotal, cast(tax_paid_cents as decimal(16,2)) as tax_paid from stg_orders) as broken
where not ({TAX_CHECK})"""


def _build_sql(steps: list[Step], **replaced: str) -> str:
    """Statuses of all nodes that a build of `steps` has, from the failure counts of all their checks. A step is skipped when a
    check on tables before it fails, and a check when one of its tables is skipped."""
    built = {s.name for s in steps}
    checks = [c for c in CHECKS if built.intersection(c.models)]
    before: dict[str, set[str]] = {}
    for step in PROJECT:
        before[step.name] = set(step.needs).union(*(before.get(n, set()) for n in step.needs))

    def skipped(*models: str) -> str:
        stopping = [f"'{c.model}: {c.name}'" for c in checks if any(set(c.models) <= before[m] for m in models)]
        found = f"select 1 from counts where failures > 0 and node in ({', '.join(stopping)})"
        return f"exists ({found})" if stopping else "false"

    counts = "\nunion all\n".join(f"select '{c.model}: {c.name}' as node, ({_failures_sql(c)}) as failures" for c in checks)
    rows = [
        f"select '{s.name}' as node, '{s.kind}' as kind, case when {skipped(s.name)} then 'skip' else 'pass' end as status, "
        "cast(null as bigint) as failures"
        for s in steps
    ]
    rows += [
        f"select '{f.name}', 'fixture', case when {skipped(f.model)} then 'skip' else 'pass' end, "
        f"case when {skipped(f.model)} then null else 0 end"
        for f in FIXTURES if f.model in built
    ]
    rows += [
        f"select node, 'check', case when {skipped(*c.models)} then 'skip' when failures > 0 then 'error' else 'pass' end, "
        f"case when {skipped(*c.models)} then null else failures end from counts where node = '{c.model}: {c.name}'"
        for c in checks
    ]
    nodes = "\nunion all\n".join(rows)
    return f"{with_tables('', **replaced)}, counts as ({counts})\nselect *, cast(null as varchar) as message from ({nodes}) as nodes"


ORACLE = {
    **{name: with_tables(f"select * from {name}") for name in QUERIES if name.startswith(("stg_", "mart_"))},
    "customer_type_summary": with_tables(
        "select customer_type, count(*) as customers, cast(sum(lifetime_spend) as decimal(38,2)) as lifetime_spend "
        "from mart_customers group by customer_type"
    ),
    "check_suite": _suite_sql(),
    "broken_tax_scenario": with_tables(BROKEN_TAX),
    "gated_build_status": _build_sql(
        downstream("stg_orders", PROJECT), stg_orders="select * replace (cast(tax_paid_cents as decimal(16,2)) as tax_paid) "
        f"from ({SQL['stg_orders']})"),
    "full_build_status": _build_sql(PROJECT, raw_orders=RAW_ORDERS_OF_ITEMS),
}
