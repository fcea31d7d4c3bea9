"""Declared checks, counted together: as few scans and shuffles per table as the checks allow."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martworks.checks.compare import orphans
from martworks.checks.groups import unique
from martworks.checks.rows import expression_fails, null_fails
from martworks.operators.columns import type_of
from martworks.session import written

PASS, ERROR, SKIP = "pass", "error", "skip"
# Bits of the hashes by which repeated keys are looked for; up to how many repeated hashes are broadcast (8 MB) to find their keys.
HASH_BITS, MAX_BROADCAST_HASHES = 48, 1_000_000


@dataclass(frozen=True)
class Check:
    model: str

    @property
    def models(self) -> tuple[str, ...]:
        """Every table the check reads."""
        return (self.model,)


@dataclass(frozen=True)
class NotNull(Check):
    column: str

    @property
    def name(self) -> str:
        return f"not_null {self.column}"


@dataclass(frozen=True)
class Unique(Check):
    column: str

    @property
    def name(self) -> str:
        return f"unique {self.column}"


@dataclass(frozen=True)
class Expression(Check):
    expression: str
    column: str | None = None

    @property
    def name(self) -> str:
        return f"expression {self.column + ' ' if self.column else ''}{self.expression}"


@dataclass(frozen=True)
class AcceptedValues(Check):
    column: str
    values: tuple

    @property
    def name(self) -> str:
        return f"accepted_values {self.column}"


@dataclass(frozen=True)
class Relationship(Check):
    column: str
    to: str
    field: str

    @property
    def name(self) -> str:
        return f"relationships {self.column} to {self.to}"

    @property
    def models(self) -> tuple[str, ...]:
        return (self.model, self.to)


@dataclass(frozen=True)
class Query(Check):
    """Any check: a function of the tables that returns failing rows."""

    name: str
    failing: Callable[[Mapping[str, DataFrame]], DataFrame]
    reads: tuple[str, ...] = ()

    @property
    def models(self) -> tuple[str, ...]:
        return (self.model, *self.reads)


def failure_count(failing: DataFrame) -> DataFrame:
    return failing.agg(F.count(F.lit(1)).alias("failures"))


def _condition(check: NotNull | Expression) -> Column:
    if isinstance(check, NotNull):
        return null_fails(check.column)
    return expression_fails(check.expression, check.column)


def _long(counts: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row of counts `c0, c1, …` as one row per check."""
    rows = [
        F.struct(
            F.lit(check.model).alias("model"), F.lit(check.name).alias("check"),
            F.coalesce(F.col(f"c{i}"), F.lit(0)).cast("bigint").alias("failures"),
        )
        for i, check in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*rows)))


def _count_orphans(models: Mapping[str, DataFrame], check: Relationship) -> DataFrame:
    found = orphans(models[check.model], check.column, models[check.to], check.field)
    return _long(found.agg(F.sum("n_records").alias("c0")), [check])


def _key_family(type_: T.DataType) -> str | None:
    """Keys of one family can be compared with each other by `_key`; None where that does not hold."""
    if isinstance(type_, T.IntegralType):
        return "integral"
    return type_.simpleString() if isinstance(type_, (T.StringType, T.DateType, T.BooleanType, T.DecimalType)) else None


def _key(key: Column, type_: T.DataType) -> tuple[Column, Column]:
    """A key of any family as two longs, both null for a null: the number itself, or 128 bits of hash."""
    if isinstance(type_, T.IntegralType):
        return key.cast("bigint"), F.when(key.isNotNull(), F.lit(0).cast("bigint"))
    hashes = (F.xxhash64(F.lit(seed), key) for seed in (17, 71))
    first, second = (F.when(key.isNotNull(), h) for h in hashes)
    return first, second


def _entries(table: DataFrame, cells: Sequence[Column]) -> DataFrame:
    """A row for each cell that is not null. Columns become rows by an `Expand`, which is compiled with what is around it."""
    names = [f"_e{i}" for i in range(len(cells))]
    wide = table.select(*(cell.alias(name) for cell, name in zip(cells, names)))
    return wide.unpivot([], names, "_n", "_e").filter(F.col("_e").isNotNull()).select("_e.*")


def _count_by_key(models: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame | None:
    """Row, uniqueness, value and relationship checks of all tables in one grouping and one scan of each table.

    A row becomes one narrow entry of fixed width for each key that is looked at: (domain, key as two longs, role). A domain is the key
    column of a parent, and role 0 its own rows; the children of a relationship come in the parent's domain with the check's
    role. A row that fails a row check, or has a value that is not accepted, is an entry of a domain of that check. Entries are added up
    before the shuffle, so a frequent key or failure crosses it once per task."""
    domains = {key: i for i, key in enumerate(dict.fromkeys(
        (c.to, c.field) if isinstance(c, Relationship) else (c.model, c.column) for c in checks if isinstance(c, (Unique, Relationship))))}
    roles = {check: i + 1 for i, check in enumerate(c for c in checks if isinstance(c, Relationship))}
    tables: dict[str, list[Column]] = {}

    def entry(table: str, domain: int, key: str | None, role: int = 0, when: Column | None = None) -> None:
        halves = _key(F.expr(key), type_of(models[table], key)) if key else (F.lit(None).cast("bigint"),) * 2
        cell = F.struct(F.lit(domain).alias("domain"), halves[0].alias("key"), halves[1].alias("rest"), F.lit(role).alias("role"))
        tables.setdefault(table, []).append(cell if when is None else F.when(when, cell))

    for (table, column), domain in domains.items():
        entry(table, domain, column)
    for i, check in enumerate(checks):
        if isinstance(check, Relationship):
            entry(check.model, domains[check.to, check.field], check.column, roles[check], F.expr(check.column).isNotNull())
        elif isinstance(check, AcceptedValues):
            entry(check.model, -1 - i, check.column, when=~F.expr(check.column).isin(list(check.values)))
        elif isinstance(check, (NotNull, Expression)):
            entry(check.model, -1 - i, None, when=_condition(check))
    if not tables:
        return None
    entries = [_entries(models[name], cells) for name, cells in tables.items()]
    per_key = reduce(DataFrame.union, entries).groupBy("domain", "key", "rest").agg(
        *(F.count_if(F.col("role") == role).alias(f"n{role}") for role in (0, *roles.values())))
    counts = []
    for i, check in enumerate(checks):
        if isinstance(check, Relationship):
            orphaned = (F.col("domain") == domains[check.to, check.field]) & (F.col("n0") == 0)
            count = F.sum(F.when(orphaned, F.col(f"n{roles[check]}")))
        elif isinstance(check, Unique):
            count = F.count_if((F.col("domain") == domains[check.model, check.column]) & (F.col("n0") > 1))
        elif isinstance(check, AcceptedValues):
            count = F.count_if(F.col("domain") == -1 - i)
        else:
            count = F.sum(F.when(F.col("domain") == -1 - i, F.col("n0")))
        counts.append(count.alias(f"c{i}"))
    return _long(per_key.agg(*counts), checks)


def _count_repeated(models: Mapping[str, DataFrame], checks: Sequence[Unique]) -> DataFrame:
    """Uniqueness of texts. Short hashes, one narrow column, are grouped first; only keys whose hash comes twice are then compared by
    128 bits. With very many repeated hashes that is all keys."""
    def keys(*columns: str) -> DataFrame:
        parts = []
        for i, check in enumerate(checks):
            key = F.expr(check.column)
            first, second = _key(key, type_of(models[check.model], check.column))
            short = F.xxhash64(F.lit(i), key).bitwiseAND(F.lit((1 << HASH_BITS) - 1))
            parts.append(models[check.model].select(
                short.alias("hash"), F.lit(i).alias("check"), first.alias("key"), second.alias("rest")).select(*columns))
        return reduce(DataFrame.union, parts)

    hashes = keys("hash").groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("hash")
    repeated = written(hashes, "repeated-hashes")
    found = keys("hash", "check", "key", "rest")
    if repeated.count() <= MAX_BROADCAST_HASHES:
        found = found.join(F.broadcast(repeated), "hash", "left_semi")
    per_key = found.groupBy("check", "key", "rest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return _long(per_key.agg(*(F.count_if(F.col("check") == i).alias(f"c{i}") for i in range(len(checks)))), checks)


def run_checks(models: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """Count the failures of every check: `model, check, failures, status`, one row per check.

    All declared checks share one scan of each table and one grouping, but for unique texts that no relationship refers to: these are
    looked for at once, by short hashes, when this is called. Relationships between keys of different kinds, and
    checks that are queries, are counted by themselves. Tables that are expensive to compute should be written first."""
    if not checks:
        raise ValueError("run_checks: no checks given")

    def type_of_key(table: str, column: str) -> str | None:
        return _key_family(type_of(models[table], column))

    apart = [c for c in checks if isinstance(c, Query)]
    apart += [c for c in checks if isinstance(c, Unique) and type_of_key(c.model, c.column) is None]
    apart += [
        c for c in checks if isinstance(c, Relationship)
        and (type_of_key(c.model, c.column) is None or type_of_key(c.model, c.column) != type_of_key(c.to, c.field))
    ]
    parts: list[DataFrame] = []
    for check in apart:
        if isinstance(check, Relationship):
            parts.append(_count_orphans(models, check))
        elif isinstance(check, Unique):
            parts.append(_long(failure_count(unique(models[check.model], check.column)).toDF("c0"), [check]))
        else:
            parts.append(_long(failure_count(check.failing(models)).toDF("c0"), [check]))
    parents = {(c.to, c.field) for c in checks if isinstance(c, Relationship)}
    texts = [
        c for c in checks if isinstance(c, Unique) and c not in apart and (c.model, c.column) not in parents
        and type_of_key(c.model, c.column) == "string"
    ]
    if texts:
        parts.append(_count_repeated(models, texts))
    together = _count_by_key(models, [c for c in checks if c not in apart and c not in texts])
    if together is not None:
        parts.append(together)
    status = F.when(F.col("failures") == 0, PASS).otherwise(ERROR)
    return reduce(DataFrame.union, parts).withColumn("status", status)
