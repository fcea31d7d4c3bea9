from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martworks.sources.tables import VERSION, is_versioned

# Table types as the catalog words them, and the words of the result; any other type is lower-cased.
TABLE_TYPES = {"MANAGED": "table", "BASE TABLE": "table", "EXTERNAL": "external", "EXTERNAL TABLE": "external",
               "MATERIALIZED VIEW": "materializedview"}


@dataclass(frozen=True, order=True)
class Relation:
    schema: str
    name: str
    type: str

    @property
    def full_name(self) -> str:
        """Schema and name; the name alone for temporary views."""
        return f"{self.schema}.{self.name}" if self.schema else self.name

    @property
    def identifier(self) -> str:
        parts = [self.schema, self.name] if self.schema else [self.name]
        return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def relations_by_pattern(
    spark: SparkSession, schema_pattern: str, table_pattern: str, exclude: str = ""
) -> list[Relation]:
    """Catalog tables and views whose schema and name match `ILIKE` patterns and whose name does not match `exclude`.
    Temporary views have the empty schema, which the pattern `%` matches too. Types are looked up for matches only."""
    listed = reduce(
        DataFrame.union, (spark.sql(f"SHOW TABLES IN `{d.name}`") for d in spark.catalog.listDatabases())
    )
    # Entries behind versioned tables are no relations of their own.
    matching = listed.distinct().filter(~F.contains("tableName", F.lit(VERSION))).filter(
        F.ilike("namespace", F.lit(schema_pattern))
        & F.ilike("tableName", F.lit(table_pattern))
        & ~F.ilike("tableName", F.lit(exclude))
    )
    return [_relation(spark, *row) for row in matching.orderBy("namespace", "tableName").collect()]


def _relation(spark: SparkSession, schema: str, name: str, temporary: bool) -> Relation:
    relation = Relation(schema, name, "temporary")
    if temporary:
        return relation
    type_ = "EXTERNAL" if is_versioned(spark, relation.identifier) else spark.catalog.getTable(relation.identifier).tableType
    return Relation(schema, name, TABLE_TYPES.get(type_, type_.lower()))


def relations_by_prefix(spark: SparkSession, schema: str, prefix: str, exclude: str = "") -> list[Relation]:
    return relations_by_pattern(spark, schema, f"{prefix}%", exclude)


def read_relations(spark: SparkSession, relations: Sequence[Relation]) -> dict[str, DataFrame]:
    """The found tables by full name, e.g. for `union_relations`, which labels rows with it."""
    return {r.full_name: spark.table(r.identifier) for r in relations}
