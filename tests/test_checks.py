from __future__ import annotations

from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from martworks import checks as c
from martworks.checks import suite
from martworks.checks.suite import AcceptedValues, Expression, NotNull, Query, Relationship, Unique


@pytest.fixture
def df(spark):
    data = [(1, "a", 5, 1.0), (1, "a", None, 2.0), (2, " ", 7, None), (None, None, 9, 4.0), (None, "", 5, 5.0)]
    return spark.createDataFrame(data, "k int, s string, n int, d double")


def values(found, name):
    return sorted((r[name] for r in found.collect()), key=str)


def test_row_checks_pass_on_null(df):
    assert c.not_null(df, "k").count() == 2
    assert values(c.expression_is_true(df, "n > 5"), "n") == [5, 5]
    assert values(c.expression_is_true(df, "> 5", "n"), "n") == [5, 5]
    assert values(c.accepted_range(df, "n", 6, 8), "n") == [5, 5, 9]
    assert values(c.accepted_range(df, "n", 5, 9, inclusive=False), "n") == [5, 5, 9]
    assert values(c.accepted_range(df, "n", max_value="d"), "n") == [5, 9]
    assert c.accepted_range(df, "n").count() == 0


def test_not_empty_string(df):
    assert values(c.not_empty_string(df, "s"), "s") == ["", ""]
    assert values(c.not_empty_string(df, "s", trim_whitespace=False), "s") == [""]


def test_group_checks(df):
    assert rows(c.unique(df, "k")) == [(None, 2), (1, 2)]
    assert rows(c.unique_combination(df, ["k", "s"])) == [(1, "a")]
    assert rows(c.accepted_values(df, "s", ["a", ""])) == [(1, " ")]
    assert rows(c.not_accepted_values(df, "s", ["a", "z"])) == [("a",)]
    assert rows(c.not_accepted_values(df, "n", ["4 + 1"], quote=False)) == [(5,)]
    assert {r[0] for r in c.not_null_proportion(df, "n", 0.9, group_by=["k"]).collect()} == {1}
    assert c.not_null_proportion(df, "n", 0.8).count() == 0
    assert c.not_null_proportion(df, "n", 0.5, 0.7).count() == 1


def test_not_constant(df):
    assert {r["k"] for r in c.not_constant(df, "s", ["k"]).collect()} == {1, 2, None}
    assert c.not_constant(df, "s").count() == 0
    assert c.not_constant(df.filter("k = 1"), "s").first()["filler_column"] == 1
    assert c.not_constant(df.filter("d is null"), "d").count() == 0
    arrays = df.selectExpr("k", "array(k) as a")
    assert {r["k"] for r in c.not_constant(arrays, "a", ["k"]).collect()} == {1, 2, None}


def test_at_least_one(df):
    assert {r["k"] for r in c.at_least_one(df, "d", ["k"]).collect()} == {2}
    assert c.at_least_one(df, "d").count() == 0
    assert rows(c.at_least_one(df.filter("d is null"), "d")) == [(0,)]
    assert c.at_least_one(df, "k", ["k"]).first().asDict() == {"k": None, "filler_column": 0}


def test_columns_may_be_expressions(spark, df):
    assert rows(c.unique(df, "coalesce(k, -1)")) == [(-1, 2), (1, 2)]
    assert c.not_null(df, "coalesce(k, n)").count() == 0
    assert values(c.accepted_range(df, "n + 1", "3 + 4"), "n") == [5, 5]
    assert {r["k"] for r in c.not_constant(df, "upper(s)", ["k"]).collect()} == {1, 2, None}
    assert c.relationships(df, "k + 1", df, "k").count() == 1
    found = c.run_checks({"t": df}, [Unique("t", "coalesce(k, -1)"), NotNull("t", "k + n"), AcceptedValues("t", "trim(s)", ("a",))])
    assert [r["failures"] for r in found.orderBy("check").collect()] == [1, 3, 2]


def test_relationships(spark, df):
    parents = spark.createDataFrame([(2,), (2,), (None,)], "id int")
    assert values(c.relationships(df, "k", parents, "id"), "from_field") == [1, 1]
    found = c.relationships_where(df, "k", parents, "id", "d = 1.0", "id > 5")
    assert [tuple(r) for r in found.collect()] == [(1, None)]


def test_cardinality_equality(spark, df):
    other = spark.createDataFrame([(1,), (1,), (2,), (2,), (3,)], "id int")
    found = c.cardinality_equality(df, "k", other, "id")
    assert sorted((tuple(r) for r in found.collect()), key=str) == [(2, 1), (2, 2), (3, 1), (None, 2)]


def test_row_counts(spark, df):
    other = spark.createDataFrame([(1,), (3,)], "k int")
    report = c.equal_rowcount(df, other, ["k"])
    assert report.columns == ["k_a", "k_b", "count_a", "count_b", "diff_count"]
    assert c.equal_rowcount_failures(report).first()[0] == 1  # one-sided groups, null ones too, pass
    assert c.equal_rowcount_failures(c.equal_rowcount(df, other)).first()[0] == 3
    assert c.equal_rowcount_failures(c.equal_rowcount(df, other.filter("k > 9"))).first()[0] == 0
    assert c.fewer_rows_than_failures(c.fewer_rows_than(df, other)).first()[0] == 3
    assert c.fewer_rows_than_failures(c.fewer_rows_than(other, other)).first()[0] == 1
    assert c.fewer_rows_than_failures(c.fewer_rows_than(other, df)).first()[0] == 0


def test_equality(spark, df):
    assert c.equality(df, df).count() == 0
    assert c.equality_failures(c.equality(df, df)).first()[0] == 0
    other = df.filter("k is not null")
    assert c.equality_failures(c.equality(df, other)).first()[0] == 4
    assert c.equality(df, df.unionAll(df)).count() == 0  # repeated rows do not show
    near = df.withColumn("d", df.d + 0.001)
    assert c.equality(df, near).count() == 8
    assert c.equality(df, near, precision=2).count() == 0
    assert c.equality(df, near, exclude_columns=["D"]).count() == 0
    assert c.equality(df, near, compare_columns=["K", "s"]).count() == 0
    with pytest.raises(ValueError):
        c.equality(df, df.drop("d"))
    with pytest.raises(ValueError):
        c.equality(df, df, ["k"], ["k"])


def test_expect_rows_counts_repetition(spark):
    one = spark.createDataFrame([(1, "x")], "k int, more string")
    assert c.expect_rows(one, one.select("k")).count() == 0
    assert [tuple(r) for r in c.expect_rows(one.union(one), one.select("k")).collect()] == [(1, 1)]
    assert [tuple(r) for r in c.expect_rows(one, one.union(one).select("k")).collect()] == [(1, -1)]


def test_recency(spark):
    events = spark.createDataFrame(
        [("a", datetime(2024, 1, 9, 23)), ("b", datetime(2024, 1, 8, 23)), ("c", None)], "g string, t timestamp_ntz"
    )
    now = datetime(2024, 1, 10, 12)
    assert {r["g"] for r in c.recency(events, "t", "day", 1, group_by=["g"], as_of=now).collect()} == {"b", "c"}
    by_day = c.recency(events, "t", "day", 2, ignore_time_component=True, group_by=["g"], as_of=now)
    assert {r["g"] for r in by_day.collect()} == {"c"}
    assert c.recency(events, "t", "day", 1, as_of=now).count() == 0
    assert c.recency(events, "t", "day", 1).count() == 1
    zoned = events.selectExpr("g", "cast(t as timestamp) as t")
    assert c.recency(zoned, "t", "day", 1, as_of=now).count() == 0


def test_run_checks(spark, df):
    declared = [
        NotNull("t", "k"), Unique("t", "k"), Expression("t", "n > 5"), NotNull("t", "s"), Unique("t", "d"),
        AcceptedValues("t", "s", ("a",)), Relationship("t", "k", "parents", "id"), NotNull("parents", "id"),
        Query("t", "small d", lambda tables: tables["t"].filter("d < 3")),
    ]
    parents = spark.createDataFrame([(2,), (2,)], "id int")
    found = {(r["model"], r["check"]): (r["failures"], r["status"]) for r in c.run_checks({"t": df, "parents": parents}, declared).collect()}
    assert found == {
        ("t", "not_null k"): (2, "error"), ("t", "unique k"): (2, "error"), ("t", "expression n > 5"): (2, "error"),
        ("t", "not_null s"): (1, "error"), ("t", "unique d"): (0, "pass"), ("t", "accepted_values s"): (2, "error"),
        ("t", "relationships k to parents"): (2, "error"), ("parents", "not_null id"): (0, "pass"),
        ("t", "small d"): (2, "error"),
    }


def test_equality_by_digests(spark):
    """Nulls in different columns, repeats and order do not mislead; equal tables exchange digests only."""
    kind = "a int, b int, c string, d double"
    left = spark.createDataFrame([(None, 1, "x", 0.0), (1, None, "x", -0.0), (2, 2, "ab", None), (2, 2, "ab", None)], kind)
    right = spark.createDataFrame([(2, 2, "ab", None), (1, None, "x", 0.0), (None, 1, "x", -0.0)], kind)
    assert c.equality(left, right).count() == 0
    swapped = spark.createDataFrame([(1, None, "x", 0.0), (1, None, "x", 0.0), (2, 2, "ab", None)], kind)
    assert rows(c.equality(left, swapped)) == [(None, 1, "x", 0.0, "a_minus_b")]
    assert c.equality(left.limit(0), right.limit(0)).count() == 0
    nested = left.select(F.struct("a", "b").alias("s"))
    assert c.equality(nested, swapped.select(F.struct("a", "b").alias("s"))).count() == 1


def test_equal_tables_exchange_no_rows(spark, tmp_path):
    spark.range(50_000).selectExpr("id", "id % 7 AS g", "uuid() AS u").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    found = c.equality(table, table.orderBy("u"))
    assert found.collect() == []
    # The grouping of rows has an exchange; once the ranges are known to agree, adaptive execution drops it.
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan[plan.index("== Final Plan =="):plan.index("== Initial Plan ==")] if "== Final Plan ==" in plan else plan
    assert "LocalTableScan <empty>" in final or "EmptyRelation" in final or "Exchange hashpartitioning(id" not in final
    differing = c.equality(table, table.withColumn("g", F.when(F.col("id") == 5, -1).otherwise(F.col("g"))))
    assert sorted(r["which_diff"] for r in differing.collect()) == ["a_minus_b", "b_minus_a"]


@pytest.mark.parametrize(("bits", "most"), [(48, 1_000_000), (3, 1_000_000), (3, 0)])
def test_unique_texts_by_short_hashes(spark, monkeypatch, bits, most):
    """Keys that only share a short hash are not repeated; a repeated null is; all keys are compared where too many hashes repeat."""
    monkeypatch.setattr(suite, "HASH_BITS", bits)
    monkeypatch.setattr(suite, "MAX_BROADCAST_HASHES", most)
    once = spark.range(200).selectExpr("cast(id as string) as k", "if(id < 2, null, cast(id as string)) as n", "id as i")
    twice = once.unionByName(once.filter("i < 3"))
    declared = [Unique("a", "k"), NotNull("a", "n"), Unique("a", "n"), Unique("b", "k"), Unique("b", "n"), Unique("b", "i")]
    counted = c.run_checks({"a": once, "b": twice}, declared)
    assert {(r["model"], r["check"]): r["failures"] for r in counted.collect()} == {
        ("a", "unique k"): 0, ("a", "not_null n"): 2, ("a", "unique n"): 1, ("b", "unique k"): 3, ("b", "unique n"): 2, ("b", "unique i"): 3}
    if bits == 48:
        # Only repeated keys are shuffled with their 128 bits.
        assert "LeftSemi" in counted._jdf.queryExecution().executedPlan().toString()
