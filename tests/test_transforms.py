from __future__ import annotations

from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from martworks import fixed_values as fixed
from martworks import operators as op


@pytest.fixture
def colors(spark):
    return spark.createDataFrame([("S", "red"), ("S", "blue"), ("S", "red"), ("M", "red")], "size string, color string")


def test_pivot_counts_with_zero(colors):
    found = op.pivot(colors, ["size"], "color", op.column_value_list(colors, "color"))
    assert found.columns == ["size", "red", "blue"]
    assert {tuple(r) for r in found.collect()} == {("S", 2, 1), ("M", 1, 0)}


def test_pivot_takes_quotes_in_values(spark):
    df = spark.createDataFrame([(1, "it's"), (1, "a.b")], "k int, v string")
    assert op.pivot(df, ["k"], "v", ["it's", "a.b"], prefix="n ").first().asDict() == {"k": 1, "n it's": 1, "n a.b": 1}


def test_column_values(spark, colors):
    assert [tuple(r) for r in op.column_values(colors, "color").collect()] == [("red", 3), ("blue", 1)]
    assert op.column_value_list(colors, "color", limit=1) == ["red"]
    assert op.column_value_list(colors, "color", [F.col("value")]) == ["blue", "red"]
    assert op.column_value_list(colors.filter("size = 'L'"), "color", default=["none"]) == ["none"]
    assert op.column_value_list(None, "color", default=["none"]) == ["none"]
    with pytest.raises(ValueError):
        op.column_value_list(None, "color")
    assert op.column_value_list(colors, "color", limit=0, default=[]) == []
    with pytest.raises(ValueError):
        op.column_value_list(colors, "color", most=1)


def test_unpivot(spark):
    df = spark.createDataFrame([(1, "a", True, None, 9)], "id int, s string, b boolean, n int, gone int")
    found = op.unpivot(df, exclude=["ID"], remove=["GONE"])
    assert {tuple(r) for r in found.collect()} == {(1, "s", "a"), (1, "b", "true"), (1, "n", None)}


def test_union_relations(spark):
    a = spark.createDataFrame([(1, "x")], "id int, only_a string")
    b = spark.createDataFrame([(2, True), (5, False)], "ID bigint, only_b boolean")
    found = op.union_relations({"a": a, "b": b}, where="id < 5")
    assert found.dtypes == [
        (fixed.SOURCE_COLUMN, "string"), ("id", "int"), ("only_a", "string"), ("only_b", "boolean"),
    ]
    assert {tuple(r) for r in found.collect()} == {("a", 1, "x", None), ("b", 2, None, True)}
    narrow = op.union_relations({"a": a, "b": b}, {"id": "string"}, include=["ID"], source_column_name=None)
    assert narrow.dtypes == [("id", "string")]
    with pytest.raises(ValueError):
        op.union_relations({"a": a}, include=["id"], exclude=["id"])
    with pytest.raises(ValueError):
        op.union_relations({"a": a}, include=["nothing"])


def test_union_fails_on_values_that_do_not_fit(spark):
    a = spark.createDataFrame([(1,)], "id int")
    b = spark.createDataFrame([("x",)], "id string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        op.union_relations({"a": a, "b": b}).collect()


def test_star(spark):
    df = spark.createDataFrame([(1, 2, 3)], "A int, b int, `c.d` int")
    assert op.star(df, ["a"], prefix="p_", rename={"B": "bee"}).columns == ["bee", "p_c.d"]
    assert op.filtered_columns(df, ["B"]) == ["A", "c.d"]
    with pytest.raises(ValueError):
        op.star(df, ["a", "B", "c.d"])


def test_nullcheck_table(spark):
    df = spark.createDataFrame([("", 0), ("x", 1)], "s string, n int")
    assert rows(op.nullcheck_table(df)) == [(0, None), (1, "x")]


def test_generate_series(spark):
    assert [r[0] for r in op.generate_series(spark, 3).orderBy("generated_number").collect()] == [1, 2, 3]
    with pytest.raises(ValueError):
        op.generate_series(spark, 0)


@pytest.mark.parametrize(
    "part, start, end, found",
    [
        ("day", date(2024, 2, 27), date(2024, 3, 1), ["2024-02-27", "2024-02-28", "2024-02-29"]),
        ("month", date(2024, 1, 30), date(2024, 4, 1), ["2024-01-30", "2024-02-29", "2024-03-30"]),
        ("week", "date'2024-01-01'", "date'2024-01-15'", ["2024-01-01", "2024-01-08"]),
        ("day", date(2024, 1, 1), date(2024, 1, 1), []),
        ("day", date(2024, 1, 2), date(2024, 1, 1), []),
        ("hour", datetime(2024, 1, 1, 22), datetime(2024, 1, 2, 0), ["2024-01-01 22:00:00", "2024-01-01 23:00:00"]),
    ],
)
def test_date_spine(spark, part, start, end, found):
    spine = op.date_spine(spark, part, start, end)
    assert spine.columns == [f"date_{part}"]
    assert sorted(str(r[0]) for r in spine.collect()) == found
    if not isinstance(start, str):
        bounds = spark.createDataFrame([(start, end)], "a timestamp_ntz, b timestamp_ntz" if part == "hour" else "a date, b date")
        between = op.date_spine_between(bounds, part, "a", "b")
        assert sorted(str(r[2]) for r in between.collect()) == found


def test_symmetric_diff(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k int, v string")
    b = spark.createDataFrame([(1, None), (3, None)], "k int, v string")
    assert rows(op.symmetric_diff(a, b)) == [(2, "x", "a_minus_b"), (3, None, "b_minus_a")] or rows(
        op.symmetric_diff(a, b)
    ) == [(3, None, "b_minus_a"), (2, "x", "a_minus_b")]


def test_join_summary_does_not_multiply_rows(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    detail = spark.createDataFrame([(1, 5), (1, 6), (None, 7)], "k int, v int")
    found = op.join_summary(left, detail, "k", F.sum("v").alias("total"), op.count_where(F.col("v") > 9).alias("n"))
    assert {tuple(r) for r in found.collect()} == {(1, 11, 0), (2, None, None), (None, None, None)}


def test_group_by_first(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, 2, 4)], "a int, b int, c int")
    assert rows(op.group_by_first(df, 2, F.sum("c").alias("c"))) == [(1, 2, 7)]


def test_pivot_counts_a_matched_value_once(spark):
    df = spark.createDataFrame([("g", "1", 5), ("g", "01", 5), ("g", "2", 7), ("h", "9", 1)], "g string, n string, v int")
    found = op.pivot(df, ["g"], "n", [1, 2], agg="count", then_value="v", else_value=None, distinct=True)
    assert {tuple(r) for r in found.collect()} == {("g", 1, 1), ("h", 0, 0)}


@pytest.mark.parametrize("cmp, value, expected", [("in", ("1", "2"), 2), ("not in", ("1",), 3), ("<=>", None, 0), ("ilike", "X%", 1), ("not like", "0%", 3)])
def test_pivot_with_any_comparison(spark, cmp, value, expected):
    df = spark.createDataFrame([("g", "1"), ("g", "01"), ("g", "2"), ("g", "x")], "g string, n string")
    assert op.pivot(df, ["g"], "n", [value], cmp=cmp).first()[1] == expected


def test_pivot_refuses_what_is_no_name(spark):
    for wrong in ({"agg": "sum(1) --"}, {"cmp": "= 1 or 1"}):
        with pytest.raises(ValueError):
            op.pivot(spark.range(1), [], "id", [1], **wrong)


@pytest.mark.parametrize("agg", ["sum", "count", "min", "max"])
@pytest.mark.parametrize("then_value, else_value, group, distinct", [
    (1, 0, ["g"], False), ("v", None, ["g"], True), ("v", 3, [], False), ("d", 0, ["g"], False), ("f", 0.5, ["g"], False)])
def test_pivot_by_cells_agrees_with_one_condition_per_value(spark, agg, then_value, else_value, group, distinct):
    """`<=>` is not placed by cells; for values that are not null it is the same comparison."""
    rows = [(1, "x", 1, "1.50", 0.5), (1, "x", None, None, None), (1, "y", 7, "2.25", 2.0), (2, "z", 5, "9.00", 1.0), (2, None, 4, None, None),
            (3, "x", None, None, 4.0), (3, "x", None, "3.00", 4.0), (4, None, None, None, None), (None, "y", 2, "0.25", 8.0)]
    df = spark.createDataFrame(rows, "g int, c string, v int, d string, f double").withColumn("d", F.col("d").cast("decimal(9,2)"))
    found, plain = (
        op.pivot(df, group, "c", ["x", "y", "q"], agg=agg, cmp=cmp, then_value=then_value, else_value=else_value, distinct=distinct)
        for cmp in ("=", "<=>"))
    assert found.dtypes == plain.dtypes
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))


def test_pivot_by_lists_and_other_kinds(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("a", 3, 30), ("b", 3, 40)], "g string, n int, v int")
    found = op.pivot(df, ["g"], "n", [(1, 2), (3,), (2, 3, None)], cmp="in", then_value="v", quote_identifiers=False)
    assert sorted(map(tuple, found.collect())) == [("a", 30, 30, 50), ("b", 0, 40, 40)]
    empty = op.pivot(df.limit(0), [], "n", [1, 2])
    assert [tuple(r) for r in empty.collect()] == [tuple(r) for r in op.pivot(df.limit(0), [], "n", [1, 2], cmp="<=>").collect()]


def test_pivot_of_many_values(spark):
    """2,000 values: two aggregations, and no expression per value on raw rows."""
    values = list(range(2000))
    df = spark.range(20_000).select((F.col("id") % 3).alias("g"), (F.col("id") % 2500).alias("c"), F.col("id").alias("v"))
    found = op.pivot(df, ["g"], "c", values, then_value="v", prefix="n")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("pivotfirst") >= 2 and "Expand" not in plan
    rows = {r["g"]: r for r in found.collect()}
    expected = {g: sum(v for v in range(20_000) if v % 3 == g and v % 2500 < 2000) for g in range(3)}
    assert {g: sum(tuple(r)[1:]) for g, r in rows.items()} == expected
    assert rows[0]["n7"] == sum(v for v in range(7, 20_000, 2500) if v % 3 == 0)


def test_most_frequent_values_by_summary(spark):
    """Frequent values are counted without grouping all of them; where none stands out, all are grouped. Both are exact."""
    from martworks.operators import aggregates

    frequent = "CASE WHEN id % 10 < 4 THEN concat('top', id % 7) WHEN id % 10 = 4 THEN NULL ELSE concat('v', id) END AS v"
    skewed, even = spark.range(60_000).selectExpr(frequent), spark.range(60_000).selectExpr("concat('v', id % 50000) AS v")
    found = aggregates._most_frequent(skewed.toDF("value"), 5)
    assert found is not None and found.count() < 50
    assert aggregates._most_frequent(even.toDF("value"), 5) is None
    for df in (skewed, even, skewed.limit(0)):
        for limit in (1, 5, 9):
            plain = df.groupBy(F.col("v").alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value").limit(limit)
            assert op.column_values(df, "v", limit=limit).collect() == plain.collect()
    # A summary that tracks little rules out little: the list is widened to all values.
    assert aggregates._most_frequent(skewed.toDF("value"), 9, tracked=16) is None
    numbers = skewed.select(F.length("v").alias("n"), F.expr("cast(length(v) as decimal(9, 2)) AS d"))
    assert [tuple(r) for r in op.column_values(numbers, "d", limit=2).collect()] == [
        tuple(r) for r in numbers.groupBy("d").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(2).collect()]
