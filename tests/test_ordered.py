"""Order-dependent operators against brute force, on the plain path and with every group treated as hot."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows

from martworks.checks import mutually_exclusive_ranges, sequential_values
from martworks.operators import deduplicate, ordered, repeat_rows, sequence_no, with_next, with_previous

# Numbers of slices.
SLICES = [1, 4, 16]


@pytest.fixture
def slices(spark, request):
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def grouped(data, key):
    found: dict = {}
    for row in data:
        found.setdefault(key(row), []).append(row)
    return found


@pytest.mark.parametrize("slices", SLICES, indirect=True)
def test_sequence_no(spark, slices):
    rnd = random.Random(1)
    data = [(rnd.choice(["a", "a", "a", "b", None]), rnd.choice([None, 1, 2, 2, 2, 3]), i) for i in range(200)]
    df = spark.createDataFrame(data, "g string, day int, id int")
    expected = set()
    for members in grouped(data, lambda r: r[0]).values():
        ordered = sorted(members, key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        expected |= {(*row, n + 1) for n, row in enumerate(ordered)}
    found = sequence_no(df, ["g"], ["day", "id"], "n")
    assert found.columns == ["g", "day", "id", "n"]
    assert dict(found.dtypes)["n"] == "bigint"
    assert {tuple(r) for r in found.collect()} == expected


@pytest.mark.parametrize("slices", SLICES, indirect=True)
def test_sequence_no_over_a_whole_table(spark, slices):
    df = spark.range(100).selectExpr("id * 37 % 101 as v")
    found = sequence_no(df, [], ["v"], "n").collect()
    assert [n for _, n in sorted((r["v"], r["n"]) for r in found)] == list(range(1, 101))


def brute_sequential(data, interval):
    failing = []
    for group, members in grouped(data, lambda r: r[0]).items():
        values = sorted((r[1] for r in members), key=lambda v: (v is not None, v or 0))
        for previous, value in zip([None, *values], values):
            if value is not None and previous is not None and value != previous + interval:
                failing.append((group, previous, value))
    return sorted(failing, key=str)


@pytest.mark.parametrize("slices", SLICES, indirect=True)
@pytest.mark.parametrize("interval", [1, 2, 0])
def test_sequential_values(spark, slices, interval):
    rnd = random.Random(2)
    data = [(rnd.choice(["a", "a", "a", None]), rnd.choice([None, *range(0, 120, 1), 5, 5, 5])) for _ in range(150)]
    data += [("dup", 7)] * 40
    df = spark.createDataFrame(data, "g string, v int")
    failing = sequential_values(df, "v", interval, group_by=["g"])
    assert failing.columns == ["g", "v", "previous_v"]
    found = sorted(((r["g"], r["previous_v"], r["v"]) for r in failing.collect()), key=str)
    assert found == brute_sequential(data, interval)


@pytest.mark.parametrize("slices", SLICES, indirect=True)
def test_sequential_values_ungrouped_dates(spark, slices):
    df = spark.sql("select explode(sequence(date'2024-01-01', date'2024-03-31')) as d").filter("d <> date'2024-02-10'")
    failing = sequential_values(df, "d", 1, "day").collect()
    assert [(str(r["previous_d"]), str(r["d"])) for r in failing] == [("2024-02-09", "2024-02-11")]


def brute_ranges(data, meets, forward):
    failing = []
    order = lambda v: (v is not None, v or 0)
    for group, members in grouped(data, lambda r: r[0]).items():
        ordered = sorted(members, key=lambda r: (order(r[1]), order(r[2])))
        for row, following in zip(ordered, [*ordered[1:], None]):
            _, low, high = row
            next_low = following[1] if following else None
            good_length = low is not None and high is not None and forward(low, high)
            good_gap = following is None or (high is not None and next_low is not None and meets(high, next_low))
            if not (good_length and good_gap):
                failing.append((group, low, high, next_low, following is None, good_length, good_gap))
    return sorted(failing, key=str)


@pytest.mark.parametrize("slices", SLICES, indirect=True)
@pytest.mark.parametrize(
    "gaps, meets", [("allowed", int.__le__), ("required", int.__lt__), ("not_allowed", int.__eq__)]
)
@pytest.mark.parametrize("zero, forward", [(False, int.__lt__), (True, int.__le__)])
def test_mutually_exclusive_ranges(spark, slices, gaps, meets, zero, forward):
    rnd = random.Random(3)
    data = [(rnd.choice(["a", "a", "b"]), low, low + rnd.choice([0, 1, 1, 2, 5])) for low in range(0, 90, 2)]
    data += [("b", None, 3), ("b", 4, None), ("c", 1, 2), ("c", 1, 2), ("c", 1, 2), ("d", None, None)]
    df = spark.createDataFrame(data, "g string, lo int, hi int")
    failing = mutually_exclusive_ranges(df, "lo", "hi", "g", gaps, zero)
    assert sorted((tuple(r) for r in failing.collect()), key=str) == brute_ranges(data, meets, forward)


def test_ranges_reject_unknown_gap_rule(spark):
    with pytest.raises(ValueError):
        mutually_exclusive_ranges(spark.range(1), "id", "id", gaps="maybe")


def test_deduplicate_keeps_rows_with_nulls_and_shrinks_before_the_shuffle(spark):
    data = [("a", 2, None), ("a", 1, None), ("b", 1, "x"), (None, 3, "y"), (None, 4, "z")]
    df = spark.createDataFrame(data, "g string, o int, v string")
    found = deduplicate(df, ["g"], ["o"])
    assert rows(found) == rows(spark.createDataFrame([data[1], data[2], data[3]], df.schema))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_repeat_rows(spark):
    df = spark.createDataFrame([("a", 3), ("b", 0), ("c", 2_000_001)], "k string, n bigint")
    counts = {r["k"]: r["count"] for r in repeat_rows(df, "n").groupBy("k").count().collect()}
    assert counts == {"a": 3, "c": 2_000_001}


@pytest.mark.parametrize("slices", [16], indirect=True)
def test_one_group_is_spread_over_slices(spark, slices):
    df = spark.range(1000).selectExpr("if(id % 3 = 0, 'big', cast(id % 5 as string)) as g", "id * 7 % 1009 as v")
    cut = ordered._Slices(df, ["g"], ["v"]).rows
    assert cut.filter("g = 'big'").select("_slice").distinct().count() > 3
    bounds = cut.groupBy("_slice").agg({"g": "max"}).orderBy("_slice").collect()
    assert [r["max(g)"] for r in bounds] == sorted(r["max(g)"] for r in bounds)
    spanning = ordered._Slices(df, ["g"], ["v"]).of_spanning_groups(F.count(F.lit(1)))
    assert spanning.count() <= 2 * slices


@pytest.mark.parametrize("slices", SLICES, indirect=True)
def test_neighbours_carry_columns_that_cannot_be_compared(spark, slices):
    df = spark.range(40).selectExpr("id % 2 as g", "id as v", "map('k', id) as m")
    found = with_previous(df, ["g"], ["v"], "before", F.col("v") > 3).collect()
    assert {(r["v"], r["before"]["v"], r["m"]["k"]) for r in found} == {(v, v - 2, v) for v in range(4, 40)}
    assert with_next(df.limit(0), ["g"], ["v"], "after").count() == 0


@pytest.mark.parametrize("slices", [16], indirect=True)
def test_rows_stay_where_they_are_numbered(spark, slices):
    """What slices know of each other is broadcast, whatever the limit for tables; the rows are not shuffled once more for it."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        df = spark.range(1000).selectExpr("id % 3 as g", "id as v")
        text = sequence_no(df, ["g"], ["v"], "n")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in text[:text.index("Window")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
