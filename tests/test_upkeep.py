from __future__ import annotations

import os
import threading
import uuid
from datetime import datetime

import pytest
from conftest import rows

from martworks import fixed_values as fixed
from martworks import sources as s
from martworks.checks.suite import NotNull
from martworks.plans.build import Fixture, Step, gated_build, to_catalog
from martworks.plans.fixtures import FIXTURES
from martworks.plans.staging import stg_products, stg_supplies
from martworks.session import fresh_path, release, shared_folder, written


def name():
    return f"t_{uuid.uuid4().hex}"


@pytest.mark.parametrize("fixture", FIXTURES, ids=lambda f: f.name)
def test_model_fixtures(spark, fixture):
    assert fixture.failing(spark).collect() == []


def test_csv_types_and_blanks(spark, tmp_path):
    path = tmp_path / "raw_products.csv"
    path.write_text(
        "sku,name,type,price,description\n"
        f'007,"a, ""b"" ",{fixed.FOOD_TYPE},1100,ends in blank \n008,x,{fixed.DRINK_TYPE},400,y\n'
    )
    products = s.load_csv(spark, str(path), fixed.RAW_SCHEMAS["raw_products"])
    assert [tuple(r) for r in products.orderBy("sku").collect()] == [
        ("007", 'a, "b" ', fixed.FOOD_TYPE, 1100, "ends in blank "), ("008", "x", fixed.DRINK_TYPE, 400, "y"),
    ]
    staged = {r["product_id"]: r for r in stg_products(products).collect()}
    assert staged["007"]["is_food_item"] and not staged["007"]["is_drink_item"] and staged["008"]["is_drink_item"]

    path = tmp_path / "raw_supplies.csv"
    path.write_text("id,name,cost,perishable,sku\nSUP-001,knife,7,False,JAF-001\n")
    supply = stg_supplies(s.load_csv(spark, str(path), fixed.RAW_SCHEMAS["raw_supplies"])).first()
    assert supply["supply_uuid"] == "0c1009250b32f19a8c96b44ba55d3cb3" and supply["is_perishable_supply"] is False

    path.write_text("id,name,cost,perishable,sku\nSUP-001,knife,seven,False,JAF-001\n")
    with pytest.raises(Exception, match="MALFORMED"):
        s.load_csv(spark, str(path), fixed.RAW_SCHEMAS["raw_supplies"]).collect()


def test_source(spark):
    root = fresh_path(spark, "raw")
    spark.createDataFrame([("1", "x")], fixed.RAW_SCHEMAS["raw_customers"]).write.parquet(f"{root}/raw_customers")
    assert rows(s.source(spark, "raw_customers", root)) == [("1", "x")]
    with pytest.raises(ValueError):
        s.source(spark, "raw_nothing", root)


def test_table_rebuild_leaves_the_old_version_readable(spark):
    table, folder = name(), shared_folder(spark)
    old = s.as_table(spark.range(3), table, folder)
    s.as_table(spark.range(5), table, folder)
    assert old.count() == 3 and spark.table(table).count() == 5
    s.as_table(spark.range(2).withColumnRenamed("id", "other"), table, folder)
    assert spark.table(table).columns == ["other"]


def test_incremental_loads(spark):
    folder = shared_folder(spark)
    appended = name()
    s.incremental_append(spark.range(2), appended, folder)
    assert rows(s.incremental_append(spark.range(1, 3), appended, folder)) == [(0,), (1,), (1,), (2,)]

    for partition in (None, "p"):
        merged = name()
        first = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", None), (None, "n", "x")], "k int, v string, p string")
        second = spark.createDataFrame([(2, "B", "x"), (3, "C", None), (4, "d", "it's")], "k int, v string, p string")
        s.incremental_merge(first, merged, folder, ["k"], partition)
        found = s.incremental_merge(second, merged, folder, ["k"], partition)
        expected = {(1, "a", "x"), (None, "n", "x"), (2, "B", "x"), (3, "C", None), (4, "d", "it's")}
        assert {tuple(r) for r in found.select("k", "v", "p").collect()} == expected
        assert spark.table(merged).count() == 5
        moved_back = spark.createDataFrame([(4, "e", "x")], "k int, v string, p string")
        found = s.incremental_merge(moved_back, merged, folder, ["k"], partition)
        assert {tuple(r) for r in found.select("k", "v", "p").collect()} == (expected - {(4, "d", "it's")}) | {(4, "e", "x")}


def history_rows(df):
    columns = ["k", "v", fixed.VALID_FROM, fixed.VALID_TO]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.mark.parametrize("check_cols", [["v"], "all"])
def test_snapshot_by_values(spark, check_cols):
    def source(*data):
        return spark.createDataFrame(data, "k int, v string")

    days = [datetime(2024, 1, d) for d in (1, 2, 3, 4)]

    def run(history, src, day):
        return s.snapshot(history, src, ["k"], check_cols=check_cols, as_of=day)

    one = run(None, source((1, "a"), (2, None), (3, "c")), days[0])
    two = run(one, source((1, "A"), (2, None), (4, "d")), days[1])
    expected = [
        (1, "A", days[1], None), (1, "a", days[0], days[1]), (2, None, days[0], None), (3, "c", days[0], None),
        (4, "d", days[1], None),
    ]
    assert history_rows(two) == sorted(expected, key=str)
    assert history_rows(run(two, source((1, "A"), (2, None), (4, "d")), days[2])) == sorted(expected, key=str)
    three = run(two, source((2, "b")), days[3])
    assert {r["v"] for r in s.current(three).filter("k = 2").collect()} == {"b"}
    assert three.select(fixed.VERSION_ID).distinct().count() == three.count() == 6
    assert {r["v"] for r in s.as_of(three, datetime(2024, 1, 1, 12)).collect()} == {"a", None, "c"}
    assert {r["v"] for r in s.as_of(three, days[1]).filter("k = 1").collect()} == {"a", "A"}  # both ends count


def test_snapshot_by_timestamp(spark):
    def source(*data):
        return spark.createDataFrame(data, "k int, v string, at timestamp_ntz")

    early, late = datetime(2024, 1, 1), datetime(2024, 1, 5)
    one = s.snapshot(None, source((1, "a", early), (2, "b", late)), ["k"], updated_at="at")
    two = s.snapshot(one, source((1, "A", late), (2, "ignored", early)), ["k"], updated_at="at")
    assert history_rows(two) == sorted([(1, "a", early, late), (1, "A", late, None), (2, "b", late, None)], key=str)
    with pytest.raises(ValueError):
        s.snapshot(None, source(), ["k"])


def test_freshness(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1),)], "t timestamp_ntz")
    now = datetime(2024, 1, 2, 12)

    def status(frame, **limits):
        return s.freshness(frame, "t", as_of=now, **limits).first()["status"]

    assert status(df) == "pass"
    assert status(df, warn_after=(2, "day")) == "pass"
    assert status(df, warn_after=(1, "day"), error_after=(2, "day")) == "warn"
    assert status(df, error_after=(36, "hour")) == "pass"
    assert status(df, error_after=(35, "hour")) == "error"
    assert status(df.filter("t is null"), error_after=(1, "day")) == "error"
    assert s.freshness(df, "t", as_of=now).first()["age_seconds"] == 36 * 3600


def test_discovery(spark):
    prefix = name()
    for suffix in ("one", "two", "skip_me"):
        s.as_view(spark.range(1), f"{prefix}_{suffix}")
    s.as_table(spark.range(2), f"{prefix}_stored", shared_folder(spark))
    found = s.relations_by_prefix(spark, "%", prefix.upper(), exclude="%skip%")
    assert [(r.schema, r.name.split("_")[-1], r.type) for r in found] == [
        ("", "one", "temporary"), ("", "two", "temporary"), ("default", "stored", "external"),
    ]
    assert [r.name for r in s.relations_by_pattern(spark, "DEF%", f"{prefix}\\_st_red")] == [f"{prefix}_stored"]
    assert s.read_relations(spark, found)[f"default.{prefix}_stored"].count() == 2


def test_store_failures(spark):
    assert rows(s.store_failures(spark.range(2), fresh_path(spark, "failures"))) == [(0,), (1,)]


def test_gated_build_skips_what_depends_on_a_failed_check(spark):
    def step(table, *needs, rows=1):
        return Step(table, "table", needs, lambda t: spark.range(rows).selectExpr("nullif(id, 1) as k"))

    steps = [step("a", rows=2), step("b", "a"), step("c", "b"), step("other"), step("late", "other")]
    checks = [NotNull(t, "k") for t in ("a", "b", "c", "other", "late")]
    nothing = Fixture("other", "passes", lambda spark: spark.range(0))
    broken = Fixture("late", "fails", lambda spark: spark.range(3))
    found = {r["node"]: (r["kind"], r["status"], r["failures"]) for r in gated_build(spark, steps, checks, [nothing, broken]).collect()}
    assert found == {
        "a": ("table", "pass", None), "a: not_null k": ("check", "error", 1),
        "b": ("table", "skip", None), "b: not_null k": ("check", "skip", None),
        "c": ("table", "skip", None), "c: not_null k": ("check", "skip", None),
        "passes": ("fixture", "pass", 0), "other": ("table", "pass", None), "other: not_null k": ("check", "pass", 0),
        "fails": ("fixture", "error", 3), "late": ("table", "skip", None), "late: not_null k": ("check", "skip", None),
    }


def test_gated_build_survives_a_step_that_cannot_be_built(spark):
    steps = [
        Step("bad", "view", (), lambda t: spark.range(1).select("nothing")),
        Step("after", "view", ("bad",), lambda t: t["bad"]),
    ]
    assert {r["node"]: r["status"] for r in gated_build(spark, steps).collect()} == {"bad": "error", "after": "skip"}


def test_buckets_spare_the_shuffle(spark):
    folder, names = shared_folder(spark), (name(), name())
    for table in names:
        s.as_table(spark.range(500).selectExpr("id % 50 as k", "id as v"), table, folder, bucket_by=(4, ["k"]))
        s.as_table(spark.range(1000).selectExpr("id % 50 as k", "id as v"), table, folder, bucket_by=(4, ["k"]))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        one, two = (spark.table(t) for t in names)
        joined = one.join(two.groupBy("k").agg({"v": "sum"}), "k", "left")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 1000 and joined.selectExpr("sum(`sum(v)`)").first()[0] == 20 * sum(range(1000))
        new = spark.createDataFrame([(1, 7), (99, 8)], "k bigint, v bigint")
        merged = s.incremental_merge(new, names[0], folder, ["k"])
        assert merged.count() == 982 and "Exchange" not in merged.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
        assert s.incremental_append(new, names[0], folder).count() == 984
        assert s.as_table(new, names[0], folder).count() == 2  # another layout
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    with pytest.raises(ValueError):
        s.as_table(spark.range(1), name(), folder, ["id"], (2, ["id"]))


def test_a_failed_check_leaves_the_old_tables_serving(spark):
    base, mart = name(), name()
    publish = to_catalog(shared_folder(spark), "default", {mart: (2, ["k"])})

    def build(good: bool):
        source = spark.range(3).selectExpr("id as k", "id as v") if good else spark.range(9).selectExpr("nullif(id, 4) as k", "id as v")
        steps = [Step(base, "view", (), lambda t: source), Step(mart, "table", (base,), lambda t: t[base].filter("v >= 0"))]
        found = gated_build(spark, steps, [NotNull(base, "k"), NotNull(mart, "k")], publish=publish).collect()
        return {r["node"]: r["status"] for r in found}

    assert set(build(good=True).values()) == {"pass"}
    assert build(good=False) == {
        base: "pass", f"{base}: not_null k": "error", mart: "skip", f"{mart}: not_null k": "skip",
    }
    assert spark.table(base).count() == 9 and spark.table(f"default.{mart}").count() == 3


def test_partitioned_rebuild_serves_no_rows_of_before(spark):
    folder = fresh_path(spark, "rebuilt")
    one = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "v int, p string")
    two = spark.createDataFrame([(4, "x"), (5, "w"), (6, None)], "v int, p string")
    s.as_table(one, "rebuilt", folder, ["p"])
    assert rows(s.as_table(two, "rebuilt", folder, ["p"])) == rows(two)
    s.drop_table(spark, "rebuilt")
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("rebuilt")]


def test_a_merge_that_fails_leaves_the_table_as_it_was(spark, monkeypatch):
    folder = fresh_path(spark, "merged")
    first = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "it's")], "k int, v string, p string")
    s.incremental_merge(first, "merged_safely", folder, ["k"], "p")
    monkeypatch.setattr("martworks.sources.tables._take_over", lambda *_: 1 / 0)
    moved = spark.createDataFrame([(1, "A", "y"), (4, "d", None)], "k int, v string, p string")
    with pytest.raises(ZeroDivisionError):
        s.incremental_merge(moved, "merged_safely", folder, ["k"], "p")
    assert rows(spark.table("merged_safely")) == rows(first)
    monkeypatch.undo()
    found = s.incremental_merge(moved, "merged_safely", folder, ["k"], "p")
    expected = [(1, "A", "y"), (4, "d", None), (2, "b", "y"), (3, "c", "it's")]
    assert rows(found) == rows(spark.createDataFrame(expected, first.schema))
    s.drop_table(spark, "merged_safely")
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("merged_safely")]


def test_other_columns_are_refused(spark):
    folder = fresh_path(spark, "columns")
    s.incremental_append(spark.range(3), "narrow", folder)
    with pytest.raises(ValueError, match="new"):
        s.incremental_append(spark.range(3).selectExpr("id", "id as gained"), "narrow", folder)
    with pytest.raises(ValueError, match="missing"):
        s.incremental_merge(spark.range(3).toDF("other"), "narrow", folder, ["other"])
    s.drop_table(spark, "narrow")
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("narrow")]


def test_checks_that_cannot_run_and_steps_that_fail_say_why(spark):
    steps = [Step("a", "table", (), lambda _: spark.range(2)), Step("b", "table", (), lambda _: spark.sql("SELECT nothing"))]
    found = {r["node"]: r for r in gated_build(spark, steps, [NotNull("a", "gone"), NotNull("a", "id")]).collect()}
    assert found["a: not_null gone"]["status"] == "error" and "gone" in found["a: not_null gone"]["message"]
    assert found["a: not_null id"]["status"] == "pass" and "nothing" in found["b"]["message"]


def files_of(spark, table):
    """Data files of a table, by path."""
    return set(spark.table(s.version_of(spark, table)).inputFiles())


def test_a_merge_by_key_writes_the_parts_it_touches(spark):
    folder, table = fresh_path(spark, "parts"), name()
    first = spark.range(2000).selectExpr("id as k", "cast(id as string) as v", "id % 3 as `odd name`")
    s.incremental_merge(first, table, folder, ["k"])
    before = files_of(spark, table)
    assert spark.table(table).columns == first.columns and len({f.rsplit("/", 2)[1] for f in before}) == 16
    found = s.incremental_merge(spark.createDataFrame([(7, "new", 1)], "k int, v string, `odd name` bigint"), table, folder, ["k"])
    after = files_of(spark, table)
    assert len({f.rsplit("/", 2)[1] for f in before - after}) == 1 and len({f.rsplit("/", 2)[1] for f in after - before}) == 1
    assert found.count() == 2000 and found.filter("v = 'new'").select("k").collect() == [(7,)]
    # Rows that are added, a load without rows, an append, and a merge by another key, which brings the table into other parts.
    s.incremental_merge(spark.createDataFrame([(5000, "x", 1), (None, "y", 2)], "k bigint, v string, `odd name` bigint"), table, folder, ["k"])
    s.incremental_merge(first.limit(0), table, folder, ["k"])
    s.incremental_append(spark.createDataFrame([(6000, "z", 1)], first.schema), table, folder)
    assert s.incremental_merge(spark.createDataFrame([(6000, "zz", 1)], first.schema), table, folder, ["k"]).filter("k = 6000").count() == 1
    found = s.incremental_merge(spark.createDataFrame([(1, "zz", 0)], first.schema), table, folder, ["v"])
    assert sorted(r["k"] for r in found.filter("k >= 5000 OR v = 'zz'").collect()) == [1, 5000] and found.count() == 2003
    s.drop_table(spark, table)


def test_history_table_writes_changes_only(spark):
    folder, table, days = fresh_path(spark, "history"), name(), [datetime(2024, 1, d) for d in (1, 2, 3, 4, 5)]
    sources = [[(1, "a"), (2, "b"), (None, "n")], [(1, "A"), (2, "b"), (None, "n")], [(1, "A"), (2, "B"), (3, "c")], [(1, "A"), (2, "B"), (3, "c")]]
    plain, closed = None, []
    for day, rows_ in zip(days, sources):
        source = spark.createDataFrame(rows_, "k int, v string")
        found = s.snapshot_table(source, table, folder, ["k"], check_cols="all", as_of=day)
        plain = s.snapshot(plain, source, ["k"], check_cols="all", as_of=day)
        assert history_rows(found) == history_rows(plain) and found.columns == plain.columns
        files = {f for f in files_of(spark, table) if "=open" not in f}
        assert set(closed) <= files  # what was closed before is neither written nor moved
        closed = files
    assert len({f.rsplit("/", 2)[1] for f in closed}) == 2  # two runs closed a version each
    # A gained column is null in all versions of before; a lost one is refused.
    wider = spark.createDataFrame([(1, "A", 9)], "k int, v string, w int")
    found = s.snapshot_table(wider, table, folder, ["k"], check_cols=["v", "w"], as_of=days[4])
    assert sorted(((r["k"], r["w"]) for r in found.filter("k = 1").collect()), key=str) == [(1, 9), (1, None), (1, None)]
    with pytest.raises(ValueError, match="lost"):
        s.snapshot_table(wider.drop("v"), table, folder, ["k"], check_cols=["w"], as_of=days[4])
    s.drop_table(spark, table)


@pytest.mark.parametrize("partition_by", [[], ["p"]])
def test_readers_always_find_a_whole_table(spark, partition_by):
    folder, table = fresh_path(spark, "polled"), name()
    build = lambda n: s.as_table(spark.range(30).selectExpr(f"{n} as n", "id % 2 as p"), table, folder, partition_by)
    build(0)
    seen, stop = [], threading.Event()

    def poll():
        while not stop.is_set():
            try:
                seen.append(tuple(spark.sql(f"SELECT count(*), count(DISTINCT n) FROM {table}").first()))
            except Exception as error:
                seen.append(str(error))

    reader = threading.Thread(target=poll)
    reader.start()
    for n in range(1, 21):
        build(n)
    stop.set()
    reader.join()
    assert len(seen) > 5 and set(seen) == {(30, 1)} and spark.table(table).first()["n"] == 20
    # The version before stays in the catalog for readers, none other.
    assert len([t for t in spark.catalog.listTables() if t.name.startswith(f"{table}__")]) == 2
    s.drop_table(spark, table)


def test_a_plain_table_becomes_a_versioned_one(spark):
    table, path = name(), fresh_path(spark, "plain")
    spark.range(3).write.parquet(path)
    spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{path}'")
    assert s.incremental_merge(spark.range(2, 5), table, fresh_path(spark, "plain"), ["id"]).count() == 5
    assert s.relations_by_prefix(spark, "%", table)[0].type == "external" and len(s.relations_by_prefix(spark, "%", table)) == 1
    s.drop_table(spark, table)


def test_release_deletes_what_was_written(spark):
    kept, gone = written(spark.range(3), "kept"), written(spark.range(4), "gone")
    path = gone.inputFiles()[0].removeprefix("file:")
    release(gone, spark.range(1))
    assert not os.path.exists(os.path.dirname(path)) and kept.count() == 3
