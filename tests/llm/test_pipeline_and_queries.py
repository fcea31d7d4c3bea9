"""Stages of the pipeline against what each must keep, and every query of the package against its SQL."""

from __future__ import annotations

import re

import pytest
from compare import difference, from_duckdb, from_spark
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from martworks.llm import language_id, queries
from martworks.llm.common import read

SF = "/root/testdata/sf0.001"
NATIVE = ("op2_", "op4_", "op6_", "op9_")


@pytest.mark.parametrize("name", queries.QUERIES)
def test_queries(spark, name):
    df = entry.queries()[name](spark, SF)
    ours = from_spark(df)
    if name in queries.ORACLE:
        assert difference(ours, from_duckdb(SF, queries.ORACLE[name])) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", *(["EvalPython", "InPandas", "InArrow"] if name.startswith(NATIVE) else [])):
        assert node not in plan
    table = "pages" if name.startswith(("op6", "op10")) else "documents"
    if not name.startswith(("op2", "op8", "op11", "op12")):
        assert len(ours[1]) == read(spark, SF, table).count()


def test_stages_keep_and_drop_what_they_should(spark, tmp_path):
    docs = read(spark, SF, "documents")
    kept = [docs]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(number))
        stage(spark, kept[-1], SF).write.parquet(path)
        kept.append(spark.read.parquet(path))
        assert kept[-1].columns[:5] == docs.columns
    rows = [{r["doc_id"]: r for r in df.collect()} for df in kept]
    gone = [set(a) - set(b) for a, b in zip(rows, rows[1:])]
    assert all(set(b) <= set(a) for a, b in zip(rows, rows[1:]))
    # 1: only texts without letters, or hard to tell
    assert not any(len(re.findall(r"[^\W\d_]", rows[0][k]["text"])) > 40 for k in gone[0])
    # 2: the smallest id of each group stays
    groups = {r["doc_id"]: r["component_id"] for r in queries.QUERIES["op5_set_join"](spark, SF).collect() if r["doc_id"] in rows[1]}
    assert gone[1] == {k for k, g in groups.items() if k != g}
    # 3: documents with a whole item go, others without any long run of one stay
    items = [r["text"] for r in read(spark, SF, "benchmark").collect()]
    assert gone[2] == {k for k, r in rows[2].items() if any(i in r["text"] for i in items)}
    # 4: words by source come near their targets, nothing more often than three times
    mixed = kept[4].groupBy("doc_id").count()
    assert mixed.agg(F.max("count")).first()[0] <= 3
    # 5: nothing is lost
    assert kept[5].count() == kept[4].count() and set(rows[5]) == set(rows[4])


def test_odd_documents_pass_all_stages(spark, tmp_path):
    rows = [(1, "the cat and the dog", "en", "a", 3), (1, "the cat and the dog", "en", "a", 3), (None, "le chat", None, None, None),
            (None, None, None, None, None), (2, "", "en", "a", 0), (3, "word " * 5000, "en", None, 1), (4, "1 2 3", "fr", "b", 9)]
    known = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(*r, i, "own") for i, r in enumerate(rows)], f"{known}, size int, lang_pred string")
    for table in (docs, docs.limit(0), spark.createDataFrame([], known)):
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            found = stage(spark, table, SF)
            path = str(tmp_path / f"{number}-{len(docs.columns)}-{id(table)}")
            found.write.parquet(path)
            table = spark.read.parquet(path)
    first = corpus_pipeline.STAGES[0][1](spark, docs, SF)
    assert first.columns == docs.columns
    assert {r["lang_pred"] for r in first.collect()} == {"own"} and first.filter("doc_id = 4 or doc_id = 2").count() == 0
    second = corpus_pipeline.STAGES[1][1](spark, docs, SF)
    assert second.filter("doc_id = 1").count() == 1 and second.filter("doc_id IS NULL").count() == 2 and second.count() == 6


def test_texts_under_one_id(spark):
    """Rows are judged by their own text: another text under an id that goes stays, whatever the order of rows."""
    text = lambda seed, n=60: " ".join(f"w{seed}x{i}" for i in range(n))
    near = text("b").replace("wbx59", "other")
    rows = [(1, text("a")), (5, text("a")), (5, text("b")), (7, near), (9, text("c")), (9, text("d")), (9, text("c")),
            (11, text("e")), (11, text("e").replace("wex59", "q")), (12, text("e")), (13, None), (13, ""), (14, "\n"), (14, " ")]
    known = "doc_id long, text string"
    kept = []
    for ordered in (rows, rows[::-1]):
        docs = spark.createDataFrame(ordered, known).withColumns({c: F.lit(None).cast("string") for c in ("lang", "source")}).withColumn("n_chars", F.lit(1))
        kept.append(sorted((r["doc_id"], r["text"] or "") for r in corpus_pipeline.STAGES[1][1](spark, docs, SF).collect()))
    assert kept[0] == kept[1]
    eleven = [t for i, t in kept[0] if i == 11]
    assert len(eleven) == 1 and sorted(x for x in kept[0] if x[0] != 11) == sorted(
        [(1, text("a")), (5, text("b")), (9, text("c")), (9, text("d")), (13, ""), (14, "\n"), (14, " ")])


def test_held_out_share(spark):
    ids = spark.range(3000)
    assert 900 < ids.filter(language_id.held_out(F.col("id"))).count() < 1100
