"""The corpus pipeline: documents through five of the operators, each stage written and read again by the next.

Language identification drops what has no language; of each group of near duplicates one document stays; documents that repeat
benchmark items go; sources are mixed, with repeats; the mix is cut into shards. Rows keep the columns of `documents`; the
last stage adds the shard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martworks.llm import decontamination, language_id, mixing, set_join, sharding
from martworks.llm.common import fresh, read
from martworks.llm.native_queries import SHARD_BYTES
from martworks.session import configure, release, written

# Below this share the best of the languages is hardly better than chance.
LEAST_LANGUAGE_SCORE = 0.3
ORACLE_SQL = None
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a known language. Those without a letter (or text) go, and those whose best language scores below
    `LEAST_LANGUAGE_SCORE`."""
    trees = language_id.fit(docs.select("doc_id", "text", "lang"))
    found = language_id.predict(docs, "text", trees)
    known = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    return found.filter(known).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of similar texts: the smallest id, of several texts with that id the one with the least MD5, and once if its
    row is repeated. A row is told by its id and text, so another text under an id that goes stays. Documents without words are similar to
    none; rows without id stay, as nothing tells them apart."""
    marked = docs.withColumn("_digest", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    rows = docs.count()
    found = written(set_join.groups(marked.select("doc_id", "text", "_digest"), ["_digest"]), "pipeline-groups", at_most=rows)
    per_text = found.filter("doc_id IS NOT NULL").groupBy("doc_id", "_digest").agg(
        F.count(F.lit(1)).alias("n"), F.min("component_id").alias("component_id"), F.first("group").alias("group"))
    texts = written(per_text.filter("n > 1 OR component_id < doc_id OR group IS NOT NULL"), "pipeline-texts", at_most=rows)
    # Several texts of the smallest id of a group: the least digest stays.
    ties = written(texts.filter("component_id = doc_id").groupBy(F.col("group").alias("tied")).agg(
        F.min("_digest").alias("least"), F.count(F.lit(1)).alias("texts")).filter("texts > 1"), "pipeline-ties", at_most=rows)
    goes = (F.col("component_id") < F.col("doc_id")) | F.coalesce(F.col("_digest") > F.col("least"), F.lit(False))
    judged = texts.join(ties, F.col("group") == F.col("tied"), "left").select(
        F.col("doc_id").alias("_id"), F.col("_digest").alias("_text"), "n", goes.alias("_goes"))
    others = written(judged.filter("_goes OR n > 1").drop("n"), "pipeline-others", at_most=rows)
    marks = F.broadcast(others) if others.count() <= set_join.MAX_BROADCAST_IDS else others
    joined = marked.join(marks, (F.col("doc_id") == F.col("_id")) & (F.col("_digest") == F.col("_text")), "left")
    single = joined.filter(F.col("_id").isNull()).select(docs.columns)
    repeated = joined.filter(F.col("_id").isNotNull() & ~F.col("_goes")).dropDuplicates(["doc_id", "_digest"]).select(docs.columns)
    return single.unionByName(repeated)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which no passage repeats a benchmark item."""
    items = decontamination.split_items(read(spark, sf_dir, "benchmark", "item_id", "text"))
    return decontamination.search(docs, "text", items).filter(F.size("leaks") == 0).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, a document as often as it was taken."""
    sized = docs.withColumn("size", mixing.word_count(F.col("text")))
    mixed = mixing.mix(*mixing.weighted_by_quality(sized, read(spark, sf_dir, "labels", "doc_id", "quality")))
    times = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(0).cast("int")
    taken = mixed.withColumn("_times", times).filter(F.col("_times") > 0)
    return taken.select(*docs.columns, F.explode(F.sequence(F.lit(1), "_times")).alias("_time")).drop("_time")


def cut_into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard; repeats of a document share one."""
    return sharding.shard(docs, "doc_id", "text", SHARD_BYTES)


def _stage(decide):
    """The stage with the session settings it relies on. Columns beyond those of `documents` are passed by it untouched."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        others = [c for c in docs.columns if c.lower() not in COLUMNS]
        if not others:
            return decide(configure(spark), docs, sf_dir)
        packed = fresh(docs, "_other_columns")
        known = docs.select(*(c for c in docs.columns if c not in others), F.struct(*(F.col(f"`{c}`") for c in others)).alias(packed))
        found = decide(configure(spark), known, sf_dir)
        new = {c.lower() for c in found.columns}
        return found.select(
            *(c for c in found.columns if c != packed), *(F.col(packed)[c].alias(c) for c in others if c.lower() not in new))

    run_stage.__doc__ = decide.__doc__
    return run_stage


STAGES = [
    ("language identification", _stage(identify_language)),
    ("n-gram Jaccard join", _stage(drop_near_duplicates)),
    ("benchmark decontamination", _stage(drop_contaminated)),
    ("mixing sources to target weights", _stage(mix_sources)),
    ("sharding", _stage(cut_into_shards)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        previous, docs = docs, written(stage(spark, docs, sf_dir), f"pipeline-stage-{number}")
        release(previous)
    return docs
