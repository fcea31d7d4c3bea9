"""Queries of the operators that score texts in Arrow batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martworks.llm import decontamination, html_text, language_id, lm_scoring, quality, set_join
from martworks.llm.common import WORD, read

# The domain that documents are compared with: three of the sources.
TARGET_SOURCES = ("src1", "src2", "src3")


def cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents", "doc_id", "text", "source")
    scored = lm_scoring.score_corpus(documents, "text", F.col("source").isin(*TARGET_SOURCES))
    return scored.select("doc_id", "n_tokens", F.round("ce_difference", 6).alias("ce_difference"))


DIFFERENCE_SQL = f"""
WITH split AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source IN {TARGET_SOURCES}, false) AS hit, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
used AS (SELECT r, hit, len(w) AS m, w[i] AS b, CASE WHEN i > 1 THEN w[i - 1] ELSE ' ' END AS a FROM split, unnest(range(1, len(w) + 1)) AS x(i)),
pairs AS (SELECT a, b, count(*) FILTER (hit) AS nt, count(*) FILTER (NOT hit) AS nb FROM used GROUP BY a, b),
contexts AS (SELECT a, count(*) FILTER (hit) AS ct, count(*) FILTER (NOT hit) AS cb FROM used GROUP BY a),
singles AS (SELECT b, count(*) FILTER (hit) AS st, count(*) FILTER (NOT hit) AS sb FROM used GROUP BY b),
sizes AS (SELECT sum(st)::DOUBLE AS wt, sum(sb)::DOUBLE AS wb, count(*) + 1 AS v FROM singles),
scales AS (SELECT *, CASE WHEN wt > 0 THEN least(wt, wb) / wt ELSE 0 END AS rt, CASE WHEN wb > 0 THEN least(wt, wb) / wb ELSE 0 END AS rb FROM sizes),
own AS (SELECT r, hit, m, a, b, count(*) AS times, sum(count(*)) OVER (PARTITION BY r, a) AS times_a, sum(count(*)) OVER (PARTITION BY r, b) AS times_b
        FROM used GROUP BY r, hit, m, a, b),
rest AS (SELECT r, m, times, v, rt, rb, nt - CASE WHEN hit THEN times ELSE 0 END AS nt, nb - CASE WHEN hit THEN 0 ELSE times END AS nb,
                ct - CASE WHEN hit THEN times_a ELSE 0 END AS ct, cb - CASE WHEN hit THEN 0 ELSE times_a END AS cb,
                st - CASE WHEN hit THEN times_b ELSE 0 END AS st, sb - CASE WHEN hit THEN 0 ELSE times_b END AS sb,
                wt - CASE WHEN hit THEN m ELSE 0 END AS wt, wb - CASE WHEN hit THEN 0 ELSE m END AS wb
         FROM own JOIN pairs USING (a, b) JOIN contexts USING (a) JOIN singles USING (b), scales),
scored AS (SELECT r, sum(times * (
               log2((rb * nb + {lm_scoring.PRIOR}::DOUBLE * (rb * sb + 1) / (rb * wb + v)) / (rb * cb + {lm_scoring.PRIOR}::DOUBLE))
               - log2((rt * nt + {lm_scoring.PRIOR}::DOUBLE * (rt * st + 1) / (rt * wt + v)) / (rt * ct + {lm_scoring.PRIOR}::DOUBLE)))) / max(m) AS difference
           FROM rest GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_tokens, round(difference, 6) AS ce_difference FROM split LEFT JOIN scored USING (r)
"""


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents", "doc_id", "text")
    model = quality.fitted(documents, read(spark, sf_dir, "labels"))
    return quality.assess(documents, "text", model).drop("text")


def similar_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_join.similar(read(spark, sf_dir, "documents", "doc_id", "text"))


SIMILAR_SQL = f"""
WITH RECURSIVE split AS (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
runs AS (SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle FROM split, unnest(range(1, greatest(len(w) - 3, 2))) AS r(i)
         WHERE len(w) > 0),
shingles AS (SELECT DISTINCT doc_id, shingle FROM runs),
sizes AS (SELECT d.doc_id, count(s.shingle) AS n FROM documents d LEFT JOIN shingles s USING (doc_id) GROUP BY d.doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingles x JOIN shingles y USING (shingle)
           WHERE x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
          WHERE 100 * shared.n >= 75 * (p.n + q.n - shared.n)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT doc_id, n AS n_shingles, least(doc_id, (SELECT min(b) FROM reach WHERE a = doc_id)) AS component_id,
       (SELECT count(*) FROM links WHERE a = doc_id) AS n_links
FROM sizes
"""


def predicted_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    trees = language_id.fit(documents)
    found = language_id.predict(documents.select("doc_id", "text"), "text", trees)
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def contaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents", "doc_id", "text")
    items = decontamination.split_items(read(spark, sf_dir, "benchmark", "item_id", "text"))
    found = decontamination.search(documents, "text", items).select("doc_id", F.inline("leaks"))
    return found.groupBy("doc_id", "item_id").agg(
        *(F.max(name).alias(name) for name in ("score", "question_overlap", "answer_overlap")))


def visible_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages", "page_id", "html"), "html").drop("html")


QUERIES = {
    "op1_lm_scoring": cross_entropy_difference,
    "op3_quality_rules": quality_rules,
    "op5_set_join": similar_documents,
    "op7_language_id": predicted_language,
    "op8_decontamination": contaminated,
    "op10_html_text": visible_text,
}
ORACLE = {"op1_lm_scoring": DIFFERENCE_SQL, "op5_set_join": SIMILAR_SQL}
