"""Queries of the operators that need no Python on executors: preference segments, mixing, URL filter, sharding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martworks.llm import mixing, preferences, sharding, url_filter
from martworks.llm.common import WORD, read

SHARD_BYTES = 16 << 20
# A page counts as junk from so many runs of symbols on; its host is listed.
JUNK_RUN, JUNK_RUNS = r"[#%*$]{3}", 3


def chat_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return preferences.segments(preferences.swapped_answers(turns)).withColumnRenamed("pair", "conv_id")


CHAT_SQL = """
WITH turns AS (SELECT conv_id, turn, role, text FROM conversations),
last AS (SELECT conv_id, max(turn) AS turn FROM turns WHERE role = 'assistant' GROUP BY conv_id),
answers AS (SELECT t.conv_id, t.turn, max(t.text) AS text FROM turns t JOIN last l
            ON t.conv_id = l.conv_id AND t.turn = l.turn WHERE t.role = 'assistant' GROUP BY ALL),
marked AS (SELECT t.*, a.conv_id IS NOT NULL AS is_last, coalesce(n.text, '') AS other
           FROM turns t LEFT JOIN answers a ON t.conv_id = a.conv_id AND t.turn = a.turn AND t.text = a.text AND t.role = 'assistant'
           LEFT JOIN answers n ON n.conv_id = t.conv_id + 1),
chosen AS (SELECT conv_id, turn, role, text, count(*) AS copies FROM marked GROUP BY ALL),
rejected AS (SELECT conv_id, turn, role, CASE WHEN is_last THEN other ELSE text END AS text, count(*) AS copies
             FROM marked GROUP BY ALL),
difference AS (SELECT conv_id, min(turn) AS first_turn FROM (
    (SELECT * FROM chosen EXCEPT SELECT * FROM rejected) UNION ALL (SELECT * FROM rejected EXCEPT SELECT * FROM chosen))
    GROUP BY conv_id),
parts AS (
    SELECT c.*, CASE WHEN d.first_turn IS NULL OR c.turn < d.first_turn THEN 'prompt' ELSE 'chosen' END AS part
    FROM chosen c LEFT JOIN difference d USING (conv_id)
    UNION ALL
    SELECT r.*, 'rejected' AS part FROM rejected r JOIN difference d USING (conv_id) WHERE r.turn >= d.first_turn)
SELECT conv_id, part, turn, role,
       '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS segment,
       CASE WHEN part <> 'prompt' AND role = 'assistant' THEN CAST(length(role) + 13 AS BIGINT) ELSE 0 END AS mask_start,
       CASE WHEN part <> 'prompt' AND role = 'assistant' THEN CAST(length(text) + 10 AS BIGINT) ELSE 0 END AS mask_length,
       copies
FROM parts
"""


def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents", "doc_id", "text", "source")
    narrow = documents.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    return mixing.mix(*mixing.weighted_by_quality(narrow, read(spark, sf_dir, "labels"))).select(
        "doc_id", "size", "source_size", "target", "taken")


MIX_SQL = f"""
WITH RECURSIVE docs AS (
    SELECT d.doc_id, d.source, coalesce(len(regexp_extract_all(d.text, '{WORD}')), 0)::BIGINT AS size,
           CASE l.quality WHEN 1 THEN 2.0::DOUBLE WHEN 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS weight
    FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) l USING (doc_id)),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight
    FROM docs GROUP BY source),
rounds AS (
    SELECT 0 AS n, source, source_size, weight, 0.0::DOUBLE AS target, false AS cut FROM sources
    UNION ALL
    SELECT n + 1, source, source_size, weight, least(share, 3.0 * source_size) AS target, cut OR share >= 3.0 * source_size
    FROM (SELECT *, CASE WHEN cut THEN target ELSE weight * (
              sum(source_size) OVER () - sum(CASE WHEN cut THEN 3.0 * source_size ELSE 0 END) OVER ())::DOUBLE
              / sum(CASE WHEN cut THEN 0 ELSE weight END) OVER () END AS share FROM rounds)
    WHERE n < (SELECT count(*) FROM sources)),
targets AS (SELECT source, source_size, target,
                   CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs
            FROM rounds WHERE n = (SELECT count(*) FROM sources)),
keyed AS (
    SELECT d.*, t.source_size, t.target, t.epochs,
           -ln(((('0x' || left(md5(d.doc_id::VARCHAR), 15))::BIGINT >> 8) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE) / d.weight AS k
    FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
ran AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY k, size ROWS UNBOUNDED PRECEDING) AS upto FROM keyed)
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN upto - size / 2.0 <= target - epochs * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ran
"""


def junk_hosts(pages: DataFrame) -> DataFrame:
    host, _ = url_filter.host_and_path(F.col("url"))
    return pages.filter(F.regexp_count("html", F.lit(JUNK_RUN)) >= JUNK_RUNS).select(host.alias("key"))


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages", "page_id", "url", "html")
    return url_filter.judge(pages.select("page_id", "url"), "url", junk_hosts(pages)).select(
        "page_id", "host", "path", "rule", "verdict")


URL_SQL = f"""
WITH parts AS (SELECT *, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
rules(rule_host, rule_path, says) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
    ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fitting AS (SELECT DISTINCT page_id, rule_host || rule_path AS rule, says FROM split JOIN rules
            ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
best AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(says, length(rule)) AS says FROM fitting GROUP BY page_id),
listed AS (SELECT DISTINCT host FROM split WHERE len(regexp_extract_all(html, '{JUNK_RUN}')) >= {JUNK_RUNS})
SELECT page_id, host, path, rule, coalesce(says, CASE WHEN host IN (SELECT host FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM split LEFT JOIN best USING (page_id)
"""


def hash_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents", "doc_id", "text")
    return sharding.shard(documents, "doc_id", "text", SHARD_BYTES).select("doc_id", "shard", "shard_part", "shard_bytes")


SHARD_SQL = f"""
WITH docs AS (SELECT doc_id, coalesce(strlen(text), 0) AS bytes, ('0x' || left(md5(doc_id::VARCHAR), 15))::BIGINT AS bits FROM documents),
depths AS (SELECT unnest(range(0, 25))::INTEGER AS depth),
totals AS (SELECT depth, bits >> (60 - depth) AS prefix, sum(bytes)::BIGINT AS total FROM docs, depths GROUP BY ALL),
leaves AS (SELECT doc_id, min(depth) AS depth, any_value(bits) AS bits FROM docs JOIN totals ON prefix = bits >> (60 - depth)
           WHERE total <= {SHARD_BYTES} GROUP BY doc_id)
SELECT doc_id, CASE WHEN l.depth = 0 THEN '' ELSE lpad(bin(prefix), l.depth, '0') END AS shard, 0::BIGINT AS shard_part, total AS shard_bytes
FROM leaves l JOIN totals t ON t.depth = l.depth AND t.prefix = l.bits >> (60 - l.depth)
"""

QUERIES = {
    "op2_chat_preferences": chat_preferences,
    "op4_mix_sources": mix_sources,
    "op6_url_filter": url_verdicts,
    "op9_hash_shards": hash_shards,
}
ORACLE = {
    "op2_chat_preferences": CHAT_SQL,
    "op4_mix_sources": MIX_SQL,
    "op6_url_filter": URL_SQL,
    "op9_hash_shards": SHARD_SQL,
}
