"""Queries of the filter audit, the conversation repair and the removal of repeated passages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martworks.llm import conversation_repair, filter_audit, repeated_windows
from martworks.llm.common import WORD, read


def filter_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.documents_audit(
        read(spark, sf_dir, "documents", "doc_id", "text", "source"), read(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


AUDIT_SQL = f"""
WITH letters(l) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM letters a, letters b, letters c, letters d, letters e
           WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (SELECT filter_order, step::INTEGER AS step, substr(filter_order, step, 1) AS letter, left(filter_order, step - 1) AS earlier
          FROM orders, unnest(range(1, 6)) AS s(step)),
texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                 regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
firsts AS (SELECT t, min(doc_id) AS first_id FROM texts GROUP BY t),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
cells AS (
    SELECT part, CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
                 || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t) THEN 'C' ELSE '' END
                 || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN doc_id > first_id THEN 'E' ELSE '' END AS fails,
           coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
    FROM texts JOIN firsts USING (t) LEFT JOIN marks USING (doc_id) GROUP BY ALL),
seen AS (SELECT c.*, s.*, contains(fails, letter) AS failing, translate(fails, earlier, '') <> fails AS gone FROM cells c, steps s),
summed AS (
    SELECT part, filter_order, step, letter,
           sum(CASE WHEN NOT gone AND NOT failing THEN n ELSE 0 END)::BIGINT AS kept,
           sum(CASE WHEN NOT gone AND failing THEN n ELSE 0 END)::BIGINT AS removed,
           sum(CASE WHEN gone AND failing THEN n ELSE 0 END)::BIGINT AS redundant,
           sum(CASE WHEN fails = letter THEN n ELSE 0 END)::BIGINT AS unique_fails,
           sum(CASE WHEN NOT gone AND failing AND good THEN n ELSE 0 END)::BIGINT AS good_lost,
           sum(CASE WHEN NOT gone AND failing AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost
    FROM seen GROUP BY ALL)
SELECT * EXCLUDE (letter), sum(removed) OVER (PARTITION BY part, letter)::BIGINT AS shapley FROM summed
"""

def conversation_repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return conversation_repair.repair(conversation_repair.damaged(turns), turns.select("conv_id"))


# From left to right: the cheapest (cost, audit) that leads to each place of a conversation: nothing kept yet (n), after the system turn (s),
# after a user turn (u), after an assistant turn (a). BIG stands for impossible.
REPAIR_SQL = """
WITH crc AS (SELECT list_transform(range(256), lambda n: list_reduce(
                 range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS t),
filled AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                  list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT) AS key
           FROM conversations),
kinds AS (SELECT * EXCLUDE (key, t), xor(list_reduce(
              key, lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]), 4294967295::BIGINT), 4294967295) % 20 AS kind FROM filled, crc),
damaged AS (
    SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM kinds, unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS c(copy)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos FROM damaged),
faults AS (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                   WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
                   WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
           left(role, 1) AS i, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) AS pair
    FROM placed),
counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
           list(struct_pack(i := i, stay := fault NOT IN ('blank', 'duplicate'), late := (fault = 'truncated')::BIGINT) ORDER BY pos) AS items
    FROM faults GROUP BY conv_id),
folded AS (
    SELECT *, list_reduce(items, lambda z, x: struct_pack(
        n := {'c': z.n.c + 3, 'e': z.n.e || 'D'},
        s := list_sort([{'c': z.s.c + 3, 'e': z.s.e || 'D'}, {'c': CASE WHEN x.stay AND x.i = 's' THEN z.n.c + x.late ELSE 1000000000 END, 'e': z.n.e || 'K'}])[1],
        u := list_sort([{'c': z.u.c + 3, 'e': z.u.e || 'D'}, {'c': z.a.c + 5, 'e': z.a.e || 'ID'}] || list_transform(
            [z.n, z.s, z.a, {'c': z.u.c + 2, 'e': z.u.e || 'I'}],
            lambda y: {'c': CASE WHEN x.stay THEN y.c + x.late + CASE x.i WHEN 'u' THEN 0 ELSE 2 END ELSE 1000000000 END,
                       'e': y.e || CASE x.i WHEN 'u' THEN 'K' ELSE 'R' END}))[1],
        a := list_sort([{'c': z.a.c + 3, 'e': z.a.e || 'D'}] || list_transform(
            [z.u, {'c': z.n.c + 2, 'e': z.n.e || 'I'}, {'c': z.s.c + 2, 'e': z.s.e || 'I'}, {'c': z.a.c + 2, 'e': z.a.e || 'I'}],
            lambda y: {'c': CASE WHEN x.stay THEN y.c + x.late + CASE x.i WHEN 'a' THEN 0 ELSE 2 END ELSE 1000000000 END,
                       'e': y.e || CASE x.i WHEN 'a' THEN 'K' ELSE 'R' END}))[1]),
        struct_pack(n := {'c': 0::BIGINT, 'e': ''}, s := {'c': 1000000000::BIGINT, 'e': ''},
                    u := {'c': 1000000000::BIGINT, 'e': ''}, a := {'c': 1000000000::BIGINT, 'e': ''})) AS z
    FROM counted),
best AS (SELECT *, list_sort([z.n, z.a, {'c': z.u.c + 2, 'e': z.u.e || 'I'}, {'c': z.s.c + 4, 'e': z.s.e || 'II'}])[1] AS b FROM folded),
letters AS (SELECT conv_id, b.e AS e, unnest(string_split(b.e, '')) AS l, generate_subscripts(string_split(b.e, ''), 1) AS nr FROM best WHERE b.e <> ''),
edits AS (SELECT *, count(*) FILTER (l <> 'I') OVER (PARTITION BY conv_id ORDER BY nr) AS pos,
                 count(*) FILTER (l <> 'D') OVER (PARTITION BY conv_id ORDER BY nr) - length(replace(e, 'D', '')) % 2 AS nth FROM letters),
hashes AS (
    SELECT e.conv_id, sha256(string_agg(CASE l WHEN 'K' THEN f.role ELSE CASE nth % 2 WHEN 1 THEN 'user' ELSE 'assistant' END END || ':'
               || CASE l WHEN 'I' THEN '' ELSE f.text END, chr(10) ORDER BY nr)) AS hash
    FROM edits e LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM e.conv_id AND f.pos = e.pos WHERE l <> 'D' GROUP BY e.conv_id)
SELECT i.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b.c, 0)::BIGINT AS cost,
       coalesce(b.e, '') AS audit, coalesce(hash, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN hashes h ON h.conv_id IS NOT DISTINCT FROM i.conv_id
"""

def without_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_windows.remove_repeats(read(spark, sf_dir, "documents", "doc_id", "text"), "text")
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


REPEATS_SQL = f"""
WITH split AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
starts AS (SELECT r, i, sha256(array_to_string(w[i:i + 34], ' ')) AS run FROM split, unnest(range(1, len(w) - 33)) AS s(i)),
repeated AS (SELECT run FROM starts GROUP BY run HAVING count(*) > 1),
begun AS (SELECT r, list(i ORDER BY i) AS begins FROM starts JOIN repeated USING (run) GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(b, b + 35)) AS i FROM begun, unnest(begins) AS x(b)),
gone_of AS (SELECT r, count(*) AS n_removed, list(i) AS places FROM gone GROUP BY r),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS text FROM (
             SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM split) ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM split LEFT JOIN gone_of USING (r) LEFT JOIN kept USING (r)
"""

QUERIES = {
    "op11_filter_audit": filter_interaction,
    "op12_conversation_repair": conversation_repairs,
    "op13_substring_dedup": without_repeats,
}
ORACLE = {"op11_filter_audit": AUDIT_SQL, "op12_conversation_repair": REPAIR_SQL, "op13_substring_dedup": REPEATS_SQL}
