"""Preference segments, mixing, URL filter and shards on small tables with nulls, ties, repeats and clashing names."""

from __future__ import annotations

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from martworks.llm import mixing, preferences, sharding, url_filter

TURNS = "pair long, turn long, role string, text string, in_chosen boolean, in_rejected boolean"


def segments(spark, rows):
    found = preferences.segments(spark.createDataFrame(rows, TURNS)).collect()
    return sorted((r["pair"] is not None, r["pair"] or 0, r["part"], r["turn"] if r["turn"] is not None else -1, r["role"], r["segment"],
                   r["mask_start"], r["mask_length"], r["copies"]) for r in found)


def test_prefix_is_rendered_once_and_answers_are_masked(spark):
    both = [(1, 0, "user", "hi", True, True), (1, 1, "assistant", "a", True, False), (1, 1, "assistant", "bcd", False, True),
            (1, 2, "user", "end", True, True)]
    open_user = "<|im_start|>user\n"
    assert segments(spark, both) == [
        (True, 1, "chosen", 1, "assistant", "<|im_start|>assistant\na<|im_end|>\n", 22, 11, 1),
        (True, 1, "chosen", 2, "user", f"{open_user}end<|im_end|>\n", 0, 0, 1),
        (True, 1, "prompt", 0, "user", f"{open_user}hi<|im_end|>\n", 0, 0, 1),
        (True, 1, "rejected", 1, "assistant", "<|im_start|>assistant\nbcd<|im_end|>\n", 22, 13, 1),
        (True, 1, "rejected", 2, "user", f"{open_user}end<|im_end|>\n", 0, 0, 1),
    ]


def test_equal_sides_missing_sides_nulls_and_repeats(spark):
    rows = [(1, None, None, None, True, True), (1, 0, "assistant", "x", True, True), (1, 0, "assistant", "x", True, True),
            (2, 0, "assistant", "only", True, False), (None, 0, "user", "", True, True), (3, 0, "user", "r", True, True),
            (3, 0, "user", "r", True, False)]
    found = segments(spark, rows)
    assert [(x[1], x[2], x[3], x[8]) for x in found] == [
        (0, "prompt", 0, 1), (1, "prompt", -1, 1), (1, "prompt", 0, 2), (2, "chosen", 0, 1), (3, "chosen", 0, 2), (3, "rejected", 0, 1)]
    assert segments(spark, []) == []


def test_swapped_answers(spark):
    turns = spark.createDataFrame(
        [(1, 0, "user", "q"), (1, 1, "assistant", "a1"), (2, 0, "assistant", "b0"), (2, 1, "assistant", "b1"), (4, 0, "user", None)],
        "conv_id long, turn long, role string, text string")
    found = {tuple(r) for r in preferences.swapped_answers(turns).collect()}
    assert found == {
        (1, 0, "user", "q", True, True), (1, 1, "assistant", "a1", True, False), (1, 1, "assistant", "b1", False, True),
        (2, 0, "assistant", "b0", True, True), (2, 1, "assistant", "b1", True, False), (2, 1, "assistant", "", False, True),
        (4, 0, "user", None, True, True)}


# -- mixing


def filled(weights, sizes):
    """Targets by repeated sharing."""
    total, target, cut = sum(sizes), [0.0] * len(sizes), set()
    while True:
        left = total - sum(3 * sizes[i] for i in cut)
        rest = [i for i in range(len(sizes)) if i not in cut]
        for i in rest:
            target[i] = left * weights[i] / sum(weights[j] for j in rest)
        above = {i for i in rest if target[i] > 3 * sizes[i]}
        if not above:
            return target
        cut |= above
        for i in above:
            target[i] = 3.0 * sizes[i]


def test_targets(spark):
    rng = random.Random(5)
    for _ in range(6):
        names = [*sorted(rng.sample(["a", "B", "é", "z", "s1", "s10", "s2"], rng.randint(1, 6)), key=lambda s: s.encode()), None]
        sizes = [rng.choice([0, 1, 7, 100, 5000]) for _ in names]
        found = mixing.targets(spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")).collect()
        expected = filled([(5, 2, 1)[i % 3] for i in range(len(names))], sizes)
        by_name = {r["source"]: r["target"] for r in found}
        assert [by_name[n] for n in names] == pytest.approx(expected)


def u(key):
    return ((int(hashlib.md5(str(key).encode()).hexdigest()[:15], 16) >> 8) + 0.5) / 2**52


def test_mix_follows_the_key_order(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["a", "b", None]), rng.randint(0, 30), rng.choice([0.5, 1.0, 2.0, None])) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long, w double")
    found = {r["doc_id"]: r for r in mixing.mix(docs, "doc_id", "size", "source", F.col("w")).collect()}
    assert len(found) == 600
    for source in ("a", "b", None):
        own = [r for r in rows if r[1] == source]
        own.sort(key=lambda r: -math.log(u(r[0])) / (r[3] or 1e-6))
        total, target = sum(r[2] for r in own), found[own[0][0]]["target"]
        epochs, before = int(target // total), 0
        for doc_id, _, size, _ in own:
            fits = before + size / 2 <= target - epochs * total
            before += size
            assert found[doc_id]["taken"] == size * (epochs + fits)
        assert abs(sum(found[r[0]]["taken"] for r in own) - target) <= 15.5


def test_mix_repeated_rows_clashing_names_and_empty_tables(spark):
    rows = [(1, "a", 4, "x"), (1, "a", 4, "x"), (None, "a", 2, "y"), (2, None, None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long, _mix_size string").withColumn("taken", F.lit("t"))
    found = mixing.mix(docs, "doc_id", "size", "source")
    assert set(found.columns) == {"doc_id", "source", "_mix_size", "size", "source_size", "target", "taken"}
    taken = [(r["doc_id"], r["_mix_size"], r["taken"]) for r in found.collect()]
    assert len(taken) == 4 and sum(t for *_, t in taken) == 10 and (2, "z", 0) in taken
    assert mixing.mix(docs.limit(0), "doc_id", "size", "source").count() == 0


def test_word_count(spark):
    texts = spark.createDataFrame([(None,), ("",), (" a\tb\x0bc ",), ("\u00a0",)], "t string")
    assert [r[0] for r in texts.select(mixing.word_count(F.col("t"))).collect()] == [0, 0, 3, 1]


# -- URLs


def test_hosts_paths_and_rules(spark):
    urls = ["http://A.example.ORG/es/x?q#f", "https://example.org/en/12", "x://org", "http://a.com/fr/1", "http://a.com/DE/1", "noscheme/de/",
            None, "", "://e.com/de/?x", "http://xcom/de/", "http://h.net#a/b", "ftp://com/de/://x"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    listed = spark.createDataFrame([("a.com",), ("h.net",), ("h.net",), (None,), ("other",), ("",)], "key string")
    found = [tuple(r)[2:] for r in url_filter.judge(pages, "url", listed).orderBy("page_id").collect()]
    assert found == [
        ("a.example.org", "/es/x", "example.org/es/", "block"), ("example.org", "/en/12", "example.org/en/1", "block"),
        ("org", "", None, "allow"), ("a.com", "/fr/1", "com/fr/", "allow"), ("a.com", "/DE/1", None, "block"), ("", "", None, "block"),
        ("", "", None, "block"), ("", "", None, "block"), ("e.com", "/de/", "com/de/", "block"), ("xcom", "/de/", None, "allow"),
        ("h.net", "", None, "block"), ("com", "/de/://x", "com/de/", "block")]


@pytest.mark.parametrize("n_listed", [0, 1, 40, 900])
def test_cascade_is_exact_over_its_universe(spark, n_listed):
    universe = spark.range(1000).select(F.concat(F.lit("host"), "id").alias("key"))
    listed = universe.filter(F.expr(f"xxhash64(key, 7) % 1000 + 1000 < {n_listed} + 1000 AND xxhash64(key, 7) >= 0"))
    listed = listed.unionByName(listed)
    cascade = url_filter.Cascade.build(universe, listed)
    expected = {r["key"] for r in listed.collect()}
    found = {r["key"] for r in universe.filter(cascade.holds(F.col("key"))).collect()}
    assert found == expected


def test_long_lists_make_several_cascades(spark, monkeypatch):
    hosts = [f"h{i}.net" for i in range(60)]
    pages = spark.createDataFrame(
        [(i, f"http://{h}/") for i, h in enumerate(hosts)] + [(90, None), (91, "http://h1.net/"), (91, "http://h1.net/")],
        "page_id long, url string").withColumn("_url_key", F.lit(1))
    listed = spark.createDataFrame([(h,) for h in (*hosts[::3], "other.net", None)], "key string")
    few = url_filter.judge(pages, "url", listed).orderBy("page_id").collect()
    monkeypatch.setattr(url_filter, "MAX_FILTER_KEYS", 6)
    found = url_filter.judge(pages, "url", listed)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and found.orderBy("page_id").collect() == few
    assert [r["page_id"] for r in few if r["verdict"] == "block"] == list(range(0, 60, 3))
    assert url_filter.judge(pages.limit(0), "url", listed).count() == 0


# -- shards


def bits(key):
    return f"{int(hashlib.md5(('' if key is None else str(key)).encode()).hexdigest()[:15], 16):060b}"


def python_shards(sizes, limit):
    """prefix by key, splitting only what is too large."""
    found = {}

    def split(prefix, keys):
        if sum(sizes[k] for k in keys) <= limit or len(prefix) == 60:
            found.update(dict.fromkeys(keys, prefix))
        else:
            for bit in "01":
                split(prefix + bit, [k for k in keys if bits(k).startswith(prefix + bit)])

    split("", list(sizes))
    return found


@pytest.mark.parametrize("limit", [20_000, 400, 60])
def test_only_large_shards_split(spark, limit):
    rng = random.Random(limit)
    texts = {i: "é" * rng.randint(0, 15) for i in range(800)}
    docs = spark.createDataFrame([(k, t, "x") for k, t in texts.items()], "doc_id long, text string, _shard_size string")
    rows = sharding.shard(docs, "doc_id", "text", limit).collect()
    expected = python_shards({k: 2 * len(t) for k, t in texts.items()}, limit)
    assert {r["doc_id"]: r["shard"] for r in rows} == expected
    totals = {}
    for k, shard in expected.items():
        totals[shard] = totals.get(shard, 0) + 2 * len(texts[k])
    assert all(r["shard_bytes"] == totals[r["shard"]] <= limit and r["shard_part"] == 0 and r["_shard_size"] == "x" for r in rows)


def test_deep_directories(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROUND_BITS", 3)
    texts = {i: "abc" for i in range(300)}
    rows = sharding.shard(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), "doc_id", "text", 9).collect()
    assert {r["doc_id"]: r["shard"] for r in rows} == python_shards(dict.fromkeys(texts, 3), 9)


def test_equal_keys_and_long_texts_are_cut_into_parts(spark):
    rows = [(None, "x" * n) for n in [3] * 40 + [7] * 5 + [60]] + [(5, "y"), (5, None), (6, "z" * 11)]
    found = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", 10).collect()
    assert len(found) == len(rows)
    totals = {}
    for r in found:
        key = (r["shard"], r["shard_part"])
        totals[key] = totals.get(key, 0) + len(r["text"] or "")
    for r in found:
        assert r["shard_bytes"] == totals[r["shard"], r["shard_part"]]
        assert r["shard_bytes"] <= 10 or len(r["text"]) > 10 and r["shard_bytes"] == len(r["text"])
    assert sharding.shard(spark.createDataFrame([], "doc_id long, text string"), "doc_id", "text", 10).count() == 0
