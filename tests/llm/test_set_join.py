"""The set join and its components against brute force."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from martworks.llm import set_join
from martworks.llm import components
from martworks.session import written
from martworks.llm.components import connected_components


def shingles(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4)) or frozenset([tuple(words)] if words else [])


def brute(rows):
    sets, n = [shingles(t) for _, t in rows], len(rows)
    links = {i: set() for i in range(n)}
    for i in range(n):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                links[i].add(j)
                links[j].add(i)
    found = []
    for i, (doc_id, _) in enumerate(rows):
        reach, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - reach
            reach |= new
            todo += new
        ids = [rows[k][0] for k in reach if rows[k][0] is not None]
        found.append((doc_id, len(sets[i]), min(ids, default=None), len(links[i])))
    return sorted(found, key=str)


def near_copies(seed, n=150):
    rng = random.Random(seed)
    bases = [[f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 6, 12, 40, 80]))] for _ in range(8)]
    rows = [(900, None), (901, ""), (902, " \n"), (None, "lonely words here"), (None, None)]
    for i in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            words[rng.randrange(len(words))] = rng.choice(["X", "y", "É", f"z{rng.randrange(60)}"])
        if rng.random() < 0.3:
            words = words[rng.randint(0, 2):]
        rows.append((None if rng.random() < 0.03 else i, " ".join(words).upper() if rng.random() < 0.2 else " ".join(words)))
    return rows


def joined(spark, rows):
    found = set_join.similar(spark.createDataFrame(rows, "doc_id long, text string"))
    return sorted((tuple(r[n] for n in ("doc_id", "n_shingles", "component_id", "n_links")) for r in found.collect()), key=str)


@pytest.mark.parametrize("seed,block", [(1, 500_000), (2, 300), (3, 60)])
def test_all_links_and_components(spark, monkeypatch, seed, block):
    monkeypatch.setattr(set_join, "BLOCK_SHINGLES", block)
    monkeypatch.setattr(set_join, "RANGE_SHINGLES", 500)
    rows = near_copies(seed)
    assert joined(spark, rows) == brute(rows)


def test_joined_without_broadcast_and_empty(spark, monkeypatch):
    monkeypatch.setattr(set_join, "MAX_BROADCAST_IDS", 0)
    rows = near_copies(4, 60)
    assert joined(spark, rows) == brute(rows)
    assert joined(spark, []) == []
    assert joined(spark, [(1, None), (1, None)]) == [(1, 0, 1, 0), (1, 0, 1, 0)]
    assert joined(spark, [(1, "same text"), (1, "same text"), (2, "SAME  text")]) == [(1, 1, 1, 2), (1, 1, 1, 2), (2, 1, 1, 2)]


def test_blocks_skip_and_derive_alike(monkeypatch):
    """Overlaps that the index gives are exact, and a set it passes over has no partner."""
    rng = random.Random(9)
    texts = [t for _, t in near_copies(9, 80) if shingles(t)]
    sets = []
    for _, ends, found, _ in set_join._sets(pa.array(texts)):
        sets += [found[ends[i]:ends[i + 1]] for i in range(len(ends) - 1)]
    rng.shuffle(sets)
    monkeypatch.setattr(set_join, "SKIP", 4)
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    sets = [sets[i] for i in order]
    for i, overlap in set_join.Block(sets).overlaps(sets, True):
        exact = [len(set(sets[i].tolist()) & set(s.tolist())) for s in sets]
        if overlap is not None:
            assert overlap.tolist() == exact
        else:
            assert not any(4 * o >= 3 * (len(sets[i]) + len(s) - o) for k, (o, s) in enumerate(zip(exact, sets)) if k != i)


def test_components_of_chains_stars_and_repeats(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 130)] + [(200, 200), (5, 4), (None, 1)]
    links += [(1000 + rng.randrange(60), 1000 + rng.randrange(60)) for _ in range(40)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    found = connected_components(spark.createDataFrame(links, "a long, b long"))
    assert {r["node"]: r["component"] for r in found.collect()} == {x: root(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_other_columns_are_no_harm(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string").withColumns({"node": F.lit("x"), "n": F.lit(2)})
    assert set_join.similar(docs).columns == ["doc_id", "n_shingles", "component_id", "n_links"]


def test_packed_shingles_grow_with_shingles_only():
    """What one flush sends stays within twice 8 bytes per shingle, however many ranges there are."""
    rng = np.random.default_rng(1)
    for size in (60, 300):
        sets = [np.sort(rng.integers(0, 1 << 63, size, dtype=np.uint64) * 2) for _ in range(30_000 // size)]
        keys = list(rng.integers(0, 1 << 62, len(sets)))
        for bits in (4, 8, 12):
            batch = set_join._ranged(keys, sets, bits)
            sent = sum(len(x) for name in ("low", "many", "flags", "keys") for x in batch[name].to_pylist())
            assert sent <= 16 * sum(map(len, sets))


def test_index_lists_go_on_in_other_tasks():
    """Wherever the sorted lists are cut, every link between neighbours is found."""
    rng = np.random.default_rng(2)
    entries = np.unique(np.stack((rng.integers(0, 4, 300), rng.integers(4, 12, 300), rng.integers(0, 1000, 300)), axis=1), axis=0)

    def chained(rows):
        batches = [pa.RecordBatch.from_arrays([pa.array(rows[:, i].astype(np.int64)) for i in range(3)], names=["shingle", "n", "node"])]
        return pa.Table.from_batches(list(set_join._chain_batches(iter(batches))))

    whole = chained(entries)
    expected = {(r["a"], r["b"]) for r in whole.filter(pa.compute.is_null(whole["shingle"])).to_pylist()}
    for cuts in ([], [150], sorted(rng.integers(1, len(entries), 20)), range(1, len(entries))):
        parts = pa.concat_tables(chained(part) for part in np.split(entries, list(dict.fromkeys(cuts))) if len(part))
        edge = pa.compute.is_valid(parts["shingle"])
        links = parts.filter(pa.compute.invert(edge)).to_pylist() + set_join._edge_links(parts.filter(edge)).to_pylist()
        assert expected <= {(r["a"], r["b"]) for r in links}


def test_small_steps_write_few_files(spark, monkeypatch):
    """Steps of few links are not written by as many tasks as there are shuffle partitions, and find the same."""
    names = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in names}
    files = []

    def counted(df, name, **options):
        found = written(df, name, **options)
        files.append((name, len(found.inputFiles())))
        return found

    monkeypatch.setattr(components, "written", counted)
    try:
        for key, value in names.items():
            spark.conf.set(key, value)
        links = spark.range(500).selectExpr("id as a", "id - id % 10 as b")
        found = connected_components(links).collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert {(r["node"], r["component"]) for r in found} == {(i, i - i % 10) for i in range(500)}
    assert len(files) > 2 and all(n == 1 for _, n in files[1:])
