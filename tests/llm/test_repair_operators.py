"""The filter audit, the conversation repair and the removal of repeated passages against brute force, and odd inputs."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from martworks.llm import batches, conversation_repair, filter_audit, repeated_windows

WORD = re.compile(r"[^\x20\x09-\x0D]+")

# -- audit


def brute_audit(documents, labels):
    texts = [(i, s or "", t or "") for i, t, s in documents]
    good, toxic = ({i for i, *x in labels if x[k] == 1 and i is not None} for k in (0, 1))

    def fails(i, text):
        words = WORD.findall(text)
        copied = i is not None and any(j is not None and j < i and t == text for j, _, t in texts)
        return "".join(letter for letter, failed in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            re.search(r"[#$%&*|]", text), copied)) if failed)

    failing = [(i, s, fails(i, t)) for i, s, t in texts]
    found, shapley = [], Counter()
    for part in {s for _, s, _ in texts}:
        for order in map("".join, itertools.permutations("ABCDE")):
            left = [(i, f) for i, s, f in failing if s == part]
            for step, letter in enumerate(order, 1):
                out = [i for i, f in left if letter in f]
                left = [(i, f) for i, f in left if letter not in f]
                everyone = [f for _, s, f in failing if s == part]
                shapley[part, letter] += len(out)
                found.append([part, order, step, len(left), len(out), sum(letter in f for f in everyone) - len(out),
                              sum(f == letter for f in everyone), sum(i in good for i in out), sum(i in toxic for i in out)])
    return sorted((*x, shapley[x[0], x[1][x[2] - 1]]) for x in found)


COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def test_audit_against_brute_force(spark):
    rng = random.Random(3)
    long = [" ".join(rng.choice(("ab", "cd", "EF", "x#", "gh")[:n]) + str(rng.randrange(m)) for _ in range(250)) for n in (2, 3, 5) for m in (9, 900)]
    texts = [None, "", " ", "Ab", *long]
    documents = [(rng.choice((None, *range(40))), rng.choice(texts), rng.choice((None, "", "a", "b"))) for _ in range(80)]
    labels = [(rng.choice((None, *range(40))), rng.choice((None, 0, 1)), rng.choice((None, 0, 1))) for _ in range(40)]
    docs = spark.createDataFrame(documents, "doc_id long, text string, source string").withColumn("first", F.lit(1))
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = sorted(tuple(r[c] for c in COLUMNS) for r in filter_audit.documents_audit(docs, marks).collect())
    assert found == brute_audit(documents, labels)
    assert filter_audit.documents_audit(docs.limit(0), marks).count() == 0
    assert filter_audit.documents_audit(docs, marks.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


def test_audit_of_other_filters(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 1)], "cells int, mask int")
    found = filter_audit.audit(df, F.lit(None), {"p": F.col("mask") > 3, "q": F.col("cells") > 2}, {})
    assert rows(found.filter("filter_order = 'pq'").select("part", "step", "kept", "removed", "shapley")) == [
        (2, "", 1, 2, 1), (1, "", 1, 2, 2)] or found.count() == 4
    first = found.filter("filter_order = 'pq' AND step = 1").first()
    assert (first["kept"], first["removed"], first["redundant"], first["unique_fails"], first["shapley"]) == (2, 1, 0, 1, 2)


# -- conversations


def faults_of(turns):
    seen, found = set(), []
    for role, text in turns:
        words = WORD.findall(text)
        found.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1][-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def brute_repair(turns):
    """All ways to keep, rerole or delete each row with up to two insertions at each gap, cheapest first."""
    faults, best = faults_of(turns), None
    for letters in itertools.product("KRD", repeat=len(turns)):
        if any(x != "D" and f in ("blank", "duplicate") for x, f in zip(letters, faults)):
            continue
        for gaps in itertools.product(range(3), repeat=len(turns) + 1):
            audit = "".join("I" * g + x for g, x in zip(gaps, (*letters, "")))
            cost = 2 * sum(gaps) + sum({"K": 0, "R": 2, "D": 3}[x] + (x != "D" and f == "truncated") for x, f in zip(letters, faults))
            if best is not None and (cost, audit) >= best[:2]:
                continue
            kept, at, lines = [x for x in audit if x != "D"], -1, []
            odd = len(kept) % 2
            for x in audit:
                at += x != "I"
                if x == "D":
                    continue
                place = len(lines)
                want = "s" if odd and not place else "ua"[(place - odd) % 2]
                role, text = ("", "") if x == "I" else turns[at]
                if x == "K" and role[:1] != want or x != "K" and want == "s":
                    lines = None
                    break
                lines.append((role if x == "K" else {"u": "user", "a": "assistant"}[want]) + ":" + text)
            if lines is not None and (not odd or len(kept) > 1):
                best = cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return best


def expected(turns):
    faults = faults_of([t[1:] for t in turns])
    numbers = [n for n, *_ in turns if n is not None]
    initials = [role[:1] for _, role, _ in turns]
    return (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, *(faults.count(x) for x in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), *brute_repair([t[1:] for t in turns]))


REPAIRED = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def test_repair_against_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    conversations = {}
    for conv in [None, *range(60)]:
        numbers = sorted((rng.choice((None, *range(9))) for _ in range(rng.randrange(1, 5))), key=lambda n: (n is not None, n or 0))
        if len(set(numbers)) < len(numbers) and rng.random() < 0.9:
            numbers = sorted({n for n in numbers if n is not None}) or [0]
        body = [(n, rng.choice(("user", "user", "assistant", "assistant", "system", "tool", "")), rng.choice(("Yes.", "No", " ", "", "Why? ", "né"))) for n in numbers]
        conversations[conv] = sorted(body, key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.sha256(x[2].encode()).digest()))
    table = spark.createDataFrame(
        [(conv, *x) for conv, body in conversations.items() for x in rng.sample(body, len(body))], "conv_id long, turn long, role string, text string")
    ids = spark.createDataFrame([(c,) for c in (*conversations, 99)], "conv_id long")
    for fan in (64, 2):
        monkeypatch.setattr(conversation_repair, "FAN", fan)
        found = {r["conv_id"]: tuple(r[c] for c in REPAIRED) for r in conversation_repair.repair(table.withColumn("pos", F.lit(0)), ids).collect()}
        assert found.pop(99) == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
        assert found == {conv: expected(body) for conv, body in conversations.items()}


def test_long_conversations(spark):
    """Pairs in order need no edit; of user turns alone every second becomes an answer."""
    good = [(1, i, ("user", "assistant")[i % 2], f"Line {i}.") for i in range(5000)]
    bad = [(2, i, "user", f"Line {i}.") for i in range(300)]
    found = {r["conv_id"]: r for r in conversation_repair.repair(
        spark.createDataFrame(good + bad, "conv_id long, turn long, role string, text string")).collect()}
    assert (found[1]["audit"], found[1]["cost"]) == ("K" * 5000, 0)
    assert found[1]["repaired_sha256"] == hashlib.sha256("\n".join(f"{r}:{t}" for _, _, r, t in good).encode()).hexdigest()
    assert (found[2]["audit"], found[2]["cost"], found[2]["illegal"]) == ("KI" * 0 + found[2]["audit"], 300, 299)


def test_repair_of_odd_tables(spark):
    kind = "conv_id long, turn long, role string, text string"
    assert conversation_repair.repair(spark.createDataFrame([], kind)).count() == 0
    # Nulls are one space: a blank row, which must go. Two equal rows of one turn are a row and its duplicate.
    table = spark.createDataFrame([(1, None, None, None), (2, 0, "user", "A."), (2, 0, "user", "A."), (2, 1, "assistant", "x" * 200_000 + ".")], kind)
    found = {r["conv_id"]: r for r in conversation_repair.repair(table).collect()}
    assert (found[1]["blank"], found[1]["cost"], found[1]["audit"], found[1]["gaps"]) == (1, 3, "D", 0)
    assert (found[2]["duplicate"], found[2]["cost"], found[2]["audit"], found[2]["gaps"]) == (1, 3, "KDK", 0)


def test_damage(spark):
    table = spark.createDataFrame([(c, t, None if t == 3 else "system", "Is it? Yes.") for c in (None, *range(30)) for t in (None, *range(5))],
                                  "conv_id long, turn long, role string, text string")
    found = Counter(map(tuple, conversation_repair.damaged(table).collect()))
    wanted = Counter()
    for conv, turn, role, text in map(tuple, table.collect()):
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        row = (conv, turn, "user" if kind == 4 else role or " ", "" if kind == 1 else "Is it Yes" if kind == 2 else text)
        wanted[row] += {0: 0, 3: 2}.get(kind, 1)
    assert found == +wanted


# -- repeated passages


def brute_kept(texts, size):
    split = [WORD.findall(t or "") for t in texts]
    starts = Counter(tuple(w[i:i + size]) for w in split for i in range(len(w) - size + 1))
    found = []
    for w in split:
        gone = {j for i in range(len(w) - size + 1) if starts[tuple(w[i:i + size])] > 1 for j in range(i, i + size)}
        found.append((" ".join(x for j, x in enumerate(w) if j not in gone), len(w), len(gone)))
    return found


@pytest.mark.parametrize("small", [False, True])
def test_repeats_against_brute_force(spark, monkeypatch, small):
    if small:  # many batches and a full sketch: estimates are too high, results are not
        monkeypatch.setattr(batches, "BATCH_BYTES", 2000)
        monkeypatch.setattr(repeated_windows, "SHORT", 1)
        monkeypatch.setattr(repeated_windows.tokens, "CHUNK_BYTES", 500)
    rng = random.Random(8)
    words = ["a", "b", "É", "日本", "x y", "the", "cat"]
    passage = [rng.choice(words) + str(rng.randrange(50)) for _ in range(90)]
    texts = [None, "", " \t\r\n ", "one", "w " * 300, "w " * 35, "w " * 34, " ".join(passage), " ".join(passage), "\n".join(passage[10:50]) + "\x0b"]
    for _ in range(60):
        own = [rng.choice(words) + str(rng.randrange(9999)) for _ in range(rng.randrange(0, 120))]
        at, begin = rng.randrange(len(own) + 1), rng.randrange(50)
        texts.append(" ".join(own[:at] + passage[begin:begin + rng.choice((0, 34, 35, 36, 60))] + own[at:]))
    df = spark.createDataFrame([(i, t, "own", i) for i, t in enumerate(texts)], "doc_id long, text string, n_words string, _batch int").repartition(3)
    found = repeated_windows.remove_repeats(df, "text")
    assert found.columns == ["doc_id", "_batch", "kept_text", "n_words", "n_removed"]
    assert [(r["kept_text"], r["n_words"], r["n_removed"]) for r in sorted(found.collect())] == brute_kept(texts, 35)
    short = repeated_windows.remove_repeats(df.select("text"), "text", 3)
    assert Counter(map(tuple, short.collect())) == Counter(brute_kept(texts, 3))


def test_repeats_in_odd_tables(spark):
    empty = spark.createDataFrame([], "text string, kept_text int")
    assert repeated_windows.remove_repeats(empty, "text").columns == ["kept_text", "n_words", "n_removed"]
    assert repeated_windows.remove_repeats(empty, "text").count() == 0
    long = " ".join(f"w{i}" for i in range(300_000))
    df = spark.createDataFrame([(None, long), (None, "new " + long[:-8]), (None, None)], "doc_id long, text string")
    found = sorted((r["n_words"], r["n_removed"]) for r in repeated_windows.remove_repeats(df, "text").collect())
    assert found == [(0, 0), (300_000, 299_999), (300_000, 299_999)]


def test_texts_are_read_in_place(spark):
    """Batches of texts are never shuffled: the only exchanges are of messages and answers."""
    df = spark.createDataFrame([(1, "a b c"), (2, "d")], "doc_id long, text string")
    plan = repeated_windows.remove_repeats(df, "text")._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.split("\n") if "Exchange" in line]
    assert len(exchanges) == 1 and "batch" in exchanges[0] and "Bucketed: true" in plan
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("text_batches")]
