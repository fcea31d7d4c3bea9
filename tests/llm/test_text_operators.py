"""Operators that score texts, against brute force, exact formulas or held-out labels."""

from __future__ import annotations

import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from martworks.llm import batches, decontamination, language_id, lm_scoring, quality, tokens
from martworks.llm.common import read

SF = "/root/testdata/sf0.01"
ODD_TEXTS = [None, "", " \n\t", "é", "#*$%&|<> x", "a b\nA B\na b\n\na b", "w " * 3000, "one two three four five " * 3, "x\n" * 12, "\x0b\nq\nq"]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def python_base(text):
    words = words_of(text)
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    windows = collections.defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i:i + 5])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def random_texts(seed, n=60):
    rng = random.Random(seed)
    return [" ".join(rng.choice(["a", "b", "é", "A", "c\n", "\nd", "#", "\n"]) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("limit", [1, 50, 1 << 20])
def test_base_counts(limit):
    texts, found = ODD_TEXTS + random_texts(limit), []
    for _, _, data, offsets in tokens.chunks(pa.array(texts), limit):
        found += list(zip(*(v.tolist() for v in quality.base_counts(data, offsets, tokens.words(data, offsets)).values())))
    assert found == [python_base(t) for t in texts]


def test_quality_on_held_out_labels(spark):
    documents, labels = read(spark, SF, "documents", "doc_id", "text"), read(spark, SF, "labels")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    model = quality.fitted(documents, labels.filter(~held))
    found = quality.assess(documents, "text", model).join(labels.filter(held), "doc_id").filter(~F.col("base_failed")).collect()
    good = [r["kept"] for r in found if r["quality"] == 1]
    bad = [r["kept"] for r in found if r["quality"] == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.25 * len(bad) and len(bad) > 5
    sure = [r for r in found if r["probability"] > 0.9]
    assert np.mean([r["quality"] for r in sure]) > 0.9


def test_quality_without_labels_and_with_one_class(spark):
    docs = spark.createDataFrame([(i, t, "k") for i, t in enumerate(ODD_TEXTS)], "doc_id long, text string, _quality string")
    none = spark.createDataFrame([(None, 1, 0), (99, 1, 0), (1, None, 0), (4, 0, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.fitted(docs, none.filter("doc_id is null or doc_id <> 4")) is None
    assert quality.fitted(docs, none) is None
    rows = quality.assess(docs, "text", None).orderBy("doc_id").collect()
    assert [tuple(r[n] for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) for r in rows] == [
        python_base(t) for t in ODD_TEXTS]
    assert [r["kept"] for r in rows] == [not r["base_failed"] for r in rows] and {r["_quality"] for r in rows} == {"k"}
    good = spark.createDataFrame([(4, 1, 0), (5, 1, 0), (5, 1, 1)], "doc_id long, quality int, toxic int")
    model = quality.fitted(docs, good)
    assert all(0 <= r["probability"] <= 1 for r in quality.assess(docs, "text", model).collect())
    assert quality.assess(docs.limit(0), "text", model).count() == 0


# -- languages


def python_bits(text: bytes, training: list[bytes]) -> float:
    """PPM code length with escape method C, straight from the definition."""
    counts = collections.defaultdict(collections.Counter)
    for t in training:
        for i in range(len(t)):
            for k in range(min(i, language_id.ORDER) + 1):
                counts[t[i - k:i]][t[i]] += 1
    total = 0.0
    for i, byte in enumerate(text):
        for k in range(min(i, language_id.ORDER), -1, -1):
            seen = counts.get(text[i - k:i])
            if not seen:
                continue
            size = sum(seen.values()) + len(seen)
            if byte in seen:
                total -= math.log2(seen[byte] / size)
                break
            total -= math.log2(len(seen) / size)
        else:
            total += 8
    return total


def trees_of(spark, rows):
    return language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_code_lengths_are_exact(spark):
    learned = [i for i in range(200) if not spark_free_held_out(i)]
    rows = [(learned[0], "abracadabra", "x"), (learned[1], "", "x"), (learned[2], "éa abra", "y"), (learned[3], "cab", "y"), (learned[4], None, "y")]
    trees = trees_of(spark, rows)
    texts = ["abra", "", "zzz", "éab cab", "a" * 50]
    data, offsets = tokens.text_bytes(pa.array(texts))
    for i, lang in enumerate(trees.languages):
        training = [t.encode() for _, t, name in rows if name == lang and t is not None]
        assert trees.bits(data, offsets)[:, i] == pytest.approx([python_bits(t.encode(), training) for t in texts])


def spark_free_held_out(doc_id):
    import zlib
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_held_out_accuracy(spark):
    documents = read(spark, SF, "documents", "doc_id", "text", "lang")
    found = language_id.predict(documents, "text", language_id.fit(documents)).filter(language_id.held_out(F.col("doc_id"))).collect()
    assert all(spark_free_held_out(r["doc_id"]) for r in found)
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in found)


def test_unknown_languages_and_nothing_to_learn(spark):
    held = next(i for i in range(100) if spark_free_held_out(i))
    docs = spark.createDataFrame(
        [(1, "abc", None), (2, None, "x"), (held, "abc", "x"), (None, "12 !?", None)], "doc_id long, text string, lang string")
    assert language_id.fit(docs) is None
    assert {(r["lang_pred"], r["score"]) for r in language_id.predict(docs, "text", None).collect()} == {("und", 0.0)}
    trees = trees_of(spark, [(next(i for i in range(9) if not spark_free_held_out(i)), "abc", "x")])
    found = [(r["lang_pred"], r["score"]) for r in language_id.predict(docs, "text", trees).collect()]
    assert sorted(found) == [("und", 0.0), ("und", 0.0), ("x", 1.0), ("x", 1.0)]


def test_predictions_do_not_see_labels(spark):
    documents = read(spark, SF, "documents", "doc_id", "text", "lang").limit(300)
    trees = language_id.fit(documents)
    plain = language_id.predict(documents, "text", trees).select("doc_id", "lang_pred", "score").orderBy("doc_id").collect()
    other = documents.withColumn("lang", F.lit("zz")).withColumn("_language", F.lit(0))
    assert language_id.predict(other, "text", trees).select("doc_id", "lang_pred", "score").orderBy("doc_id").collect() == plain


def test_texts_without_letters_take_no_place_in_the_draw(spark):
    ids = [i for i in range(200) if not spark_free_held_out(i)][:60]
    usable = ids[::20]
    rows = [(i, "abra cadabra" if i in usable else [None, "", "12 !?"][i % 3], "x") for i in ids]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    few, whole = language_id.fit(docs, 3), language_id.fit(docs.filter(F.col("doc_id").isin(usable)))
    assert few is not None and few.languages == whole.languages
    for found, expected in zip(few.codes + few.lengths, whole.codes + whole.lengths):
        assert np.array_equal(found, expected)


def batches_read(plan) -> int:
    """Batches that the Parquet reader has given to the plan."""
    own = plan.metrics().get("numInputBatches").get().value() if plan.nodeName() == "ColumnarToRow" else 0
    children = plan.children()
    return own + sum(batches_read(children.apply(i)) for i in range(children.size()))


def test_texts_are_read_in_small_batches(spark, tmp_path):
    """The reader holds all texts of a batch in one array: a few hundred, not thousands."""
    name, path = "spark.sql.parquet.columnarReaderBatchSize", str(tmp_path / "documents.parquet")
    ids = [i for i in range(2000) if not spark_free_held_out(i)]
    rows = [(i, ("abra cadabra " if i % 2 else "hocus pocus ") * 50, "x" if i % 2 else "y") for i in ids]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1).write.parquet(path)
    documents = spark.read.parquet(path)
    before = spark.conf.get(name)
    try:
        spark.conf.unset(name)
        trees = language_id.fit(documents)
        spark.conf.unset(name)
        found = language_id.predict(documents, "text", trees)
        assert {(r["doc_id"], r["lang_pred"]) for r in found.collect()} == {(i, lang) for i, _, lang in rows}
        assert batches_read(found._jdf.queryExecution().executedPlan()) >= len(rows) / 256
    finally:
        spark.conf.set(name, before)


# -- language models


def python_difference(counted, asked):
    """Cross-entropy differences by dictionaries. `asked`: (key, text, side it was counted on: 0, 1 or None)."""
    lowered = lambda t: [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words_of(t)]
    pairs = lambda ws: list(zip(["<s>", *ws], ws))
    sides = [[lowered(t) for _, t, hit in counted if bool(hit) == side] for side in (False, True)]
    models = [collections.Counter(p for ws in texts for p in pairs(ws)) for texts in sides]
    sizes = [sum(m.values()) for m in models]
    scales = [min(sizes) / n if n else 0 for n in sizes]
    vocabulary = len({b for m in models for _, b in m}) + 1

    def loss(side, own, p):
        model = models[side] - own
        context, single = (sum(c for q, c in model.items() if q[i] == p[i]) for i in (0, 1))
        alone = (scales[side] * single + 1) / (scales[side] * sum(model.values()) + vocabulary)
        return -math.log2((scales[side] * model[p] + lm_scoring.PRIOR * alone) / (scales[side] * context + lm_scoring.PRIOR))

    found = {}
    for key, text, side in asked:
        ws = pairs(lowered(text))
        own = [collections.Counter(ws) if side == x else collections.Counter() for x in (0, 1)]
        found[key] = np.mean([loss(1, own[1], p) - loss(0, own[0], p) for p in ws]) if ws else None
    return found


def test_cross_entropy_difference(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("a b c A dd é a a".split()) for _ in range(rng.randint(0, 12))), rng.choice([True, False, None]))
            for i in range(25)] + [(90, None, True), (91, "", False), (92, "new words only", None), (93, "a b", True), (94, "a b", True)]
    others = [(1, "a b zz é", None), (2, "zz yy", None), (3, None, None), (4, "b " * 40, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hit boolean").withColumn("_batch", F.lit(1)).repartition(3)
    expected = python_difference(rows, [(k, t, int(bool(hit))) for k, t, hit in rows])
    for size in (8 << 20, 50):
        monkeypatch.setattr(batches, "BATCH_BYTES", size)
        whole = lm_scoring.score_corpus(docs, "text", F.col("hit"))
        assert whole.columns == ["doc_id", "text", "hit", "_batch", "n_tokens", "ce_difference"]
        found = {r["doc_id"]: r for r in whole.collect()}
        for key, text, _ in rows:
            assert (found[key]["text"], found[key]["n_tokens"]) == (text, len(words_of(text)))
            assert found[key]["ce_difference"] == (None if expected[key] is None else pytest.approx(expected[key]))
    models = lm_scoring.fit(docs, "text", F.col("hit"))
    asked = spark.createDataFrame([r[:2] for r in others], "doc_id long, text string")
    found = {r["doc_id"]: r["ce_difference"] for r in lm_scoring.score(asked, "text", models).collect()}
    assert found == {k: None if x is None else pytest.approx(x) for k, x in python_difference(rows, others).items()}


def test_unknown_words_are_not_like_the_target(spark):
    """Few target texts among many: target texts score below others, and a text of unknown words about 0."""
    rng = random.Random(4)
    text = lambda ws: " ".join(rng.choice(ws) for _ in range(60))
    rows = [(i, text("the cat sat on a mat and saw it".split()), True) for i in range(5)]
    rows += [(i, text("tax law court judge rule case act of".split()), False) for i in range(10, 205)]
    docs = spark.createDataFrame([*rows, (300, "qx vz jk wq zz kx", False)], "doc_id long, text string, hit boolean")
    found = {r["doc_id"]: r["ce_difference"] for r in lm_scoring.score_corpus(docs, "text", F.col("hit")).collect()}
    assert max(found[i] for i in range(5)) < -1 and min(found[i] for i in range(10, 205)) > 1 and abs(found[300]) < 0.3
    models = lm_scoring.fit(docs, "text", F.col("hit"))
    asked = spark.createDataFrame([(1, "uu vv ww xx yy"), (2, "the cat sat")], "doc_id long, text string")
    other = {r["doc_id"]: r["ce_difference"] for r in lm_scoring.score(asked, "text", models).collect()}
    assert abs(other[1]) < 0.5 and other[2] < -1


def test_rare_words_and_pairs_count_at_any_size(spark):
    rows = [(1, "rare once", True), (2, "seldom twice", False), (3, "rare once", True), (4, "seldom twice", False)]
    filler = [(i, "the same words again " * 1000, i % 2 == 0) for i in range(10, 160)]
    docs = spark.createDataFrame(rows + filler, "doc_id long, text string, hit boolean")
    found = {r["doc_id"]: (r["n_tokens"], r["ce_difference"]) for r in lm_scoring.score_corpus(docs, "text", F.col("hit")).collect()}
    # The rare words keep apart what half a million other words surround; equal texts score alike.
    assert found[1] == found[3] and found[1][0] == 2 and found[1][1] < -0.3 and found[2][1] > 0.3


def test_models_are_distributions():
    """The probabilities of all words after a context, and an unknown one, add up to 1."""
    scale, n, single = 0.4, np.array([3, 0, 1, 0]), np.array([5, 2, 1, 0])
    loss = lm_scoring.losses(n, n.sum(), single, single.sum(), scale, 4)
    assert (2 ** -loss).sum() == pytest.approx(1)


def test_language_models_of_odd_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (3, "")], "doc_id long, text string")
    empty = lm_scoring.fit(docs.limit(0), "text", F.lit(True))
    assert [r["ce_difference"] for r in lm_scoring.score(docs, "text", empty).orderBy("doc_id").collect()] == [pytest.approx(0), None, None]
    assert lm_scoring.score_corpus(docs.limit(0), "text", F.lit(True)).count() == 0
    one_side = lm_scoring.score_corpus(docs, "text", F.lit(None)).filter("doc_id = 1").first()
    assert one_side["ce_difference"] == pytest.approx(0)


# -- decontamination


def brute_leaks(docs, items):
    """BM25 of every passage with every item, then overlaps, from the definitions."""
    plain = lambda t: re.findall("[a-z0-9\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    texts = {k: (plain(q), plain(a)) for k, q, a in items if k is not None and (plain(q) or plain(a))}
    whole = {k: q + a for k, (q, a) in texts.items()}
    n, mean, stride = len(whole), np.mean([len(w) for w in whole.values()]), max(len(w) for w in whole.values())
    df = collections.Counter(w for ws in whole.values() for w in set(ws))

    def impact(word, ws):
        tf, k1, b = ws.count(word), decontamination.K1, decontamination.B
        return math.log(1 + (n - df[word] + 0.5) / (df[word] + 0.5)) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(ws) / mean))

    def overlap(part, passage):
        size = min(5, len(part))
        runs = lambda ws: {tuple(ws[i:i + size]) for i in range(len(ws) - size + 1)}
        return len(runs(part) & runs(passage)) / len(runs(part)) if part else 1.0

    found = set()
    for doc_id, text in docs:
        ws = plain(text)
        for at in range(0, max(len(ws), 1), stride):
            passage = ws[at:at + 2 * stride]
            for key, item in whole.items():
                score = sum(impact(w, item) for w in set(passage) & set(item)) / sum(impact(w, item) for w in set(item))
                if score >= decontamination.THRESHOLD and overlap(texts[key][0], passage) >= decontamination.LEAST_QUESTION and (
                        overlap(texts[key][1], passage) >= decontamination.LEAST_ANSWER):
                    found.add((doc_id, key))
    return found


def test_leaks_against_brute_force(spark, monkeypatch):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(40)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, say(rng.randint(1, 25)), say(rng.randint(0, 6))) for i in range(30)] + [(None, "w1", "w2"), (77, None, ""), (78, "..", None)]
    docs = [(100, None), (101, ""), (102, "w1")]
    for i in range(60):
        _, q, a = items[rng.randrange(30)]
        middle = f"{q.upper()}, {a}" if rng.random() < 0.5 else " ".join((q + " " + a).split()[rng.randint(0, 4):])
        docs.append((i, f"{say(rng.randint(0, 60))} {middle}! {say(rng.randint(0, 60))}"))
    table = spark.createDataFrame(items, "item_id long, question string, answer string")
    source = spark.createDataFrame(docs, "doc_id long, text string").withColumn("leaks", F.lit("own"))
    expected = brute_leaks(docs, items)
    got = lambda: {(r["doc_id"], x["item_id"]) for r in decontamination.search(source, "text", table).collect() for x in r["leaks"]}
    assert got() == expected and len(expected) > 20
    monkeypatch.setattr(decontamination, "BLOCK_ITEMS", 1)
    assert got() == expected
    assert decontamination.search(source, "text", table.limit(0)).filter("size(leaks) > 0").count() == 0
    # However the items are cut into indexes, the same is found with the same scores.
    rows = lambda: {r["doc_id"]: [tuple(x) for x in r["leaks"]] for r in decontamination.search(source, "text", table).collect()}
    whole = rows()
    monkeypatch.setattr(decontamination, "INDEX_WORDS", 100)
    assert len(decontamination.indexes(table)) > 3
    cut = rows()
    assert cut.keys() == whole.keys() and all(cut[k] == [pytest.approx(x) for x in whole[k]] for k in whole)


def test_planted_items_are_found(spark):
    documents, items = read(spark, SF, "documents", "doc_id", "text"), read(spark, SF, "benchmark", "item_id", "text")
    planted = {tuple(r) for r in documents.join(items.withColumnRenamed("text", "item"), F.col("text").contains(F.col("item"))).select("doc_id", "item_id").collect()}
    found = decontamination.search(documents, "text", decontamination.split_items(items)).select("doc_id", F.inline("leaks"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == planted and planted


def test_altered_copies_are_found(spark):
    rng = random.Random(5)
    say = lambda n: " ".join(rng.choice("bcdfghjklm") + rng.choice("aeiou") + str(rng.randrange(400)) for _ in range(n))
    items = [(i, say(26), say(n)) for i, n in enumerate([3, 4, 5, 8, 9, 12] * 8)]
    docs, copies = [], set()
    for i, question, answer in items:
        for changed in (1, 2, 3):
            words = f"{question} {answer}".split()
            in_answer = 0 if changed == 2 else 1  # a word of the answer; the others spread over the question
            for at in [26 + rng.randrange(len(words) - 26)] * in_answer + [6, 13, 20][:changed - in_answer]:
                words[at] = "other"
            docs.append((10 * i + changed, f"{say(30)} {' '.join(words)} {say(30)}"))
            copies.add((10 * i + changed, i))
        docs.append((10 * i, f"{say(30)} {question} {say(30)}"))  # the question alone is no copy
    found = decontamination.search(
        spark.createDataFrame(docs, "doc_id long, text string"), "text",
        spark.createDataFrame(items, "item_id long, question string, answer string"))
    assert {(r["doc_id"], x["item_id"]) for r in found.collect() for x in r["leaks"]} == copies


def test_words_in_order():
    rng = random.Random(6)
    for _ in range(200):
        part, passage = ([rng.randrange(4) for _ in range(rng.randint(low, 9))] for low in (1, 0))
        row = list(range(len(part) + 1))
        least = row[-1]
        for word in passage:
            new = [0]
            for j, other in enumerate(part):
                new.append(min(row[j] + (word != other), row[j + 1] + 1, new[j] + 1))
            row, least = new, min(least, new[-1])
        found = decontamination.in_order(np.array(part, np.uint64), np.array(passage, np.uint64))
        assert found == pytest.approx(1 - least / len(part))
