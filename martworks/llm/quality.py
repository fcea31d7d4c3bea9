"""Quality rules: fixed base rules, then a calibrated logistic regression over hashed word and character n-grams.

The regression is fitted on a bounded sample of labelled documents (`MAX_TRAINING_DOCUMENTS`, half of each class where there are enough, drawn
by a hash of the id). Tasks hash the n-grams of the sample; only the hashed counts reach the driver, never a text. A third of the sample
is kept back to calibrate its scores as probabilities, for the share of good ones among all labels. The weights have a fixed size, so they reach the tasks as
a broadcast of 3 MB at any scale. Texts are scored in Arrow batches, whole, in one pass over the documents."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martworks.llm import tokens
from martworks.llm.common import fresh, prepare, with_results
from martworks.session import written

# The base rules.
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
LEAST_WORDS, MOST_REPEATED_PERCENT = 10, 20

MAX_TRAINING_DOCUMENTS = 3_000
DRAW_BUCKETS = 1024
KEEP_FROM = 0.2
FEATURE_BITS = 18
FAMILIES = 3  # words, word pairs, runs of four bytes
STEPS, RATE, DECAY = 80, 0.5, 1e-6
SCALE = 10.0

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
RESULT = pa.struct([
    *((name, pa.int64()) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
    ("probability", pa.float64()),
])
RESULT_DDL = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, probability double"


def base_counts(data: np.ndarray, offsets: np.ndarray, w: tokens.Words) -> dict[str, np.ndarray]:
    """The counts of the base rules for each row of a chunk."""
    rows = len(offsets) - 1
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    symbols = np.concatenate(([0], np.cumsum(_IS_SYMBOL[data])))
    return {
        "n_words": w.counts,
        "word_chars": tokens.sums_by_row(points[w.stop] - points[w.start], w.row, rows),
        "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]],
        "n_dup_lines": _repeated_lines(data, offsets, w),
        "n_repeat_words": _repeated_words(w, rows),
    }


def _repeated_lines(data: np.ndarray, offsets: np.ndarray, w: tokens.Words) -> np.ndarray:
    rows = len(offsets) - 1
    breaks = np.flatnonzero(data == 10)
    start = np.unique(np.concatenate((offsets[:-1], breaks + 1)))
    start = start[start < len(data)]
    row = np.searchsorted(offsets, start, "right") - 1
    stop = np.minimum(np.append(breaks, len(data))[np.searchsorted(breaks, start)], offsets[row + 1])
    with_word = np.searchsorted(w.start, stop) > np.searchsorted(w.start, start)
    start, stop, row = start[with_word], stop[with_word], row[with_word]
    found = tokens.range_hashes(w.sums, start, stop)
    order = np.lexsort((found, row))
    same = (row[order][1:] == row[order][:-1]) & (found[order][1:] == found[order][:-1])
    return np.bincount(row[order][1:][same], minlength=rows)


def _repeated_words(w: tokens.Words, rows: int) -> np.ndarray:
    first, found = tokens.windows(w, WINDOW)
    row = w.row[first]
    order = np.lexsort((found, row))
    same = (row[order][1:] == row[order][:-1]) & (found[order][1:] == found[order][:-1])
    twice = np.zeros(len(first), bool)
    twice[1:] |= same
    twice[:-1] |= same
    repeated = first[order[twice]]
    change = np.bincount(repeated, minlength=len(w.hash) + WINDOW + 1) - np.bincount(
        repeated + WINDOW, minlength=len(w.hash) + WINDOW + 1)
    covered = np.cumsum(change)[:len(w.hash)] > 0
    return tokens.sums_by_row(covered.astype(np.int64), w.row, rows)


def features(data: np.ndarray, offsets: np.ndarray, w: tokens.Words) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature number) of every n-gram of a chunk, family after family."""
    shift = np.uint64(64 - FEATURE_BITS)
    first, pairs = tokens.windows(w, 2)
    wide = data.astype(np.uint32)
    n = max(0, len(wide) - 3)
    runs = wide[:n] << 24 | wide[1:n + 1] << 16 | wide[2:n + 2] << 8 | wide[3:n + 3]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    within = np.flatnonzero(row[:n] == row[3:n + 3])
    return (
        np.concatenate((w.row, w.row[first], row[within])),
        np.concatenate((
            (w.hash >> shift).astype(np.int64),
            (pairs >> shift).astype(np.int64) + (1 << FEATURE_BITS),
            (runs[within] * np.uint32(0x9E3779B1) >> np.uint32(32 - FEATURE_BITS)).astype(np.int64) + (2 << FEATURE_BITS),
        )),
    )


@dataclass(frozen=True)
class Model:
    """Weights of the regression, its constant, and the calibration of its scores."""

    weights: np.ndarray
    constant: float
    slope: float
    offset: float

    def scores(self, row: np.ndarray, feature: np.ndarray, rows: int) -> np.ndarray:
        family = feature >> FEATURE_BITS
        place = family * rows + row
        many = np.bincount(place, minlength=FAMILIES * rows)
        sums = np.bincount(place, self.weights[feature], minlength=FAMILIES * rows)
        return self.constant + SCALE * (sums / np.maximum(many, 1)).reshape(FAMILIES, rows).sum(axis=0)

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        return _logistic(self.slope * scores + self.offset)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def hashed_counts(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each text its distinct features and how often it has each."""
    found = []
    for begin, end, data, offsets in tokens.chunks(texts):
        row, feature = features(data, offsets, tokens.words(data, offsets))
        key, count = np.unique(row * (FAMILIES << FEATURE_BITS) + feature, return_counts=True)
        cuts = np.searchsorted(key, np.arange(end - begin + 1) * (FAMILIES << FEATURE_BITS))
        own = (key % (FAMILIES << FEATURE_BITS)).astype(np.int32)
        found += [(own[i:j], count[i:j].astype(np.int32)) for i, j in zip(cuts, cuts[1:])]
    return found


def fit(counts: list[tuple[np.ndarray, np.ndarray]], good: np.ndarray, share: float | None = None) -> Model:
    """Fit and calibrate on labelled texts, given as `hashed_counts`. Two rows of three train, the third calibrates; probabilities are for a
    table with this `share` of good texts, None: the rows' own. With one class only, every text gets that class's share."""
    rows = len(counts)
    row = np.repeat(np.arange(rows, dtype=np.int32), [len(own) for own, _ in counts])
    feature, count = (np.concatenate([np.zeros(0, np.int32), *x]) for x in zip(*counts))
    family = feature >> FEATURE_BITS
    many = np.bincount(family * rows + row, count, FAMILIES * rows)
    value = (SCALE * count / many[family * rows + row]).astype(np.float32)
    del family, count
    training = np.arange(rows) % 3 != 2
    weights, constant = np.zeros(FAMILIES << FEATURE_BITS), 0.0
    squares, constant_square = np.full(len(weights), 1e-8), 1e-8
    # Both classes weigh the same in the fit; the calibration below brings their real shares back.
    balance = np.where(good, 0.5 / max(1, good[training].sum()), 0.5 / max(1, (~good)[training].sum())) * training
    for _ in range(STEPS):
        error = (_logistic(constant + np.bincount(row, weights[feature] * value, rows)) - good) * balance
        slope = np.bincount(feature, error[row] * value, len(weights)) + DECAY * weights
        squares += slope * slope
        weights -= RATE * slope / np.sqrt(squares)
        constant_square += error.sum() ** 2
        constant -= RATE * error.sum() / np.sqrt(constant_square)
    model = Model(weights.astype(np.float32), constant, 1.0, 0.0)
    scores = constant + np.bincount(row, weights[feature] * value, rows)
    slope, offset = _calibration(scores[~training], good[~training])
    if share is not None and 0 < good.sum() < rows and 0 < share < 1:
        offset += np.log(share / (1 - share)) - np.log(good.sum() / (~good).sum())
    return Model(model.weights, constant, slope, offset)


def _calibration(scores: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn scores into probabilities (Platt), by Newton steps on smoothed targets."""
    if not len(scores):
        return 1.0, 0.0
    n_good, n_bad = good.sum(), (~good).sum()
    target = np.where(good, (n_good + 1) / (n_good + 2), 1 / (n_bad + 2))
    x = np.stack((scores, np.ones_like(scores)))
    found = np.array([0.0, np.log((n_good + 1) / (n_bad + 1))])
    for _ in range(50):
        p = _logistic(found @ x)
        slope = x @ (p - target) + 1e-3 * found * [1, 0]
        curve = (x * (p * (1 - p))) @ x.T + np.diag([1e-3, 1e-9])
        found -= np.linalg.solve(curve, slope)
    return max(float(found[0]), 0.0), float(found[1])


def training_sample(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAINING_DOCUMENTS) -> tuple[DataFrame, float | None]:
    """(doc_id, text, good) of at most `limit` labelled documents, half of it for each class, drawn by a hash of the id; and the share of good
    ones among all labelled ids. Ids labelled both ways or not at all are left out; the ids are drawn before any text is read, by bucket
    first, so that no task gathers a class."""
    clear = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
    ids = clear.filter(F.col("low") == F.col("high")).select(F.col("doc_id").alias("_labelled"), (F.col("high") == 1).alias("good"))
    share = ids.agg(F.avg(F.col("good").cast("int"))).first()[0]
    drawn = ids.withColumn("_hash", F.xxhash64("_labelled"))
    for groups in (["good", F.pmod("_hash", F.lit(DRAW_BUCKETS))], ["good"]):
        order = Window.partitionBy(*groups).orderBy("_hash", "_labelled")
        drawn = drawn.withColumn("_nth", F.row_number().over(order)).filter(F.col("_nth") <= max(limit // 2, 1)).drop("_nth")
    drawn = written(drawn.drop("_hash"), "quality-draw")  # at most `limit` rows
    found = docs.select("doc_id", "text").join(F.broadcast(drawn), F.col("doc_id") == F.col("_labelled"))
    # Repeated rows of an id count once, so that the sample stays within its bound.
    sample = found.groupBy("doc_id").agg(F.max("text").alias("text"), F.first("good").alias("good")).filter(F.col("text").isNotNull())
    return sample, share


def _count_batches(batches):
    for batch in batches:
        counts = hashed_counts(batch.column("text"))
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), batch.column("good"), *(pa.array([x[i].tobytes() for x in counts], pa.binary()) for i in (0, 1))],
            names=["doc_id", "good", "features", "counts"])


def fitted(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAINING_DOCUMENTS) -> Model | None:
    """The model of a training sample, None where nothing is labelled."""
    prepare(docs.sparkSession)
    sample, share = training_sample(docs.withColumn("doc_id", F.col("doc_id").cast("long")), labels, limit)
    hashed = sample.mapInArrow(_count_batches, "doc_id long, good boolean, features binary, counts binary").toArrow().sort_by("doc_id")
    if not hashed.num_rows:
        return None
    columns = [[np.frombuffer(x, np.int32) for x in hashed[name].to_pylist()] for name in ("features", "counts")]
    return fit(list(zip(*columns)), hashed["good"].to_numpy().astype(bool), share)


def assess(docs: DataFrame, text: str, model: Model | None) -> DataFrame:
    """The rows of `docs` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, probability (of good quality; null
    without a model), base_failed and kept. A null text has no words and fails the base rules."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(RESULT_DDL)
    def judged(column: pa.Array) -> pa.Array:
        parts = []
        for begin, end, data, offsets in tokens.chunks(column):
            w = tokens.words(data, offsets)
            counts = base_counts(data, offsets, w)
            if shared.value is None:
                probability = pa.nulls(end - begin, pa.float64())
            else:
                probability = pa.array(shared.value.probabilities(shared.value.scores(*features(data, offsets, w), end - begin)))
            parts.append([*(pa.array(counts[name].astype(np.int64)) for name in list(counts)), probability])
        columns = [pa.concat_arrays(x) for x in zip(*parts)] if parts else [pa.nulls(0, f.type) for f in RESULT]
        return pa.StructArray.from_arrays(columns, fields=list(RESULT))

    name = fresh(docs, "_quality")
    judged_docs = docs.withColumn(name, judged(F.col(f"`{text}`")))
    q = F.col(name)
    failed = base_failed(q["n_words"], q["n_repeat_words"])
    return with_results(
        judged_docs, **{f.name: q[f.name] for f in RESULT}, base_failed=failed,
        kept=~failed & F.coalesce(q["probability"] >= KEEP_FROM, F.lit(True))).drop(name)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < LEAST_WORDS) | (100 * n_repeat_words > MOST_REPEATED_PERCENT * n_words)
