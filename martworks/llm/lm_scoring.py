"""Cross-entropy difference of two matched bigram models.

The target model is counted on the rows that a condition selects, the background model on all others. Both share one vocabulary and one
smoothing, and are matched in size: the counts of the larger side are scaled to as many words as the smaller has, so that what neither knows
costs the same under both. A row's score is the mean over its words of the loss under the target model minus the loss under the
background model, in bits: the lower, the more the row is like the target. A row that was counted is scored without its own counts.

A word b after a has the probability (r n(ab) + PRIOR p(b)) / (r c(a) + PRIOR) with p(b) = (r s(b) + 1) / (r N + V): n, c and s are counts of the pair,
of a as context and of b, N all words, r the side's scale, V the distinct words of both sides and one for the unknown. Both are distributions over the
vocabulary.

Every word and pair counts, at every input size. Texts are read in place, in batches (see `batches`): a batch sends its distinct
pairs and words with their counts to segments of their hashes, where they are added up. These totals, packed by segment, are the
models; they grow with the input and are never gathered. To score, a batch asks the segments for its distinct pairs and words.

Words are compared with A-Z in lower case, words and pairs by 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martworks.llm import batches, tokens
from martworks.llm.common import prepare
from martworks.session import written

# Words that a context's own counts weigh as much as.
PRIOR = 2.0
# Text whose words one segment counts, at most about a sixth as many distinct pairs.
SEGMENT_BYTES = 8 << 20
# The context of the first word of a text.
START = np.uint64(1)

_PAIR, _WORD = 0, 1
# Counts of a pair: background, target. Of a word: background and target, as a word, then as a context.
_WIDTH = {_PAIR: 2, _WORD: 4}
_MESSAGES = "kind int, segment long, batch long, keys binary, counts binary"
# Beside what a message holds: words that are new in a segment, and words on each side.
_TOTALS = f"{_MESSAGES}, new long, words long, words_target long"


class _Batch:
    """The words of a batch in order: hashes, rows, hashes of the word before and of both."""

    def __init__(self, rows: pa.Table):
        self.rows = batches.in_order(rows)
        word, row, before = [], [], []
        for begin, _, data, offsets in tokens.chunks(self.rows["_text"].combine_chunks()):
            w = tokens.words(data, offsets, lower=True)
            previous = np.concatenate(([START], w.hash[:-1]))[:len(w.hash)]
            previous[w.firsts[:-1][w.counts > 0]] = START
            word.append(w.hash)
            row.append(w.row + begin)
            before.append(previous)
        joined = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts])
        self.word, self.before, self.row = joined(word, np.uint64), joined(before, np.uint64), joined(row, np.int64)
        pair = tokens.mixed(self.before * np.uint64(0x9E3779B97F4A7C15) + self.word)
        self.pairs, self.pair = np.unique(pair, return_inverse=True)
        self.words, place = np.unique(np.concatenate((self.word, self.before)), return_inverse=True)
        self.second, self.first = place[:len(self.word)], place[len(self.word):]
        self.side = self.rows["_side"].to_numpy()

    def messages(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(kind, keys, counts of each key), of the rows that are on a side."""
        side = self.side[self.row]
        for kind, keys, uses in ((_PAIR, self.pairs, [self.pair]), (_WORD, self.words, [self.second, self.first])):
            columns = [np.bincount(use[side == s], minlength=len(keys)) for use in uses for s in (0, 1)]
            yield kind, keys, np.stack(columns, axis=1) if len(keys) else np.zeros((0, _WIDTH[kind]), np.int64)

    def own(self, number: np.ndarray, size: int) -> np.ndarray:
        """How often the row of each word has what `number` numbers."""
        _, place, many = np.unique(self.row * max(size, 1) + number, return_inverse=True, return_counts=True)
        return many[place]


def _packed(counts: np.ndarray) -> bytes:
    """Counts, a byte each; those above 254 follow in eight."""
    flat = counts.ravel()
    large = flat >= 255
    return np.where(large, 255, flat).astype(np.uint8).tobytes() + flat[large].astype(np.int64).tobytes()


def _unpacked(data: bytes, rows: int, width: int) -> np.ndarray:
    flat = np.frombuffer(data, np.uint8, rows * width).astype(np.int64)
    flat[flat == 255] = np.frombuffer(data[rows * width:], np.int64)
    return flat.reshape(rows, width)


def _count(rows: pa.Table, segments: int) -> pa.Table:
    batch, found = rows["_batch"][0].as_py(), []
    for kind, keys, counts in _Batch(rows).messages():
        for segment, begin, end in batches.segments_of(keys, segments):
            found.append((kind, int(segment), batch, keys[begin:end].tobytes(), _packed(counts[begin:end])))
    return batches.table(found, _MESSAGES)


class _Segment:
    """The totals of one segment over all its messages."""

    def __init__(self, messages: pa.Table):
        self.kind, self.segment = messages["kind"][0].as_py(), messages["segment"][0].as_py()
        keys = [np.frombuffer(x, np.uint64) for x in messages["keys"].to_pylist()]
        width = _WIDTH[self.kind]
        self.batch, self.sizes = messages["batch"].to_pylist(), [len(k) for k in keys]
        self.keys, self.place = np.unique(np.concatenate(keys), return_inverse=True)
        self.totals = np.zeros((len(self.keys), width), np.int64)
        at = 0
        for size, packed in zip(self.sizes, messages["counts"].to_pylist()):
            self.totals[self.place[at:at + size]] += _unpacked(packed, size, width)  # the keys of a message are distinct
            at += size

    def sums(self) -> tuple[int, int, int]:
        """Words that some row has, and how many words each side has."""
        words = self.totals[:, :2]
        return (int(words.any(axis=1).sum()), *(int(x) for x in words.sum(axis=0))) if self.kind == _WORD else (0, 0, 0)


def _model(messages: pa.Table) -> pa.Table:
    found = _Segment(messages)
    used = found.totals.any(axis=1)
    return batches.table([(
        found.kind, found.segment, None, found.keys[used].tobytes(), _packed(found.totals[used]), *found.sums())], _TOTALS)


def _answer_all(messages: pa.Table) -> pa.Table:
    """To each batch the totals of the keys that it sent, in their order; and a row of sums."""
    found, at = _Segment(messages), 0
    rows = [(found.kind, found.segment, None, b"", b"", *found.sums())]
    for batch, size in zip(found.batch, found.sizes):
        rows.append((found.kind, found.segment, batch, b"", _packed(found.totals[found.place[at:at + size]]), 0, 0, 0))
        at += size
    return batches.table(rows, _TOTALS)


@dataclass(frozen=True)
class Models:
    """Totals of both sides by segment (kind, segment, keys, counts); words on each side; the vocabulary."""

    totals: DataFrame
    segments: int
    words: tuple[int, int]
    vocabulary: int

    @property
    def scales(self) -> tuple[float, float]:
        """What makes both sides as large as the smaller."""
        least = min(self.words)
        return tuple(least / n if n else 0.0 for n in self.words)


def _answer(asked: pa.Table, totals: pa.Table) -> pa.Table:
    """The totals of the keys that batches ask for, zero for those that no row has."""
    if not asked.num_rows:
        return batches.table([], _TOTALS)
    kind, segment = asked["kind"][0].as_py(), asked["segment"][0].as_py()
    known, counts = np.zeros(0, np.uint64), np.zeros((0, _WIDTH[kind]), np.int64)
    for keys, packed in zip(totals["keys"].to_pylist(), totals["counts"].to_pylist()):
        known = np.frombuffer(keys, np.uint64)
        counts = _unpacked(packed, len(known), _WIDTH[kind])
    counts = np.concatenate((counts, np.zeros((1, _WIDTH[kind]), np.int64)))
    found = []
    for batch, keys in zip(asked["batch"].to_pylist(), asked["keys"].to_pylist()):
        wanted = np.frombuffer(keys, np.uint64)
        place = np.searchsorted(known, wanted)
        hit = place < len(known)
        hit[hit] = known[place[hit]] == wanted[hit]
        found.append((kind, segment, batch, b"", _packed(counts[np.where(hit, place, len(known))]), 0, 0, 0))
    return batches.table(found, _TOTALS)


def losses(n, context, single, words, scale, vocabulary):
    """Loss in bits of words with these counts (see the module)."""
    alone = (scale * single + 1) / (scale * words + vocabulary)
    return -np.log2((scale * n + PRIOR * alone) / (scale * context + PRIOR))


def _score(rows: pa.Table, answers: pa.Table, segments: int, words: tuple, scales: tuple, vocabulary: int) -> pa.Table:
    whole = _Batch(rows)
    counts = {}
    for kind, size in ((_PAIR, len(whole.pairs)), (_WORD, len(whole.words))):
        mine = answers.filter(pa.compute.equal(answers["kind"], kind)).sort_by("segment")
        keys = whole.pairs if kind == _PAIR else whole.words
        ends = [end - begin for _, begin, end in batches.segments_of(keys, segments)]
        parts = [_unpacked(x, n, _WIDTH[kind]) for x, n in zip(mine["counts"].to_pylist(), ends)]
        counts[kind] = np.concatenate([np.zeros((0, _WIDTH[kind]), np.int64), *parts])
    n_rows = whole.rows.num_rows
    many = np.bincount(whole.row, minlength=n_rows)
    own = [whole.own(number, size) for number, size in (
        (whole.pair, len(whole.pairs)), (whole.first, len(whole.words)), (whole.second, len(whole.words)))]
    loss = []
    for side in (0, 1):
        counted = whole.side[whole.row] == side
        n = counts[_PAIR][whole.pair, side] - own[0] * counted
        context = counts[_WORD][whole.first, 2 + side] - own[1] * counted
        single = counts[_WORD][whole.second, side] - own[2] * counted
        rest = words[side] - many[whole.row] * counted
        loss.append(losses(n, context, single, rest, scales[side], vocabulary))
    total = np.bincount(whole.row, loss[1] - loss[0], n_rows)
    mean = pa.array(total / np.maximum(many, 1), mask=many == 0)
    return pa.table([whole.rows["_others"], whole.rows["_text"], pa.array(many.astype(np.int64)), mean],
                    names=["_others", "_text", "_n_tokens", "_difference"])


def _counted(rows: DataFrame, size: int) -> tuple[DataFrame, int]:
    """The messages of all batches, and the number of segments."""
    segments = 1 << max(4, int(size // SEGMENT_BYTES).bit_length())
    return rows.groupBy("_batch").applyInArrow(lambda batch: _count(batch, segments), _MESSAGES).groupBy("kind", "segment"), segments


def _models(totals: DataFrame, segments: int) -> Models:
    new, *words = totals.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("new", "words", "words_target"))).first()
    return Models(totals.select("kind", "segment", "keys", "counts"), segments, tuple(words), new + 1)


def _scored(rows: DataFrame, columns: list[str], text: str, models: Models, answers: DataFrame) -> DataFrame:
    segments, words, scales, vocabulary = models.segments, models.words, models.scales, models.vocabulary
    kind = rows.schema["_others"].dataType.simpleString()
    found = rows.groupBy("_batch").cogroup(answers.select("kind", "segment", "batch", "counts").groupBy("batch")).applyInArrow(
        lambda batch, told: _score(batch, told, segments, words, scales, vocabulary),
        f"_others {kind}, _text string, _n_tokens long, _difference double")
    ours = {"n_tokens": "_n_tokens", "ce_difference": "_difference"}
    carried = [(F.col("_text") if c == text else F.col("_others")[c]).alias(c) for c in columns if c.lower() not in ours]
    return found.select(*carried, *(F.col(own).alias(name) for name, own in ours.items()))


def _side(target: Column | None) -> Column:
    return F.lit(-1) if target is None else F.when(F.coalesce(target, F.lit(False)), 1).otherwise(0)


def fit(docs: DataFrame, text: str, target: Column) -> Models:
    """Models of all rows of `docs`; rows where `target` is true are the target's, all others, also where it is null, the background's.
    Where one side has no words, all differences are 0."""
    prepare(docs.sparkSession)
    counted, segments = _counted(*batches.stored(docs, text, _side=_side(target)))
    return _models(written(counted.applyInArrow(_model, _TOTALS), "lm-totals"), segments)


def score(docs: DataFrame, text: str, models: Models, target: Column | None = None) -> DataFrame:
    """The rows of `docs` with `n_tokens` and `ce_difference` (bits per word, target minus background; null without
    words, as for a null text). `target` says that the rows were counted by `fit`, and on which side, so that a row's own counts are left
    out; None: they were not. Columns of `docs` with these names are replaced."""
    prepare(docs.sparkSession)
    rows, _ = batches.stored(docs, text, _side=_side(target))
    segments = models.segments
    asked = rows.groupBy("_batch").applyInArrow(lambda batch: _count(batch, segments), _MESSAGES)
    answers = asked.groupBy("kind", "segment").cogroup(models.totals.groupBy("kind", "segment")).applyInArrow(_answer, _TOTALS)
    return _scored(rows, docs.columns, text, models, answers)


def score_corpus(docs: DataFrame, text: str, target: Column) -> DataFrame:
    """`fit` and `score` of the same rows. They are written once, and what a batch counts is also what it asks for: segments answer with
    the totals at once."""
    prepare(docs.sparkSession)
    rows, size = batches.stored(docs, text, _side=_side(target))
    counted, segments = _counted(rows, size)
    answers = written(counted.applyInArrow(_answer_all, _TOTALS), "lm-answers")
    return _scored(rows, docs.columns, text, _models(answers, segments), answers.filter("batch IS NOT NULL"))
