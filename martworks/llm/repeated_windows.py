"""Removal of repeated passages: every word covered by a window of words that occurs at more than one place of the table.

1. Rows are written once in batches, which later passes read in place (see `batches`).
2. Each batch makes a count-min sketch of its windows: `DEPTH` rows of counters, a window counts in one counter of each row. The sketch
   is as wide as the table has bytes, and a batch fills little of it, so only its counters above zero travel, two bytes each, cut into
   segments of the sketch. A task merges one segment of all batches' sketches by adding counters, up to two, and answers each
   batch with one bit for each of its counters: whether the sum is two or more.
3. A window of which all counters are two or more is estimated repeated; estimates are never too low, so none is lost. Only these
   windows are grouped exactly, by 128 bits of hash: again a batch sends each once, with whether it has it twice, and gets back a bit.
4. Words covered by repeated windows go.

A batch sends a window once however often it has it, so frequent passages do not gather. Messages are as many as batches times segments;
both grow with the table, so that beyond some 10 TB `batches.BATCH_BYTES` should grow, too.

A word has a 64-bit hash, as elsewhere in this package; a window has 128 bits of its words' hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martworks.llm import batches, tokens
from martworks.llm.common import prepare
from martworks.session import written

WINDOW = 35
DEPTH = 2
# A segment has at most two to this power counters; a task holds them, a byte each.
SEGMENT_BITS = 26
# Messages with fewer counters name them by four bytes.
SHORT = 4096

_SKETCH, _EXACT = 0, 1
_SALT = np.uint64(0xA0761D6478BD642F)
_MESSAGES = "kind int, segment long, batch long, many long, a binary, b binary, twice binary"
_ANSWERS = "kind int, segment long, batch long, many long, bits binary"


class _Powers:
    """Powers of an odd number and of its inverse, modulo 2^64."""

    def __init__(self, base: int):
        self.bases = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.values = np.ones((2, 1), np.uint64)

    def first(self, n: int) -> np.ndarray:
        if n > self.values.shape[1]:
            steps = np.repeat(np.array(self.bases, np.uint64)[:, None], max(n, 1 << 20), axis=1)
            steps[:, 0] = 1
            self.values = np.multiply.accumulate(steps, axis=1)
        return self.values[:, :n]


_POWERS = _Powers(0xE7037ED1A0B428DB), _Powers(0x8EBC6AF09C88C6E3)


def window_hashes(w: tokens.Words, size: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Index of the first word of each window within one row, and two hashes of it."""
    n = len(w.hash)
    if n < size:
        return np.zeros(0, np.int64), [np.zeros(0, np.uint64)] * 2
    first = np.flatnonzero(w.row[:n - size + 1] == w.row[size - 1:])
    found = []
    for powers in _POWERS:
        up, down = powers.first(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(w.hash * up, out=sums[1:])
        found.append(tokens.mixed((sums[first + size] - sums[first]) * down[first]))
    return first, found


class _Batch:
    """The windows of a batch, in the order of its rows."""

    def __init__(self, rows: pa.Table, size: int, with_words: bool = False):
        rows = batches.in_order(rows)
        self.rows, self.chunks, hashes = rows, [], [[np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]]
        for _, _, data, offsets in tokens.chunks(rows["_text"].combine_chunks()):
            w = tokens.words(data, offsets)
            first, found = window_hashes(w, size)
            w.sums = None
            if with_words:
                self.chunks.append((data, w, first))
            for all_found, more in zip(hashes, found):
                all_found.append(more)
        self.h, self.h2 = (np.concatenate(x) for x in hashes)

    def counters(self, bits: int):
        """For each row of the sketch: numbers of the counters above zero, whether above one, and the place of each window's counter."""
        for depth in range(DEPTH):
            found = (self.h if depth == 0 else tokens.mixed(self.h ^ _SALT)) >> np.uint64(64 - bits)
            number, place, many = np.unique(found, return_inverse=True, return_counts=True)
            yield number + np.uint64(depth << bits), many > 1, place

    def estimated(self, answers: pa.Table, bits: int) -> np.ndarray:
        """Which windows the merged sketch counts more than once."""
        found = np.ones(len(self.h), bool)
        told = _bits_of(answers, _SKETCH)
        at = 0
        for number, _, place in self.counters(bits):
            found &= told[at:at + len(number)][place]
            at += len(number)
        return found

    def candidates(self, estimated: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct windows of those, as pairs of hashes in order; whether here more than once; the number of each window's pair."""
        here = np.flatnonzero(estimated)
        order = np.lexsort((self.h2[here], self.h[here]))
        a, b = self.h[here][order], self.h2[here][order]
        new = np.concatenate((np.ones(min(1, len(a)), bool), (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        number = np.zeros(len(here), np.int64)
        number[order] = np.cumsum(new) - 1
        return a[new], b[new], np.bincount(number, minlength=int(new.sum())) > 1, number


def _bits_of(answers: pa.Table, kind: int) -> np.ndarray:
    """The answers to a batch, segments in order."""
    mine = answers.filter(pa.compute.equal(answers["kind"], kind)).sort_by("segment")
    counts = mine["many"].to_pylist()
    parts = [np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(mine["bits"].to_pylist(), counts)]
    return np.concatenate([np.zeros(0, np.uint8), *parts]).astype(bool)


def _message(kind, segment, batch, a: bytes, b: bytes, twice: np.ndarray) -> tuple:
    return kind, int(segment), int(batch), len(twice), a, b, np.packbits(twice).tobytes()


def _sketch(rows: pa.Table, size: int, bits: int, segments: int) -> pa.Table:
    """The sketch of a batch, a message for each segment that it counts in."""
    batch, shift = rows["_batch"][0].as_py(), _shift(bits, segments)
    found = []
    for number, twice, _ in _Batch(rows, size).counters(bits):
        for segment, begin, end in batches.runs(number >> np.uint64(shift)):
            inside = (number[begin:end] & np.uint64((1 << shift) - 1)).astype(np.int64)
            if len(inside) < SHORT:
                a, b = inside.astype(np.uint32), np.zeros(0, np.uint32)
            else:
                a, b = inside.astype(np.uint16), np.bincount(inside >> 16, minlength=max(1, 1 << shift >> 16)).astype(np.uint32)
            found.append(_message(_SKETCH, segment, batch, a.tobytes(), b.tobytes(), twice[begin:end]))
    return batches.table(found, _MESSAGES)


def _shift(bits: int, segments: int) -> int:
    """Bits of a counter's number within its segment; `segments` is a power of two."""
    return bits + (DEPTH - 1).bit_length() - segments.bit_length() + 1


def _inside(a: bytes, b: bytes) -> np.ndarray:
    """Numbers of counters within a segment."""
    if not b:
        return np.frombuffer(a, np.uint32).astype(np.int64)
    many = np.frombuffer(b, np.uint32)
    return np.repeat(np.arange(len(many)) << 16, many) + np.frombuffer(a, np.uint16)


def _merge_sketches(messages: pa.Table, shift: int) -> pa.Table:
    """One segment of the sketch of all rows: counters up to two, and which counters of each batch are two."""
    counters = np.zeros(1 << shift, np.uint8)
    columns = [messages[c].to_pylist() for c in ("segment", "batch", "many", "a", "b", "twice")]
    for _, _, many, a, b, twice in zip(*columns):
        place = _inside(a, b)
        counters[place] = np.minimum(counters[place] + 1 + np.unpackbits(np.frombuffer(twice, np.uint8), count=many), 2)
    found = []
    for segment, batch, many, a, b, _ in zip(*columns):
        found.append((_SKETCH, segment, batch, many, np.packbits(counters[_inside(a, b)] > 1).tobytes()))
    return batches.table(found, _ANSWERS)


def _ask(rows: pa.Table, answers: pa.Table, size: int, bits: int, segments: int) -> pa.Table:
    """The windows of a batch that are estimated repeated, a message for each segment of hashes."""
    if not rows.num_rows:
        return batches.table([], _MESSAGES)
    whole = _Batch(rows, size)
    a, b, twice, _ = whole.candidates(whole.estimated(answers, bits))
    batch = rows["_batch"][0].as_py()
    return batches.table([
        _message(_EXACT, segment, batch, a[begin:end].tobytes(), b[begin:end].tobytes(), twice[begin:end])
        for segment, begin, end in batches.segments_of(a, segments)], _MESSAGES)


def _count_exactly(messages: pa.Table) -> pa.Table:
    """Which windows of one segment of hashes occur more than once, for each batch."""
    columns = [messages[c].to_pylist() for c in ("segment", "batch", "many")]
    a, b = (np.concatenate([np.frombuffer(x, np.uint64) for x in messages[c].to_pylist()]) for c in ("a", "b"))
    repeated = np.concatenate([
        np.unpackbits(np.frombuffer(x, np.uint8), count=n).astype(bool) for x, n in zip(messages["twice"].to_pylist(), columns[2])])
    order = np.lexsort((b, a))
    same = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    # What one batch has twice is known as repeated to that batch only where no other has it.
    at, found = 0, []
    for segment, batch, many in zip(*columns):
        found.append((_EXACT, segment, batch, many, np.packbits(repeated[at:at + many]).tobytes()))
        at += many
    return batches.table(found, _ANSWERS)


def _kept(data: np.ndarray, w: tokens.Words, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kept words of each row joined by one space: bytes of all rows, and of each row how many."""
    start, row = w.start[kept], w.row[kept]
    length = w.stop[kept] - start + 1
    ends = np.cumsum(length)
    last = np.concatenate((row[1:] != row[:-1], np.ones(min(1, len(row)), bool)))
    source = np.repeat(start - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)
    out = data[np.minimum(source, len(data) - 1)] if len(source) else np.zeros(0, np.uint8)
    out[ends - 1] = 0x20
    inner = np.ones(len(out), bool)
    inner[ends[last] - 1] = False
    return out[inner], np.bincount(row, length - last, minlength=len(w.counts)).astype(np.int64)


def _remove(rows: pa.Table, answers: pa.Table, size: int, bits: int) -> pa.Table:
    whole = _Batch(rows, size, with_words=True)
    estimated = whole.estimated(answers, bits)
    number = whole.candidates(estimated)[3]
    repeated = np.zeros(len(estimated), bool)
    repeated[estimated] = _bits_of(answers, _EXACT)[number]
    at, texts, sizes, removed, words = 0, [np.zeros(0, np.uint8)], [np.zeros(1, np.int64)], [], []
    for data, w, first in whole.chunks:
        begins = first[repeated[at:at + len(first)]]
        at += len(first)
        edges = np.zeros(len(w.hash) + 1, np.int64)
        edges[begins] += 1
        edges[begins + size] -= 1
        kept = np.cumsum(edges[:-1]) == 0
        text, length = _kept(data, w, kept)
        texts.append(text)
        sizes.append(length)
        words.append(w.counts)
        removed.append(np.bincount(w.row[~kept], minlength=len(w.counts)))
    offsets = np.cumsum(np.concatenate(sizes))
    kept_text = pa.LargeStringArray.from_buffers(
        whole.rows.num_rows, pa.py_buffer(offsets), pa.py_buffer(np.concatenate(texts))).cast(pa.string())
    counts = (pa.array(np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64)) for x in (words, removed))
    return pa.table([whole.rows["_others"], kept_text, *counts], names=["_others", "_kept_text", "_n_words", "_n_removed"])


def remove_repeats(df: DataFrame, text: str, size: int = WINDOW) -> DataFrame:
    """`df` without column `text`, with kept_text (the words that are left, joined by one space), n_words and n_removed.

    A window is a run of `size` words of one row's text, as written; it is repeated if the same words also begin anywhere else, in the same
    row or another. Every word in a repeated window goes; what is left is not judged again. Rows of fewer words, without words or
    with a null text have no window, and stay (kept_text is empty without words). Rows that come twice are two places. Columns of `df` with
    these names are replaced. A text longer than `batches.BATCH_BYTES` is a batch of its own, held by one task."""
    prepare(df.sparkSession)
    stored, total = batches.stored(df, text)
    bits = max(16, total.bit_length())
    segments = 1 << max(4, bits + 1 - SEGMENT_BITS)
    shift = _shift(bits, segments)
    windows = stored.select("_batch", "_row", "_text").groupBy("_batch")
    sketches = windows.applyInArrow(lambda batch: _sketch(batch, size, bits, segments), _MESSAGES)
    merged = written(sketches.groupBy("segment").applyInArrow(lambda x: _merge_sketches(x, shift), _ANSWERS), "repeated-sketch")
    asked = windows.cogroup(merged.groupBy("batch")).applyInArrow(
        lambda batch, answers: _ask(batch, answers, size, bits, segments), _MESSAGES)
    exact = written(asked.groupBy("segment").applyInArrow(_count_exactly, _ANSWERS), "repeated-exact")
    kind = stored.schema["_others"].dataType.simpleString()
    found = stored.groupBy("_batch").cogroup(merged.unionByName(exact).groupBy("batch")).applyInArrow(
        lambda batch, answers: _remove(batch, answers, size, bits), f"_others {kind}, _kept_text string, _n_words long, _n_removed long")
    ours = ("kept_text", "n_words", "n_removed")
    carried = [F.col("_others")[c].alias(c) for c in df.columns if c != text and c.lower() not in ours]
    return found.select(*carried, *(F.col(f"_{c}").alias(c) for c in ours))
