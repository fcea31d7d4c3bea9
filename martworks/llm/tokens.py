"""Words, shingles and hashes of whole Arrow text columns, computed on flat byte arrays instead of string by string.

A word is a run of bytes other than space and 0x09-0x0D; these separators never occur inside a UTF-8 character. Hashes
have 64 bits and depend on the word's bytes alone, so every task computes the same ones."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
# Separators of `words(..., plain=True)`: everything in ASCII but letters and digits.
_PLAIN = np.ones(256, bool)
_PLAIN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)
_CODES = np.random.Generator(np.random.PCG64(20240601)).integers(1, 1 << 63, 256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over all output bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Powers:
    """1, b, b^2, ... modulo 2^64, as many as were asked for."""

    def __init__(self, base: np.uint64):
        self.base, self.values = base, np.ones(1, np.uint64)

    def first(self, n: int) -> np.ndarray:
        if n > len(self.values):
            steps = np.full(max(n, CHUNK_BYTES + 1), self.base)
            steps[0] = 1
            self.values = np.multiply.accumulate(steps)
        return self.values[:n]


_POWERS, _INVERSES = _Powers(_BASE), _Powers(_BASE_INVERSE)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts after each other, and where each text begins and ends. A null is an empty text."""
    filled = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = filled.buffers()
    if not len(filled):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[filled.offset:filled.offset + len(filled) + 1]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of rows with `limit` bytes at most, or one longer row.
    Bounds the arrays that are made of a batch."""
    data, offsets = text_bytes(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


@dataclass
class Words:
    """Words of a chunk in order: byte range, row within the chunk, hash; the number of words of each row; and what
    `range_hashes` needs for other parts of the chunk."""

    start: np.ndarray
    stop: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    counts: np.ndarray
    sums: np.ndarray

    @property
    def firsts(self) -> np.ndarray:
        """Index of the first word of each row, and the number of all words at the end."""
        return np.concatenate(([0], np.cumsum(self.counts)))


def prefix_hashes(data: np.ndarray, lower: bool = False) -> np.ndarray:
    codes = _CODES[_LOWER] if lower else _CODES
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(codes[data] * _POWERS.first(len(data)), out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hashes of byte ranges, from `prefix_hashes`."""
    return mixed((sums[stop] - sums[start]) * _INVERSES.first(len(sums))[start] + (stop - start).astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False, plain: bool = False) -> Words:
    """`lower`: A-Z count as a-z. `plain`: ASCII punctuation separates words, too."""
    rows = len(offsets) - 1
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(none, none, none, np.zeros(0, np.uint64), np.zeros(rows, np.int64), np.zeros(1, np.uint64))
    separator = (_PLAIN if plain else _SEPARATOR)[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = edge[:-1].copy()
    before[1:] |= separator[:-1]
    after = edge[1:].copy()
    after[:-1] |= separator[1:]
    inside = ~separator
    start = np.flatnonzero(inside & before)
    stop = np.flatnonzero(inside & after) + 1
    row = np.searchsorted(offsets, start, "right") - 1
    sums = prefix_hashes(data, lower)
    return Words(start, stop, row, range_hashes(sums, start, stop), np.bincount(row, minlength=rows), sums)


def windows(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word, and hash, of each run of `size` words within one row."""
    last = len(w.hash) - size + 1
    if last <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first = np.flatnonzero(w.row[:last] == w.row[size - 1:])
    found = np.zeros(len(first), np.uint64)
    for i in range(size):
        found = found * _STEP + w.hash[first + i]
    return first, mixed(found)


def shingle_sets(w: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each row as (row, hash), sorted by both. A row of fewer words has its whole sequence."""
    first, found = windows(w, size)
    row = w.row[first]
    firsts = w.firsts
    for short in range(1, size):
        few = np.flatnonzero(w.counts == short)
        if len(few):
            whole = np.full(len(few), short, np.uint64)
            for i in range(short):
                whole = whole * _STEP + w.hash[firsts[few] + i]
            row, found = np.concatenate((row, few)), np.concatenate((found, mixed(whole)))
    order = np.lexsort((found, row))
    row, found = row[order], found[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (found[1:] != found[:-1])
    return row[new], found[new]


def sums_by_row(values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Exact sums of integers per row; rows ascend."""
    total = np.concatenate((np.zeros(1, values.dtype), np.cumsum(values)))
    ends = np.searchsorted(row, np.arange(rows + 1))
    return total[ends[1:]] - total[ends[:-1]]
