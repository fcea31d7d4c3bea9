"""Words, windows and sets on flat bytes against plain Python."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martworks.llm import tokens

TEXTS = st.lists(st.one_of(st.none(), st.text("aAbé \n\t\x0b.ß", max_size=40)), max_size=8)


def python_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.booleans(), st.sampled_from([1, 8, 1 << 20]))
def test_words_of_all_rows(texts, lower, limit):
    found = []
    for begin, end, data, offsets in tokens.chunks(pa.array(texts, pa.string()), limit):
        w = tokens.words(data, offsets, lower)
        raw = data.tobytes()
        for row in range(end - begin):
            here = slice(w.firsts[row], w.firsts[row + 1])
            found.append([(raw[a:b].decode(), int(h)) for a, b, h in zip(w.start[here], w.stop[here], w.hash[here])])
    assert [[x for x, _ in row] for row in found] == [python_words(t) for t in texts]
    fold = (lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x)) if lower else (lambda x: x)
    by_word: dict[str, set[int]] = {}
    for row in found:
        for word, value in row:
            by_word.setdefault(fold(word), set()).add(value)
    assert all(len(values) == 1 for values in by_word.values())
    assert len(set.union(set(), *by_word.values())) == len(by_word)


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_shingle_sets(texts):
    column = pa.array(texts, pa.string())
    data, offsets = tokens.text_bytes(column)
    row, found = tokens.shingle_sets(tokens.words(data, offsets, lower=True), 5)
    for i, text in enumerate(texts):
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in python_words(text)]
        expected = {tuple(words[k:k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())
        assert (row == i).sum() == len(expected)
    assert all(np.all(np.diff(found[row == i].astype(object)) > 0) for i in range(len(texts)))


def test_sliced_and_chunked_columns():
    column = pa.array(["a b", None, "c", ""])
    assert tokens.text_bytes(column[1:])[1].tolist() == [0, 0, 1, 1]
    assert [x[:2] for x in tokens.chunks(column, 3)] == [(0, 2), (2, 4)]
    assert list(tokens.chunks(pa.array([], pa.string()))) == []


@pytest.mark.parametrize("size", [2, 5])
def test_windows_stay_within_rows(size):
    data, offsets = tokens.text_bytes(pa.array(["a b c", "d", "a b c d e f"]))
    w = tokens.words(data, offsets)
    first, _ = tokens.windows(w, size)
    assert all(w.row[i] == w.row[i + size - 1] for i in first)
    assert len(first) == sum(max(0, n - size + 1) for n in (3, 1, 6))
