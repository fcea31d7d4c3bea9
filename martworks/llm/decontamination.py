"""Benchmark decontamination: BM25 over the test items with block-max pruning, then overlap of question and answer.

Question and answer each must be in the passage: by enough of their five-word runs, or, as altered copies, by enough of their
words in order at one place, where each word that is changed, left out or put in counts against it. An altered question has
`LEAST_WORDS` words or more, as shorter ones come about by chance.

The test items are the indexed documents; every training passage is a query. Impacts are divided by the score an item gives
to its own text, so that one threshold fits all items: 1 means that the passage has all of the item's words. Items stand in
blocks; for each word the index knows the largest impact in the whole index and in every block. A passage whose bound by
the former stays below the threshold is done; of the others only the blocks are scored whose own bound reaches it. All
bounds are sums of maxima, so no pair above the threshold is lost. Passages overlap by half, and half a passage is as long as
the longest item, so every copy of an item lies within one passage.

The index covers at most `INDEX_WORDS` words of items and is broadcast; more items make more indexes, each searched in turn. Numbers of items
that have a word, their mean and longest length are counted over all items, so scores and passages do not depend on the cut."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martworks.llm import tokens
from martworks.llm.common import prepare, with_results
from martworks.session import written

K1, B = 1.2, 0.75
THRESHOLD = 0.6
BLOCK_ITEMS = 8
INDEX_WORDS = 2_000_000
OVERLAP_GRAM = 5
LEAST_QUESTION, LEAST_ANSWER = 0.6, 0.5
# Altered copies: shares of words in order, and of what length the question must be.
LEAST_QUESTION_ORDER, LEAST_ANSWER_ORDER, LEAST_WORDS = 0.8, 0.6, 7
LEAKS_DDL = "array<struct<item_id:long,score:double,question_overlap:double,answer_overlap:double>>"
LEAK = pa.struct([("item_id", pa.int64()), *((n, pa.float64()) for n in ("score", "question_overlap", "answer_overlap"))])


def split_items(items: DataFrame) -> DataFrame:
    """(item_id, question, answer) of items (item_id, text): the answer is the last sentence with three words or more,
    with what follows it. A text of one sentence is all question, with an empty answer, which any passage has."""
    at = F.regexp_instr(F.col("text"), F.lit(r"(?<=[.!?])\s+(?=\S+\s+\S+\s+\S+[^.!?]*[.!?]*(\s+\S+){0,2}\s*$)"))
    return items.select(
        "item_id", F.when(at > 0, F.substr("text", F.lit(1), at)).otherwise(F.col("text")).alias("question"),
        F.when(at > 0, F.substr("text", at)).otherwise("").alias("answer"))


@dataclass(frozen=True)
class Statistics:
    """Of all items: how many, their mean and greatest number of words, and how many have each of an index's words (sorted hashes)."""

    items: int
    mean: float
    longest: int
    words: np.ndarray
    having: np.ndarray


@dataclass(frozen=True)
class Index:
    """Postings by word and block, with the maxima that bound scores."""

    item_ids: np.ndarray
    block_items: int
    stride: int
    words: np.ndarray          # sorted hashes
    highest: np.ndarray        # by word
    entry_starts: np.ndarray   # by word: where its entries begin; one more at the end
    entry_block: np.ndarray    # an entry is one word in one block of items
    entry_highest: np.ndarray
    entry_begin: np.ndarray    # where the entry's postings begin; one more at the end
    posting_item: np.ndarray
    posting_impact: np.ndarray
    question_grams: tuple[Part, ...]
    answer_grams: tuple[Part, ...]

    @classmethod
    def of(cls, item_ids: np.ndarray, questions: pa.Array, answers: pa.Array, whole: Statistics) -> Index:
        n = len(item_ids)
        w = _words_of(questions, answers)
        vocabulary, word = np.unique(w.hash, return_inverse=True)
        code, tf = np.unique(word * n + w.row, return_counts=True)
        word, item = code // max(n, 1), code % max(n, 1)
        df = whole.having[np.searchsorted(whole.words, vocabulary)]
        idf = np.log(1 + (whole.items - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * w.counts / max(whole.mean, 1e-9))
        impact = idf[word] * tf * (K1 + 1) / (tf + norm[item])
        own = np.bincount(item, impact, n)
        impact = impact / own[item]
        blocks = max(-(-n // BLOCK_ITEMS), 1)
        entry, begin = np.unique(word * blocks + item // BLOCK_ITEMS, return_index=True)
        entry_highest = np.maximum.reduceat(impact, begin) if len(begin) else impact
        entry_starts = np.searchsorted(entry // blocks, np.arange(len(vocabulary) + 1))
        highest = np.maximum.reduceat(entry_highest, entry_starts[:-1]) if len(vocabulary) else impact
        return cls(
            item_ids, BLOCK_ITEMS, max(whole.longest, 1), vocabulary, highest, entry_starts, entry % blocks,
            entry_highest, np.append(begin, len(item)), item, impact, _item_grams(questions), _item_grams(answers))

    def leaks(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, float, float, float]]:
        """(row, item, score, question overlap, answer overlap) of a chunk's rows, the best passage of each."""
        w = tokens.words(data, offsets, lower=True, plain=True)
        if not len(w.hash) or not len(self.words):
            return []
        place = np.minimum(np.searchsorted(self.words, w.hash), len(self.words) - 1)
        known = np.flatnonzero(self.words[place] == w.hash)
        # Halves of passages, numbered through all rows; a row's last half has no other after it.
        halves = -(-w.counts // self.stride)
        first_half = np.concatenate(([0], np.cumsum(halves)))
        half = first_half[w.row] + (np.arange(len(w.hash)) - w.firsts[w.row]) // self.stride
        pairs = np.unique(half[known] * len(self.words) + place[known])
        half_of, word_of = pairs // len(self.words), pairs % len(self.words)
        total = first_half[-1]
        last = np.zeros(total, bool)
        last[first_half[1:][halves > 0] - 1] = True

        def both(by_half: np.ndarray) -> np.ndarray:
            """Sums of a half and the one after it: at least the passage's, as words in both count twice."""
            follows = np.concatenate((by_half[1:], np.zeros_like(by_half[:1])))
            follows[last] = 0
            return by_half + follows

        margin = THRESHOLD - 1e-9
        # Bounds of all passages of the chunk by the words' largest impacts.
        bound = both(np.bincount(half_of, self.highest[word_of], total))
        passages = np.flatnonzero(bound >= margin)
        if not len(passages):
            return []
        ends = np.searchsorted(half_of, np.arange(total + 1))
        best: dict[tuple[int, int], tuple[float, float, float]] = {}
        for passage in passages:
            upto = passage if last[passage] else passage + 1
            # The distinct words of this passage alone: tighter than both halves' sums.
            terms = word_of[ends[passage]:ends[upto + 1]]
            if upto > passage:
                terms = np.unique(terms)
            if self.highest[terms].sum() < margin:
                continue
            entries = _ranges(self.entry_starts[terms], self.entry_starts[terms + 1])
            block_of = self.entry_block[entries]
            bounds = np.bincount(block_of, self.entry_highest[entries])
            for block in np.flatnonzero(bounds >= margin):
                items, scores = self._scores(entries[block_of == block], block)
                for item, score in zip(items[scores >= margin], scores[scores >= margin]):
                    row = int(np.searchsorted(first_half, passage, "right") - 1)
                    begin = w.firsts[row] + (passage - first_half[row]) * self.stride
                    grams = _grams(w.hash[begin:min(begin + 2 * self.stride, w.firsts[row + 1])])
                    parts = self.question_grams[item], self.answer_grams[item]
                    question, answer = (_overlap(part, grams) for part in parts)
                    if question < LEAST_QUESTION and len(parts[0][2]) >= LEAST_WORDS:
                        question = _altered(question, parts[0], grams, LEAST_QUESTION_ORDER)
                    if question >= LEAST_QUESTION and answer < LEAST_ANSWER:
                        answer = _altered(answer, parts[1], grams, LEAST_ANSWER_ORDER)
                    if question >= LEAST_QUESTION and answer >= LEAST_ANSWER:
                        found = (float(score), question, answer)
                        best[row, int(item)] = max(best.get((row, int(item)), found), found)
        return [(row, item, *found) for (row, item), found in sorted(best.items())]

    def _scores(self, entries: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Exact scores of the items of one block for a passage, from its words' entries there."""
        posting = _ranges(self.entry_begin[entries], self.entry_begin[entries + 1])
        low = block * self.block_items
        high = min(low + self.block_items, len(self.item_ids))
        scores = np.bincount(self.posting_item[posting] - low, self.posting_impact[posting], high - low)
        return np.arange(low, high), scores


def _ranges(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers of several ranges, one after the other."""
    many = end - begin
    return np.repeat(begin - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())


def _grams(word_hashes: np.ndarray, size: int = OVERLAP_GRAM) -> dict[int, np.ndarray]:
    """Hashes of all runs of 1 to `size` words, sorted, by length; made when asked for."""
    return _Grams(word_hashes)


class _Grams(dict):
    def __init__(self, word_hashes: np.ndarray):
        super().__init__()
        self.word_hashes = word_hashes

    def __missing__(self, size: int) -> np.ndarray:
        self[size] = np.unique(_runs(self.word_hashes, size))
        return self[size]


def _runs(word_hashes: np.ndarray, size: int) -> np.ndarray:
    n = len(word_hashes)
    row = np.zeros(n, np.int64)
    return tokens.windows(tokens.Words(row, row, row, word_hashes, np.array([n]), word_hashes), size)[1]


# The length of a text's runs (five words, or all if it has fewer), their distinct hashes, and the hashes of its words.
Part = tuple[int, np.ndarray, np.ndarray]


def _item_grams(texts: pa.Array) -> tuple[Part, ...]:
    w = tokens.words(*tokens.text_bytes(texts), lower=True, plain=True)
    found = []
    for row, n in enumerate(w.counts):
        size = int(min(OVERLAP_GRAM, n))
        hashes = w.hash[w.firsts[row]:w.firsts[row + 1]]
        found.append((size, np.unique(_runs(hashes, size)) if size else np.zeros(0, np.uint64), hashes))
    return tuple(found)


def _overlap(part: Part, passage: _Grams) -> float:
    size, grams, _ = part
    return float(np.isin(grams, passage[size]).mean()) if size else 1.0


def _altered(overlap: float, part: Part, passage: _Grams, least: float) -> float:
    """The share of the part's words that stand in order at one place of the passage, if it is `least` or more; else `overlap`."""
    found = in_order(part[2], passage.word_hashes)
    return max(overlap, found) if found >= least - 1e-9 else overlap


def in_order(part: np.ndarray, passage: np.ndarray) -> float:
    """1 - (least number of words changed, left out or put in to make `part` out of a piece of `passage`) / its length."""
    steps = np.arange(len(part) + 1)
    cost = steps.copy()
    least = len(part)
    for word in passage:
        below = np.minimum(cost[:-1] + (part != word), cost[1:] + 1)
        # Words left out: each place from the cheapest before it.
        cost = np.minimum.accumulate(np.concatenate(([0], below)) - steps) + steps
        least = min(least, cost[-1])
    return 1 - least / max(len(part), 1)


def _words_of(questions: pa.Array, answers: pa.Array) -> tokens.Words:
    texts = pa.compute.binary_join_element_wise(pa.compute.fill_null(questions, ""), pa.compute.fill_null(answers, ""), " ")
    return tokens.words(*tokens.text_bytes(texts), lower=True, plain=True)


def _item_words(batches):
    """(part, word, length): the distinct words of each item, and a row without word that has the item's length."""
    for batch in batches:
        part = batch.column("part").to_numpy()
        w = _words_of(batch.column("question"), batch.column("answer"))
        pairs = np.unique(np.stack((w.row.astype(np.uint64), w.hash), axis=1), axis=0)
        n = len(pairs)
        words = pa.array(np.concatenate((pairs[:, 1].view(np.int64), np.zeros(len(part), np.int64))),
                         mask=np.arange(n + len(part)) >= n)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate((part[pairs[:, 0].astype(np.int64)], part))), words,
            pa.array(np.concatenate((np.zeros(n, np.int64), w.counts)))], names=["part", "word", "length"])


def indexes(items: DataFrame) -> list[Index]:
    """Indexes of items (item_id, question, answer), `INDEX_WORDS` words each at most (one item more if that is longer). Null ids
    and items without words are left out; of several rows with one id each is searched for."""
    words = F.regexp_count(F.concat_ws(" ", "question", "answer"), F.lit(r"\S+"))
    usable = items.filter(F.col("item_id").isNotNull() & (words > 0))
    total = usable.agg(F.coalesce(F.sum(words), F.lit(0))).first()[0]
    groups = max(1, -(-2 * total // INDEX_WORDS)) if total > INDEX_WORDS else 1
    cut = usable.withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(groups)))
    counted = cut.select("part", "question", "answer").mapInArrow(_item_words, "part long, word long, length long")
    sums = written(counted.groupBy("part", "word").agg(
        F.count(F.lit(1)).alias("items"), F.sum("length").alias("words"), F.max("length").alias("longest")), "item-words")
    n, total, longest = sums.filter("word IS NULL").agg(F.sum("items"), F.sum("words"), F.max("longest")).first()
    having = F.sum("items").over(Window.partitionBy("word")).alias("having")
    shared = written(sums.filter("word IS NOT NULL").select("part", "word", having), "item-counts")
    found = []
    for part in range(groups):
        rows = cut.filter(F.col("part") == part).toArrow().sort_by("item_id")
        if rows.num_rows:
            words = shared.filter(F.col("part") == part).toArrow()
            hashes = words["word"].to_numpy().view(np.uint64)
            order = np.argsort(hashes)
            whole = Statistics(n, total / n, longest, hashes[order], words["having"].to_numpy()[order])
            texts = (rows[name].combine_chunks() for name in ("question", "answer"))
            found.append(Index.of(rows["item_id"].to_numpy().astype(np.int64), *texts, whole))
    return found


def search(docs: DataFrame, text: str, items: DataFrame) -> DataFrame:
    """The rows of `docs` with `leaks`: the items (item_id, score, question_overlap, answer_overlap) that a passage of the text
    repeats, by item id; an empty array for a clean, empty or null text."""
    prepare(docs.sparkSession)
    columns = [_leaks(index, docs)(F.col(f"`{text}`")) for index in indexes(items)]
    if not columns:
        return with_results(docs, leaks=F.array().cast(LEAKS_DDL))
    return with_results(docs, leaks=columns[0] if len(columns) == 1 else F.array_sort(F.concat(*columns)))


def _leaks(index: Index, docs: DataFrame):
    shared = docs.sparkSession.sparkContext.broadcast(index)

    @F.arrow_udf(LEAKS_DDL)
    def found(column: pa.Array) -> pa.Array:
        rows = [[] for _ in range(len(column))]
        for begin, _, data, offsets in tokens.chunks(column):
            for row, item, *values in shared.value.leaks(data, offsets):
                rows[begin + row].append((int(shared.value.item_ids[item]), *values))
        flat = [leak for row in rows for leak in row]
        names = [f.name for f in LEAK]
        values = pa.StructArray.from_arrays(
            [pa.array([leak[i] for leak in flat], LEAK[i].type) for i in range(len(names))], names)
        ends = pa.array(np.concatenate(([0], np.cumsum([len(row) for row in rows]))).astype(np.int32))
        return pa.ListArray.from_arrays(ends, values)

    return found
