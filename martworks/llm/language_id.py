"""Language identification by prediction by partial matching (PPM).

Every language has a tree of byte contexts of up to `ORDER` bytes with frozen counts. A byte is coded in the longest context
that was seen; where it was not seen there, an escape is coded and the next shorter context tried, down to equal chances for
all 256 bytes (escape method C: with T bytes of D kinds in a context, a byte seen c times has c / (T + D), an escape
D / (T + D)). The language with the shortest code of the whole text wins.

The trees are fitted on a bounded sample of learned documents per language (`SAMPLE_DOCUMENTS`), counted on Spark. Because counts
are frozen, the code length of a byte given its context is one number per language; all such numbers are computed once, so
that a text is scored by table lookups."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martworks.llm import tokens
from martworks.llm.common import fresh, prepare, with_results
from martworks.session import written

ORDER = 3
SAMPLE_DOCUMENTS = 300
DRAW_BUCKETS = 1024
# Drawn ids up to this number are broadcast (about 64 MB) to find their texts, more are joined.
MAX_BROADCAST_DRAW = 1_000_000
UNKNOWN = "und"
# Code lengths are compared per byte; the score is the share of the best language at this many bytes.
SCORE_BYTES = 16.0


def grams(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(position of the last byte, code) of all runs of order + 1 bytes within one row."""
    last = np.arange(order, len(data))
    within = np.repeat(offsets[:-1], np.diff(offsets))[order:] + order <= last
    code = np.zeros(len(last), np.uint32)
    for i in range(order + 1):
        code = (code << np.uint32(8)) | data[i:len(data) - order + i]
    return last[within], code[within]


def learned(docs: DataFrame) -> DataFrame:
    """Documents that may be learned from: with text and language, and not held out."""
    return docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))


def has_letter(text: Column) -> Column:
    return F.regexp_like(text, F.lit(r"\p{L}"))


def held_out(doc_id: Column) -> Column:
    """Whether crc32(doc_id as text) mod 3 is 1; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


@dataclass(frozen=True)
class Trees:
    """Per order: sorted codes of all runs seen in any language, and the code length of their last byte for each language;
    sorted contexts, and the length of an escape from them for each language (0 where a language has not seen it)."""

    languages: tuple[str, ...]
    codes: tuple[np.ndarray, ...]
    lengths: tuple[np.ndarray, ...]
    contexts: tuple[np.ndarray, ...]
    escapes: tuple[np.ndarray, ...]

    def bits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code length in bits of every row in every language."""
        rows, total = len(offsets) - 1, np.zeros((len(offsets) - 1, len(self.languages)))
        row = np.repeat(np.arange(rows), np.diff(offsets))
        pending = np.arange(len(data))
        for order in range(ORDER, -1, -1):
            if not len(pending):
                break
            code = np.zeros(len(pending), np.uint32)
            for i in range(order, -1, -1):
                code = (code << np.uint32(8)) | data[np.maximum(pending - i, 0)]
            inside = pending - order >= offsets[row[pending]]
            place, hit = _find(self.codes[order], code)
            hit &= inside
            total += _sums(self.lengths[order], place[hit], row[pending[hit]], rows)
            # What is not coded here escapes, at a price only where the context was seen.
            missed = ~hit
            place, seen = _find(self.contexts[order], code[missed] >> np.uint32(8))
            seen &= inside[missed]
            pending = pending[missed]
            total += _sums(self.escapes[order], place[seen], row[pending[seen]], rows)
        return total + 8.0 * np.bincount(row[pending], minlength=rows)[:, None]


def _find(sorted_codes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_codes):
        return np.zeros(len(codes), np.int64), np.zeros(len(codes), bool)
    place = np.minimum(np.searchsorted(sorted_codes, codes), len(sorted_codes) - 1)
    return place, sorted_codes[place] == codes


def _sums(table: np.ndarray, place: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    return np.stack([np.bincount(row, table[place, i], rows) for i in range(table.shape[1])], axis=1)


def fit(docs: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS) -> Trees | None:
    """Trees of every `lang` in docs (doc_id, text, lang), from up to `sample_documents` learned documents of each, drawn by a
    hash of the id. None if there is nothing to learn from."""
    prepare(docs.sparkSession)
    # Only what can be learned from takes a place in the draw. It is drawn by bucket of ids first, so that what meets in one task per
    # language is bounded, however many documents a language has.
    usable = learned(docs).filter(has_letter(F.col("text")))
    drawn = usable.select("doc_id", "lang", F.xxhash64("doc_id").alias("_hash"))
    for groups in (["lang", F.pmod("_hash", F.lit(DRAW_BUCKETS))], ["lang"]):
        order = Window.partitionBy(*groups).orderBy("_hash", "doc_id")
        drawn = drawn.withColumn("_nth", F.row_number().over(order)).filter(F.col("_nth") <= sample_documents).drop("_nth")
    wanted = written(drawn.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang")).distinct(), "language-draw")
    if wanted.count() <= MAX_BROADCAST_DRAW:
        wanted = F.broadcast(wanted)
    sample = usable.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("lang") == F.col("_lang")), "left_semi")
    counted = sample.select("lang", "text").mapInArrow(_count_batches, "lang string, length int, code long, n long")
    total = counted.groupBy("lang", "length", "code").agg(F.sum("n").alias("n")).toArrow()
    return _trees(total) if total.num_rows else None


def _count_batches(batches):
    for batch in batches:
        for lang in batch.column(0).unique().to_pylist():
            texts = batch.column(1).filter(pa.compute.equal(batch.column(0), lang))
            for _, _, data, offsets in tokens.chunks(texts):
                for order in range(ORDER + 1):
                    code, n = np.unique(grams(data, offsets, order)[1], return_counts=True)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang] * len(code), pa.string()), pa.array(np.full(len(code), order, np.int32)),
                        pa.array(code.astype(np.int64)), pa.array(n.astype(np.int64)),
                    ], names=["lang", "length", "code", "n"])


def _trees(total: pa.Table) -> Trees:
    languages = tuple(sorted(total["lang"].unique().to_pylist()))
    lang = pa.compute.index_in(total["lang"], pa.array(languages)).to_numpy()
    length, code, n = (total[name].to_numpy() for name in ("length", "code", "n"))
    codes, lengths, contexts, escapes = [], [], [], []
    for order in range(ORDER + 1):
        here = length == order
        known, place = np.unique(code[here].astype(np.uint32), return_inverse=True)
        count = np.zeros((len(known), len(languages)))
        np.add.at(count, (place, lang[here]), n[here])
        context, of = np.unique(known >> np.uint32(8), return_inverse=True)
        sums, kinds = np.zeros((len(context), len(languages))), np.zeros((len(context), len(languages)))
        np.add.at(sums, of, count)
        np.add.at(kinds, of, count > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(kinds > 0, -np.log2(kinds / (sums + kinds)), 0.0)
            own = -np.log2(count / (sums + kinds)[of])
        if order:
            shorter = lengths[-1][np.searchsorted(codes[-1], known & np.uint32((1 << 8 * order) - 1))]
        else:
            shorter = np.full(count.shape, 8.0)
        codes.append(known)
        lengths.append(np.where(count > 0, own, escape[of] + shorter))
        contexts.append(context)
        escapes.append(escape)
    return Trees(languages, tuple(codes), tuple(lengths), tuple(contexts), tuple(escapes))


def predict(docs: DataFrame, text: str, trees: Trees | None) -> DataFrame:
    """The rows of `docs` with `lang_pred` and `score` (0 to 1, the winner's share). A null text, one without a letter, and any
    text where nothing was learned, is `und` with score 0. Equal lengths go to the first language by name."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    @F.arrow_udf("lang string, score double")
    def best(column: pa.Array) -> pa.Array:
        model, langs, scores = shared.value, [], []
        for _, _, data, offsets in tokens.chunks(column):
            bits = model.bits(data, offsets)
            per_byte = bits / np.maximum(np.diff(offsets), 1)[:, None]
            langs.append(np.argmin(bits, axis=1))
            scores.append(1 / np.exp2(SCORE_BYTES * (per_byte.min(axis=1)[:, None] - per_byte)).sum(axis=1))
        names = pa.array(model.languages, pa.string()).take(pa.array(np.concatenate([*langs, np.zeros(0, np.int64)])))
        found = pa.array(np.concatenate([*scores, np.zeros(0)]))
        return pa.StructArray.from_arrays([names, found], ["lang", "score"])

    known = has_letter(F.col(f"`{text}`"))
    if trees is None:
        return with_results(docs, lang_pred=F.lit(UNKNOWN), score=F.lit(0.0))
    name, lettered = fresh(docs, "_language"), fresh(docs, "_has_letter")
    found = docs.withColumns({name: best(F.col(f"`{text}`")), lettered: F.coalesce(known, F.lit(False))})
    return with_results(
        found, lang_pred=F.when(F.col(lettered), F.col(name)["lang"]).otherwise(UNKNOWN),
        score=F.when(F.col(lettered), F.col(name)["score"]).otherwise(0.0)).drop(name, lettered)
