"""Operator 6: language identification with language-bitmask n-gram filters.

The model is a bit-sliced Bloom filter: a table of bitmasks, one bit per
language in as many 64-bit words as the languages need, so a lookup ANDs the masks at an n-gram's positions and returns all
languages whose training text holds it.  A text's n-grams are counted per
language (popcounts), the counts are corrected for the filter's false positives
(the share of slots set for that language, to the power of the number of
positions), and the largest corrected count decides.

n-grams are four bytes of the text with A-Z lower-cased and every run of ASCII
non-letters turned to a space; a language gets the n-grams that are frequent in its training text and
not far rarer than in other languages' text, which keeps borrowed passages out.

Defined cases: rows of null language are never learned from; null texts and texts
without a letter are ``und`` with score 0; without any training row all are ``und``;
ties go to the alphabetically first language; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.llm.common import materialise, mix64, table

#: Bound of the labelled sample the filters are fitted on: rows per language, those of smallest hash.
MOST_TRAINING_ROWS = 4000
WORD_BITS = 64
CODE_BITS = 20
SLOT_BITS = 22
POSITIONS = 3
#: An n-gram enters a language's filter at this least share of its n-grams and this least part of its best share in any language.
LEAST_SHARE = 2e-6
LEAST_PART = 0.3
BLOCK = 1 << 20

_CLEAN = bytes(
    b if b >= 0x80 else (b | 0x20) if chr(b).isalpha() else 0x20 for b in range(256)
)


def clean(text: bytes) -> bytes:
    return b" " + b" ".join(text.translate(_CLEAN).split()) + b" "


def gram_codes(buffer: bytes) -> np.ndarray:
    """Code of the n-gram at each byte of ``buffer`` (three fewer than bytes)."""
    b = np.frombuffer(buffer, np.uint8)
    g = np.ndarray(max(0, len(b) - 3), "<u4", buffer, 0, (1,)).astype(np.uint32)
    g *= np.uint32(2654435769)
    return g >> np.uint32(32 - CODE_BITS)


def positions(codes: np.ndarray) -> list[np.ndarray]:
    h = mix64(codes.astype(np.uint64) + np.uint64(1))
    return [((h >> np.uint64(21 * i)) & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64) for i in range(POSITIONS)]


@dataclass
class LanguageModel:
    languages: list[str]
    #: Languages of each n-gram code, a row per word of 64 languages: the filter's answer, looked up once for every code there is.
    masks: np.ndarray
    false_rates: np.ndarray

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Corrected share of n-grams per text and language."""
        out = np.zeros((len(texts), len(self.languages)))
        parts = [clean(t) for t in texts]
        start = 0
        while start < len(parts):
            end, size = start, 0
            while end < len(parts) and (end == start or size + len(parts[end]) <= BLOCK):
                size += len(parts[end])
                end += 1
            self._block(parts[start:end], out[start:end])
            start = end
        return out

    def _block(self, parts: list[bytes], out: np.ndarray) -> None:
        lengths = np.array([len(p) for p in parts])
        ends = np.cumsum(lengths)
        starts = ends - lengths
        codes = gram_codes(b"".join(parts) + b"   ")
        for i in range(len(self.languages)):
            bit = i % WORD_BITS
            if bit == 0:
                masks = self.masks[i // WORD_BITS][codes]
            hits = np.concatenate([[0], np.cumsum((masks >> masks.dtype.type(bit)) & masks.dtype.type(1), dtype=np.int64)])
            last = np.maximum(ends - 3, starts)
            n = np.maximum(last - starts, 1)
            count = hits[last] - hits[starts]
            rate = self.false_rates[i]
            out[:, i] = np.clip((count - n * rate) / (n * max(1e-9, 1 - rate)), 0, 1)


def held_out(doc_id, of: int, remainder: int):
    """Whether crc32 of doc_id as text leaves ``remainder`` modulo ``of``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % of == remainder


def fit_language_model(docs: DataFrame, most_rows: int = MOST_TRAINING_ROWS) -> LanguageModel:
    """Filters from rows ``(doc_id, text, lang)``; the n-gram counts of at most
    ``most_rows`` rows per language are summed on the executors into one sparse array
    of at most 2^20 counters per language, which the driver reads one at a time."""
    known = docs.where("lang is not null and text is not null")
    sizes = known.groupBy("lang").count().orderBy("lang").collect()
    seen = [r["lang"] for r in sizes]
    if not seen:
        return LanguageModel([], np.zeros((1, 1 << CODE_BITS), np.uint8), np.zeros(0))
    # hashes are uniform: a threshold per language keeps about most_rows of its rows
    tops = [int(-(1 << 63) + min(1.0, most_rows / r["count"]) * ((1 << 64) - 1)) for r in sizes]
    least = docs.sparkSession.createDataFrame(
        [(x, min(top, (1 << 63) - 1)) for x, top in zip(seen, tops, strict=True)], "lang string, top long"
    )
    rows = known.select("lang", F.xxhash64("doc_id").alias("h"), F.col("text").cast("binary").alias("text"))
    rows = rows.join(F.broadcast(least), "lang").where("h <= top").select("lang", "text")

    def pack(x: str, c: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(c)
        return pa.RecordBatch.from_arrays(
            [pa.array([x]), pa.array([at.astype("<i4").tobytes()], pa.binary()), pa.array([c[at].astype("<i8").tobytes()], pa.binary())],
            ["lang", "codes", "counts"],
        )

    # rows come by language, so a task holds the counters of one language at a time
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, c = None, None
        for batch in batches:
            by: dict[str, list[bytes]] = {}
            for x, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by.setdefault(x, []).append(clean(t))
            for x, texts in by.items():
                if x != now:
                    if now is not None:
                        yield pack(now, c)
                    now, c = x, np.zeros(1 << CODE_BITS, np.int64)
                c += np.bincount(gram_codes(b"".join(texts)), minlength=1 << CODE_BITS)
        if now is not None:
            yield pack(now, c)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, s = None, None
        for batch in batches:
            for x, a, c in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if x != now:
                    if now is not None:
                        yield pack(now, s)
                    now, s = x, np.zeros(1 << CODE_BITS, np.int64)
                s[np.frombuffer(a, "<i4")] += np.frombuffer(c, "<i8")
        if now is not None:
            yield pack(now, s)

    schema = "lang string, codes binary, counts binary"
    packed = rows.sortWithinPartitions("lang").mapInArrow(count, schema)
    # one sparse array per task and language, summed by language
    sums = materialise(packed.repartition(len(seen), "lang").sortWithinPartitions("lang").mapInArrow(total, schema), "lang-counts")

    def shares(languages: list[str]) -> Iterator[tuple[str, np.ndarray]]:
        """Each language's share per n-gram code, dense, one language at a time."""
        of = sums if languages is seen else sums.where(F.col("lang").isin(languages))
        for r in of.toLocalIterator():
            c = np.zeros(1 << CODE_BITS)
            c[np.frombuffer(r["codes"], "<i4")] = np.frombuffer(r["counts"], "<i8")
            yield r["lang"], c / max(c.sum(), 1)

    return build_filters(seen, shares)


def build_filters(languages: list[str], shares: Callable[[list[str]], Iterator[tuple[str, np.ndarray]]]) -> LanguageModel:
    """Filters from each language's shares, read once for the best ones and once by words of 64 languages."""
    best = np.zeros(1 << CODE_BITS)
    for _, share in shares(languages):
        np.maximum(best, share, out=best)
    where = positions(np.arange(1 << CODE_BITS))
    masks, filled = [], []
    for start in range(0, len(languages), WORD_BITS):
        word = languages if len(languages) <= WORD_BITS else languages[start:start + WORD_BITS]
        index = {x: i for i, x in enumerate(word)}
        slices = np.zeros(1 << SLOT_BITS, np.uint64)
        for x, share in shares(word):
            on = np.flatnonzero((share >= LEAST_SHARE) & (share >= LEAST_PART * best) & (share > 0))
            for p in where:
                slices[p[on]] |= np.uint64(1 << index[x])
        mask = slices[where[0]]
        for p in where[1:]:
            mask &= slices[p]
        masks.append(mask.astype(np.min_scalar_type((1 << len(languages)) - 1) if len(languages) <= WORD_BITS else np.uint64))
        filled += [np.mean((slices >> np.uint64(i)) & np.uint64(1)) for i in range(len(word))]
    return LanguageModel(languages, np.stack(masks), np.array(filled) ** POSITIONS)


def identify(docs: DataFrame, model: LanguageModel, columns: tuple[str, ...] | list[str] = ("doc_id",),
             text: str = "text") -> DataFrame:
    """Rows of ``docs`` with ``columns``, lang_pred and lang_score (0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.masks, model.false_rates))  # 1 to 8 MB per 64 languages whatever the input
    columns = list(columns)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = LanguageModel(*shared.value)
        for batch in batches:
            texts = [t or b"" for t in batch.column(len(columns)).to_pylist()]
            letters = batch.column(len(columns) + 1).to_pylist()
            pred, score = ["und"] * len(texts), [0.0] * len(texts)
            if m.languages and texts:
                s = m.score(texts)
                best = s.argmax(1)
                for i, (k, ok) in enumerate(zip(best, letters, strict=True)):
                    if ok:
                        pred[i], score[i] = m.languages[k], float(s[i, k])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(columns))), pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                [*columns, "lang_pred", "lang_score"],
            )

    kept = docs.select(*columns)
    return docs.select(
        *columns, F.col(text).cast("binary").alias("_text"), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("_letter")
    ).mapInArrow(predict, kept.schema.add("lang_pred", "string").add("lang_score", "double"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_language_model(docs.where(~F.coalesce(held_out(F.col("doc_id"), 5, 0), F.lit(False))))
    out = identify(docs, model)
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id"), 5, 0), F.lit(False)).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def crc_remainder(doc_id: int, of: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % of
