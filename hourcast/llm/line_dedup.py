"""Operator 11: line dedup by a sharded minimal perfect hash.

A line's key is the line without outer ASCII white space, A-Z lower-cased; it is
known by its 128-bit hash.  Keys that stand in at least ``least_docs`` documents lose
all their lines.

1. Documents are written once to the shared folder in *chunks* of about
   ``CHUNK_LINES`` lines, each row with the packed hashes of its lines.
2. The hashes, counted once a document and summed per batch before the shuffle, are
   dealt over shards of about ``SHARD_KEYS`` distinct keys.  Each shard becomes one row
   of arrays: the bit levels of a minimal perfect hash, and in slot order a 16-bit
   fingerprint and a count that stops at ``least_docs``: some 3 to 6 bytes a key.
3. A chunk sends each shard one packed row of its distinct hashes and gets back those
   that are frequent.  A shard's task holds that shard's arrays alone and probes a whole
   batch at once.  No row per line is shuffled, and lines are never joined.
4. Each chunk's answers meet its documents in one pass sorted by (chunk, answers first).

Hashes are spread evenly whatever the text, and a key is one row a batch before any
shuffle, so a line that stands in a third of all documents is no hot spot.  Every
intermediate is a written table or derives from one by content, so a lost executor
changes nothing.

Defined cases: null and empty text are one empty line, kept; keys of fewer than
``least_chars`` code points are kept; a key counts once a row of ``docs``, so rows that
repeat a doc_id are documents of their own; null ids pass through; an empty table gives
no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.llm.common import LOWER, LOWER_BYTES, UPPER, materialise, mix64, table

LEAST_DOCS = 10
LEAST_CHARS = 1
#: Lines of one chunk of documents (the last document may exceed it).
CHUNK_LINES = 1 << 15
#: Distinct keys that one shard's task indexes.
SHARD_KEYS = 1 << 20
#: Slots per key at each level of the perfect hash.
GAMMA = 1.5
MOST_LEVELS = 128
SPACE = b" \t\n\x0b\x0c\r"
WIDTH = 16
NO_KEY = bytes(WIDTH)


# --------------------------------------------------------------------------- the perfect hash

def _place(h: np.ndarray, level: int, size: int) -> np.ndarray:
    """Place of each key ``h[:, 0:2]`` among ``size`` at one level."""
    with np.errstate(over="ignore"):
        x = mix64(h[:, 0] + np.uint64(0x9E3779B97F4A7C15) * np.uint64(level + 1))
        return (mix64(x ^ h[:, 1]) % np.uint64(size)).astype(np.int64)


def _print(h: np.ndarray) -> np.ndarray:
    return (h[:, 1] >> np.uint64(48)).astype(np.uint16)


@dataclass
class Shard:
    """Minimal perfect hash of a shard's keys with their fingerprints and counts."""

    sizes: list[int]
    bits: np.ndarray
    prints: np.ndarray
    counts: np.ndarray

    @classmethod
    def build(cls, h: np.ndarray, counts: np.ndarray, top: int) -> Shard:
        """From distinct keys ``h`` (n x 2); counts stop at ``top``."""
        sizes, levels, left = [], [], h
        while len(left):
            if len(sizes) == MOST_LEVELS:
                raise ValueError("the keys of a shard are not distinct")
            size = max(64, int(GAMMA * len(left)))
            at = _place(left, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            left = left[~alone[at]]
        bits = np.concatenate(levels) if levels else np.zeros(0, bool)
        out = cls(sizes, bits, np.zeros(len(h), np.uint16), np.zeros(len(h), np.min_scalar_type(top)))
        slot = out.slots(h)
        out.prints[slot] = _print(h)
        out.counts[slot] = np.minimum(counts, top)
        return out

    def slots(self, h: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 where no level holds it."""
        if not hasattr(self, "_ranks"):
            self._ranks = np.cumsum(self.bits, dtype=np.int32) - 1
        out = np.full(len(h), -1, np.int64)
        open_, start = np.arange(len(h)), 0
        for level, size in enumerate(self.sizes):
            at = _place(h[open_], level, size) + start
            hit = self.bits[at]
            out[open_[hit]] = self._ranks[at[hit]]
            open_ = open_[~hit]
            start += size
            if not len(open_):
                break
        return out

    def count(self, h: np.ndarray) -> np.ndarray:
        """Documents of each key up to the top count; 0 for keys that the fingerprint tells apart."""
        if not len(self.prints):
            return np.zeros(len(h), np.int64)
        slot = self.slots(h)
        known = (slot >= 0) & (self.prints[slot] == _print(h))
        return np.where(known, self.counts[slot], 0)

    def row(self, shard: int) -> list:
        return [shard, self.sizes, np.packbits(self.bits).tobytes(), self.prints.tobytes(), self.counts.tobytes()]

    @classmethod
    def read(cls, sizes: list[int], bits: bytes, prints: bytes, counts: bytes) -> Shard:
        n = len(prints) // 2
        return cls(
            sizes, np.unpackbits(np.frombuffer(bits, np.uint8), count=sum(sizes)).astype(bool), np.frombuffer(prints, np.uint16),
            np.frombuffer(counts, f"u{len(counts) // n}" if n else np.uint8),
        )


def _keys(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, "<u8").reshape(-1, 2)


def _distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of ``h`` and how often each occurs."""
    if not len(h):
        return h, np.zeros(0, np.int64)
    h = h[np.lexsort((h[:, 1], h[:, 0]))]
    new = np.concatenate([[True], (h[1:] != h[:-1]).any(1)])
    at = np.flatnonzero(new)
    return h[at], np.diff(np.append(at, len(h)))


# --------------------------------------------------------------------------- jobs

def hashed_lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """Rows ``(chunk, doc_id, text, hashes)`` of ``docs(doc_id, text)``: text in UTF-8, 16 bytes of hash a line
    (zeros where the key is too short).  To be written before use: the chunk numbers are those of this run's tasks."""
    doc_id = docs.schema["doc_id"].dataType.simpleString()

    def hash_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        chunk, n = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            chunks, hashes = [], []
            for text in batch.column(1).to_pylist():
                keys = [x.strip(SPACE) for x in text.translate(LOWER_BYTES).split(b"\n")]
                if least_chars <= 1:
                    packed = b"".join([xxh3_128_digest(k) if k else NO_KEY for k in keys])
                else:
                    packed = b"".join([xxh3_128_digest(k) if len(k.decode()) >= least_chars else NO_KEY for k in keys])
                if n and n + len(keys) > CHUNK_LINES:
                    chunk, n = chunk + 1, 0
                n += len(keys)
                chunks.append(chunk)
                hashes.append(packed)
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunks, pa.int64()), batch.column(0), batch.column(1), pa.array(hashes, pa.binary())],
                ["chunk", "doc_id", "text", "hashes"],
            )

    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(hash_, f"chunk long, doc_id {doc_id}, text binary, hashes binary")


def line_index(lines: DataFrame, shards: int, least_docs: int = LEAST_DOCS) -> DataFrame:
    """The index, a row per shard, of the ``hashes`` of :func:`hashed_lines`."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [_distinct(_keys(x))[0] for x in batch.column(0).to_pylist()]  # once a document
            h, n = _distinct(np.concatenate(parts) if parts else np.zeros((0, 2), "<u8"))
            real = h.any(1)
            h, n = h[real], n[real]
            yield pa.RecordBatch.from_arrays(
                [pa.array((h[:, 0] % np.uint64(shards)).astype(np.int64)), pa.array(h[:, 0].view("<i8")), pa.array(h[:, 1].view("<i8")),
                 pa.array(n.astype(np.int64))],
                ["shard", "a", "b", "n"],
            )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(shard: int, parts: list) -> pa.RecordBatch:
            h = np.stack([np.concatenate([p[i] for p in parts]).view("<u8") for i in (0, 1)], 1)
            row = Shard.build(h, np.concatenate([p[2] for p in parts]), least_docs).row(shard)
            types = [pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], INDEX_COLUMNS)

        now, parts = None, []
        for batch in batches:
            shard, a, b, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            edges = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]])
            for i, j in zip(edges[:-1], edges[1:], strict=True):
                if j > i:
                    if shard[i] != now:
                        if parts:
                            yield made(now, parts)
                        now, parts = int(shard[i]), []
                    parts.append((a[i:j].copy(), b[i:j].copy(), n[i:j].copy()))
        if parts:
            yield made(now, parts)

    rows = lines.select("hashes").mapInArrow(count, "shard long, a long, b long, n long")
    total = rows.repartition("shard").groupBy("shard", "a", "b").agg(F.sum("n").alias("n"))
    return total.sortWithinPartitions("shard").mapInArrow(build, INDEX)


INDEX = "shard long, sizes array<long>, bits binary, prints binary, counts binary"
INDEX_COLUMNS = ["shard", "sizes", "bits", "prints", "counts"]


def frequent_lines(lines: DataFrame, index: DataFrame, shards: int, least_docs: int = LEAST_DOCS) -> DataFrame:
    """Rows ``(chunk, hashes)``: the packed hashes of a chunk that the index counts ``least_docs`` times or more,
    a row per chunk and shard that has any.  ``lines`` may hold lines the index has not seen."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(chunk: int, parts: list[bytes]) -> pa.RecordBatch:
            h = _distinct(_keys(b"".join(parts)))[0]
            h = h[h.any(1)]
            shard = (h[:, 0] % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            h, shard = h[order], shard[order]
            names, at = np.unique(shard, return_index=True)
            ends = np.append(at, len(h))[1:]
            out = [h[i:j].tobytes() for i, j in zip(at, ends, strict=True)]
            return pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array([chunk] * len(out), pa.int64()), pa.array(out, pa.binary())], ["shard", "chunk", "hashes"]
            )

        now, parts = None, []
        for batch in batches:
            for chunk, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if chunk != now:
                    if parts:
                        yield packed(now, parts)
                    now, parts = chunk, []
                parts.append(x)
        if parts:
            yield packed(now, parts)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, arrays = None, None
        for batch in batches:
            shard = batch.column(0).to_numpy()
            chunk = batch.column(1)
            out_chunk, out = [], []
            edges = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]])
            for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if j > i and chunk[i].as_py() is None:  # a shard's arrays stand before its questions
                    held, arrays = int(shard[i]), Shard.read(*(batch.column(k)[i].as_py() for k in range(3, 7)))
                    i += 1
                if j <= i or held != shard[i]:
                    continue
                asked = batch.column(2).slice(i, j - i).to_pylist()
                h = _keys(b"".join(asked))
                common = arrays.count(h) >= least_docs
                ends = np.cumsum([len(x) // WIDTH for x in asked])
                for c, s, e in zip(chunk.slice(i, j - i).to_pylist(), np.append([0], ends[:-1]), ends, strict=True):
                    if common[s:e].any():
                        out_chunk.append(c)
                        out.append(h[s:e][common[s:e]].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out_chunk, pa.int64()), pa.array(out, pa.binary())], ["chunk", "hashes"])

    questions = lines.select("chunk", "hashes").mapInArrow(ask, "shard long, chunk long, hashes binary")
    both = questions.unionByName(index, allowMissingColumns=True).select("shard", "chunk", "hashes", *INDEX_COLUMNS[1:])
    return both.repartition("shard").sortWithinPartitions("shard", F.asc_nulls_first("chunk")).mapInArrow(answer, "chunk long, hashes binary")


def without_lines(lines: DataFrame, drop: DataFrame) -> DataFrame:
    """Rows ``(doc_id, n_lines, n_dropped, text)`` of ``lines`` without those whose hash ``drop(chunk, hashes)`` holds."""
    doc_id = lines.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, gone = None, set()
        for batch in batches:
            chunks, is_doc = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            texts, hashes = batch.column(3), batch.column(4).to_pylist()
            rows, n_lines, n_dropped, kept = [], [], [], []
            for i, (chunk, doc, packed) in enumerate(zip(chunks, is_doc, hashes, strict=True)):
                if chunk != now:
                    now, gone = chunk, set()
                cells = [packed[k:k + WIDTH] for k in range(0, len(packed), WIDTH)]
                if not doc:
                    gone.update(cells)
                    continue
                text = texts[i].as_py()
                out = [c in gone for c in cells]
                n = sum(out)
                if n:
                    text = b"\n".join([x for x, o in zip(text.split(b"\n"), out, strict=True) if not o])
                rows.append(i)
                n_lines.append(len(cells))
                n_dropped.append(n)
                kept.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(2).take(pa.array(rows, pa.int64())), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                ["doc_id", "n_lines", "n_dropped", "text"],
            )

    answers = drop.select("chunk", F.lit(False).alias("doc"), F.lit(None).cast(doc_id).alias("doc_id"), F.lit(None).cast("binary").alias("text"), "hashes")
    both = answers.union(lines.select("chunk", F.lit(True), "doc_id", "text", "hashes"))
    return both.repartition("chunk").sortWithinPartitions("chunk", "doc").mapInArrow(
        cut, f"doc_id {doc_id}, n_lines long, n_dropped long, text string"
    )


def drop_common_lines(docs: DataFrame, least_docs: int = LEAST_DOCS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, n_lines (before), n_dropped, text (the lines that stay, joined by newlines)."""
    lines = materialise(hashed_lines(docs, least_chars), "lines")
    n = lines.agg(F.sum(F.octet_length("hashes").cast("long"))).first()[0] or 0
    shards = max(1, -(-n // (WIDTH * SHARD_KEYS)))
    index = materialise(line_index(lines, shards, least_docs), "line-index")
    return without_lines(lines, frequent_lines(lines, index, shards, least_docs))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_common_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM l),
c AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= {LEAST_DOCS}),
m AS (SELECT k.*, c.key IS NOT NULL AS gone FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r, doc_id
"""
