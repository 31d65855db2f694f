"""Operator 2: removal of repeated 50-byte strings by bucket-pointer refinement.

Every 50-byte string holds 33 grams of 18 bytes; the least gram hash is the string's
bucket, wherever it stands.  A cell is a run of neighbouring strings of one bucket.

1. Equal texts become one (of the smallest doc_id); the other copies go whole.
2. Initial q-gram buckets, refined at once by the gram bucket 16 bytes to the right or
   to the left: of a string's 32 bytes beside the gram, 16 stand on one side.  Only
   these 34-byte buckets are packed and dealt; those of one document drop out.  A key
   that several documents of a batch have is known there and sent once.
3. Refinement: the remaining cells are grouped by content.  A cell that also stands
   in a smaller document is settled at once, with all its strings; so is a bucket that
   has one cell content only, which covers the inside of copied passages.
4. Refinement by later offsets: the strings of each content's cells in its first
   document, in buckets that have several contents, get the identifiers of the gram buckets at offsets 0, 16
   and 32, which together cover the 50 bytes.  Equal identifiers are equal strings;
   the smallest document that has them keeps them.
5. The settled ranges of each text are cut out.

A bucket's identifier is the gram's 64-bit hash, so pointers to later offsets need no
global ranks; cells are told apart by 128 bits, single strings by 64 bits of their
pointers.  Keys that many documents share are answered within a batch where possible.

Defined cases: null text is the empty text; texts under 50 bytes lose nothing; rows
of null doc_id lose nothing and are no source; rows that repeat id and text fare
alike; of different texts under one doc_id the one of smallest digest is the document,
the others lose nothing; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourcast.llm.common import materialise, mix64, shared_path, table

LENGTH = 50
GRAM = 18
SIDE = 16
GRAMS = LENGTH - GRAM + 1
#: Offsets whose grams cover a string.
POINTERS = (0, SIDE, 2 * SIDE)
SEGMENT = 1 << 17
PACK_BYTES = 16 << 20
BUCKET_BYTES = 32 << 20
#: Two keys of about 8 bytes for a cell of about 17 strings.
PACKED_SHARE = 1.0
_ODD = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(buffer: bytes) -> np.ndarray:
    """Hash of the 18 bytes at each place."""
    n = len(buffer) - GRAM + 1
    a, b = (np.ndarray(n, "<u8", buffer, at, (1,)) for at in (0, 8))
    c = np.ndarray(n, "<u2", buffer, 16, (1,))
    h = a * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(32)
    h += b * np.uint64(0x165667B19E3779F9)
    h += c * _ODD
    return mix64(h)


def least_of(h: np.ndarray) -> np.ndarray:
    """Least hash of the 33 grams from each place."""
    m = h
    for step in (1, 2, 4, 8, 16):
        m = np.minimum(m[:-step], m[step:])
    return np.minimum(m[:-1], m[1:])


def segments(texts: list[bytes]) -> Iterator[tuple[bytes, list[tuple[int, int, int, int]]]]:
    """Buffers of about 128 KB (their arrays stay in cache) with their parts ``(text, place in the text, place in
    the buffer, strings)``; longer texts are cut, overlapping by 49 bytes."""
    buffer, parts, size = [], [], 0
    for i, t in enumerate(texts):
        for at in range(0, max(0, len(t) - LENGTH + 1), SEGMENT):
            piece = t[at:at + SEGMENT + LENGTH - 1]
            parts.append((i, at, size, len(piece) - LENGTH + 1))
            buffer.append(piece)
            size += len(piece)
            if size >= SEGMENT:
                yield b"".join(buffer), parts
                buffer, parts, size = [], [], 0
    if parts:
        yield b"".join(buffer), parts


def cells(texts: list[bytes], content: bool = False) -> Iterator[tuple[np.ndarray, ...]]:
    """Per buffer, of each cell: text, first and last string (places in the text) and
    bucket, then the 34-byte buckets to the right and left as pairs (cell, key), and
    with ``content`` a hash of the cell's bytes."""
    for buffer, parts in segments(texts):
        h = gram_hashes(buffer)
        m = least_of(h)
        part = np.array(parts)
        index = np.arange(part[:, 3].sum())
        place = index + np.repeat(part[:, 2] - np.cumsum(part[:, 3]) + part[:, 3], part[:, 3])
        new = np.ones(len(place), bool)
        new[1:] = (m[place[1:]] != m[place[:-1]]) | (place[1:] != place[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(place)) - 1
        own = np.repeat(np.arange(len(part)), part[:, 3])[first]
        shift = part[own, 1] - part[own, 2]
        lo, hi = place[first], place[last]
        same = h[lo[:, None] + np.arange(GRAMS)] == m[lo][:, None]
        at = lo + same.argmax(1)
        cell, gram = np.arange(len(lo)), at
        # where the least gram stands more than once in a cell, all its places count
        again = np.flatnonzero((lo + GRAMS - 1 - same[:, ::-1].argmax(1) > at) | (hi > at))
        if len(again):
            more = [lo[i] + np.flatnonzero(h[lo[i]:hi[i] + GRAMS] == m[lo[i]]) for i in again]
            cell = np.concatenate([cell, np.repeat(again, [len(x) for x in more])])
            gram = np.concatenate([gram, *more])
        right, left = gram + SIDE <= hi[cell] + GRAMS - 1, gram - SIDE >= lo[cell]
        keyed = np.concatenate([cell[right], cell[left]])
        g = np.concatenate([gram[right], gram[left] - SIDE])
        side = np.repeat(np.array([1, 2], np.uint64), [right.sum(), left.sum()])
        keys = mix64(mix64(h[g] * _ODD + side) + h[g + SIDE])
        out = (part[own, 0], lo + shift, hi + shift, m[lo], keyed, keys)
        if content:
            powers = np.full(len(h) + 1, _ODD)
            powers[0] = 1
            powers = np.multiply.accumulate(powers)
            inverse = np.full(len(h) + 1, np.uint64(pow(int(_ODD), -1, 1 << 64)))
            inverse[0] = 1
            inverse = np.multiply.accumulate(inverse)
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * powers[:-1], dtype=np.uint64)])
            body = (sums[hi + GRAMS] - sums[lo]) * inverse[lo]
            out += (mix64(body + (hi - lo).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)),)
        yield out


def packed_buckets(texts: DataFrame, groups: int) -> DataFrame:
    """``(r, keys, ids, counts)``: a batch's distinct (key, document) pairs of remainder r,
    by document.  Pairs of keys that several documents of the batch have go in a group
    of their own, r < 0, that needs no look at others; one pair of each is sent too."""

    def rows(r: np.ndarray, key: np.ndarray, ids: np.ndarray) -> list[tuple]:
        order = np.lexsort((ids, r))
        r, key, ids = r[order], key[order], ids[order]
        out = []
        for part in np.split(np.arange(len(r)), np.flatnonzero(np.diff(r)) + 1) if len(r) else []:
            at, counts = np.unique(ids[part], return_counts=True)
            out.append((int(r[part[0]]), key[part].astype("<u4").tobytes(), at.astype("<i8").tobytes(), counts.astype("<u4").tobytes()))
        return out

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            found = [(own[keyed], keys) for own, _, _, _, keyed, keys in cells(batch.column(1).to_pylist())]
            if not found:
                continue
            own, keys = (np.concatenate(x) for x in zip(*found, strict=True))
            own = ids[own]
            order = np.lexsort((own, keys))
            own, keys = own[order], keys[order]
            new = np.append(True, (keys[1:] != keys[:-1]) | (own[1:] != own[:-1]))
            own, keys = own[new], keys[new]
            first = np.append(True, keys[1:] != keys[:-1])
            many = np.repeat(np.add.reduceat(np.ones(len(keys), int), np.flatnonzero(first)) > 1, np.diff(np.append(np.flatnonzero(first), len(keys))))
            r, key = (keys % np.uint64(groups)).astype(np.int64), keys >> np.uint64(32)
            known = np.full(int(many.sum()), -1 - random.getrandbits(60))
            r_, *blobs = zip(*(rows(r[first], key[first], own[first]) + rows(known, key[many], own[many])), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(r_, pa.int64()), *(pa.array(b, pa.binary()) for b in blobs)], ["r", "keys", "ids", "counts"])

    return texts.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        pack, "r long, keys binary, ids binary, counts binary"
    )


def shared_buckets(packed: DataFrame) -> DataFrame:
    """``(doc_id, keys)``: each document's buckets that another document has too."""

    def find(rows: pa.Table) -> pa.Table:
        keys, ids, counts = (np.frombuffer(b"".join(rows.column(c).to_pylist()), t) for c, t in (("keys", "<u4"), ("ids", "<i8"), ("counts", "<u4")))
        ids = np.repeat(ids, counts)
        if rows.column("r")[0].as_py() >= 0:
            order = np.argsort(keys, kind="stable")
            keys, ids = keys[order], ids[order]
            starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            many = np.minimum.reduceat(ids, starts) != np.maximum.reduceat(ids, starts)
            keep = np.repeat(many, np.diff(np.append(starts, len(keys))))
            keys, ids = keys[keep], ids[keep]
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "key": pa.array(keys.view(np.int32))})

    return packed.groupBy("r").applyInArrow(find, "doc_id long, key int").groupBy("doc_id").agg(F.collect_list("key").alias("keys"))


def candidate_cells(texts: DataFrame, shared: DataFrame) -> DataFrame:
    """``(bucket, cell, doc_id, lo, hi)`` of the cells in shared buckets."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, t, keys in zip(*(batch.column(k) for k in range(3)), strict=True):
                i, t, keys = i.as_py(), t.as_py(), keys.values.to_numpy().view(np.uint32)
                for _, lo, hi, bucket, keyed, key, cell in cells([t], content=True):
                    ok = np.zeros(len(lo), bool)
                    ok[keyed[np.isin((key >> np.uint64(32)).astype("<u4"), keys)]] = True
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(bucket[ok].view(np.int64)), pa.array(cell[ok].view(np.int64)), pa.array(np.full(ok.sum(), i, np.int64)),
                         pa.array(lo[ok].astype(np.int32)), pa.array(hi[ok].astype(np.int32))],
                        ["bucket", "cell", "doc_id", "lo", "hi"],
                    )

    return texts.join(shared, "doc_id").select("doc_id", F.col("text").cast("binary").alias("text"), "keys").mapInArrow(
        emit, "bucket long, cell long, doc_id long, lo int, hi int"
    )


def pointer_strings(texts: DataFrame, ranges: DataFrame) -> DataFrame:
    """``(pointers, doc_id, place, known)`` of each string in ``ranges(doc_id, ranges)``;
    known: a smaller document of the same buffer has it."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts_ = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            lists = batch.column(2)
            flat, offsets = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            los, his = flat.field("lo").to_numpy(), flat.field("hi").to_numpy()
            for buffer, parts in segments(texts_):
                h = gram_hashes(buffer)
                wanted = np.zeros(len(buffer) + 1, np.int32)
                for i, at, start, n in parts:
                    lo, hi = los[offsets[i]:offsets[i + 1]] - at, his[offsets[i]:offsets[i + 1]] - at
                    ok = (hi >= 0) & (lo < n)
                    np.add.at(wanted, start + np.maximum(lo[ok], 0), 1)
                    np.add.at(wanted, start + np.minimum(hi[ok], n - 1) + 1, -1)
                place = np.flatnonzero(np.cumsum(wanted) > 0)
                p = np.zeros(len(place), np.uint64)
                for o in POINTERS:
                    p = mix64(p * _ODD + h[place + o])
                part = np.array(parts)
                own = np.searchsorted(part[:, 2], place, "right") - 1
                place, own = place - part[own, 2] + part[own, 1], ids[part[own, 0]]
                order = np.lexsort((own, p))
                p, own, place = p[order], own[order], place[order]
                starts = np.flatnonzero(np.append(True, p[1:] != p[:-1])) if len(p) else np.zeros(0, int)
                known = own > np.repeat(own[starts], np.diff(np.append(starts, len(p))))
                # rows that are known to go need no company: any other key will do
                p[known] = mix64(p[known] + place[known].astype(np.uint64) + own[known].astype(np.uint64) * _ODD)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p.view(np.int64)), pa.array(own), pa.array(place.astype(np.int32)), pa.array(known)], ["pointers", "doc_id", "place", "known"]
                )

    return texts.join(ranges, "doc_id").select("doc_id", F.col("text").cast("binary").alias("text"), "ranges").mapInArrow(
        emit, "pointers long, doc_id long, place int, known boolean"
    )


def cut_out(text: bytes, los: np.ndarray, his: np.ndarray) -> tuple[bytes, int, int]:
    """What is left of ``text`` without the strings that start in the ranges, the bytes
    removed, and the runs removed."""
    edge = np.zeros(len(text) + 1, np.int64)
    np.add.at(edge, los, 1)
    np.add.at(edge, his + LENGTH, -1)
    gone = np.cumsum(edge)[:-1] > 0
    runs = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1])) if len(gone) else 0
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), int(gone.sum()), runs


def remaining(texts: DataFrame, ranges: DataFrame) -> DataFrame:
    """Per text with ``ranges(doc_id, ranges)``: doc_id, removed, spans, kept (binary)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, t, r in zip(*(batch.column(k) for k in range(3)), strict=True):
                flat = r.values
                kept, removed, spans = cut_out(t.as_py(), flat.field("lo").to_numpy(), flat.field("hi").to_numpy())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i.as_py()]), pa.array([removed]), pa.array([spans]), pa.array([kept], pa.binary())], ["doc_id", "removed", "spans", "kept"]
                )

    return texts.join(ranges, "doc_id").select("doc_id", F.col("text").cast("binary").alias("text"), "ranges").mapInArrow(
        emit, "doc_id long, removed long, spans long, kept binary"
    )


def repeated_ranges(texts: DataFrame, size: int) -> DataFrame:
    """``(doc_id, ranges)``: the strings of each text that a smaller document has, as ranges of their starts."""
    groups = max(1, -(-int(size * PACKED_SHARE) // PACK_BYTES))
    shared = materialise(shared_buckets(packed_buckets(texts, groups)), "shared-buckets")
    # one shuffle by bucket serves both: is a content in a smaller document, has the bucket several
    bucket = Window.partitionBy("bucket")
    found = (
        candidate_cells(texts, shared).withColumn("open", F.min("cell").over(bucket) < F.max("cell").over(bucket))
        .withColumn("settled", F.col("doc_id") > F.min("doc_id").over(Window.partitionBy("bucket", "cell")))
    )
    marked = materialise(found.where("settled or open").select("doc_id", "lo", "hi", "settled"), "marked-cells")
    settled = marked.where("settled").select("doc_id", "lo", "hi")
    # written first: a grouped table's partitioning would make the join move the bucketed texts
    open_cells = materialise(
        marked.where("not settled").groupBy("doc_id").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges")), "open-cells"
    )
    least = F.min("doc_id").over(Window.partitionBy("pointers"))
    refined = (
        pointer_strings(texts, open_cells).withColumn("least", least).where("known or doc_id > least")
        .select("doc_id", F.col("place").alias("lo"), F.col("place").alias("hi"))
    )
    return settled.union(refined).groupBy("doc_id").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text (null if untouched)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = docs.select("doc_id", text.alias("text"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))
    rows = materialise(docs.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "texts-rows")
    size = rows.agg(F.sum("n_bytes")).first()[0] or 0
    one = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min("digest").alias("digest"), F.max("n_bytes").alias("n_bytes"))
    firsts = materialise(one.groupBy("digest").agg(F.min("doc_id").alias("doc_id")), "firsts")
    n = max(2 * spark.sparkContext.defaultParallelism, -(-size // BUCKET_BYTES))
    own = firsts.select("doc_id", F.col("digest").alias("d")).repartition(n, "doc_id")
    # bucketed by doc_id, so that later joins move what they add and not the texts
    name = f"repeat_texts_{random.getrandbits(63):x}"
    unique = docs.where("doc_id is not null").repartition(n, "doc_id").join(own, "doc_id").where("digest <= d and digest >= d")
    unique.select("doc_id", "text").dropDuplicates(["doc_id"]).write.bucketBy(n, "doc_id").option(
        "path", shared_path(spark, "repeat-texts")
    ).option("compression", "zstd").saveAsTable(name)
    texts = spark.table(name)
    ranges = materialise(repeated_ranges(texts, size), "ranges")
    left = materialise(
        remaining(texts, ranges).select("doc_id", "removed", "spans", F.sha2("kept", 256).alias("sha"), F.col("kept").cast("string").alias("kept_text")),
        "remaining",
    )
    marked = rows.join(firsts.select("digest", F.col("doc_id").alias("least")), "digest", "left")
    out = marked.join(left.withColumn("least", F.col("doc_id")), ["doc_id", "least"], "left")
    copy = F.coalesce((F.col("doc_id") > F.col("least")) & (F.col("n_bytes") >= LENGTH), F.lit(False))
    return out.select(
        "doc_id", "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("sha", F.lower(F.hex("digest")))).alias("kept_sha256"),
        F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"),
    )


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text")
