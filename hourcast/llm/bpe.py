"""Operator 3: byte-level BPE encoding and decoding.

Texts are cut into words by the tokenizer's pattern.  Tasks number the words of a
chunk of documents and keep each document as a sequence of those numbers, so text is
read once and never shuffled.  The distinct words go through one Spark expression:
a higher-order ``aggregate`` over the word's bytes that merges, at each step, the
leftmost adjacent pair of lowest rank.  The ranks come from a table of all mergeable
pairs (a hash table without collisions in two arrays, since looking up a map scans it),
a scalar subquery: as literals its arrays were text of every version of the plan.  A
word's ids return to its chunks, where documents are put together; decoding concatenates
the ids' binary pieces.

Words longer than ``LONG_WORD`` bytes, for which a fold is quadratic, are merged with
a heap by the same rule.

Defined cases: null text is the empty text, with no tokens; texts are encoded whole;
rows of null doc_id are encoded too; repeated rows give repeated results; an empty
table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.llm.common import shared_path, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
LONG_WORD = 200
#: Bytes of text of a chunk, and chunks of which one group of a word's places may hold the numbers.
CHUNK_BYTES = 56 << 20
PLACES = 1024
#: A place is one long: the chunk's number, then this many bits for the word's number in it.
PLACE_BITS = 26
NONE = 2**31 - 1
_MULTIPLIERS = (7919, 613, 31, 1009)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def word_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a word: lowest-ranked adjacent pair first, the leftmost of equals."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    right, left, piece = list(range(1, n + 1)), list(range(-1, n - 1)), [word[i:i + 1] for i in range(n)]
    heap = [(r, i, word[i:i + 2]) for i in range(n - 1) if (r := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, both = heapq.heappop(heap)
        j = right[i]
        if not piece[i] or j >= n or piece[i] + piece[j] != both:
            continue  # one of the two has been merged since
        piece[i], piece[j], right[i] = both, b"", right[j]
        if right[i] < n:
            left[right[i]] = i
        for a in (left[i], i):
            if a >= 0 and right[a] < n and (r := ranks.get(p := piece[a] + piece[right[a]])) is not None:
                heapq.heappush(heap, (r, a, p))
    return [ranks[p] for p in piece if p]


def mergeable_pairs(ranks: dict[bytes, int]) -> dict[tuple[int, int], int]:
    """(left id, right id) -> id of the two pieces together."""
    out = {}
    for piece, r in ranks.items():
        for cut in range(1, len(piece)):
            a, b = ranks.get(piece[:cut]), ranks.get(piece[cut:])
            if a is not None and b is not None:
                out[a, b] = r
    return out


class RankTable:
    """The pair table as column expressions.

    A pair's group has a shift that sends the group's pairs to free slots of the
    key and value arrays; a lookup reads the shift, then compares one key."""

    def __init__(self, spark: SparkSession, ranks: dict[bytes, int]):
        if max(ranks.values()) >= 1 << 16 or any(bytes([i]) not in ranks for i in range(256)):
            raise ValueError("a byte-level vocabulary of at most 65536 entries is needed")
        pairs = mergeable_pairs(ranks)
        self.slots = 1 << max(8, (5 * len(pairs) // 4).bit_length())
        self.groups = self.slots // 2
        m = _MULTIPLIERS
        by: dict[int, list[tuple[int, int]]] = {}
        for a, b in pairs:
            by.setdefault((a * m[2] + b * m[3]) % self.groups, []).append((a, b))
        keys, values, shifts = [-1] * self.slots, [0] * self.slots, [0] * self.groups
        for g, members in sorted(by.items(), key=lambda x: -len(x[1])):
            for shift in range(self.slots):
                at = [(a * m[0] + b * m[1] + shift) % self.slots for a, b in members]
                if len(set(at)) == len(at) and all(keys[s] < 0 for s in at):
                    break
            else:
                raise ValueError("no room for a group of pairs")
            shifts[g] = shift
            for s, (a, b) in zip(at, members, strict=True):
                keys[s], values[s] = (a << 16) + b, pairs[a, b]
        arrays = pa.table({
            "keys": pa.array([keys], pa.list_(pa.int64())), "values": pa.array([values], pa.list_(pa.int32())),
            "shifts": pa.array([shifts], pa.list_(pa.int32())),
        })
        #: One row, read by the driver once a query and sent with its tasks, as the literals were.
        self.arrays = spark.createDataFrame(arrays).select(F.struct("keys", "values", "shifts")).scalar()
        self.bytes = F.from_json(F.lit(json.dumps([ranks[bytes([i])] for i in range(256)])), "array<int>")
        #: Entries that merges do not reach: a word equal to one is that one id.
        self.irregular = {p: r for p, r in ranks.items() if len(p) > 1 and merge_word(p, _Without(ranks, p)) != [r]}

    def rank(self, t: Column, a: Column, b: Column) -> Column:
        """Id (and rank) of the merged pair, or NONE; ``t`` holds the table's arrays."""
        m = _MULTIPLIERS
        shift = F.get(t["shifts"], F.pmod(a * m[2] + b * m[3], F.lit(self.groups)))
        slot = F.pmod(a * m[0] + b * m[1] + shift, F.lit(self.slots))
        return bind(slot, lambda s: F.when(
            F.get(t["keys"], s) == F.shiftleft(a.cast("bigint"), 16) + b, F.get(t["values"], s)
        ).otherwise(F.lit(NONE)))

    def fold(self, word: Column, table: Column) -> Column:
        """``array<int>`` of ids of a binary ``word``; ``table`` is a column of :attr:`arrays`."""
        return bind(table, lambda t: self._fold(word, t))

    def _fold(self, word: Column, t: Column) -> Column:
        no_pair = F.array().cast("array<struct<a: int, b: int>>")
        chars = F.decode(word, "ISO-8859-1")  # one character for each byte
        ids = F.transform(F.split(chars, ""), lambda c: F.get(self.bytes, F.ascii(c)))

        def start(ids: Column) -> Column:
            after = F.slice(ids, 2, F.greatest(F.size(ids) - 1, F.lit(0)))
            ranks = F.zip_with(ids, after, lambda a, b: F.when(b.isNull(), F.lit(NONE)).otherwise(self.rank(t, a, b)))
            return F.struct(ids.alias("ids"), ranks.alias("ranks"))

        def step(state: Column, _: Column) -> Column:
            ids, ranks = state["ids"], state["ranks"]

            def merged(low: Column, at: Column) -> Column:
                left = F.when(at > 1, F.array(F.struct(F.get(ids, at - 2).alias("a"), low.alias("b")))).otherwise(no_pair)
                right = F.array(F.struct(low.alias("a"), F.get(ids, at + 1).alias("b")))
                beside = F.transform(F.concat(left, right), lambda p: F.when(p["b"].isNull(), F.lit(NONE)).otherwise(self.rank(t, p["a"], p["b"])))
                rest = lambda x: F.slice(x, at + 2, F.size(ids))
                return F.struct(
                    F.concat(F.slice(ids, F.lit(1), at - 1), F.array(low), rest(ids)).alias("ids"),
                    F.concat(F.slice(ranks, F.lit(1), F.greatest(at - 2, F.lit(0))), beside, rest(ranks)).alias("ranks"),
                )

            return bind(F.array_min(ranks), lambda low: F.when(low == NONE, state).otherwise(
                bind(F.array_position(ranks, low).cast("int"), lambda at: merged(low, at))
            ))

        steps = F.sequence(F.lit(2), F.greatest(F.octet_length(word), F.lit(2)))
        out = F.aggregate(steps, bind(ids, start), step, lambda state: state["ids"])
        for piece, r in self.irregular.items():
            out = F.when(word == F.lit(piece), F.array(F.lit(r))).otherwise(out)
        return out


class _Without:
    """Ranks without one entry: shows whether merges alone reach it."""

    def __init__(self, ranks: dict[bytes, int], piece: bytes):
        self.ranks, self.piece = ranks, piece

    def __contains__(self, p: bytes) -> bool:
        return p != self.piece and p in self.ranks

    def get(self, p: bytes):
        return self.ranks.get(p)

    def __getitem__(self, p: bytes) -> int:
        return self.ranks[p]


def bind(value: Column, f) -> Column:
    """``f`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), f), 0)


def pack(numbers: np.ndarray) -> bytes:
    """Compressed 32-bit numbers, byte planes apart."""
    planes = numbers.astype("<i4", copy=False).view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<i4").ravel()


def chunked(docs: DataFrame, pattern: str) -> DataFrame:
    """A row per chunk of documents: chunk, doc_ids, lengths (words of each), sequence, words."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find = regex.compile(pattern).findall

        class Numbers(dict):
            def __missing__(self, word: str) -> int:
                self[word] = n = len(self)
                return n

        def row(chunk: int, ids: list, lengths: list[int], parts: list[np.ndarray], numbers: Numbers) -> pa.RecordBatch:
            seq = np.concatenate(parts)
            parts.clear()
            order = np.argsort(-np.bincount(seq, minlength=len(numbers)), kind="stable")  # frequent words get small numbers
            place = np.empty(len(order), np.int32)
            place[order] = np.arange(len(order), dtype=np.int32)
            words = list(numbers)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([chunk]), pa.array([ids], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int32())),
                    pa.array([pack(place[seq])], pa.binary()), pa.array([[words[i].encode() for i in order]], pa.list_(pa.binary())),
                ],
                ["chunk", "doc_ids", "lengths", "sequence", "words"],
            )

        chunk = TaskContext.get().partitionId() << 20
        ids, lengths, parts, numbers, size = [], [], [], Numbers(), 0
        for batch in batches:
            for i, t in zip(batch.column(0), batch.column(1), strict=True):
                text = t.as_py() or ""
                found = find(text)
                ids.append(i.as_py())
                lengths.append(len(found))
                parts.append(np.fromiter(map(numbers.__getitem__, found), np.int32, len(found)))
                size += len(text)
                if size >= CHUNK_BYTES:
                    yield row(chunk, ids, lengths, parts, numbers)
                    chunk += 1
                    ids, lengths, parts, numbers, size = [], [], [], Numbers(), 0
        if ids:
            yield row(chunk, ids, lengths, parts, numbers)

    return docs.select("doc_id", "text").mapInArrow(
        cut, "chunk long, doc_ids array<long>, lengths array<int>, sequence binary, words array<binary>"
    )


def long_ids(words: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """Ids of ``words(word, places)`` by the heap."""
    shared = words.sparkSession.sparkContext.broadcast(ranks)  # the vocabulary, whatever the input

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [merge_word(w, shared.value) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(ids, pa.list_(pa.int32()))], ["places", "ids"])

    return words.select("word", "places").mapInArrow(merge, "places array<bigint>, ids array<int>")


def sequences(seq: np.ndarray, lengths: list[int], sizes: np.ndarray, starts: np.ndarray, values: np.ndarray) -> Iterator[np.ndarray]:
    """Each document's ids, one at a time: word w's are ``values[starts[w]:starts[w] + sizes[w]]``."""
    at = 0
    for n in lengths:
        s = seq[at:at + n]
        at += n
        k = sizes[s]
        ends = np.cumsum(k)
        yield values[np.repeat(starts[s] - ends + k, k) + np.arange(ends[-1])] if n else values[:0]


def assembled(chunks: DataFrame, ids: DataFrame, schema: str, finish) -> DataFrame:
    """Rows that ``finish(doc_ids, iterator of id arrays)`` makes of each chunk, given ``ids(chunk, n, ids)``."""

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        at = right.column("n").to_numpy()
        lists = right.column("ids").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy()
        sizes, starts = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        sizes[at], starts[at] = np.diff(offsets), offsets[:-1]
        for row in left.select(["doc_ids", "lengths", "sequence"]).to_pylist():
            out.append(finish(row["doc_ids"], sequences(unpack(row["sequence"]), row["lengths"], sizes, starts, values)))
        return pa.concat_tables(out)

    return chunks.groupBy("chunk").cogroup(ids.groupBy("chunk")).applyInArrow(join, schema)


def encode_documents(docs: DataFrame, finish, schema: str, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Encode ``docs(doc_id, text)`` and give each chunk's documents to ``finish``."""
    spark = docs.sparkSession
    ranks = load_ranks(path or vocabulary_path())
    table_ = RankTable(spark, ranks)
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = max(1, -(-size // CHUNK_BYTES))
    # bucketed by chunk as it is written, so that the join below does not shuffle the sequences
    name = f"bpe_chunks_{uuid.uuid4().hex}"
    chunked(docs.coalesce(n), pattern or word_pattern()).write.bucketBy(min(n, 4096), "chunk").sortBy("chunk").option(
        "path", shared_path(spark, "bpe-chunks")
    ).option("compression", "zstd").saveAsTable(name)
    chunks = spark.table(name)
    places = chunks.select("chunk", F.posexplode("words").alias("n", "word")).groupBy(
        "word", F.pmod(F.xxhash64("chunk"), F.lit(-(-n // PLACES))).alias("part")
    ).agg(F.collect_list(F.shiftleft("chunk", PLACE_BITS) + F.col("n")).alias("places"))
    # a subquery may not stand inside a higher-order function; the two projections become one, so no row carries the table
    short = places.where(F.octet_length("word") <= LONG_WORD).select("places", "word", table_.arrays.alias("table"))
    short = short.select("places", table_.fold(F.col("word"), F.col("table")).alias("ids"))
    long = long_ids(places.where(F.octet_length("word") > LONG_WORD), ranks)
    ids = short.union(long).select(F.explode("places").alias("p"), "ids").select(
        F.shiftright("p", PLACE_BITS).alias("chunk"), F.col("p").bitwiseAND((1 << PLACE_BITS) - 1).cast("int").alias("n"), "ids"
    )
    return assembled(chunks.select("chunk", "doc_ids", "lengths", "sequence"), ids, schema, finish)


def pieces_of(path: str | None = None) -> list[bytes]:
    """The binary piece of each id."""
    ranks = load_ranks(path or vocabulary_path())
    pieces = [b""] * (max(ranks.values()) + 1)
    for p, r in ranks.items():
        pieces[r] = p
    return pieces


def decode_ids(ids: Column, path: str | None = None) -> Column:
    """Binary text of an ``array<int>`` of ids: a native concatenation of their pieces."""
    literal = F.from_json(F.lit(json.dumps([p.decode("latin-1") for p in pieces_of(path)])), "array<string>")
    return F.encode(F.array_join(F.transform(ids, lambda i: F.get(literal, i)), ""), "ISO-8859-1")


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``(doc_id, ids array<int>)`` of ``docs(doc_id, text)``."""

    def finish(doc_ids: list, docs: Iterator[np.ndarray]) -> pa.Table:
        return pa.table({"doc_id": pa.array(doc_ids, pa.int64()), "ids": pa.array(list(docs), pa.list_(pa.int32()))})

    return encode_documents(docs, finish, "doc_id long, ids array<int>", path)


def token_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256 (of the decoded ids), n_decoded (bytes)."""
    pieces = pieces_of(path)
    shared = docs.sparkSession.sparkContext.broadcast(pieces)  # the vocabulary, whatever the input

    def finish(doc_ids: list, docs: Iterator[np.ndarray]) -> pa.Table:
        n, ids_sha, decoded_sha, n_decoded = [], [], [], []
        for ids in docs:
            decoded = b"".join(map(shared.value.__getitem__, ids.tolist()))
            n.append(len(ids))
            ids_sha.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
            decoded_sha.append(hashlib.sha256(decoded).hexdigest())
            n_decoded.append(len(decoded))
        return pa.table({
            "doc_id": pa.array(doc_ids, pa.int64()), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(ids_sha, pa.string()),
            "decoded_sha256": pa.array(decoded_sha, pa.string()), "n_decoded": pa.array(n_decoded, pa.int64()),
        })

    return encode_documents(
        docs, finish, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_decoded long", path
    )


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))
