"""Operator 1: near-duplicate documents by bottom-k sketches of one hash function.

A document's set is its distinct 2-word shingles, each a 64-bit hash; its sketch is
the k smallest.  For two sets of Jaccard similarity J, each of the k smallest values
of their union lies in both sets with probability J, and then in both sketches.  At
J >= 0.8 at least ``LEAST_SHARED`` of 48 do, but for one pair in 10^8 at J = 0.8 and
far fewer above; sets smaller than k are their own sketches, which is exact.

1. Equal sets become one representative (the smallest doc_id).
2. Inverted lists: values retained by one sketch only are dropped; of a sketch's
   values only its rarest ``k - LEAST_SHARED + 1`` are listed.  Any pair that shares
   ``LEAST_SHARED`` values meets in one of those, so frequent shingles and passages
   that many documents share seldom make lists.  Each entry carries its whole sketch
   as 256 bits: the common bits of two entries bound the overlap of their sketches from
   above, so documents that meet by chance are told apart inside the list and make no
   pair, however many they become in a larger corpus.
3. Star round: every list's members are compared with its smallest id, those of long
   lists with a few more; pairs pass the union-sketch estimate, then exact Jaccard on
   the full sets.  Components of the links found settle most lists: all members in one
   component.  A list of two is settled by its one pair.
4. What is left are pairs of *different* components in one list.  Short lists give
   them directly; long ones are dealt in blocks over (list, block, block) groups,
   where 16-bit prints of wider sketches (``WIDE`` values, made for the members of such
   lists only) are compared in memory and only similar pairs come out, each from the
   first such list that holds both.  Prints that clash only add to an overlap, so a set of
   up to ``WIDE`` shingles is never ruled out wrongly, a larger one in 10^8 pairs once.
   They take the same estimate and exact check.

Defined cases: null, empty and blank texts have empty sets, linked with nothing; one
word is a set of one; rows with null doc_id are linked with nothing and kept; rows
that share a doc_id are separate texts; an empty table gives no rows; ties have no effect.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.llm.common import LOWER_BYTES, collect_garbage, components, discard, materialise, mix64, table

K = 48
LEAST_SHARED = 21
#: Lists up to this long give their open pairs directly.
SHORT_LIST = 32
#: Values of a wider sketch, kept as 16-bit prints; compared where a long list stays open.
#: Most sets have no more, so that similarities of 0.65 to 0.8 make no pairs, which are
#: the square of their group in number.
WIDE = 1024
#: Members of a block of a long list: two blocks of prints are 8 MB at most.
BLOCK = 2048
PIVOTS = 12
#: Rows of the bit table that tells which ids are asked for (64 bits a row).
ASKED = 1 << 20
#: 64-bit words of a sketch's bit set.
WORDS = 4
BITS = "struct<" + ", ".join(f"w{i}: long" for i in range(WORDS)) + ">"


def shingle_hashes(text: bytes | None, width: int = 2) -> np.ndarray:
    """Sorted distinct 64-bit hashes (signed) of the shingles of ``width`` words.

    Words are runs of bytes other than space and \\t-\\r, A-Z lower-cased; with
    fewer words than ``width`` the whole sequence is one shingle."""
    words = (text or b"").translate(LOWER_BYTES).split()
    if not words:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(h) - width + 1)
    out = np.zeros(n, np.uint64)
    for i in range(min(width, len(h))):
        out = mix64(out * np.uint64(3) + h[i:i + n] + np.uint64(i + 1))
    return np.unique(out.view(np.int64))


def bit_words(values: np.ndarray) -> np.ndarray:
    """The bit set of the values' low bits, as ``WORDS`` signed 64-bit words."""
    marks = np.zeros(64 * WORDS, np.uint8)
    marks[(values & (64 * WORDS - 1)).astype(np.intp)] = 1
    return np.packbits(marks, bitorder="little").view("<i8")


def least_shared(k: int, percent: int, missed: float = 1e-8) -> int:
    """Fewest shared values of a union sketch of ``k`` that are less likely than ``missed``
    to be undercut by sets of that similarity."""
    p, below = percent / 100, 0.0
    for n in range(k + 1):
        below += math.comb(k, n) * p**n * (1 - p) ** (k - n)
        if below > missed:
            return n
    return k


def sketches(docs: DataFrame, width: int = 2, k: int = K) -> DataFrame:
    """Per row: doc_id, n_shingles, set_key (16-byte digest of the set, null if empty),
    sketch, bits (its bit set)."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, keys, low, bits = [], [], [], []
            for t in batch.column(1):
                h = shingle_hashes(t.as_py(), width)
                n.append(len(h))
                keys.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest() if len(h) else None)
                low.append(h[:k])
                bits.append(bit_words(h[:k]))
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in low])]).astype(np.int32)
            flat = np.concatenate(low) if low else np.zeros(0, np.int64)
            words = np.stack(bits) if bits else np.zeros((0, WORDS), np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                 pa.ListArray.from_arrays(offsets, pa.array(flat)),
                 pa.StructArray.from_arrays([pa.array(words[:, i]) for i in range(WORDS)], [f"w{i}" for i in range(WORDS)])],
                ["doc_id", "n_shingles", "set_key", "sketch", "bits"],
            )

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        sketch, f"doc_id long, n_shingles long, set_key binary, sketch array<long>, bits {BITS}"
    )


def asked(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose ``id`` is in ``ids(id)``, by a table of hash bits first: only texts and sketches
    that are asked for (and the few whose bit another id set) are shuffled.

    The table has at most ``ASKED`` rows of two numbers, whatever the number of ids, so it is
    broadcast; some 10^7 ids fill it up, from where on more rows pass to the join that decides."""
    slot = F.pmod(F.xxhash64("id"), F.lit(ASKED)).alias("slot")
    bit = F.expr("shiftleft(1L, cast(pmod(shiftrightunsigned(xxhash64(id), 40), 64) as int))")
    marks = ids.groupBy(slot).agg(F.bit_or(bit).alias("marks"))
    near = rows.withColumn("slot", slot).join(F.broadcast(marks), "slot").where(F.col("marks").bitwiseAND(bit) != 0)
    return near.drop("slot", "marks").join(ids, "id", "left_semi")


def ends(pairs: DataFrame) -> DataFrame:
    """The distinct ids on ``pairs(a, b)``."""
    return pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()


def full_sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """``(id, hashes)`` of the documents in ``ids(id)``."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i]), pa.array([shingle_hashes(t, width)], pa.list_(pa.int64()))], ["id", "hashes"]
                )

    texts = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("binary").alias("text"))
    return asked(texts, ids).mapInArrow(hashes, "id long, hashes array<long>")


def wide_prints(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """``(id, n, prints)`` of the documents in ``ids(id)``: a set's size and the low 16 bits of its
    ``WIDE`` smallest hashes; an array, as texts of one id may have sets of one size."""

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, low = [], []
            for t in batch.column(1):
                h = shingle_hashes(t.as_py(), width)
                n.append(len(h))
                low.append(h[:WIDE].astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int32()), pa.array(low, pa.binary())], ["id", "n", "prints"]
            )

    texts = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("binary").alias("text"))
    made = asked(texts, ids).mapInArrow(prints, "id long, n int, prints binary")
    return made.groupBy("id", "n").agg(F.collect_set("prints").alias("prints"))


def part_of(size, percent: int):
    """The least whole number that is ``percent`` of ``size``, in whole numbers."""
    return F.floor((size * percent + 99) / 100).cast("int")


def listed(reps: DataFrame, k: int = K, least: int = LEAST_SHARED, percent: int = 80) -> DataFrame:
    """Inverted lists ``(v, id, n, bits, df, p)``: each sketch's rarest values that another sketch retains
    too; df is the list's length, 2 or more, p its member of the smallest id."""
    keyed = reps.withColumn("key", F.xxhash64("set_key"))
    rows = keyed.select("key", F.explode("sketch").alias("v"))
    counts = materialise(rows.groupBy("v").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "sketch-counts")
    size = F.least("n", F.lit(k))
    prefix = size - F.least(part_of(size, percent), F.lit(least)) + 1
    shared = rows.join(counts, "v").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("vs"))
    shared = shared.join(keyed.select("key", "id", F.col("n_shingles").cast("int").alias("n"), "bits"), "key")
    # values that no other sketch has are the rarest: they fill the prefix first
    take = F.greatest(F.lit(0), prefix - (size - F.size("vs"))).cast("int")
    lists = materialise(
        shared.select("id", "n", "bits", F.explode(F.slice("vs", F.lit(1), take)).alias("x")).select(F.col("x.v").alias("v"), "id", "n", "bits"),
        "lists",
    )
    stats = materialise(
        lists.groupBy("v").agg(F.count(F.lit(1)).alias("df"), F.min(F.struct("id", "n", "bits")).alias("p")).where("df > 1"), "lists-stats"
    )
    # joined once: all that reads the lists later takes length and first member from their rows
    found = materialise(lists.join(stats, "v"), "listed")
    discard(counts, lists, stats)
    return found


def ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def similar_size(n1: str, n2: str, percent: int) -> Column:
    return F.least(n1, n2) * 100 >= F.greatest(n1, n2) * percent


def may_share(a: str, b: str, k: int, least: int, percent: int) -> Column:
    """Whether the entries' bit sets leave room for the overlap that the estimate asks for.

    The values that two sketches share have at least as many different bits as there are
    such values, less the values of one sketch that fall on a bit already taken."""
    ones = lambda x: sum(F.bit_count(F.col(f"{x}.bits.w{i}")) for i in range(WORDS))
    common = sum(F.bit_count(F.col(f"{a}.bits.w{i}").bitwiseAND(F.col(f"{b}.bits.w{i}"))) for i in range(WORDS))
    size = lambda x: F.least(F.col(f"{x}.n"), F.lit(k))
    need = F.least(F.lit(least), part_of(F.greatest(size(a), size(b)), percent))
    return common >= need - F.least(size(a) - ones(a), size(b) - ones(b))


def estimated(pairs: DataFrame, reps: DataFrame, k: int, least: int, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` whose union sketch does not rule out the similarity."""
    pairs = materialise(pairs, "met")
    s = asked(reps.select("id", "sketch"), materialise(ends(pairs), "met-ids"))
    p = pairs.join(s.select(F.col("id").alias("a"), F.col("sketch").alias("s_a")), "a")
    p = p.join(s.select(F.col("id").alias("b"), F.col("sketch").alias("s_b")), "b")
    every = F.array_union("s_a", "s_b")
    p = p.select("a", "b", "s_a", "s_b", F.slice(F.array_sort(every), 1, k).alias("union"))
    shared = F.size(F.array_intersect(F.array_intersect("s_a", "s_b"), "union"))
    floor = F.when(F.size("union") < k, part_of(F.size("union"), percent)).otherwise(F.lit(least))
    return p.where(shared >= floor).select("a", "b")


def verified(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs whose full sets have the similarity."""
    pairs = materialise(pairs.distinct(), "pairs")
    ids = materialise(ends(pairs), "pair-ids")
    sets = materialise(full_sets(docs, ids, width), "sets")
    p = pairs.join(sets.select(F.col("id").alias("a"), F.col("hashes").alias("h_a")), "a")
    p = p.join(sets.select(F.col("id").alias("b"), F.col("hashes").alias("h_b")), "b")
    both = F.size(F.array_intersect("h_a", "h_b"))
    union = F.size("h_a") + F.size("h_b") - both
    links = materialise(p.where(both * 100 >= union * percent).select("a", "b").distinct(), "links")
    discard(pairs, ids, sets)
    return links


def open_pairs(
    lists: DataFrame, docs: DataFrame, comps: DataFrame, width: int, k: int, least: int, percent: int
) -> DataFrame:
    """Pairs of different components that meet in a list: of short lists directly,
    of long ones from blocks compared in memory."""
    labelled = materialise(
        lists.where("df > 2").join(comps, "id", "left")
        .withColumn("comp", F.coalesce("component_id", "id")).select("v", "df", "id", "n", "bits", "comp"),
        "labelled",
    )
    mixed = labelled.groupBy("v").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("v")
    left = materialise(labelled.join(mixed, "v"), "open")
    discard(labelled, lists)
    short = left.where(F.col("df") <= SHORT_LIST).groupBy("v").agg(F.collect_list(F.struct("id", "n", "bits", "comp")).alias("m"))
    short = short.select(F.explode("m").alias("x"), "m").select("x", F.explode("m").alias("y")).where(
        (F.col("x.id") < F.col("y.id")) & (F.col("x.comp") != F.col("y.comp")) & similar_size("x.n", "y.n", percent)
        & may_share("x", "y", k, least, percent)
    ).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    # of a long list, only members outside its main component must meet all the others:
    # blocks of those (left) against blocks of all (right), a group for each two blocks
    long = left.where(F.col("df") > SHORT_LIST).drop("bits")
    main = materialise(
        long.groupBy("v", "comp").count().groupBy("v").agg(F.max(F.struct("count", "comp")).alias("main")), "main"
    )
    long = long.join(main, "v").withColumn("r_blocks", F.ceil(F.col("df") / BLOCK).cast("int")).withColumn(
        "l_blocks", F.ceil((F.col("df") - F.col("main.count")) / BLOCK).cast("int")
    )
    # one row a member, with the places it has in its lists (at most a prefix a text): what is told of it is joined
    # once, not at every place; its lists also tell whether an earlier one holds a pair
    # (one doc_id may have several texts: a member is told by id and set size)
    place = F.struct("v", (F.col("comp") != F.col("main.comp")).alias("apart"), "l_blocks", "r_blocks")
    members = materialise(
        long.groupBy("id", "n", "comp").agg(F.array_sort(F.collect_set(place)).alias("places")), "long-members"
    )
    prints = wide_prints(docs, materialise(members.select("id").distinct(), "long-ids"), width)
    told = members.join(prints, ["id", "n"]).withColumn("vs", F.col("places.v")).withColumn("prints", F.explode("prints"))
    block = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    every = lambda n: F.sequence(F.lit(0), n - 1)
    group = lambda side, i, j: F.struct(F.lit(side).alias("side"), i.alias("i"), j.alias("j"))
    rights = F.transform(every(F.col("p.l_blocks")), lambda i: group(1, i, block(F.col("p.r_blocks"))))
    lefts = F.transform(every(F.col("p.r_blocks")), lambda j: group(0, block(F.col("p.l_blocks")), j))
    dealt = told.withColumn("p", F.explode("places")).withColumn(
        "g", F.explode(F.when(F.col("p.apart"), F.concat(rights, lefts)).otherwise(rights))
    ).select("p.v", "g.i", "g.j", "g.side", "id", "n", "comp", "vs", "prints")
    wide = least_shared(WIDE, percent)

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        r = rows[rows["side"] == 1]
        ids, n, comp = (r[c].to_numpy() for c in ("id", "n", "comp"))
        out = [np.zeros((0, 2), np.int64)]
        if len(r):
            prints = [np.frombuffer(x, "<u2") for x in r["prints"]]
            flat, starts = np.concatenate(prints), np.cumsum([0, *map(len, prints)])[:-1]
            there = np.zeros(1 << 16, np.int32)
            # every member is in this list, so none of its parts is empty
            lists_of, places = np.unique(np.concatenate(r["vs"].to_list()), return_inverse=True)
            list_starts = np.cumsum([0, *map(len, r["vs"])])[:-1]
            for x in rows[rows["side"] == 0].itertuples():
                mine = np.frombuffer(x.prints, "<u2")
                there[mine] = 1
                shared = np.add.reduceat(there[flat], starts)
                there[mine] = 0
                whole = shared * 100 >= (n + x.n - shared) * percent  # exact but for clashes, if both prints are of whole sets
                ok = np.where(np.maximum(n, x.n) <= WIDE, whole, shared >= wide) & (comp != x.comp)
                ok &= np.minimum(n, x.n) * 100 >= np.maximum(n, x.n) * percent
                if ok.any():
                    earlier = np.isin(lists_of, [v for v in x.vs if v < key[0]])
                    ok &= ~np.logical_or.reduceat(earlier[places], list_starts)
                    out.append(np.stack([np.minimum(ids[ok], x.id), np.maximum(ids[ok], x.id)], 1))
        pairs = np.concatenate(out)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return short.union(dealt.groupBy("v", "i", "j").applyInPandas(compare, "a long, b long")).distinct()


def merged(comps: DataFrame, links: DataFrame) -> DataFrame:
    """Components ``(id, component_id)`` after further ``links(a, b)``, found on the links between components."""
    known = lambda c: comps.select(F.col("id").alias(c), F.col("component_id").alias(f"of_{c}"))
    top = lambda c: F.coalesce(f"of_{c}", c).alias(c)
    between = links.join(known("a"), "a", "left").join(known("b"), "b", "left").select(top("a"), top("b")).distinct()
    found = materialise(components(between), "joined").select(F.col("id").alias("component_id"), F.col("component_id").alias("least"))
    old = comps.join(found, "component_id", "left").select("id", F.coalesce("least", "component_id").alias("component_id"))
    # documents that had no link before stand for themselves in ``found``
    new = found.select(F.col("component_id").alias("id"), F.col("least").alias("component_id")).join(comps.select("id"), "id", "left_anti")
    return materialise(old.union(new), "components")


def near_dups(docs: DataFrame, width: int = 2, percent: int = 80, k: int = K, least: int = LEAST_SHARED) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, n_shingles, component_id, kept."""
    docs = docs.select("doc_id", "text")
    rows = materialise(sketches(docs, width, k), "sketches")
    known = rows.where("doc_id is not null and set_key is not null")
    reps = materialise(
        known.groupBy("set_key").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"),
            F.first("bits").alias("bits"),
        ),
        "reps",
    )
    lists = listed(reps, k, least, percent)
    member = F.struct("id", "n", "bits")
    order = lambda salt: F.min_by(member, F.struct(F.xxhash64("id", F.lit(salt)), "id"))
    long = lists.where(F.col("df") > SHORT_LIST)
    more = long.groupBy("v").agg(F.array_distinct(F.array(*[order(i) for i in range(1, PIVOTS)])).alias("pivots"))
    # copies meet in many long lists: the further pivots of one of them are enough to a member
    one = long.groupBy("id", "n", "bits").agg(F.min("v").alias("v"))
    met = lists.select(member.alias("x"), "p").union(
        one.join(more, "v").select(member.alias("x"), F.explode("pivots").alias("p"))
    )
    star = met.where(
        (F.col("x.id") != F.col("p.id")) & similar_size("x.n", "p.n", percent) & may_share("x", "p", k, least, percent)
    ).select(*ordered(F.col("x.id"), F.col("p.id"))).distinct()
    collect_garbage(docs)
    links = verified(estimated(star, reps, k, least, percent), docs, width, percent)
    collect_garbage(docs)
    comps = materialise(components(links), "components")
    collect_garbage(docs)
    pairs = open_pairs(lists, docs, comps, width, k, least, percent)
    rest = verified(estimated(pairs, reps, k, least, percent), docs, width, percent)
    collect_garbage(docs)
    if not rest.isEmpty():
        # equal sets are one node already; rows that share a doc_id join their classes through it
        comps = merged(comps, rest)
    classes = materialise(
        reps.join(comps, "id", "left").select("set_key", F.coalesce("component_id", "id").alias("component_id")), "classes"
    )
    found = rows.join(classes, "set_key", "left").select(
        "doc_id", "n_shingles", F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("component_id")), F.col("doc_id")).alias("component_id")
    )
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups(table(spark, sf_dir, "documents"))
