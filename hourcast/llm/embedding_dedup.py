"""Operator 7: near-duplicate embeddings by spherical-cap filters.

Filter directions are the words of structured random product codes: a vector is
rotated and cut into ``BLOCKS`` parts, each part has ``CODEWORDS`` random unit vectors,
and any combination of them is a direction.  A vector is list-decoded, from the parts'
inner products alone, to every direction whose inner product reaches the bound of its
cap: that of its ``FILTERS``-th best, in each of ``CODES`` codes.  (One bound for all
vectors leaves half of them without a filter: the best codewords differ too much.)
Vectors of equal label that pass the same filters are candidates; candidates are
verified by cosine in double precision.

Two vectors of cosine 0.93 share about 14 of the 32 filters, unrelated ones seldom two;
``tests/llm`` measures the recall.  Short lists give pairs, of which those that share
two filters are verified.  Long lists (groups of near copies) are compared in blocks in
memory; of the lists that hold both vectors of a link only the first reports it.  No
list is capped.

Equal vectors of a label are one class (smallest vec_id) with a multiplicity.
Defined cases: rows of null label, or whose vector is null, empty, zero or has null or
non-finite components, link with nothing; so do rows of null vec_id, which are kept;
vectors of different length never link; repeated rows are links of each other;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.llm.common import components, materialise, table

CODES = 4
BLOCKS = 2
CODEWORDS = 128
FILTERS = 8
SHORT_LIST = 128
BLOCK = 1024
SEED = 7


def product_codes(dim: int, seed: int = SEED) -> list[tuple[np.ndarray, list[np.ndarray], np.ndarray]]:
    """Per code: a rotation, the codewords of each block, and the blocks' inner edges."""
    codes = []
    for i in range(CODES):
        rng = np.random.default_rng([seed, i, dim])
        rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        edges = np.linspace(0, dim, min(BLOCKS, dim) + 1).astype(int)
        words = [rng.standard_normal((CODEWORDS, n)) for n in np.diff(edges)]
        codes.append((rotation, [w / np.linalg.norm(w, axis=1, keepdims=True) for w in words], edges[1:-1]))
    return codes


def list_decode(v: np.ndarray, codes: list, filters: int = FILTERS) -> np.ndarray:
    """Numbers of the ``filters`` directions of each code nearest to ``v``; a sum among
    the best takes only the best of each part."""
    out = []
    for k, (rotation, blocks, edges) in enumerate(codes):
        sums, ids = np.zeros(1), np.full(1, k)
        for words, part in zip(blocks, np.split(rotation @ v, edges), strict=True):
            p = words @ part
            best = np.argsort(-p, kind="stable")[:filters]
            sums, ids = (sums[:, None] + p[best]).ravel(), (ids[:, None] * CODEWORDS + best).ravel()
            best = np.argsort(-sums, kind="stable")[:filters]
            sums, ids = sums[best], ids[best]
        out.append(ids)
    return np.concatenate(out)


def filter_rows(classes: DataFrame, filters: int) -> DataFrame:
    """``(label, f, id)`` for each filter that a class's vector passes."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[int, list] = {}
        for batch in batches:
            vectors = [np.asarray(v, np.float64) for v in batch.column(2).to_pylist()]
            for d in {len(v) for v in vectors} - codes.keys():
                codes[d] = product_codes(d)
            found = [list_decode(v, codes[len(v)], filters) for v in vectors]
            at = np.repeat(np.arange(len(found)), [len(x) for x in found])
            flat = np.concatenate(found) if found else np.zeros(0, np.int64)
            ids, labels = batch.column(0).to_numpy()[at], batch.column(1).to_numpy()[at]
            yield pa.RecordBatch.from_arrays([pa.array(labels), pa.array(flat), pa.array(ids)], ["label", "f", "id"])

    return classes.select("id", F.col("label").cast("long").alias("label"), "embedding").mapInArrow(decode, "label long, f long, id long")


def cosine_links(pairs: DataFrame, vectors: DataFrame, cosine: float) -> DataFrame:
    """Pairs ``(a, b)`` of at least that cosine."""
    p = pairs.join(vectors.select(F.col("id").alias("a"), F.col("embedding").alias("va")), "a")
    p = p.join(vectors.select(F.col("id").alias("b"), F.col("embedding").alias("vb")), "b").where(F.size("va") == F.size("vb"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.asarray(x, np.float64), np.asarray(y, np.float64)
                ok.append(bool(x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= cosine))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return p.select("a", "b", "va", "vb").mapInArrow(check, "a long, b long")


def long_links(rows: DataFrame, vectors: DataFrame, cosine: float) -> DataFrame:
    """Links inside long lists, each reported by the first list that holds both ends."""
    rows = materialise(rows.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")), "long-lists")
    lists = rows.groupBy("id").agg(F.sort_array(F.collect_list("f")).alias("fs"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = (
        rows.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).withColumn("other", every)
        .select("label", "f", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id")
        .join(materialise(vectors.join(lists, "id").select("id", "embedding", "fs"), "long-vectors"), "id")
    )

    def compare(key, part: pd.DataFrame) -> pd.DataFrame:
        f, i, j = key[1:]
        out = []
        for _, g in part.groupby(part["embedding"].map(len)):
            v = np.stack(g["embedding"].to_numpy()).astype(np.float64)
            v /= np.linalg.norm(v, axis=1, keepdims=True)
            ids, own = g["id"].to_numpy(), g["own"].to_numpy()
            earlier = [fs[fs < f] for fs in (np.asarray(x) for x in g["fs"])]
            names, at = np.unique(np.concatenate(earlier), return_inverse=True)
            e = np.zeros((len(g), len(names)), np.float32)
            e[np.repeat(np.arange(len(g)), [len(x) for x in earlier]), at] = 1
            ok = (v @ v.T >= cosine) & (e @ e.T == 0) & (ids[:, None] < ids[None, :])
            if i != j:
                ok &= own[:, None] != own[None, :]
            x, y = np.nonzero(ok)
            out.append(np.stack([ids[x], ids[y]], 1))
        pairs = np.concatenate(out)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return dealt.groupBy("label", "f", "i", "j").applyInPandas(compare, "a long, b long")


def embedding_near_dups(vectors: DataFrame, cosine: float = 0.93, filters: int = FILTERS) -> DataFrame:
    """Per row of ``vectors(vec_id, embedding, label)``: vec_id, n_links, component_id, kept."""
    usable = (
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0)
    )
    rows = vectors.select("vec_id", "label", F.when(F.coalesce(usable, F.lit(False)), F.col("embedding")).alias("embedding"))
    key = F.xxhash64("label", "embedding").alias("h")
    classes = materialise(
        rows.where("embedding is not null").groupBy(key, "label", "embedding").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies")),
        "vector-classes",
    )
    listed = materialise(filter_rows(classes, filters), "filters")
    sizes = materialise(listed.groupBy("label", "f").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "filter-sizes")
    lists = materialise(listed.join(sizes, ["label", "f"]), "filter-lists")
    members = lists.where(F.col("n") <= SHORT_LIST).groupBy("label", "f").agg(F.sort_array(F.collect_list("id")).alias("m"))
    pairs = members.select(F.posexplode("m").alias("k", "a"), "m").select(
        "a", F.explode(F.slice("m", F.col("k") + 2, F.size("m"))).alias("b")
    ).groupBy("a", "b").count().where("count > 1").select("a", "b")
    v = classes.select("id", "embedding")
    links = materialise(
        cosine_links(pairs, v, cosine).union(long_links(lists.where(F.col("n") > SHORT_LIST), v, cosine)).distinct(), "vector-links"
    )
    both = links.union(links.select("b", "a")).toDF("id", "other")
    linked = both.join(classes.select(F.col("id").alias("other"), "copies"), "other").groupBy("id").agg(F.sum("copies").alias("more"))
    comps = components(links)
    done = materialise(
        classes.join(linked, "id", "left").join(comps, "id", "left").select(
            "h", "label", "embedding", (F.col("copies") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"),
            F.coalesce("component_id", "id").alias("component_id"),
        ),
        "vector-components",
    )
    out = rows.withColumn("h", F.when(F.col("embedding").isNotNull(), F.xxhash64("label", "embedding"))).join(
        done, ["h", "label", "embedding"], "left"
    )
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_near_dups(table(spark, sf_dir, "embeddings"))
