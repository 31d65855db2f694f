"""Queries against plain Python written apart from them, and cases that once went wrong."""

import glob
import hashlib
import re
import time

import duckdb
import numpy as np
import pytest

from test_llm import SF, brute_components, documents


def lower(s):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), s)


# --------------------------------------------------------------------------- 9

def test_index_survives_reopening(spark, tmp_path):
    from pyspark.sql import functions as F

    from hourcast.llm.exact_dedup import DigestIndex

    batch = lambda a, b: spark.range(a, b).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string").cast("binary"), 256).cast("binary").alias("digest"))
    path = str(tmp_path / "index")
    spark.conf.set("spark.sql.shuffle.partitions", "211")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        first = DigestIndex(spark, path, buckets=16)
        assert first.rows().count() == 0
        first.add(batch(0, 3000))
        assert len(glob.glob(f"{path}/*.parquet")) == 16  # a file a bucket at 211 partitions
        first.forget()
        other = spark.newSession()
        again = DigestIndex(other, path)
        assert again.buckets == 16 and again.name != first.name and again.rows().count() == 3000
        again.add(batch(2000, 4000).withColumn("doc_id", F.col("doc_id") + 10_000))
        rows = {bytes(r.digest): r.keep_id for r in DigestIndex(spark, path).rows().collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(rows) == 4000
    assert {rows[hashlib.sha256(str(i).encode()).hexdigest().encode()] for i in (5, 2500, 3500)} == {5, 2500, 13_500}


# --------------------------------------------------------------------------- 10

def quadratic(words, rules):
    """The rule of suppression, each detection against all kept ones."""
    kept = []
    for r in rules:
        if r.keyword in words:
            for m in r.pattern.finditer(words):
                if not any(a <= m.start() and m.end() <= b or x.label == r.label and m.start() < b and a < m.end() for a, b, x in kept):
                    kept.append((m.start(), m.end(), r))
    return kept


def test_detections_by_bisection():
    from hourcast.llm import license_scan as L

    rules = L.build_rules()
    rng = np.random.default_rng(0)
    vocabulary = sorted({w for r in rules for w in re.sub(rb"[^a-z0-9 ]", b" ", r.pattern.pattern).split()}) + [b"and", b"mit", b"license", b"bsd", b"gpl"] * 20
    for _ in range(150):
        words = b" ".join(rng.choice(vocabulary, 60))
        assert L.detect(words, rules) == quadratic(words, rules)
    texts = [t.encode().translate(L.WORD_BYTES) for _, t, _ in documents("/root/testdata/sf0.01")]
    assert all(L.detect(w, rules) == quadratic(w, rules) for t in texts for w in [b" ".join(t.split())])


def test_long_license_text(spark):
    """One megabyte of license phrases takes seconds."""
    from hourcast.llm.license_scan import scan_licenses

    docs = spark.createDataFrame([(1, "mit license and apache license version 2.0, " * 24_000)], "doc_id long, text string")
    start = time.time()
    r = scan_licenses(docs).first()
    assert time.time() - start < 60
    assert len(r.places) == 48_000 and r.n_words == 8 * 24_000 and len(r.hits) == 48_000
    assert sorted(h.word for h in r.hits)[:3] == [0, 3, 8] and max(h.end for h in r.hits) == r.n_words


def test_license_query_base(spark):
    from hourcast.llm.license_scan import op10_license_scan

    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in op10_license_scan(spark, SF).collect()}
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    for doc, text, _ in documents():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
        found = [(i, label) for i in range(len(words)) for p, label in phrases.items() if words[i:i + len(p.split())] == p.split()]
        at = [i for i, _ in found]
        assert got[doc] == (len(words), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found})))


# --------------------------------------------------------------------------- 4

def test_secret_query_base(spark):
    from hourcast.llm.secrets_scan import op4_secret_scan

    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    kinds = [("assign", assign, lambda m: len(m.group(2)) >= 12), ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m.group()) >= 18),
             ("hex", re.compile("[0-9a-f]+"), lambda m: len(m.group()) >= 16)]
    got = {r.doc_id: r for r in op4_secret_scan(spark, SF).collect()}
    seen = 0
    for doc, text, _ in documents():
        spans = [(m.start(), k, m.end()) for k, (_, p, ok) in enumerate(kinds) for m in p.finditer(text or "") if ok(m)]
        joined = ",".join(f"{kinds[k][0]}:{a}:{b}" for a, k, b in sorted(spans))
        r = got[doc]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == j for _, k, _ in spans) for j in range(3))
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest() and set(joined.split(",")) - {""} <= set(r.spans.split(","))
        seen += len(spans)
    assert seen


# --------------------------------------------------------------------------- 3

def test_bpe_query(spark):
    import public_tokenizers as P
    import tiktoken

    from hourcast.llm.bpe import load_ranks, op3_byte_bpe, vocabulary_path

    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=load_ranks(vocabulary_path()), special_tokens={})
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op3_byte_bpe(spark, SF).collect()}
    for doc, text, _ in documents():
        ids = np.array(enc.encode_ordinary(text or ""), "<u4")
        assert got[doc] == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())


# --------------------------------------------------------------------------- 1

def test_near_dups_under_one_id(spark):
    """Different texts under one doc_id, each near another document's, join those documents; lists stay open after the
    star round, and blocks are smaller than the lists."""
    from hourcast.llm import minhash_dedup as M

    rng = np.random.default_rng(7)
    base = [[f"{c}{i}" for i in range(n)] for c, n in (("p", 60), ("q", 60), ("r", 75))]

    def near(words, k):
        words = list(words)
        for j in rng.choice(len(words), k, replace=False):
            words[j] = f"x{rng.integers(1 << 40)}"
        return " ".join(words)

    rows = [(100, " ".join(base[0])), (100, " ".join(base[1])), (100, " ".join(base[2])), (1, near(base[0], 2)), (2, near(base[1], 2)), (3, near(base[2], 3))]
    # a chain: each is near the next only, so most pairs of its lists are not links
    chain, rest = [f"c{i}" for i in range(300)], 200
    rows += [(200 + i, " ".join(chain[3 * i:3 * i + rest])) for i in range(25)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_components([r for r in rows if r[0] != 100])
    whole, M.BLOCK, M.SHORT_LIST = (M.BLOCK, M.SHORT_LIST), 4, 5
    try:
        got = {(r.doc_id, r.n_shingles): r.component_id for r in M.near_dups(docs).collect()}
    finally:
        M.BLOCK, M.SHORT_LIST = whole
    assert {got[k] for k in got if k[0] in (1, 2, 3, 100)} == {1}
    assert {d: c for (d, _), c in got.items() if d >= 200} == {d: c for d, (_, c) in want.items() if d >= 200}


# --------------------------------------------------------------------------- 7

def test_embedding_components(spark):
    from hourcast.llm.embedding_dedup import op7_embedding_near_dedup

    rows = duckdb.sql(f"select vec_id, embedding, label from '{SF}/embeddings.parquet' order by vec_id").fetchall()
    v = np.array([r[1] for r in rows], float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    label = np.array([-1 if r[2] is None else r[2] for r in rows])
    near = (v @ v.T >= 0.93) & (label[:, None] == label[None]) & (label >= 0)[:, None] & ~np.eye(len(rows), dtype=bool)
    top = np.arange(len(rows))
    while True:  # the least position reachable
        new = np.minimum(top, np.where(near, top[None], len(rows)).min(1))
        if (new == top).all():
            break
        top = new
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in op7_embedding_near_dedup(spark, SF).collect()}
    assert got == {r[0]: (int(near[i].sum()), rows[top[i]][0], top[i] == i) for i, r in enumerate(rows)}


# --------------------------------------------------------------------------- 8

def test_toxicity_sample_is_bounded(spark):
    """Rows that repeat an id, with one text or many, and an id with several labels."""
    from pyspark.sql import functions as F

    from hourcast.llm.toxicity import pu_rows

    many = spark.range(4000).select(F.lit(5).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    same = spark.range(4000).select(F.lit(6).cast("long").alias("doc_id"), F.lit("one text").alias("text"))
    docs = many.union(same).union(spark.createDataFrame([(7, None), (None, "no id")], "doc_id long, text string"))
    labels = spark.createDataFrame([(5, 0), (5, 1), (6, 1), (7, 0), (8, 1), (None, 1)], "doc_id long, toxic int")
    rows, prior = pu_rows(docs, labels, F.lit(True), most_positive=300, most_unlabelled=500)
    n = {r["positive"]: r["count"] for r in rows.groupBy("positive").count().collect()}
    assert 200 < n[True] < 400 and 380 < n[False] < 620 and prior == pytest.approx(4 / 5)
    assert rows.where("cast(text as string) = 'one text'").groupBy("positive").count().where("count > 1").count() == 0
