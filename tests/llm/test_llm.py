"""Training-data operators: brute force, round trips, held-out accuracy and edge cases."""

import base64
import hashlib
import os
import re
import sys
import zlib

import duckdb
import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, lang_pred string"
LONG = "the quick brown fox jumps over the lazy dog and runs away from it at once " * 300
EDGE = [
    (1, None, "en", "a"), (2, "", None, None), (3, "   ", "en", "a"), (4, "word", "en", "b"), (5, "WORD", "en", "b"),
    (6, LONG, "en", "a"), (7, LONG + "more words here", "en", "a"), (8, "é" * 60 + " ünï 12", "fr", "c"), (9, "日本語 " * 40, None, "c"),
    (10, "aaaa" * 2000, "de", "a"), (11, "aaaa" * 2000 + "b", "de", "a"), (12, "1234 !!", "en", "a"), (12, "1234 !!", "en", "a"),
    (None, "null id text", "en", "a"), (13, "a b", "en", "a"), (14, "a b c", "en", "a"),
]


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(i, t, x, s, len(t or ""), False, "zz") for i, t, x, s in EDGE]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(sf=SF):
    return duckdb.sql(f"select doc_id, text, lang from '{sf}/documents.parquet' order by doc_id").fetchall()


def shingles(text, width=2):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(words)} if 0 < len(words) < width else {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def brute_components(rows, width=2):
    sets = {d: shingles(t, width) for d, t in rows}
    comp = {d: d for d in sets}

    def top(d):
        while comp[d] != d:
            d = comp[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) * 100 >= 80 * max(len(x), len(y)) and 100 * len(x & y) >= 80 * len(x | y):
                p, q = sorted((top(a), top(b)))
                comp[q] = p
    return {d: (len(sets[d]), top(d)) for d in ids}


def brute_repeats(rows):
    seen, out = {}, {}
    for d, t in sorted(rows):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 49):
            if seen.setdefault(b[i:i + 50], d) < d:
                gone[i:i + 50] = True
        runs = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        out[d] = (len(b), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest())
    return out


def known(rows=EDGE):
    return list({r[0]: (r[0], r[1]) for r in rows if r[0] is not None}.values())


def test_near_dups(spark, edge, empty):
    from hourcast.llm.minhash_dedup import near_dups, op1_minhash_near_dedup

    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dups(edge).where("doc_id is not null").collect()}
    assert got == brute_components(known())
    assert near_dups(edge).count() == len(EDGE) and near_dups(empty).count() == 0
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op1_minhash_near_dedup(spark, SF).collect()}
    assert got == brute_components([r[:2] for r in documents()])


def test_near_dups_long_lists(spark):
    """A group larger than a short list, in which not all are linked to the first."""
    from hourcast.llm.minhash_dedup import near_dups

    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(90):
        w = list(base)
        for j in rng.choice(80, rng.integers(0, 9), replace=False):
            w[j] = f"x{i}_{j}"
        rows.append((i, " ".join(w)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_components(rows)


def test_repeats(spark, edge, empty):
    from hourcast.llm.suffix_dedup import op2_suffix_dedup, remove_repeats

    want = brute_repeats(known())
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(edge).where("doc_id is not null").collect()}
    assert got == want and remove_repeats(empty).count() == 0 and remove_repeats(edge).count() == len(EDGE)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op2_suffix_dedup(spark, SF).collect()}
    assert got == brute_repeats([r[:2] for r in documents()])


def test_bpe(spark, edge, empty):
    import public_tokenizers as P
    import tiktoken

    from hourcast.llm.bpe import decode_ids, encode, load_ranks, merge_word, token_digests, vocabulary_path

    ranks = load_ranks(vocabulary_path())
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = encode(edge)
    got = {r.doc_id: (r.ids, r.text) for r in out.select("doc_id", "ids", decode_ids(out.ids).cast("string").alias("text")).collect()}
    for i, t in known():
        assert got[i] == (enc.encode_ordinary(t or ""), t or "")
    assert token_digests(empty).count() == 0
    assert merge_word(b"aaaaaaaaaaaaab", ranks) == enc.encode_ordinary("aaaaaaaaaaaaab")
    digests = {r.doc_id: r for r in token_digests(edge).collect()}
    for i, t in known():
        ids = np.array(enc.encode_ordinary(t or ""), "<u4")
        assert digests[i].n_tokens == len(ids) and digests[i].ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert digests[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_secrets(spark, edge, empty):
    from hourcast.llm import secrets_scan as S

    key = base64.b64encode(hashlib.sha512(b"x").digest()).decode()[:40].replace("=", "a")
    text = f"é password= token = abcdefghijklmnop API_KEY: 'ABCDEFGHIJKL' AKIAABCDEFGHIJKLMN {'0f' * 9} x{key} {'ab' * 20} release-2024-01-02 some_variable_name_12"
    spans = S.scan_text(text, S.load_encoding(S.vocabulary_path()))
    base = [(text[a:b], S.KINDS[k]) for a, k, b in spans if k < 3]
    assert base == [("API_KEY: 'ABCDEFGHIJKL", "assign"), ("AKIAABCDEFGHIJKLMN", "access"), ("0f" * 9, "hex"), ("ab" * 20, "hex")]
    found = [text[a:b] for a, k, b in spans if k == 3]
    assert any(key[5:30] in f for f in found) and "ab" * 20 not in found and not any("release" in f or "variable" in f for f in found)
    assert S.scan_secrets(edge).count() == len(EDGE) and S.scan_secrets(empty).count() == 0


def test_licenses(spark, edge, empty):
    from hourcast.llm import license_scan as L

    rules = L.build_rules()
    assert len(rules) > 200
    words = b"released under the apache license version 2 0 not apache".split()
    assert L.base_places(words) == [(3, "apache")]
    hits = L.detect(b" ".join(words), rules)
    assert [r.label for _, _, r in hits] == ["apache"]  # the longest rule suppresses those inside it
    docs = spark.createDataFrame([(1, "MIT License, CC-BYé cc by 4.0"), (2, None)], "doc_id long, text string")
    r = {x.doc_id: x for x in L.scan_licenses(docs).collect()}
    assert [(p.word, p.label) for p in r[1].places] == [(0, "mit"), (4, "cc-by")] and r[1].n_words == 8 and r[2].n_words == 0
    assert L.scan_licenses(edge).count() == len(EDGE) and L.scan_licenses(empty).count() == 0


def test_language(spark, edge, empty):
    from hourcast.llm.language_id import fit_language_model, identify, op6_language_id

    truth = {d: x for d, _, x in documents("/root/testdata/sf0.01")}
    rows = op6_language_id(spark, "/root/testdata/sf0.01").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]) > 0.97
    got = [(r.doc_id, r.lang_pred) for r in identify(edge, fit_language_model(edge)).collect()]
    assert {d for d, x in got if x == "und"} == {1, 2, 3, 12} and len(got) == len(EDGE)
    assert identify(edge, fit_language_model(empty)).where("lang_pred <> 'und'").count() == 0


def test_toxicity(spark, edge, empty):
    from pyspark.sql import functions as F

    from hourcast.llm.toxicity import ToxicityModel, fit_toxicity, op8_toxicity, score_toxicity

    sf = "/root/testdata/sf0.1"
    labels = dict(duckdb.sql(f"select doc_id, max(toxic) from '{sf}/labels.parquet' group by 1").fetchall())
    rows = [r for r in op8_toxicity(spark, sf).collect() if r.held_out and r.doc_id in labels]
    y, p = np.array([labels[r.doc_id] for r in rows]), np.array([r.predicted for r in rows])
    assert (p & y).sum() / p.sum() > 0.9 and (p & y).sum() / y.sum() > 0.8
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert fit_toxicity(edge, none, F.lit(True)) == ToxicityModel()
    assert score_toxicity(edge, ToxicityModel()).where("score <> 0").count() == 0 and score_toxicity(empty, ToxicityModel()).count() == 0


def test_embeddings(spark):
    from hourcast.llm.embedding_dedup import embedding_near_dups

    rng = np.random.default_rng(2)
    centre = rng.normal(size=(60, 32))
    rows = []
    for i in range(600):  # pairs near the bound, one large group, plain ones
        c = centre[0] if i < 150 else centre[i % 60]
        v = c + rng.normal(size=32) * (0.1 if i < 150 else 0.33)
        rows.append((i, v.astype("f4").tolist(), i % 2))
    rows += [(600, rows[3][1], 1), (601, None, 1), (602, [0.0] * 32, 1), (603, [float("nan")] * 32, 1), (604, rows[5][1], None), (605, [1.0, 2.0], 1), (606, [], 1), (None, rows[3][1], 1)]
    got = {r.vec_id: r for r in embedding_near_dups(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    v = np.array([r[1] for r in rows[:601]])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    lab = np.array([r[2] for r in rows[:601]])
    true = (v @ v.T >= 0.93) & (lab[:, None] == lab[None]) & ~np.eye(601, dtype=bool)
    links = np.array([got[i].n_links for i in range(601)])
    assert len(got) == len(rows) and (links <= true.sum(1)).all() and links.sum() >= 0.99 * true.sum() > 1000
    assert all(got[i].n_links == 0 and got[i].kept for i in (601, 602, 603, 604, 605, 606))
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_near_dups(none).count() == 0


def test_exact(spark, edge, empty):
    from hourcast.llm.exact_dedup import DigestIndex, digest_of, exact_dedup

    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup(edge, batches=3).collect()}
    assert got[1] == (2, 2, False) and got[2] == (2, 2, True) and got[4] == (5, 2, False) and got[12] == (12, 2, True) and got[None][2]
    assert exact_dedup(empty).count() == 0
    index = DigestIndex(spark, buckets=4)
    one = edge.where("doc_id in (4, 6)").select("doc_id", digest_of(edge.text).alias("digest"))
    index.add(one)
    index.add(edge.where("doc_id in (5, 7)").select("doc_id", digest_of(edge.text).alias("digest")))
    assert sorted(r.keep_id for r in index.rows().collect()) == [4, 6, 7]


def test_mixing(spark, edge, empty):
    from hourcast.llm.mixing import cells_of, mix_sources, rake, tempered_targets

    assert mix_sources(edge).count() == len(EDGE) and mix_sources(empty).count() == 0
    cells = spark.createDataFrame([(s, x, "t", 10 * i + 5, 1) for i, (s, x) in enumerate([("a", "en"), ("a", "de"), ("b", "en"), ("b", "de")])],
                                  "source string, lang string, topic string, tokens long, docs long")
    targets = spark.createDataFrame([("source", "a", 0.7), ("source", "b", 0.3), ("lang", "en", 0.6), ("lang", "de", 0.4), ("topic", "t", 1.0)],
                                    "dim string, category string, weight double")
    w = {(r.source, r.lang): r.w for r in rake(cells, targets, 40).collect()}
    assert w["a", "en"] + w["a", "de"] == pytest.approx(0.7) and w["a", "en"] + w["b", "en"] == pytest.approx(0.6)
    assert cells_of(mix_sources(edge)).count() > 1 and tempered_targets(cells, {"source": 1, "lang": 1, "topic": 1}).count() == 5


def test_pipeline(spark, edge, empty):
    import corpus_pipeline as C

    assert [n for n, _ in C.STAGES] == ["language_id", "exact_dedup", "minhash_near_dedup", "mixing", "byte_bpe"]
    stages = dict(C.STAGES)
    for docs in (edge, empty):
        for name, stage in C.STAGES:
            out = stage(spark, docs, SF)
            assert name == "byte_bpe" or out.columns == docs.columns
            assert out.count() <= docs.count()
    ids = lambda d: sorted(r[0] for r in d.select("doc_id").collect() if r[0] is not None)
    assert not {1, 2, 3, 12} & set(ids(stages["language_id"](spark, edge, SF)))
    rows = [(d, t) for d, t, _ in documents()]
    last = {}
    for d, t in rows:
        last[re.sub("[A-Z]", lambda m: m.group().lower(), t)] = d
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    exact = stages["exact_dedup"](spark, docs, SF)
    assert ids(exact) == sorted(last.values())
    kept = [(d, t) for d, t in rows if d in set(last.values())]
    assert ids(stages["minhash_near_dedup"](spark, exact, SF)) == sorted(d for d, (_, c) in brute_components(kept, 5).items() if c == d)
