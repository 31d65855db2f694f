"""Operators 11 to 13 against plain Python, on the given tables and on edge rows."""

import hashlib
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, chunk long, hashes string, kept boolean, term string"
COMMON = "the same line"
ROWS = (
    [(i, f"own {i}\n  THE same LINE \t\n\nlast {i}\n", "en", "a" if i % 3 else "b") for i in range(12)]
    + [(100, None, "en", "a"), (101, "", None, None), (102, "\n\n\n", "en", "a"), (103, COMMON, "de", "a"), (103, COMMON, "de", "a"),
       (None, f"x\n{COMMON}", "en", "c"), (104, "é ünï 日本語\n" * 30, "fr", "c"), (105, "A" * 70_000 + "\n" + COMMON, "en", "a"),
       (106, "has <P> in it word", "en", "a"), (107, "İ word", "en", "zz"), (108, " nbsp line ", "en", "b"), (109, "\x0b\x0cend \x1c here\r\n", "en", "b")]
)


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame([(*r, 1, "h", False, "t") for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents():
    return duckdb.sql(f"select doc_id, text, lang, source from '{SF}/documents.parquet'").fetchall()


def lower(s):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), s)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# --------------------------------------------------------------------------- 11

def brute_lines(rows, least=10):
    keys = [[lower(x).strip(" \t\n\x0b\x0c\r") for x in (r[1] or "").split("\n")] for r in rows]
    df = Counter(k for ks in keys for k in set(ks))
    out = []
    for r, ks in zip(rows, keys):
        gone = [k != "" and df[k] >= least for k in ks]
        out.append((r[0], len(ks), sum(gone), "\n".join(x for x, g in zip((r[1] or "").split("\n"), gone) if not g)))
    return sorted(out, key=str)


def test_lines_query(spark):
    from hourcast.llm.line_dedup import op11_line_dedup

    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in op11_line_dedup(spark, SF).collect()), key=str)
    want = brute_lines(documents())
    assert got == sorted(((d, n, k, sha(t)) for d, n, k, t in want), key=str) and sum(k for _, _, k, _ in want)


@pytest.mark.parametrize("least, shard_keys, chunk_lines", [(10, 1 << 20, 1 << 15), (2, 5, 7), (1, 3, 1)])
def test_lines_edge(spark, edge, empty, monkeypatch, least, shard_keys, chunk_lines):
    """Several shards and chunks, down to one line each, give the same result."""
    from hourcast.llm import line_dedup as L

    monkeypatch.setattr(L, "SHARD_KEYS", shard_keys)
    monkeypatch.setattr(L, "CHUNK_LINES", chunk_lines)
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in L.drop_common_lines(edge, least).collect()), key=str)
    assert got == brute_lines(ROWS, least)
    assert L.drop_common_lines(empty, least).count() == 0


def test_lines_least_chars(spark):
    from hourcast.llm.line_dedup import drop_common_lines

    docs = spark.createDataFrame([(i, "éé\néééé") for i in range(10)], "doc_id long, text string")
    assert {r.text for r in drop_common_lines(docs, least_chars=3).collect()} == {"éé"}


def test_perfect_hash():
    from hourcast.llm.line_dedup import Shard

    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 63, (50_000, 2), dtype=np.uint64)
    n = rng.integers(1, 400, len(h))
    s = Shard.read(*Shard.build(h, n, 300).row(0)[1:])
    assert sorted(s.slots(h)) == list(range(len(h)))  # minimal and perfect
    assert (s.count(h) == np.minimum(n, 300)).all()
    strangers = rng.integers(0, 1 << 63, (50_000, 2), dtype=np.uint64)
    assert (s.count(strangers) > 0).mean() < 1e-3 and Shard.build(h[:0], n[:0], 10).count(strangers).sum() == 0
    assert len(s.row(0)[2]) + 4 * len(h) < 6 * len(h)  # bytes a key
    with pytest.raises(ValueError):
        Shard.build(np.zeros((2, 2), np.uint64), np.ones(2), 10)


def test_lines_new_documents(spark, edge):
    """A stored index answers for documents it was not built from."""
    from hourcast.llm import line_dedup as L
    from hourcast.llm.common import materialise

    index = materialise(L.line_index(materialise(L.hashed_lines(edge), "old"), 3), "index")
    new = materialise(L.hashed_lines(spark.createDataFrame([(1, f"fresh\n{COMMON}"), (2, "own 3")], "doc_id long, text string")), "new")
    out = {r.doc_id: r.text for r in L.without_lines(new, L.frequent_lines(new, index, 3)).collect()}
    assert out == {1: "fresh", 2: "own 3"}


# --------------------------------------------------------------------------- 12

def brute_fim(doc_id, text, unit="token"):
    t = text or ""
    tokens = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", t) if unit == "token" else list(t)
    n = len(tokens)
    h = [int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[i:i + 8], 16) for i in (0, 8, 16, 24)]
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, t
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fim_query(spark):
    from hourcast.llm.fill_in_middle import op12_fill_in_middle

    got = {r.doc_id: tuple(r)[1:] for r in op12_fill_in_middle(spark, SF).collect()}
    want = {d: brute_fim(d, t) for d, t, *_ in documents()}
    assert got == {d: (*w[:4], sha(w[4]), sha(t or "")) for (d, t, *_), w in zip(documents(), want.values())}
    assert {w[1] for w in want.values()} == {"plain", "spm", "psm"}


@pytest.mark.parametrize("unit", ["token", "char"])
def test_fim_edge(spark, edge, empty, unit):
    from hourcast.llm.fill_in_middle import fill_in_middle, restored

    out = fill_in_middle(edge, unit=unit)
    got = out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", restored(out.output, out.form).alias("again")).collect()
    want = sorted(((r[0], *brute_fim(r[0], r[1], unit), r[1] or "") for r in ROWS), key=str)
    assert sorted((tuple(r) for r in got), key=str) == want
    assert fill_in_middle(empty, unit=unit).count() == 0
    with pytest.raises(ValueError):
        fill_in_middle(edge, unit="line")


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="a é日😀 \n\t<P>SM", max_size=40), st.integers(0, 10**6), st.integers(1, 9))
def test_fim_texts(text, doc_id, block):
    from hourcast.llm import fill_in_middle as M

    whole, M.BLOCK = M.BLOCK, block  # blocks far smaller than the text
    try:
        raw = text.encode()
        index = M.Exceptions.of(raw)
        cuts = np.arange(len(text) + 1)
        at = np.array([len(text[:k].encode()) for k in cuts])
        assert (index.bytes(cuts) == at).all() and (index.chars(at) == cuts).all()
        for unit in ("token", "char"):
            n, form, p, m, out = M.transform(raw, M.draws(doc_id, 42), unit, 50, 80)
            assert (n, form, p, m, out.decode()) == brute_fim(doc_id, text, unit)
    finally:
        M.BLOCK = whole


# --------------------------------------------------------------------------- 13

def brute_audit(rows, least=3, most=200):
    docs = [(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(t or "")), x or "", s or "") for _, t, x, s in rows]
    out = []
    for lang in {x for _, x, _ in docs}:
        here = [(w, s) for w, x, s in docs if x == lang]
        df = Counter(w for ws, _ in here for w in set(ws))
        vocab = {w for w, n in df.items() if n >= least}
        v = len(vocab)
        counts = {s: Counter(w for ws, t in here if t == s for w in ws if w in vocab) for s in {s for _, s in here}}
        total = sum(counts.values(), Counter())

        def share(c, w):
            return 1 + 10**9 * (c[w] + 1) // (sum(c.values()) + v)

        p = {s: {w: share(c, w) for w in vocab} for s, c in counts.items()}
        q = {w: share(total, w) for w in vocab}
        for s in counts:
            pair = [(sum((p[s][w] - p[o][w]) ** 2 // p[o][w] for w in vocab), o) for o in counts if o != s]
            term = [((p[s][w] - q[w]) ** 2 // q[w], w) for w in vocab if counts[s][w] and p[s][w] > q[w]]
            for part, found in (("pair", pair), ("term", term)):
                found.sort(key=lambda r: (-r[0], r[1].encode()))
                out += [(lang, s, part, w, f, i + 1) for i, (f, w) in enumerate(found) if part == "pair" or i < most]
    return sorted(out)


def audit(df):
    return sorted(tuple(r) for r in df.collect())


def test_audit_query(spark):
    from hourcast.llm.divergence_audit import op13_divergence_audit

    want = brute_audit(documents())
    assert audit(op13_divergence_audit(spark, SF)) == want and {r[2] for r in want} == {"pair", "term"}


def test_audit_edge(spark, edge, empty):
    from hourcast.llm.divergence_audit import divergence_audit

    for least, most in ((3, 200), (1, 2), (1, 5), (1000, 200)):
        assert audit(divergence_audit(edge, least, most)) == brute_audit(ROWS, least, most)
    assert divergence_audit(empty).count() == 0


def test_audit_ties(spark):
    """Many terms of equal counts: a cut inside a cell follows UTF-8 order, and small buffers change nothing."""
    from hourcast.llm import divergence_audit as D

    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600)] + ["zé", "z日", "z😀", "z�"]
    rows = [(i, " ".join(words[i % 2::2] if i % 4 else words), "en", "abc"[i % 3]) for i in range(12)]
    rows += [(50, "nothing kept here", "xx", "a"), (51, None, "xx", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    held, D.HELD = D.HELD, 50
    try:
        assert audit(D.divergence_audit(docs)) == brute_audit(rows)
    finally:
        D.HELD = held
