"""Inputs on which an operator once did less than the whole job."""

import os
import random
import re
import string
import subprocess
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_identifier_is_linear():
    code = """
from hourcast.llm.secrets_scan import IDENTIFIER
for late in ("a" * 10_000 + "1a", "a" + "-1" * 5_000 + "1a1", "getting_started_with_distributed_processing_2x"):
    assert not IDENTIFIER.fullmatch(late)
for name in ("release-2024-01-02", "some_variable_name_12", "HTTPServer2", "1.2.3", "a--b", "x12345"):
    assert bool(IDENTIFIER.fullmatch(name)) == (name != "x12345")
"""
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=60)


def test_random_runs_beside_names():
    from hourcast.llm import secrets_scan as S

    encoding = S.load_encoding(S.vocabulary_path())
    found = lambda t: [t[a:b] for a, b in S.random_runs(t, encoding)]
    path = "www.example.com/some/long/path/of/the/site/index/page/view.html/session="
    rng = random.Random(7)
    for letters, length in ((string.ascii_letters + string.digits, 24), (string.ascii_letters, 20), (string.ascii_lowercase, 40)):
        for before in ("", "production.database.credentials.token=", path):
            keys = ["".join(rng.choices(letters, k=length)) for _ in range(200)]
            assert sum(any(k in f for f in found(before + k)) for k in keys) >= 190
    assert any("xKqZvTgHjWpLsDfRbNmY7" in f for f in found("xKqZvTgHjWpLsDfRbNmY7"))
    parts = ["".join(rng.choices(string.ascii_letters + string.digits, k=20)) for _ in range(2)]
    spans = found(path + "+".join(parts) + "/index/page/view")
    assert len(spans) == 1 and "+".join(parts) in spans[0]  # one secret, not two
    for name in (
        path + "12", "getting_started_with_distributed_processing_2x", "__NORMALIZE_WHITESPACE__", "releases/2024-01-02/notes_v2.1.0",
        "internationalization", "=" * 30 + "a", "archive.tar.gz/archive.tar.xz",
    ):
        assert found(name) == [], name
    for known in ("0f" * 20, "123e4567-e89b-12d3-a456-426614174000"):
        assert found("international/information/" * 6 + known) == []


def test_mixing_keeps_its_share(spark):
    """One rare row does not change how much of the rest the pipeline's mixing stage keeps."""
    import corpus_pipeline as C
    from hourcast.llm.mixing import mix_sources

    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id is not null").select("doc_id", "text", "lang", "source")
    rare = spark.createDataFrame([(10**9, "one two three four five", "xx", "rare")], docs.schema)
    kept = C.mixing_stage(spark, docs.union(rare), "").where("doc_id < 1000000000").count()
    assert abs(kept / docs.count() - C.MIX_SHARE) < 0.02  # 0.085 where the largest probability was scaled to 1
    rows = mix_sources(docs.union(rare), keep_share=C.MIX_SHARE).collect()
    assert all(0 <= r.prob <= 1 for r in rows) and [r.prob for r in rows if r.source == "rare"] == [1.0]
    tokens = sum(r.tokens for r in rows)
    assert abs(sum(r.prob * r.tokens for r in rows) / tokens - C.MIX_SHARE) < 0.005


def test_more_than_64_languages(spark):
    """Each of 130 languages has words of its own, in the first, second and third word of the masks."""
    from hourcast.llm.language_id import fit_language_model, identify

    rng = random.Random(11)
    words = {f"l{i:03}": ["".join(rng.choices(string.ascii_lowercase, k=9)) for _ in range(12)] for i in range(130)}
    rows = [(10 * i + j, " ".join(rng.choices(w, k=60)), x) for i, (x, w) in enumerate(words.items()) for j in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit_language_model(docs.where("doc_id % 10 > 0"))
    assert model.languages == sorted(words) and len(model.masks) == 3
    got = {r.doc_id: r.lang_pred for r in identify(docs.where("doc_id % 10 = 0"), model).collect()}
    assert len(got) == 130 and all(got[d] == x for d, _, x in rows if d % 10 == 0)


def test_toxicity_of_fully_labelled_table(spark):
    from pyspark.sql import functions as F

    from hourcast.llm.toxicity import fit_toxicity, score_toxicity

    rng = random.Random(12)
    words = ["".join(rng.choices(string.ascii_lowercase, k=6)) for _ in range(300)]
    rows = [(i, " ".join(rng.choices(words, k=30) + ["vile", "filth"] * (i % 5 == 0)), int(i % 5 == 0)) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = fit_toxicity(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"), F.lit(True))
    scores = {r.doc_id: r.score for r in score_toxicity(docs, model).collect()}
    assert min(scores[i] for i in range(0, 600, 5)) > 0.7 and max(scores[i] for i in range(600) if i % 5) < 0.3


def test_licenses_that_share_a_word():
    from hourcast.llm import license_scan as L

    labels = lambda t: sorted({r.label for _, _, r in L.detect(t, L.build_rules())})
    assert labels(b"bsd license mit") == ["bsd", "mit"]
    assert labels(b"psf license 2 0") == ["python"]
    assert labels(b"gnu lesser general public license version 2") == ["lgpl"]  # gpl's detection is contained
    assert labels(b"cc by sa 4 0") == ["cc-by-sa"]


def test_queries_equal_plain_python(spark):
    """Every column of op4 and op10 on sf0.001, from the texts one at a time."""
    from hourcast.llm import license_scan as L
    from hourcast.llm import secrets_scan as S

    sf = "/root/testdata/sf0.001"
    texts = duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall()
    encoding, rules = S.load_encoding(S.vocabulary_path()), L.build_rules()
    secrets, licenses = {}, {}
    for d, t in texts:
        spans = [(S.KINDS[k], a, b) for a, k, b in S.scan_text(t or "", encoding)]
        joined = lambda x: ",".join(f"{k}:{a}:{b}" for k, a, b in x)
        n = [sum(k == kind for k, _, _ in spans) for kind in S.KINDS[:3]]
        secrets[d] = (*n, S.digest(joined(x for x in spans if x[0] != "random")), joined(spans))
        lower = re.sub(rb"[A-Z]", lambda m: m.group().lower(), (t or "").encode())
        words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        places = sorted((i, x) for p, x in L.BASE for i in range(len(words)) if words[i:i + len(p.split())] == p.split())
        hits = [r for _, _, r in L.detect(b" ".join(words), rules)]
        names = lambda x: ",".join(sorted(set(x)))
        base = [x for _, x in places]
        licenses[d] = (
            len(words), len(places), min(places)[0] if places else None, max(places)[0] if places else None, names(base),
            names(base + [r.label for r in hits]), max([0.0, *(r.confidence for r in hits), *([0.8] if places else [])]),
        )
    assert {r[0]: tuple(r[1:]) for r in S.op4_secret_scan(spark, sf).collect()} == secrets
    assert {r[0]: tuple(r[1:]) for r in L.op10_license_scan(spark, sf).collect()} == licenses
    assert any(x[5] for x in licenses.values()) and any(x[4] for x in secrets.values())


def test_group_below_the_threshold_makes_no_pairs(spark, monkeypatch):
    """Documents of similarity 0.74 to each other, with sets of over 256: all their pairs were verified on full sets."""
    from hourcast.llm import minhash_dedup as M

    rng = random.Random(3)
    words = lambda n: ["".join(rng.choices(string.ascii_lowercase, k=9)) for _ in range(n)]
    common = words(340)
    texts = [" ".join(common + words(60)) for _ in range(60)]
    texts.append(" ".join(texts[40].split()[:-5]))  # its only similar text is not the group's first
    seen, plain = [], M.verified

    def verified(pairs, *rest):
        seen.append(pairs.count())
        return plain(pairs, *rest)

    monkeypatch.setattr(M, "verified", verified)
    got = {r.doc_id: r.component_id for r in M.near_dups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {i: 40 if i == 60 else i for i in range(61)}
    assert len(seen) == 2 and seen[1] < 600  # of 60 * 59 / 2; what is left are pairs of lists of up to 32


def join_rows(df) -> int:
    """Rows that the joins of a collected table's plan made."""
    def nodes(p):
        yield p
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            below = [p.executedPlan()]
        elif name.endswith("QueryStageExec"):
            below = [p.plan()]
        else:
            below = [p.children().apply(i) for i in range(p.children().size())]
        for x in below:
            yield from nodes(x)

    joins = [p for p in nodes(df._jdf.queryExecution().executedPlan()) if "Join" in p.nodeName()]
    assert joins
    return sum(p.metrics().apply("numOutputRows").value() for p in joins)


@pytest.mark.parametrize("pipeline", [False, True])
def test_members_of_long_lists_are_joined_once(spark, monkeypatch, pipeline):
    """A member's lists and prints were joined to each of its rows: one a list and block, so the square of a group."""
    import corpus_pipeline
    from hourcast.llm import minhash_dedup as M

    rng = random.Random(7)
    words = lambda n: ["".join(rng.choices(string.ascii_lowercase, k=9)) for _ in range(n)]
    common = words(340)
    texts = [" ".join(common + words(60)) for _ in range(70)]
    texts += [" ".join(texts[i].split()[:-5]) for i in (0, 0, 30, 50)]
    rows = [*enumerate(texts), (5, texts[60] + " more"), (5, "")]  # a doc_id of three texts joins two groups
    rows.append((None, texts[0]))
    seen, plain = [], M.open_pairs

    def open_pairs(*rest):
        found = plain(*rest)
        pairs = [tuple(r) for r in found.collect()]
        assert len(pairs) == len(set(pairs))
        seen.append(join_rows(found))
        return found

    monkeypatch.setattr(M, "open_pairs", open_pairs)
    monkeypatch.setattr(M, "BLOCK", 32)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    group = {70: 0, 71: 0, 72: 30, 73: 50, 60: 5}
    if pipeline:
        got = [r.doc_id for r in corpus_pipeline.near_stage(spark, docs, "").collect()]
        assert sorted(i for i in got if i is not None) == sorted(i for i, _ in rows if i is not None and i not in group)
        assert got.count(None) == 1
    else:
        got = sorted((r.doc_id, r.component_id) for r in M.near_dups(docs).where("doc_id is not null").collect())
        assert got == sorted((i, group.get(i, i)) for i, _ in rows if i is not None)
    assert seen[0] < 10 * len(rows)  # members and their texts, not places in lists and blocks


def test_stars_take_no_round(spark, monkeypatch):
    """Links that are stars already took a round of joins, with four tables, to be told so."""
    from hourcast.llm import common as C

    made, plain = [], C.materialise
    monkeypatch.setattr(C, "materialise", lambda df, name: made.append(name) or plain(df, name))
    find = lambda rows: {r.id: r.component_id for r in C.components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert find([(1, 2), (3, 1), (9, 7), (5, 5), (2, 1)]) == {1: 1, 2: 1, 3: 1, 7: 7, 9: 7}
    assert made == ["edges"]
    chain = [(i, i + 1) for i in range(20)] + [(100, 103), (103, 101), (101, 102)]
    assert find(chain) == {i: 0 for i in range(21)} | {i: 100 for i in range(100, 104)}


def test_vocabulary_is_no_text_of_the_plan(spark):
    """Each version of a plan, and each run that the driver remembers, once held the rank table as 1.8 MB of text."""
    import corpus_pipeline

    docs = spark.createDataFrame([(1, "the plan of a query"), (2, None)], "doc_id long, text string")
    out = corpus_pipeline.bpe_stage(spark, docs, "")
    plan = out._jdf.queryExecution()
    assert len(plan.toString()) < 200_000
    assert "subquery" in plan.optimizedPlan().toString() and " AS table#" not in plan.optimizedPlan().toString()  # no row carries it
    assert sorted((r.doc_id, r.n_tokens, r.n_decoded) for r in out.collect()) == [(1, 5, 19), (2, 0, 0)]
