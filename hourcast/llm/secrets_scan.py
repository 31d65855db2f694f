"""Operator 4: secret scans by a token-efficiency test.

A byte-pair vocabulary trained on prose and code spends few tokens on what people
write and many on random strings.  Every maximal run of key characters with a
letter is encoded with a tiktoken vocabulary; runs with few characters per token are
reported as ``random``, after excluding known digests (plain hex of a digest's
length), UUIDs and identifiers (words, versions, dates, numbers, joined by
separators; words are told from random letters by the lengths of their tokens).  Of
any other run the stretches of separator-delimited pieces with few characters per
token are reported, so names and paths beside a secret do not hide it.  Three base
kinds (``assign``, ``access``, ``hex``) are matched by pattern and always stay.

Spans are of the whole match, in code points, end exclusive.  Defined cases: null
and empty texts have no spans; texts are scanned whole; repeated rows give
repeated results; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.llm.common import table

KINDS = ("assign", "access", "hex", "random")
LEAST_VALUE = 12
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
#: Failing matches of these are shorter runs of the same characters, so a least length in the pattern drops just them.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
#: Candidates of the method: runs of key characters with a letter in them.
LEAST_RUN = 16
RUN = re.compile(rf"[A-Za-z0-9+/_=.-]{{{LEAST_RUN},}}")
PIECE = re.compile(r"[A-Za-z0-9]+")
LETTER = re.compile(r"[A-Za-z]")
DIGEST_LENGTHS = frozenset((32, 40, 56, 64, 96, 128))
UUID = re.compile(r"(?<![0-9A-Za-z])[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![0-9A-Za-z])")
HEX_ONLY = re.compile(r"[0-9a-f]+|[0-9A-F]+")
#: Shape of names that people write: words (with a short number at most), numbers and versions, joined by separators.
#: No character can be matched in two ways and nothing is given back, so a run that fails late costs linear time.
IDENTIFIER = re.compile(r"(?:[A-Za-z]++[0-9]{0,4}+|[0-9]++)(?:[-_./=+](?:[A-Za-z]++[0-9]{0,4}+|[0-9]*+))*+")
NAME = re.compile(r"([A-Za-z]*+)[0-9]{0,4}+|[0-9]++")
MOST_CHARS_PER_TOKEN = 2.2
VOCABULARY = "byte_bpe_50k.tiktoken"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load_encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("scan", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def is_name(piece: str, encoding, most: float) -> bool:
    """Whether a piece is a number, or letters that the vocabulary knows as words and a short number.

    A piece too short to be reported alone may have one token more: abbreviations."""
    m = NAME.fullmatch(piece)
    if not m:
        return False
    letters = m.group(1) or ""
    grace = 1 if len(letters) < LEAST_RUN else 0
    # names in capitals are known by their lower-cased words
    n = min(len(encoding.encode_ordinary(x)) for x in {letters, letters.lower()})
    return len(letters) < 4 or len(letters) > most * (n - grace)


def excluded(run: str, encoding, most: float = MOST_CHARS_PER_TOKEN) -> bool:
    """Known digests and identifiers are random-looking but no secrets."""
    if HEX_ONLY.fullmatch(run) and len(run) in DIGEST_LENGTHS:
        return True
    if UUID.fullmatch(run):
        return True
    return bool(IDENTIFIER.fullmatch(run.strip("-_./=+"))) and all(is_name(p, encoding, most) for p in PIECE.findall(run))


def random_stretches(run: str, encoding, most: float) -> Iterator[tuple[int, int]]:
    """Stretches of pieces with at most ``most`` characters per token, names, digests and UUIDs counting against them.

    Each piece scores ``most`` a token less its length; these are the maximal scoring
    stretches (Ruzzo and Tompa), in time linear in the run's pieces."""
    uuids = [m.span() for m in UUID.finditer(run)]
    # per stretch: start, end, score of all before it, score up to its end
    found: list[tuple[int, int, float, float]] = []
    total, u = 0.0, 0
    for m in PIECE.finditer(run):
        a, b = m.span()
        piece = m.group()
        while u < len(uuids) and uuids[u][1] <= a:
            u += 1
        known = u < len(uuids) and uuids[u][0] <= a
        if known or (HEX_ONLY.fullmatch(piece) and len(piece) in DIGEST_LENGTHS) or is_name(piece, encoding, most):
            total -= b - a
            continue
        score = most * len(encoding.encode_ordinary(piece)) - (b - a)
        if score <= 0:
            total += score
            continue
        new = (a, b, total, total + score)
        total += score
        while found:
            at = len(found) - 1
            while at >= 0 and found[at][2] >= new[2]:
                at -= 1
            if at < 0 or found[at][3] >= new[3]:
                break
            new = (found[at][0], b, found[at][2], new[3])
            del found[at:]
        found.append(new)
    yield from ((a, b) for a, b, _, _ in found if b - a >= LEAST_RUN)


def random_runs(text: str, encoding, most: float = MOST_CHARS_PER_TOKEN) -> Iterator[tuple[int, int]]:
    for m in RUN.finditer(text):
        run = m.group()
        if not LETTER.search(run) or excluded(run, encoding, most):
            continue
        if len(run) <= most * len(encoding.encode_ordinary(run)):
            yield m.span()
        else:
            yield from ((m.start() + a, m.start() + b) for a, b in random_stretches(run, encoding, most))


def scan_text(text: str, encoding, most: float = MOST_CHARS_PER_TOKEN) -> list[tuple[int, int, int]]:
    """All spans of a text: (start, kind index, end), by start, then kind."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST_VALUE]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    spans += [(a, 3, b) for a, b in random_runs(text, encoding, most)]
    return sorted(spans)


def scan_secrets(docs: DataFrame, path: str | None = None, most: float = MOST_CHARS_PER_TOKEN) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id and spans, an array of (kind, start, end)."""
    path = path or vocabulary_path()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(path)
        kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        for batch in batches:
            spans = [
                [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in scan_text(t.as_py() or "", encoding, most)]
                for t in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(kind))], ["doc_id", "spans"])

    return docs.select("doc_id", "text").mapInArrow(
        scan, "doc_id long, spans array<struct<kind: string, start: int, end: int>>"
    )


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != "random")
    n = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )


def digest(spans: str) -> str:
    return hashlib.sha256(spans.encode()).hexdigest()
