"""Operator 12: fill-in-middle transformation with a sparse exception index.

A text stays UTF-8 bytes throughout.  Its *exception index* records only the
multibyte characters: byte position, code-point position and the running excess of
bytes over characters.  Converting a cut is one ``searchsorted`` in it; between
exceptions the two positions differ by a constant, so ASCII spans cost nothing and
plain ASCII texts have an empty index.  Token ends are found on the bytes, as
white space is ASCII, in blocks of ``BLOCK`` bytes, so a very long text needs
little beside itself.

The transformation is a projection (no shuffle).  Cuts and forms are drawn from a
hash of seed and doc_id: a rerun task gives the same rows.

Defined cases: null text is empty and stays plain with n = 0; a null doc_id is hashed
as the empty string; rows that share a doc_id get the same draws; texts that hold a
marker stay plain; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.llm.common import table

SEED = 42
#: Percent of documents transformed, and of those percent in suffix-first order.
RATE = 50
SUFFIX_FIRST = 80
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
BLOCK = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


@dataclass
class Exceptions:
    """The multibyte characters of a UTF-8 text, in order."""

    bytes_at: np.ndarray
    chars_at: np.ndarray
    #: Excess bytes up to and with each of them, after a leading 0.
    excess: np.ndarray

    @classmethod
    def of(cls, text: bytes) -> Exceptions:
        if text.isascii():
            none = np.zeros(0, np.uint32)
            return cls(none, none, np.zeros(1, np.uint32))
        at, more = [], []
        for start in range(0, len(text), BLOCK):
            b = np.frombuffer(text, np.uint8, min(BLOCK, len(text) - start), start)
            lead = np.flatnonzero(b >= 0xC0)
            at.append((lead + start).astype(np.uint32))
            b = b[lead]
            more.append(1 + (b >= 0xE0).astype(np.uint8) + (b >= 0xF0))
        bytes_at = np.concatenate(at)
        excess = np.zeros(len(bytes_at) + 1, np.uint32)
        np.cumsum(np.concatenate(more), out=excess[1:])
        return cls(bytes_at, bytes_at - excess[:-1], excess)

    def chars(self, byte_cuts: np.ndarray) -> np.ndarray:
        """Code points before each byte position (character boundaries)."""
        return byte_cuts - self.excess[np.searchsorted(self.bytes_at, byte_cuts)]

    def bytes(self, char_cuts: np.ndarray) -> np.ndarray:
        """Bytes before each code-point position."""
        return char_cuts + self.excess[np.searchsorted(self.chars_at, char_cuts)]


class Tokens:
    """Ends of a text's tokens: white space with the word after it, or white space at the end."""

    def __init__(self, text: bytes):
        self.text = text
        counts = [len(self._ends(s)) for s in range(0, len(text), BLOCK)]
        self.before = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        self.n = int(self.before[-1])

    def _ends(self, start: int) -> np.ndarray:
        n = min(BLOCK, len(self.text) - start)
        space = _SPACE[np.frombuffer(self.text, np.uint8, min(n + 1, len(self.text) - start), start)]
        if len(space) == n:  # the text ends here: whatever it ends with ends a token
            space = np.append(space, True)
            end = ~space[:-1] & space[1:]
            end[-1] = True
        else:
            end = ~space[:-1] & space[1:]
        return np.flatnonzero(end) + (start + 1)

    def cut(self, k: int) -> int:
        """Bytes of the first ``k`` tokens."""
        if k == 0:
            return 0
        block = int(np.searchsorted(self.before, k)) - 1
        return int(self._ends(block * BLOCK)[k - 1 - self.before[block]])


def draws(doc_id: int | None, seed: int) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]


def transform(text: bytes, h: list[int], unit: str, rate: int, suffix_first: int) -> tuple[int, str, int | None, int | None, bytes]:
    """``(n, form, prefix_chars, middle_chars, output)`` of one text with draws ``h``."""
    plain = not text or h[2] % 100 >= rate or PREFIX in text or SUFFIX in text or MIDDLE in text
    if unit == "token":
        tokens = Tokens(text)
        n = tokens.n
        if plain:
            return n, "plain", None, None, text
        index = Exceptions.of(text)
        units = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        cuts = np.array([tokens.cut(k) for k in units])
        chars = index.chars(cuts)
    else:
        index = Exceptions.of(text)
        n = len(text) - int(index.excess[-1])
        if plain:
            return n, "plain", None, None, text
        chars = np.array(sorted((h[0] % (n + 1), h[1] % (n + 1))))
        cuts = index.bytes(chars)
    a, b = int(cuts[0]), int(cuts[1])
    spm = h[3] % 100 < suffix_first
    order = (SUFFIX, text[b:], PREFIX, text[:a]) if spm else (PREFIX, text[:a], SUFFIX, text[b:])
    return n, "spm" if spm else "psm", int(chars[0]), int(chars[1] - chars[0]), b"".join((*order, MIDDLE, text[a:b]))


def fill_in_middle(docs: DataFrame, seed: int = SEED, unit: str = "token", rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, n (units), form, prefix_chars, middle_chars (code points,
    null if plain), output.  ``unit`` is ``token`` or ``char`` (cuts at any code point)."""
    if unit not in ("token", "char"):
        raise ValueError(f"unit is token or char, not {unit}")
    doc_id = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            out = [
                transform(texts[i].as_py(), draws(d, seed), unit, rate, suffix_first)
                for i, d in enumerate(batch.column(0).to_pylist())
            ]
            n, form, prefix, middle, output = zip(*out, strict=True) if out else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                 pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")).mapInArrow(
        rows, f"doc_id {doc_id}, n long, form string, prefix_chars long, middle_chars long, output string"
    )


def restored(output: Column, form: Column) -> Column:
    """The text an output was made of.  No marker stands in a transformed text, and none can
    begin before a marker and end in it, so the output splits at exactly three."""
    parts = F.split(output, "<[PSM]>", -1)
    first, second, middle = (F.get(parts, i) for i in (1, 2, 3))
    return F.when(form == "psm", F.concat(first, middle, second)).when(form == "spm", F.concat(second, middle, first)).otherwise(output)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle(table(spark, sf_dir, "documents"))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"),
        sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS s FROM documents),
t AS (SELECT *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
  ('0x' || substr(s, 1, 8))::BIGINT AS h1, ('0x' || substr(s, 9, 8))::BIGINT AS h2, ('0x' || substr(s, 17, 8))::BIGINT AS h3,
  ('0x' || substr(s, 25, 8))::BIGINT AS h4 FROM d),
c AS (SELECT doc_id, text, u, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= {RATE} THEN 'plain'
    WHEN h4 % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form FROM t),
p AS (SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS prefix, coalesce(array_to_string(u[a + 1:b], ''), '') AS middle,
  coalesce(array_to_string(u[b + 1:], ''), '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM p
"""
