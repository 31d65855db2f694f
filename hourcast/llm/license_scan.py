"""Operator 10: license scans by ordered signature rules.

A rule is a regular expression over the text's words (joined by single spaces)
with a label, a priority and a confidence.  The rules are hundreds: hand-written
stems times versions and forms.  A keyword prefilter decides which rules run on a
text.  Overlapping detections are resolved in order of priority: a detection
contained in one of a better rule is suppressed, and of two of the same label that
overlap in part the better stays; kept detections are looked up by bisection, so time
grows little more than in proportion to a text's detections.  The base phrases are found apart and always stay.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased.
Defined cases: null and empty texts have no words, no places, score 0; texts are
scanned whole; repeated rows give repeated results; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.llm.common import LOWER_BYTES, table

#: Base phrases and their labels.
BASE = ((b"gnu general public license", "gpl"), (b"apache license", "apache"), (b"cc by", "cc-by"), (b"mit license", "mit"))
#: Non-word bytes become spaces, A-Z is lower-cased, bytes of multi-byte characters stay.
WORD_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in LOWER_BYTES)
FIRST_WORDS = frozenset(p.split()[0] for p, _ in BASE)

#: Hand-written stems: label, keyword, expressions; ``{v}`` stands for each version in turn.
FAMILIES = (
    ("gpl", "gpl", ("1", "2", "3", "1 0", "2 0", "3 0"),
     ("gpl v? ?{v}", "gpl version {v}", "gplv{v}", "gpl {v} (?:only|or later)", "gnu gpl v? ?{v}")),
    ("gpl", "general public", ("1", "2", "3"),
     ("general public license version {v}", "general public license v{v}", "general public license as published by the free software foundation either version {v}")),
    ("lgpl", "lgpl", ("2", "2 0", "2 1", "3", "3 0"),
     ("lgpl v? ?{v}", "lgplv{v}", "lgpl {v} (?:only|or later)", "gnu lgpl v? ?{v}")),
    ("lgpl", "general public", ("2", "2 1", "3"), ("(?:lesser|library) general public license version {v}", "(?:lesser|library) general public license v{v}")),
    ("agpl", "agpl", ("1", "3", "1 0", "3 0"), ("agpl v? ?{v}", "agplv{v}", "agpl {v} (?:only|or later)", "gnu agpl v? ?{v}")),
    ("agpl", "general public", ("1", "3"), ("affero general public license version {v}", "affero general public license v{v}")),
    ("apache", "apache", ("1 0", "1 1", "2", "2 0"),
     ("apache license version {v}", "apache license v? ?{v}", "apache software license (?:version |v)?{v}", "licensed under the apache license version {v}", "apache {v} license")),
    ("mpl", "mozilla", ("1", "1 0", "1 1", "2", "2 0"), ("mozilla public license (?:version |v ?)?{v}",)),
    ("mpl", "mpl", ("1 0", "1 1", "2 0"), ("mpl v? ?{v}", "mplv{v}", "mpl version {v}")),
    ("epl", "eclipse", ("1 0", "2 0"), ("eclipse public license (?:version |v ?)?{v}", "eclipse distribution license (?:version |v ?)?{v}")),
    ("cddl", "cddl", ("1 0", "1 1"), ("cddl v? ?{v}", "cddl version {v}")),
    ("cc-by", "cc", ("1 0", "2 0", "2 5", "3 0", "4 0"), ("cc by {v}", "cc by {v} (?:international|unported|generic)")),
    ("cc-by-sa", "cc", ("1 0", "2 0", "2 5", "3 0", "4 0"), ("cc by sa {v}",)),
    ("cc-by-nc", "cc", ("1 0", "2 0", "2 5", "3 0", "4 0"), ("cc by nc {v}",)),
    ("cc-by-nd", "cc", ("1 0", "2 0", "2 5", "3 0", "4 0"), ("cc by nd {v}",)),
    ("cc-by-nc-sa", "cc", ("1 0", "2 0", "2 5", "3 0", "4 0"), ("cc by nc sa {v}",)),
    ("cc-by-nc-nd", "cc", ("1 0", "2 0", "2 5", "3 0", "4 0"), ("cc by nc nd {v}",)),
    ("cc-by", "creative commons", ("1 0", "2 0", "2 5", "3 0", "4 0"), ("creative commons attribution {v}", "creative commons attribution {v} (?:international|unported|generic)")),
    ("cc-by-sa", "creative commons", ("1 0", "2 0", "2 5", "3 0", "4 0"), ("creative commons attribution share ?alike {v}",)),
    ("cc-by-nc", "creative commons", ("1 0", "2 0", "2 5", "3 0", "4 0"), ("creative commons attribution non ?commercial {v}",)),
    ("cc-by-nd", "creative commons", ("1 0", "2 0", "2 5", "3 0", "4 0"), ("creative commons attribution no ?deriv(?:ative)?s?(?: works)? {v}",)),
    ("cc0", "cc0", ("1 0",), ("cc0 {v}", "cc0 {v} universal")),
    ("bsd", "bsd", ("0", "1", "2", "3", "4"), ("bsd {v} clause", "{v} clause bsd", "bsd {v} clause license")),
    ("osl", "open software license", ("1 0", "2 0", "2 1", "3 0"), ("open software license (?:version |v ?)?{v}",)),
    ("afl", "academic free", ("1 1", "1 2", "2 0", "2 1", "3 0"), ("academic free license (?:version |v ?)?{v}",)),
    ("artistic", "artistic", ("1 0", "2 0"), ("artistic license (?:version |v ?)?{v}",)),
    ("boost", "boost", ("1 0",), ("boost software license (?:version |v ?)?{v}",)),
    ("eupl", "union public", ("1 0", "1 1", "1 2"), ("european union public licen[cs]e (?:version |v ?)?{v}",)),
    ("zpl", "zope", ("1 1", "2 0", "2 1"), ("zope public license (?:version |v ?)?{v}",)),
    ("lppl", "latex project", ("1 0", "1 1", "1 2", "1 3", "1 3c"), ("latex project public license (?:version |v ?)?{v}",)),
    ("python", "python", ("2", "2 0"), ("python software foundation license (?:version |v ?)?{v}",)),
    ("python", "psf", ("2", "2 0"), ("psf license (?:version |v ?)?{v}",)),
    ("odbl", "open database", ("1 0",), ("open database license (?:version |v ?)?{v}",)),
    ("ecl", "educational community", ("1 0", "2 0"), ("educational community license (?:version |v ?)?{v}",)),
)
#: Single rules: label, keyword, confidence, expression.
SINGLES = (
    ("gpl", "general public", 0.95, "gnu general public license"),
    ("gpl", "gpl", 0.6, "gnu gpl"), ("gpl", "free software foundation", 0.8, "redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "general public", 0.95, "gnu (?:lesser|library) general public license"), ("lgpl", "lgpl", 0.6, "gnu lgpl"),
    ("agpl", "general public", 0.95, "gnu affero general public license"), ("agpl", "agpl", 0.6, "gnu agpl"),
    ("apache", "apache", 0.9, "apache license"), ("apache", "apache", 0.95, "licensed under the apache license"),
    ("mit", "mit", 0.9, "mit license"), ("mit", "mit", 0.95, "(?:released|licensed|available|distributed) under the mit license"),
    ("mit", "permission is hereby granted", 1.0, "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "as is", 0.7, "the software is provided as is without warranty of any kind"),
    ("bsd", "bsd", 0.85, "bsd license"), ("bsd", "bsd", 0.85, "berkeley software distribution license"),
    ("bsd", "redistribution and use", 1.0, "redistribution and use in source and binary forms with or without modification are permitted"),
    ("isc", "isc", 0.85, "isc license"), ("isc", "permission to use", 0.95, "permission to use copy modify and or distribute this software for any purpose"),
    ("mpl", "mozilla", 0.85, "mozilla public license"), ("mpl", "source code form", 1.0, "this source code form is subject to the terms of the mozilla public license"),
    ("epl", "eclipse", 0.85, "eclipse public license"), ("cddl", "common development", 0.9, "common development and distribution license"),
    ("cc-by", "cc", 0.8, "cc by"), ("cc-by-sa", "cc", 0.85, "cc by sa"), ("cc-by-nc", "cc", 0.85, "cc by nc"), ("cc-by-nd", "cc", 0.85, "cc by nd"),
    ("cc-by-nc-sa", "cc", 0.9, "cc by nc sa"), ("cc-by-nc-nd", "cc", 0.9, "cc by nc nd"), ("cc0", "cc0", 0.85, "cc0"),
    ("cc-by", "creative commons", 0.8, "creative commons attribution"), ("cc-by-sa", "creative commons", 0.9, "creative commons attribution share ?alike"),
    ("cc-by-nc", "creative commons", 0.9, "creative commons attribution non ?commercial"),
    ("unlicense", "unencumbered", 1.0, "free and unencumbered software released into the public domain"), ("unlicense", "unlicense", 0.7, "the unlicense"),
    ("public-domain", "public domain", 0.6, "(?:dedicated|released|placed) (?:to|into|in) the public domain"),
    ("wtfpl", "you want to public", 0.95, "do what the [a-z]+ you want to public license"), ("zlib", "zlib", 0.8, "zlib license"),
    ("boost", "boost", 0.85, "boost software license"), ("artistic", "artistic", 0.8, "artistic license"),
    ("python", "python", 0.8, "python software foundation license"), ("eupl", "eupl", 0.8, "eupl"),
    ("proprietary", "all rights reserved", 0.5, "all rights reserved"), ("proprietary", "proprietary and confidential", 0.9, "proprietary and confidential"),
)
#: Identifiers of which ``spdx license identifier <id>`` and ``license <id>`` rules are made.
SPDX = (
    ("mit", "mit"), ("apache", "apache 2 0"), ("apache", "apache 1 1"), ("bsd", "bsd 2 clause"), ("bsd", "bsd 3 clause"), ("bsd", "0bsd"),
    ("gpl", "gpl 2 0"), ("gpl", "gpl 3 0"), ("lgpl", "lgpl 2 1"), ("lgpl", "lgpl 3 0"), ("agpl", "agpl 3 0"), ("mpl", "mpl 2 0"),
    ("epl", "epl 1 0"), ("epl", "epl 2 0"), ("cc0", "cc0 1 0"), ("cc-by", "cc by 4 0"), ("cc-by-sa", "cc by sa 4 0"), ("isc", "isc"),
    ("unlicense", "unlicense"), ("zlib", "zlib"), ("boost", "bsl 1 0"), ("artistic", "artistic 2 0"), ("cddl", "cddl 1 0"), ("eupl", "eupl 1 2"),
)


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: bytes
    confidence: float
    pattern: re.Pattern
    #: Smaller is better: confidence first, then the longer expression.
    priority: tuple


def build_rules() -> list[Rule]:
    """All rules, best first."""
    raw = [(label, kw, conf, exp) for label, kw, conf, exp in SINGLES]
    for label, kw, versions, expressions in FAMILIES:
        raw += [(label, kw, 1.0, e.replace("{v}", v)) for v in versions for e in expressions]
    for label, name in SPDX:
        raw += [(label, "spdx", 1.0, f"spdx license identifier {name}"), (label, "licen", 0.75, f"licen[cs]e {name}")]
    rules = [
        Rule(label, kw.encode(), conf, re.compile(rb"(?<![^ ])" + exp.encode() + rb"(?![^ ])"), (-conf, -len(exp), exp))
        for label, kw, conf, exp in raw
    ]
    return sorted(rules, key=lambda r: r.priority)


class Kept:
    """Detections kept so far.  Those of one label never overlap, so of each label only the one that begins last
    at or before a place, and the next, can matter for it: both are found by bisection."""

    def __init__(self):
        self.by_label: dict[str, tuple[list[int], list[int]]] = {}

    def suppressed(self, start: int, end: int, label: str) -> bool:
        """Whether a kept detection contains start to end, or one of ``label`` overlaps it."""
        for x, (starts, ends) in self.by_label.items():
            i = bisect.bisect_right(starts, start)
            if i and ends[i - 1] >= end or x == label and (i and ends[i - 1] > start or i < len(starts) and starts[i] < end):
                return True
        return False

    def add(self, start: int, end: int, label: str) -> None:
        starts, ends = self.by_label.setdefault(label, ([], []))
        i = bisect.bisect_right(starts, start)
        starts.insert(i, start)
        ends.insert(i, end)


def detect(words: bytes, rules: list[Rule]) -> list[tuple[int, int, Rule]]:
    """Detections in space-joined words that no better rule's detection contains, nor one of their label overlaps."""
    present = {}
    kept, out = Kept(), []
    for r in rules:
        if present.setdefault(r.keyword, r.keyword in words):
            for m in r.pattern.finditer(words):
                if not kept.suppressed(m.start(), m.end(), r.label):
                    kept.add(m.start(), m.end(), r.label)
                    out.append((m.start(), m.end(), r))
    return out


def base_places(words: list[bytes]) -> list[tuple[int, str]]:
    """Places (start word, label) where a base phrase's words stand consecutively."""
    if FIRST_WORDS.isdisjoint(words):
        return []
    found = []
    for phrase, label in BASE:
        seq = phrase.split()
        at = -1
        for _ in range(words.count(seq[0])):
            at = words.index(seq[0], at + 1)
            if words[at:at + len(seq)] == seq:
                found.append((at, label))
    return sorted(found)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, places (word, label) of base phrases, and detections
    (label, confidence, first and end word) of the rules."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = build_rules()
        gate = re.compile(b"|".join(re.escape(k) for k in sorted({r.keyword for r in rules})))
        place = pa.struct([("word", pa.int64()), ("label", pa.string())])
        hit = pa.struct([("label", pa.string()), ("confidence", pa.float64()), ("word", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            n, places, hits = [], [], []
            for t in batch.column(1):
                words = (t.as_py() or b"").translate(WORD_BYTES).split()
                n.append(len(words))
                places.append([{"word": w, "label": x} for w, x in base_places(words)])
                joined = b" ".join(words)
                got = detect(joined, rules) if gate.search(joined) else []
                if got:  # words before each place, from one pass over the separators
                    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20)
                    first = np.searchsorted(spaces, [a for a, _, _ in got]).tolist()
                    last = np.searchsorted(spaces, [b for _, b, _ in got]).tolist()
                    hits.append([
                        {"label": r.label, "confidence": r.confidence, "word": a, "end": b + 1} for (_, _, r), a, b in zip(got, first, last, strict=True)
                    ])
                else:
                    hits.append([])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(places, pa.list_(place)), pa.array(hits, pa.list_(hit))],
                ["doc_id", "n_words", "places", "hits"],
            )

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        scan,
        "doc_id long, n_words long, places array<struct<word: long, label: string>>, "
        "hits array<struct<label: string, confidence: double, word: long, end: long>>",
    )


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    names = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    base = F.transform("places", lambda p: p["label"])
    starts = F.transform("places", lambda p: p["word"])
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        names(base).alias("base_labels"),
        names(F.concat(base, F.transform("hits", lambda h: h["label"]))).alias("labels"),
        F.greatest(
            F.coalesce(F.array_max(F.transform("hits", lambda h: h["confidence"])), F.lit(0.0)),
            F.when(F.size("places") > 0, F.lit(0.8)).otherwise(F.lit(0.0)),
        ).alias("score"),
    )
