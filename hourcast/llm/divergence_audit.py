"""Operator 13: source divergence audit by count-cell ranking.

How far the words of each source of a language depart from its other sources and
from the language as a whole.  Terms are counted per (language, source) inside the
tasks, summed by one aggregation and given their language's count.  From there on no
term is scored: terms are grouped into *cells* of equal counts, ``f`` is evaluated once
a cell, and a cell weighs as much as it has terms.

* Part ``term``: cells of (group count, language count).  Cells of equal value are
  merged, ranked by value with cumulative multiplicity, and only those that begin
  within the first ``most`` ranks are expanded to their terms, in UTF-8 order.
* Part ``pair``: cells of (own count, other's count).  Only terms that both sources
  use are counted in cells of two counts; the cells with a zero on one or both sides follow
  from the sources' own histograms of counts, since for any pair

      sum f = sum over shared terms of f(c, d) - f(c, 0) - f(0, d) + f(0, 0)
            + sum over c of M(c) (f(c, 0) - f(0, 0)) + the same for d + V f(0, 0).

All arithmetic is on 64-bit integers and 38-digit decimals, hence exact.

Hot spots: a frequent term or a large source is one row per task's batch before the shuffle and one
row per (language, source, term) after it; the expansion of cells is salted by term;
both rankings keep ``most`` rows a task before they are sorted by group.  A term used by k sources of
its language gives k (k - 1) / 2 rows of shared cells, combined inside the tasks.

Defined cases: null text, lang and source are ''; a (lang, source) without kept terms still has its
pairs (value 0 where the language keeps no term) and no term rows; rows that share a doc_id are
documents of their own; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourcast.llm.common import LOWER, UPPER, materialise, table

LEAST_DOCS = 3
SCALE = 1_000_000_000
MOST = 200
#: Counters a task holds before it passes them on.
HELD = 400_000
SALTS = 16

#: Letters a-z and bytes of multibyte characters stay, A-Z become small, all else separates.
_TERMS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def term_counts(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences and documents of each term in each group."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, d) in held.items():  # both counters hold their terms in the same order
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(lang, pa.string()), len(n)), pa.repeat(pa.scalar(source, pa.string()), len(n)),
                     pa.array(list(n), pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64()), pa.array(list(d.values()), pa.int64())],
                    ["lang", "source", "term", "n", "docs"],
                )
            held.clear()

        size = 0
        for batch in batches:
            texts = batch.column(2)
            for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                terms = texts[i].as_py().translate(_TERMS).split()
                n, d = held.setdefault(key, (Counter(), Counter()))
                size -= len(n)
                n.update(terms)
                d.update(dict.fromkeys(terms).keys())
                size += len(n)
                if size >= HELD:
                    yield from rows()
                    size = 0
        yield from rows()

    parts = docs.select(
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    ).mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counts: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``(lang, source, term, n, total, head)`` of terms in ``least_docs`` documents of the language or more:
    ``total`` is the language's count, ``head`` marks one row per (lang, term)."""
    of_term = Window.partitionBy("lang", "term")
    return (
        counts.withColumns({
            "total": F.sum("n").over(of_term), "spread": F.sum("docs").over(of_term),
            "head": F.row_number().over(of_term.orderBy("source")) == 1,
        })
        .where(F.col("spread") >= least_docs)
        .select("lang", "source", "term", "n", "total", "head")
    )


def group_totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """``(lang, source, size, vocabulary, lang_size)`` of every group that occurs: kept occurrences of the group,
    kept terms and occurrences of the language."""
    groups = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    langs = kept.groupBy("lang").agg(F.sum(F.col("head").cast("long")).alias("vocabulary"), F.sum("n").alias("lang_size"))
    return groups.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["size", "vocabulary", "lang_size"])


def share(count: Column, size: Column, vocabulary: Column) -> Column:
    """``1 + floor(SCALE (count + 1) / (size + vocabulary))``; null without vocabulary."""
    whole = (F.lit(SCALE).cast("decimal(20,0)") * (count + 1).cast("decimal(18,0)"))
    return 1 + F.call_function("div", whole, F.when(vocabulary > 0, size + vocabulary).cast("decimal(18,0)"))


def divergence(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / q)``."""
    return F.call_function("div", (p - q) * (p - q), q)


def term_part(kept: DataFrame, totals: DataFrame, most: int = MOST) -> DataFrame:
    """``(lang, source, item, value, rank)``: the terms that each group uses beyond its language, the first ``most``."""
    cells = (
        kept.groupBy("lang", "source", "n", "total").agg(F.count(F.lit(1)).alias("m"))
        .join(totals, ["lang", "source"])
        .withColumns({"p": share(F.col("n"), F.col("size"), F.col("vocabulary")), "q": share(F.col("total"), F.col("lang_size"), F.col("vocabulary"))})
        .where("p > q")
        .select("lang", "source", "n", "total", "m", divergence(F.col("p"), F.col("q")).alias("value"))
    )
    cells = materialise(cells, "audit-cells")
    group = Window.partitionBy("lang", "source")
    ordered = group.orderBy(F.desc("value"))
    merged = cells.groupBy("lang", "source", "value").agg(F.sum("m").alias("m"))
    first = merged.withColumn("i", F.row_number().over(ordered)).where(F.col("i") <= most)  # each has a term or more
    before = F.coalesce(F.sum("m").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chosen = first.withColumn("before", before).where(F.col("before") < most).select("lang", "source", "value", "before")
    salt = F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int")
    wanted = (
        cells.join(chosen, ["lang", "source", "value"])
        .select("lang", "source", "n", "total", "value", "before", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    terms = kept.select("lang", "source", "n", "total", "term", salt.alias("salt")).join(wanted, ["lang", "source", "n", "total", "salt"])
    within = Window.partitionBy("lang", "source", "value").orderBy("term")
    return (
        terms.withColumn("i", F.row_number().over(within)).where(F.col("i") <= most)
        .withColumn("rank", (F.col("before") + F.col("i")).cast("int")).where(F.col("rank") <= most)
        .select("lang", "source", F.col("term").alias("item"), "value", "rank")
    )


def pair_part(kept: DataFrame, totals: DataFrame) -> DataFrame:
    """``(lang, source, item, value, rank)``: every other source of the language, by divergence over all kept terms."""
    one = kept.select("lang", "term", F.col("source").alias("s1"), F.col("n").alias("c1"))
    two = kept.select("lang", "term", F.col("source").alias("s2"), F.col("n").alias("c2"))
    shared = one.join(two, ["lang", "term"]).where("s1 < s2").groupBy("lang", "s1", "s2", "c1", "c2").agg(F.count(F.lit(1)).alias("m"))
    shared = materialise(shared, "audit-shared")
    shared = shared.union(shared.select("lang", F.col("s2"), F.col("s1"), F.col("c2"), F.col("c1"), "m"))
    pairs = totals.select("lang", F.col("source").alias("s1"), F.col("size").alias("n1"), F.col("vocabulary").alias("v")).join(
        totals.select("lang", F.col("source").alias("s2"), F.col("size").alias("n2")), "lang"
    ).where("s1 <> s2")
    pairs = materialise(pairs, "audit-pairs")
    n1, n2, v = F.col("n1"), F.col("n2"), F.col("v")
    zero = F.lit(0).cast("long")

    def f(c: Column, d: Column) -> Column:
        return divergence(share(c, n1, v), share(d, n2, v)).cast("decimal(38,0)")

    def part(rows: DataFrame, value: Column) -> DataFrame:
        return rows.select("lang", "s1", "s2", value.cast("decimal(38,0)").alias("value")).groupBy("lang", "s1", "s2").agg(F.sum("value").alias("value"))

    own = kept.groupBy("lang", "source", "n").agg(F.count(F.lit(1)).cast("decimal(18,0)").alias("m"))
    c1, c2, m = F.col("c1"), F.col("c2"), F.col("m").cast("decimal(18,0)")
    sums = [
        part(shared.join(pairs, ["lang", "s1", "s2"]), m * (f(c1, c2) - f(c1, zero) - f(zero, c2) + f(zero, zero))),
        part(own.select("lang", F.col("source").alias("s1"), F.col("n").alias("c1"), "m").join(pairs, ["lang", "s1"]), m * (f(c1, zero) - f(zero, zero))),
        part(own.select("lang", F.col("source").alias("s2"), F.col("n").alias("c2"), "m").join(pairs, ["lang", "s2"]), m * (f(zero, c2) - f(zero, zero))),
        pairs.select("lang", "s1", "s2", F.coalesce(v.cast("decimal(18,0)") * f(zero, zero), F.lit(0)).cast("decimal(38,0)").alias("value")),
    ]
    total = sums[0]
    for s in sums[1:]:
        total = total.union(s)
    total = total.groupBy("lang", "s1", "s2").agg(F.sum("value").cast("long").alias("value"))
    order = Window.partitionBy("lang", "s1").orderBy(F.desc("value"), "s2")
    return total.select("lang", F.col("s1").alias("source"), F.col("s2").alias("item"), "value", F.row_number().over(order).alias("rank"))


def divergence_audit(docs: DataFrame, least_docs: int = LEAST_DOCS, most: int = MOST) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` of ``docs(text, lang, source)``."""
    kept = materialise(kept_terms(term_counts(docs), least_docs), "audit-terms")
    totals = materialise(group_totals(docs, kept), "audit-totals")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pair = pair_part(kept, totals).withColumn("part", F.lit("pair")).select(columns)
    return pair.union(term_part(kept, totals, most).withColumn("part", F.lit("term")).select(columns))


def op13_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence_audit(table(spark, sf_dir, "documents"))


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
t AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM t GROUP BY ALL HAVING count(DISTINCT r) >= {LEAST_DOCS}),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL),
x AS (SELECT g.lang, g.source, k.term, k.total, coalesce(c.n, 0) AS n FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
w AS (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS size, count(*) OVER (PARTITION BY lang, source) AS v, sum(total) OVER (PARTITION BY lang, source) AS lang_size FROM x),
p AS (SELECT lang, source, term, n, 1 + ({SCALE}::HUGEINT * (n + 1)) // (size + v)::HUGEINT AS p, 1 + ({SCALE}::HUGEINT * (total + 1)) // (lang_size + v)::HUGEINT AS q FROM w),
s AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
o AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM p WHERE n > 0 AND p > q),
z AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM o)
SELECT lang, source, part, item, value, rank FROM z WHERE part = 'pair' OR rank <= {MOST}
"""
