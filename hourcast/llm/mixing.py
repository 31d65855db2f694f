"""Operator 5: mixing sources to target weights by iterative proportional fitting (DataFrame operations only).

Documents are summed to cells (source, language, topic) of token counts.  The
cells' token weights are raked: each round scales them to the source, then the
language, then the topic targets.  A document's inclusion probability is its
cell's calibrated weight per token, scaled so that the largest is 1 (the largest
sample in the target mix without repeats); a hash of doc_id and seed decides.
That scale hangs on one cell, so ``keep_share`` fixes the expected sample instead:
that share of all tokens.  Categories and cells too small for their part are kept
whole (probability 1) and the others raked to the rest, so a rare cell cannot shrink
the sample.

The targets are tempered token shares, ``share ** alpha`` renormalised, which
lifts small sources and languages as multilingual corpora do; pass ``targets``
(a table ``dim, category, weight``) for other ones.

Defined cases: null source, language or text form categories of their own ("" and
topic 'none'); a document without words counts one token; null doc_id hashes as 0;
repeated rows are decided alike; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourcast.llm.common import materialise, table

ROUNDS = 12
ALPHA = {"source": 0.8, "lang": 0.8, "topic": 0.8}
SEED = 20240
#: Cells are broadcast to the documents up to this many (about 100 bytes each); beyond it they are joined by a shuffle.
BROADCAST_CELLS = 20_000
#: Topic markers in order of priority; the first whose marker occurs in the lower-cased text decides.
TOPICS = (
    ("legal", ("license", "copyright")),
    ("config", ("password", "secret", "token=", "api_key", "apikey")),
    ("contact", ("@", "phone")),
    ("web", ("http://", "https://", "www.")),
    ("table", (" | ",)),
)
DIMS = ("source", "lang", "topic")


def topic_of(text: Column) -> Column:
    low = F.lower(text)
    out = F.when(F.coalesce(F.trim(text), F.lit("")) == "", F.lit("none"))
    for name, markers in TOPICS:
        hit = F.lit(False)
        for m in markers:
            hit = hit | F.contains(low, F.lit(m))
        out = out.when(hit, F.lit(name))
    return out.otherwise(F.lit("prose"))


def uniform(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) from doc_id: integer mixing that SQL engines share."""
    m = F.lit(4294967296)
    x = F.pmod(F.coalesce(doc_id, F.lit(0)) + F.lit(seed), m)
    for _ in range(3):
        x = F.pmod((x + F.floor(x / 65536)) * F.lit(668265263) + F.lit(374761393), m)
    return x / m.cast("double")


def cells_of(rows: DataFrame) -> DataFrame:
    """Token and document totals of each (source, lang, topic), partial sums before the shuffle."""
    return rows.groupBy(*DIMS).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))


def tempered_targets(cells: DataFrame, alpha: dict[str, float]) -> DataFrame:
    """(dim, category, weight): token shares to the power alpha, summing to 1 per dim."""
    parts = None
    for d in DIMS:
        t = cells.groupBy(F.lit(d).alias("dim"), F.col(d).alias("category")).agg(
            F.pow(F.sum("tokens").cast("double"), F.lit(float(alpha[d]))).alias("raw")
        )
        parts = t if parts is None else parts.union(t)
    w = Window.partitionBy("dim")
    return parts.select("dim", "category", (F.col("raw") / F.sum("raw").over(w)).alias("weight"))


def rake(cells: DataFrame, targets: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Cells with ``w``: token shares scaled in turn to each margin's targets.

    The windows run over cells, not documents: a row per distinct combination."""
    for d in DIMS:
        t = targets.where(F.col("dim") == d).select(F.col("category").alias(d), F.col("weight").alias(f"t_{d}"))
        cells = cells.join(t, d)
    total = Window.partitionBy()
    out = materialise(cells.withColumn("w", F.col("tokens") / F.sum("tokens").over(total)), "cells")
    for i in range(rounds):
        for d in DIMS:
            out = out.withColumn("w", F.col("w") * F.col(f"t_{d}") / F.sum("w").over(Window.partitionBy(d)))
        if i % 4 == 3 and i + 1 < rounds:
            out = materialise(out, "cells")
    per_token = F.col("w") / F.col("tokens")
    return out.select(*DIMS, "tokens", "docs", "w", (per_token / F.max(per_token).over(total)).alias("prob"))


def fill_scale(cap: Column, share: Column, total: Column, tie: str) -> Column:
    """The factor f with ``sum(least(cap, f * share)) = total`` over all rows; null in rows at their caps.

    By cap / share ascending, a row is at its cap when the factor of it and the rows behind it would pass that cap."""
    order = [cap / share, F.col(tie)]
    before = Window.partitionBy().orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy().orderBy(*(o.desc() for o in order)).rowsBetween(Window.unboundedPreceding, 0)
    factor = (total - F.coalesce(F.sum(cap).over(before), F.lit(0.0))) / F.sum(share).over(behind)
    return F.when(cap > factor * share, factor)


def rake_within(cells: DataFrame, targets: DataFrame, keep_share: float, rounds: int = ROUNDS) -> DataFrame:
    """Cells with ``prob`` = ``least(1, w / tokens)``, raked to a sample of ``keep_share`` of all tokens.

    Each step scales a category's cells so that those below their bound fill what the
    cells at their bound leave of its target.  The fixed point is the sample nearest to
    the corpus that meets the targets with no document twice."""
    for d in DIMS:
        t = cells.groupBy(F.col(d)).agg(F.sum("tokens").cast("double").alias("cap")).join(
            targets.where(F.col("dim") == d).select(F.col("category").alias(d), F.col("weight").alias("share")), d
        )
        every = Window.partitionBy()
        t = t.withColumn("total", F.sum("cap").over(every) * F.lit(float(keep_share)))
        t = t.withColumn("f", fill_scale(F.col("cap"), F.col("share"), F.col("total"), d))
        t = t.select(d, F.coalesce(F.least(F.col("cap"), F.max("f").over(every) * F.col("share")), F.col("cap")).alias(f"b_{d}"))
        cells = cells.join(t, d)
    cap = F.col("tokens").cast("double")
    out = materialise(cells.withColumn("w", cap * F.lit(float(keep_share))), "cells")
    for i in range(rounds):
        for d in DIMS:
            b, w = F.col(f"b_{d}"), Window.partitionBy(d)
            at = F.sum(F.when(F.col("w") >= cap, cap).otherwise(F.lit(0.0))).over(w)
            below = F.sum(F.when(F.col("w") < cap, F.col("w")).otherwise(F.lit(0.0))).over(w)
            out = out.withColumn("w", F.col("w") * F.when((below > 0) & (at < b), (b - at) / below).otherwise(b / (at + below)))
        if i % 4 == 3 and i + 1 < rounds:
            out = materialise(out, "cells")
    return out.select(*DIMS, "tokens", "docs", "w", F.least(F.lit(1.0), F.col("w") / cap).alias("prob"))


def mix_sources(docs: DataFrame, alpha: dict[str, float] = ALPHA, rounds: int = ROUNDS, seed: int = SEED,
                targets: DataFrame | None = None, keep_share: float | None = None) -> DataFrame:
    """Per row: doc_id, source, lang, topic, tokens, prob, kept."""
    rows = materialise(docs.select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce("lang", F.lit("")).alias("lang"),
        topic_of(F.col("text")).alias("topic"),
        F.greatest(F.lit(1), F.coalesce(F.regexp_count("text", F.lit("[^ \\t\\n\\x0B\\f\\r]+")), F.lit(0))).cast("long").alias("tokens"),
    ), "mix-rows")
    cells = materialise(cells_of(rows), "mix-cells")
    targets = tempered_targets(cells, alpha) if targets is None else targets
    raked = materialise(rake(cells, targets, rounds) if keep_share is None else rake_within(cells, targets, keep_share, rounds), "raked")
    probs = raked.select(*DIMS, "prob")
    if raked.count() <= BROADCAST_CELLS:
        probs = F.broadcast(probs)
    return rows.join(probs, list(DIMS), "left").select(
        "doc_id", *DIMS, "tokens", F.round(F.coalesce("prob", F.lit(0.0)), 6).alias("prob"),
        (uniform(F.col("doc_id"), seed) < F.coalesce("prob", F.lit(0.0))).alias("kept"),
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def mixing_sql(source: str = "documents") -> str:
    """DuckDB SQL of :func:`mix_sources` at its default parameters over view ``source``."""
    topic = "CASE WHEN trim(coalesce(text, ''), ' ') = '' THEN 'none' " + " ".join(
        "WHEN " + " OR ".join(f"contains(lower(text), '{m}')" for m in ms) + f" THEN '{n}'" for n, ms in TOPICS
    ) + " ELSE 'prose' END"
    x = f"((coalesce(doc_id, 0) + {SEED}) % 4294967296)"
    for _ in range(3):
        x = f"((({x} + {x} // 65536) * 668265263 + 374761393) % 4294967296)"
    sql = [f"""WITH r AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, {topic} AS topic,
        greatest(1, coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\x0B\\f\\r]+')), 0))::BIGINT AS tokens FROM {source})""",
        "c AS (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM r GROUP BY ALL)"]
    for d in DIMS:
        sql.append(f"t_{d} AS (SELECT {d}, raw / sum(raw) OVER () AS t_{d} FROM "
                   f"(SELECT {d}, pow(sum(tokens), {ALPHA[d]}) AS raw FROM c GROUP BY {d}))")
    sql.append("k0 AS (SELECT c.*, t_source, t_lang, t_topic, tokens / sum(tokens) OVER () AS w FROM c JOIN t_source USING (source)"
               " JOIN t_lang USING (lang) JOIN t_topic USING (topic))")
    k = 0
    for _ in range(ROUNDS):
        for d in DIMS:
            sql.append(f"k{k + 1} AS (SELECT * EXCLUDE (w), w * t_{d} / sum(w) OVER (PARTITION BY {d}) AS w FROM k{k})")
            k += 1
    sql.append(f"p AS (SELECT source, lang, topic, (w / tokens) / max(w / tokens) OVER () AS prob FROM k{k})")
    sql.append(f"u AS (SELECT r.*, {x} / 4294967296.0::DOUBLE AS u FROM r)")
    return ",\n".join(sql) + ("\nSELECT doc_id, source, lang, topic, tokens, round(prob, 6) AS prob, u < prob AS kept"
                              " FROM u JOIN p USING (source, lang, topic)")


SQL = mixing_sql()
