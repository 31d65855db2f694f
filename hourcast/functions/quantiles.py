"""Exact linear-interpolation quantiles without large buffers.

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer, which does not survive a group holding a third of 100 TB.
Here exact quantiles take two passes over the rows:

1. ``percentile_approx`` (a mergeable sketch) brackets each wanted rank by two data
   values.  Their ranks are off by at most n / accuracy, which the bracket's width covers;
   a group of at most ``accuracy`` rows is bracketed by its least and largest value.
2. Values inside a bracket are counted per distinct value, those below it as one more
   "value" (partial aggregation collapses ties); cumulative counts give the order
   statistics.  Nothing is collected into a list: a column that is mostly one
   value has one row in its bracket.

A bracket that misses the rank (which the sketch guarantee rules out) raises
instead of returning a wrong value.  Result equals DuckDB ``quantile_cont`` and
pandas ``quantile``/``median``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_ACCURACY = 100_000


#: Bracket tables of at most this many groups are collected and broadcast as local rows.
SMALL_GROUPS = 1000


def _small(table: DataFrame) -> DataFrame:
    """``table`` as a broadcast local table where it is small, else as it is."""
    rows = table.limit(SMALL_GROUPS + 1).collect()
    return table if len(rows) > SMALL_GROUPS else F.broadcast(table.sparkSession.createDataFrame(rows, table.schema))


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int = DEFAULT_ACCURACY,
) -> DataFrame:
    """Per group of ``by`` (or globally): columns ``n`` and ``q0, q1, ...``."""
    keys = list(by) or ["_all"]
    whole = df if by else df.withColumn("_all", F.lit(0))
    base = whole.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    eps, k = 4.0 / accuracy, range(len(probs))
    edges = [e for p in probs for e in (max(0.0, p - eps), min(1.0, p + eps))]
    v, few = F.col("_v"), F.col("n") <= accuracy
    sketch = base.groupBy(*keys).agg(
        F.count("_v").alias("n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"), F.percentile_approx("_v", edges, accuracy).alias("_br"))
    brackets = _small(sketch.select(
        *keys, "n", F.array(*[F.when(few, F.col("_min")).otherwise(F.col("_br")[2 * j]) for j in k]).alias("_lo"),
        F.array(*[F.when(few, F.col("_max")).otherwise(F.col("_br")[2 * j + 1]) for j in k]).alias("_hi")))
    lo, hi = (lambda j: F.get("_lo", j)), (lambda j: F.get("_hi", j))
    ranked = base.join(brackets, keys)
    held = F.filter(F.array(*[F.lit(j) for j in k]), lambda j: v <= hi(j))
    inside = F.when(v >= lo(F.col("_j")), v)  # NULL: below the bracket
    counts = ranked.select(*keys, "n", "_lo", "_v", F.explode(held).alias("_j")).groupBy(*keys, "n", "_j", inside.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    up = Window.partitionBy(*keys, "_j").orderBy(F.asc_nulls_first("_v")).rowsBetween(Window.unboundedPreceding, 0)
    placed = counts.withColumn("_to", F.sum("_c").over(up))
    h = (F.col("n") - 1).cast("double") * F.get(F.array(*[F.lit(float(p)) for p in probs]), F.col("_j"))
    first, past = F.col("_to") - F.col("_c"), F.col("_to")
    at = lambda i: F.max(F.when((first <= i) & (i < past), v))
    i = F.floor(h).cast("long")
    picked = placed.groupBy(*keys, "_j", "n").agg(at(i).alias("_x1"), at(F.least(i + 1, F.col("n") - 1)).alias("_x2"), F.first(h - i).alias("_f"))
    q = F.when(F.col("_x1").isNull() | F.col("_x2").isNull(), F.raise_error(F.lit("quantile bracket missed its rank")).cast("double")).otherwise(
        F.col("_x1") + F.col("_f") * (F.col("_x2") - F.col("_x1"))
    )
    out = picked.groupBy(*keys, "n").agg(*[F.max(F.when(F.col("_j") == j, q)).alias(f"q{j}") for j in k])
    if by:
        return out
    # without a value there is still one row, of NULL quantiles
    one = df.sparkSession.range(1).select(F.lit(0).alias("_all"))
    return one.join(out, "_all", "left").select(F.coalesce("n", F.lit(0)).cast("long").alias("n"), *[f"q{j}" for j in k])


def column_medians(df: DataFrame, cols: Sequence[str], accuracy: int = DEFAULT_ACCURACY) -> dict[str, float | None]:
    """Exact median of each column in one job (unpivot -> grouped quantile).

    The result is one number per column, so it is returned to the driver and
    applied as literals downstream (no join against a stats table)."""
    cols = list(cols)
    if not cols:
        return {}
    long = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("double").alias("v")) for c in cols])).alias("_kv")
    ).select("_kv.col", "_kv.v")
    res = {r["col"]: r["q0"] for r in exact_quantiles(long, "v", [0.5], by=["col"], accuracy=accuracy).collect()}
    return {c: res.get(c) for c in cols}


def most_frequent(df: DataFrame, col: str):
    """Mode of a column, ties -> smallest value; NULLs ignored.

    Counting is a distributed group-by; only the winner reaches the driver."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).count()
    row = counts.agg(F.min_by(col, F.struct(-F.col("count"), F.col(col))).alias("m")).first()
    return None if row is None else row["m"]
