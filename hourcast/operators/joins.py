"""Joins and set operations.

Cardinality guards are aggregations (``groupBy(keys).count() > 1``) rather than
driver-side checks of collected rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRED_KEYS = ("station", "window_end", "target_time", "y_true")


def align_targets(windows: DataFrame, raw: DataFrame, series: str = "station", time: str = "datetime",
                  target: str = "pm25") -> DataFrame:
    """Windows LEFT JOIN raw rows at ``window_end + 1 hour``."""
    r = raw.select(F.col(series).alias("_s"), F.col(time).alias("target_time"), F.col(target).alias("y_true"))
    cond = (F.col(series) == F.col("_s")) & (F.col("target_time") == F.col("window_end") + F.expr("INTERVAL 1 HOUR"))
    return windows.join(r, cond, "left").drop("_s")


def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "rows") -> None:
    """Raise when a key repeats (one aggregation; only the count returns)."""
    dup = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1).count()
    if dup:
        raise ValueError(f"duplicate keys {list(keys)} in {what}")


def merge_predictions(tables: dict[str, DataFrame], keys: Sequence[str] = PRED_KEYS) -> DataFrame:
    """J2 (long form): union of per-source long predictions keeping only keys
    present in every source; model names must be unique across sources and
    each (key, model) must be unique.  The inner join of wide tables becomes a
    union + ``count(distinct source) = n`` filter, one shuffle on the keys."""
    parts = [t.select(*keys, "model", "prediction").withColumn("_src", F.lit(name)) for name, t in tables.items()]
    u = reduce(lambda a, b: a.unionByName(b), parts)
    clash = u.groupBy("model").agg(F.count_distinct("_src").alias("n")).where("n > 1").limit(1).count()
    if clash:
        raise ValueError("duplicate model names across prediction tables")
    assert_unique(u, [*keys, "model"], "predictions")
    common = u.groupBy(*keys).agg(F.count_distinct("_src").alias("_n")).where(F.col("_n") == len(tables)).drop("_n")
    out = u.join(common, list(keys), "left_semi").drop("_src")
    return out


def attach_predictions(base: DataFrame, extra: DataFrame, keys: Sequence[str] = PRED_KEYS) -> DataFrame:
    """LEFT one-to-one join of extra columns (uniqueness checked on the right)."""
    assert_unique(extra, keys, "attached predictions")
    return base.join(extra, list(keys), "left")


def union_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name, missing columns filled with NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_times(df: DataFrame, time: str) -> DataFrame:
    """Distinct timestamps (hash aggregate, partial per task)."""
    return df.select(time).distinct()


def wide_to_long(wide: DataFrame, models: Sequence[str], keys: Sequence[str] = PRED_KEYS) -> DataFrame:
    """Wide prediction table -> long (keys, model, prediction)."""
    arr = F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).cast("double").alias("prediction")) for m in models])
    return wide.select(*keys, F.explode(arr).alias("_mp")).select(*keys, "_mp.model", "_mp.prediction")


def long_to_wide(long: DataFrame, models: Sequence[str], keys: Sequence[str] = PRED_KEYS) -> DataFrame:
    """Long -> wide with a fixed model list (pivot values given: no extra job)."""
    return long.groupBy(*keys).pivot("model", list(models)).agg(F.first("prediction"))
