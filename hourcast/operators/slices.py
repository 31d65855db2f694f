"""Climatology with fallback levels, error slices, blend weights by group, categories of the target."""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourcast.functions.quantiles import exact_quantiles
from hourcast.operators.ensemble import nnls_small
from hourcast.operators.grams import gram
from hourcast.session import cut_lineage

#: Stands for a key that a level does not use, and for a NULL value of one that it does.
ANY, MISSING = "*", "missing"

# --------------------------------------------------------------------------- climatology

#: Key columns of each level, the finest first; the last one is the whole table.
LEVELS = (("station", "month", "hour"), ("station", "hour"), ("hour",), ())


def _keys(levels: Sequence[Sequence[str]]) -> list[str]:
    return list(dict.fromkeys(itertools.chain.from_iterable(levels)))


def climatology(rows: DataFrame, value: str = "y_true", levels: Sequence[Sequence[str]] = LEVELS) -> DataFrame:
    """Exact medians at every level: ``(level, keys..., n, median)``, keys as text, ``*`` where a level has none.

    Each row goes to one group a level, as GROUPING SETS would have it; medians of any number of groups come from the
    two passes of :func:`exact_quantiles`, whose counts are combined inside the tasks, so the whole-table group is
    no hot spot."""
    keys = _keys(levels)
    group = [F.struct(F.lit(i).alias("level"), *[(F.coalesce(F.col(k).cast("string"), F.lit(MISSING)) if k in level else F.lit(ANY)).alias(k) for k in keys])
             for i, level in enumerate(levels)]
    long = rows.select(F.explode(F.array(*group)).alias("g"), F.col(value).alias("_value")).select("g.*", "_value")
    q = exact_quantiles(long, "_value", [0.5], by=["level", *keys])
    return q.select("level", *keys, "n", F.col("q0").alias("median"))


def climatology_predict(rows: DataFrame, table: DataFrame, keep: Sequence[str], least: int = 5, levels: Sequence[Sequence[str]] = LEVELS) -> DataFrame:
    """``(keep..., level, prediction)``: the median of the finest level with ``least`` values or more; the last level always counts."""
    keys = _keys(levels)
    medians = []
    out = rows.select(*keep, *[F.coalesce(F.col(k).cast("string"), F.lit(MISSING)).alias(f"_k_{k}") for k in keys])
    for i, level in enumerate(levels):
        known = table.where(F.col("level") == i)
        if i < len(levels) - 1:
            known = known.where(F.col("n") >= least)
        if level:
            known = known.select(*[F.col(k).alias(f"_k_{k}") for k in level], F.col("median").alias(f"_m{i}"))
            out = out.join(known, [f"_k_{k}" for k in level], "left")
            medians.append(F.col(f"_m{i}"))
        else:  # the whole table has one median
            row = known.first()
            medians.append(F.lit(None if row is None else row["median"]).cast("double"))
    found = [F.when(m.isNotNull(), F.lit(i)) for i, m in enumerate(medians)]
    return out.select(*keep, F.coalesce(*found).alias("level"), F.coalesce(*medians).alias("prediction"))


# --------------------------------------------------------------------------- error slices

# The documented buckets of the target.
BUCKET_EDGES = (35.0, 75.0, 150.0, 250.0)
BUCKET_LABELS = ("0-35", "35-75", "75-150", "150-250", "250+")


def bucket(y) -> Column:
    """Right-closed bucket of a value; NULL stays NULL."""
    y = F.col(y) if isinstance(y, str) else y
    out = F.when(y.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(BUCKET_EDGES, BUCKET_LABELS, strict=False):
        out = out.when(y <= edge, F.lit(label))
    return out.otherwise(F.lit(BUCKET_LABELS[-1]))


def slice_attributes(latest: Column, wind_speed: Column, rain: Column, jump: float = 30.0) -> dict[str, Column]:
    """The slices of a forecast row with ``station``, ``target_time``, ``wd_lag_1`` and ``y_true``."""
    step = F.col("y_true") - latest
    return {
        "station": F.col("station"), "hour": F.hour("target_time").cast("string"), "month": F.month("target_time").cast("string"),
        "wind": F.col("wd_lag_1"), "wind_speed": F.when(wind_speed < 2, "calm").when(wind_speed < 5, "light").when(wind_speed.isNotNull(), "strong"),
        "rain": F.when(rain > 0, "rain").when(rain.isNotNull(), "dry"), "target": bucket("y_true"),
        "episode": F.when(step >= jump, "rapid_rise").when(step <= -jump, "rapid_drop").when(step.isNotNull(), "steady"),
    }


def error_slices(preds: DataFrame, slices: Sequence[str]) -> DataFrame:
    """``(model, slice, value, rows, rmse, mae, bias, over_rate, under_rate, p95_abs_error)`` of every value of every slice column.

    The forecasts are read once, into a narrow written table of errors; all slices are then grouping sets of one
    aggregation, and the exact p95 is taken for all groups together."""
    e = F.col("prediction") - F.col("y_true")
    # (written: the metrics and the two passes of the quantile read it again)
    rows = cut_lineage(preds.select("model", e.alias("e"), *[F.coalesce(F.col(s).cast("string"), F.lit(MISSING)).alias(s) for s in slices]))
    e = F.col("e")
    agg = rows.groupingSets([["model", s] for s in slices], "model", *slices).agg(
        F.concat_ws("", *[F.when(F.grouping(s) == 0, F.lit(s)) for s in slices]).alias("slice"),
        F.coalesce(*slices).alias("value"), F.count(F.lit(1)).alias("rows"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        F.avg(e).alias("bias"), F.avg((e > 0).cast("double")).alias("over_rate"), F.avg((e < 0).cast("double")).alias("under_rate"),
    ).drop(*slices)
    long = rows.select("model", F.abs(e).alias("a"), F.explode(F.array(*[F.struct(F.lit(s).alias("slice"), F.col(s).alias("value")) for s in slices])).alias("x"))
    p95 = exact_quantiles(long.select("model", "x.slice", "x.value", "a"), "a", [0.95], by=["model", "slice", "value"])
    return agg.join(p95.select("model", "slice", "value", F.col("q0").alias("p95_abs_error")), ["model", "slice", "value"], "left")


# --------------------------------------------------------------------------- blends by group

def batched_nnls(g: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Non-negative least squares for many Gram matrices at once: min w'Gw - 2b'w, w >= 0, by trying every set of positive weights."""
    n, k = b.shape
    best, score = np.zeros((n, k)), np.zeros(n)
    for r in range(1, k + 1):
        for ix in map(list, itertools.combinations(range(k), r)):
            try:
                w = np.linalg.solve(g[:, ix][:, :, ix], b[:, ix, None])[:, :, 0]
            except np.linalg.LinAlgError:  # some group has copies among its models
                return np.array([nnls_small(g[i], b[i]) for i in range(n)])
            full = np.zeros((n, k))
            full[:, ix] = np.clip(w, 0, None)
            value = np.einsum("ni,nij,nj->n", full, g, full) - 2 * np.einsum("ni,ni->n", b, full)
            better = (w >= -1e-12).all(1) & (value < score - 1e-12)
            best[better], score[better] = full[better], value[better]
    return best


def group_blend_weights(wide: DataFrame, models: Sequence[str], by: Sequence[str], y: str = "y_true") -> DataFrame:
    """E3 for each group of ``by``: ``(by..., rows, weights map<model, weight>)``, non-negative, sum 1 (all zero: equal).

    One pass for all groups' Gram matrices; they are solved where they lie, so groups may be many."""
    models, by = list(models), list(by)
    k = len(models)
    usable = wide.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*models, y)]))
    grams = gram(usable, [F.lit(1.0), *[F.col(m) for m in models], F.col(y)], by)
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in grams.schema.fields if f.name in by)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = np.array([np.frombuffer(x) for x in batch.column(len(by)).to_pylist()]).reshape(-1, k + 2, k + 2)
            w = batched_nnls(m[:, 1:-1, 1:-1], m[:, 1:-1, -1])
            w[w.sum(1) <= 0] = 1.0
            w /= w.sum(1, keepdims=True)
            out = pa.array([list(zip(models, row, strict=True)) for row in w.tolist()], pa.map_(pa.string(), pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(by))), pa.array(m[:, 0, 0].astype(np.int64)), out], [*by, "rows", "weights"]
            )

    return grams.mapInArrow(solve, f"{fields}rows long, weights map<string, double>")


def group_blend(wide: DataFrame, weights: DataFrame, models: Sequence[str], by: Sequence[str], keys: Sequence[str], name: str) -> DataFrame:
    """``(keys..., model, prediction)``: each row blended by its group's weights; a group without weights takes the mean."""
    k = len(models)
    p = reduce(lambda a, b: a + b, [F.col(m) * F.coalesce(F.col("weights")[m], F.lit(1.0 / k)) for m in models])
    return wide.join(weights.drop("rows"), list(by), "left").select(*keys, F.lit(name).alias("model"), p.alias("prediction"))


# --------------------------------------------------------------------------- categories

def confusion(preds: DataFrame, classify=bucket) -> DataFrame:
    """``(model, actual, predicted, rows)`` of the categories of target and prediction."""
    return preds.where(F.col("y_true").isNotNull() & F.col("prediction").isNotNull()).groupBy(
        "model", classify("y_true").alias("actual"), classify("prediction").alias("predicted")).agg(F.count(F.lit(1)).alias("rows"))


def confusion_matrix(counts: DataFrame, labels: Sequence[str] = BUCKET_LABELS) -> DataFrame:
    """``(model, actual, <a column per label>)``, 0 where nothing falls."""
    return counts.groupBy("model", "actual").pivot("predicted", list(labels)).agg(F.sum("rows")).na.fill(0)


def class_metrics(counts: DataFrame) -> DataFrame:
    """``(model, category, support, precision, recall, f1)``; a class never predicted has precision 0, one never seen recall 0."""
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("rows")).otherwise(0)
    side = F.explode(F.array(
        F.struct(F.col("actual").alias("category"), F.col("rows").alias("seen"), F.lit(0).cast("long").alias("said"), hit.cast("long").alias("hit")),
        F.struct(F.col("predicted").alias("category"), F.lit(0).cast("long").alias("seen"), F.col("rows").alias("said"), F.lit(0).cast("long").alias("hit")),
    )).alias("x")
    s = counts.select("model", side).select("model", "x.*").groupBy("model", "category").agg(*[F.sum(c).alias(c) for c in ("seen", "said", "hit")])
    part = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    f1 = F.try_divide(2.0 * F.col("hit"), F.col("seen") + F.col("said"))
    return s.select("model", "category", F.col("seen").alias("support"), part("hit", "said").alias("precision"), part("hit", "seen").alias("recall"), f1.alias("f1"))


def category_scores(counts: DataFrame) -> DataFrame:
    """``(model, rows, accuracy, macro_f1)``; macro F1 is over the classes that occur or are predicted."""
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("rows")).otherwise(0)
    acc = counts.groupBy("model").agg(F.sum("rows").alias("rows"), (F.sum(hit) / F.sum("rows")).alias("accuracy"))
    return acc.join(class_metrics(counts).groupBy("model").agg(F.avg("f1").alias("macro_f1")), "model")
