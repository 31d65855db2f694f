"""Ensembles over the long prediction table.

Blend weights are fitted from sufficient statistics: one aggregation returns
the Gram matrix G = sum(p_i p_j), b = sum(p_i y), sum(y^2) and n for k models
(k(k+1)/2 + k + 2 numbers), and every candidate weight vector is scored as
SSE(w) = w'Gw - 2w'b + y'y on the driver.  Rows are never replicated per
candidate, so 1001 grid points cost one pass over the data.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.operators.joins import PRED_KEYS, long_to_wide


def gram_stats(wide: DataFrame, models: Sequence[str], y: str = "y_true") -> tuple[np.ndarray, np.ndarray, float, int]:
    """One aggregation -> (G, b, yy, n) for the listed model columns."""
    k = len(models)
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(F.col(y) * F.col(y)).alias("yy")]
    aggs += [F.sum(F.col(m) * F.col(y)).alias(f"b{i}") for i, m in enumerate(models)]
    aggs += [F.sum(F.col(models[i]) * F.col(models[j])).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)]
    r = wide.agg(*aggs).first()
    g = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            g[i, j] = g[j, i] = r[f"g{i}_{j}"]
    b = np.array([r[f"b{i}"] for i in range(k)])
    return g, b, float(r["yy"]), int(r["n"])


def simplex_grid(k: int, step: float = 0.1) -> list[tuple[float, ...]]:
    """All weight vectors on the simplex with the given step (286 for k=4, 1001 for k=5)."""
    units = int(round(1 / step))
    out = []
    for combo in itertools.product(range(units + 1), repeat=k):
        if sum(combo) == units:
            out.append(tuple(c / units for c in combo))
    return out


def grid_blend(wide: DataFrame, models: Sequence[str], step: float = 0.1) -> tuple[dict, float]:
    """Exhaustive simplex search by RMSE; ties -> first in grid order."""
    g, b, yy, n = gram_stats(wide, models)
    best, best_sse = None, math.inf
    for w in simplex_grid(len(models), step):
        wv = np.array(w)
        sse = float(wv @ g @ wv - 2 * wv @ b + yy)
        if sse < best_sse - 1e-9 * max(1.0, abs(best_sse) if best_sse < math.inf else 1.0):
            best, best_sse = w, sse
    return dict(zip(models, best)), math.sqrt(max(best_sse, 0.0) / n)


def nnls_small(g: np.ndarray, b: np.ndarray, ridge: np.ndarray | None = None) -> np.ndarray:
    """Exact non-negative least squares for a handful of variables by
    enumerating active sets (min w'Gw - 2b'w, w >= 0)."""
    k = len(b)
    gg = g + (ridge if ridge is not None else 0)
    best, best_obj = np.zeros(k), 0.0
    for r in range(1, k + 1):
        for idx in itertools.combinations(range(k), r):
            ix = list(idx)
            try:
                w_s = np.linalg.solve(gg[np.ix_(ix, ix)], b[ix])
            except np.linalg.LinAlgError:
                continue
            if np.any(w_s < -1e-12):
                continue
            w = np.zeros(k)
            w[ix] = np.clip(w_s, 0, None)
            obj = float(w @ gg @ w - 2 * b @ w)
            if obj < best_obj - 1e-12:
                best, best_obj = w, obj
    return best


def positive_linear_blend(wide: DataFrame, models: Sequence[str]) -> dict:
    """Non-negative least squares without intercept, normalised to sum 1
    (all-zero -> equal weights)."""
    g, b, _, _ = gram_stats(wide, models)
    w = nnls_small(g, b)
    if w.sum() <= 0:
        w = np.ones(len(models))
    w = w / w.sum()
    return dict(zip(models, w.tolist()))


def ridge_stack_nonneg(wide: DataFrame, models: Sequence[str], alpha: float = 1.0) -> tuple[dict, float]:
    """E5: non-negative ridge stack with intercept (centred Gram + alpha I)."""
    k = len(models)
    g, b, yy, n = gram_stats(wide, models)
    means = wide.agg(*[F.avg(m).alias(m) for m in models], F.avg("y_true").alias("_y")).first()
    mu = np.array([means[m] for m in models])
    my = means["_y"]
    gc = g - n * np.outer(mu, mu)
    bc = b - n * mu * my
    w = nnls_small(gc, bc, alpha * np.eye(k))
    intercept = my - float(mu @ w)
    return dict(zip(models, w.tolist())), intercept


def weighted_prediction(wide: DataFrame, weights: dict, name: str, keys: Sequence[str] = PRED_KEYS,
                        intercept: float = 0.0, renormalise: bool = False) -> DataFrame:
    """sum(w * p) (optionally / sum of weights of available models) as a long row."""
    num = sum((F.lit(float(w)) * F.col(m) for m, w in weights.items()), F.lit(float(intercept)))
    if renormalise:
        den = sum((F.when(F.col(m).isNotNull(), F.lit(float(w))).otherwise(F.lit(0.0)) for m, w in weights.items()), F.lit(0.0))
        num = sum((F.lit(float(w)) * F.coalesce(F.col(m), F.lit(0.0)) for m, w in weights.items()), F.lit(0.0)) / den
    return wide.select(*keys, F.lit(name).alias("model"), num.alias("prediction"))


def mean_of(long: DataFrame, models: Sequence[str], name: str, keys: Sequence[str] = PRED_KEYS) -> DataFrame:
    """Per-key mean of the listed models' predictions (one group-by on the keys)."""
    return (long.where(F.col("model").isin(list(models))).groupBy(*keys)
            .agg(F.avg("prediction").alias("prediction")).select(*keys, F.lit(name).alias("model"), "prediction"))


def inverse_rmse_weights(metrics: DataFrame, top: int = 5) -> dict:
    """Weights proportional to 1 / max(rmse, 1e-9) over the top models."""
    rows = metrics.orderBy(F.col("rmse").asc_nulls_last(), "model").limit(top).collect()
    inv = {r["model"]: 1.0 / max(r["rmse"], 1e-9) for r in rows}
    tot = sum(inv.values())
    return {m: v / tot for m, v in inv.items()}


def wide(long: DataFrame, models: Sequence[str], keys: Sequence[str] = PRED_KEYS) -> DataFrame:
    return long_to_wide(long, models, keys)
