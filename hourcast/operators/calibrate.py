"""Calibration and residual correction (K1-K4).

K1 searches thresholds x offsets x slopes of an additive correction.  For a
threshold T the corrected prediction is base + o + s*(base - T) on rows with
base >= T (never clipped, since T > 0 and o, s >= 0) and clip(base) elsewhere,
so every score is a closed form in per-threshold moments; one aggregation
over the rows gives all of them and the 1575 candidates are evaluated on the
driver from 7 rows of sums.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.functions.scalar import clip_nonneg

# The correction grid.
THRESHOLDS = (60.0, 75.0, 90.0, 100.0, 115.0, 130.0, 150.0)
OFFSETS = tuple(np.linspace(0.0, 28.0, 15).tolist())
SLOPES = tuple(np.linspace(0.0, 0.35, 15).tolist())
OBJECTIVES = ("overall_rmse", "severe_rmse", "balanced")
SEVERE = 150.0


def correction_moments(df: DataFrame, base: str = "prediction", y: str = "y_true", thresholds=THRESHOLDS) -> dict:
    """Per threshold, overall and severe (y > 150): counts and sums of d, d^2, x, x^2, d*x over base >= T
    (d = base - y, x = base - T) and SSE / error sum of clip(base) - y over base < T."""
    b, yy = F.col(base), F.col(y)
    d = b - yy
    e0 = clip_nonneg(b) - yy
    sev = yy > SEVERE
    aggs = [F.count(F.lit(1)).alias("n"), F.count_if(sev).alias("n_sev")]
    for i, t in enumerate(thresholds):
        a = b >= t
        x = b - F.lit(t)
        for tag, cond in (("", a), ("s", a & sev)):
            aggs += [
                F.count_if(cond).alias(f"na{tag}{i}"),
                F.sum(F.when(cond, d)).alias(f"sd{tag}{i}"), F.sum(F.when(cond, d * d)).alias(f"sdd{tag}{i}"),
                F.sum(F.when(cond, x)).alias(f"sx{tag}{i}"), F.sum(F.when(cond, x * x)).alias(f"sxx{tag}{i}"),
                F.sum(F.when(cond, d * x)).alias(f"sdx{tag}{i}"),
            ]
        for tag, cond in (("", ~a), ("s", ~a & sev)):
            aggs += [F.sum(F.when(cond, e0 * e0)).alias(f"sse_b{tag}{i}"), F.sum(F.when(cond, e0)).alias(f"se_b{tag}{i}")]
    r = df.agg(*aggs).first().asDict()
    return {k: (0.0 if v is None else v) for k, v in r.items()}


def _scores(m: dict, i: int, o: float, s: float) -> tuple[float, float, float]:
    def sse(tag):
        na = m[f"na{tag}{i}"]
        return (m[f"sdd{tag}{i}"] + na * o * o + s * s * m[f"sxx{tag}{i}"] + 2 * o * m[f"sd{tag}{i}"]
                + 2 * s * m[f"sdx{tag}{i}"] + 2 * o * s * m[f"sx{tag}{i}"] + m[f"sse_b{tag}{i}"])

    n, ns = m["n"], m["n_sev"]
    rmse = math.sqrt(max(sse(""), 0.0) / n)
    if ns == 0:
        return rmse, float("nan"), float("nan")
    sev_rmse = math.sqrt(max(sse("s"), 0.0) / ns)
    sev_bias = (m[f"sds{i}"] + m[f"nas{i}"] * o + s * m[f"sxs{i}"] + m[f"se_bs{i}"]) / ns
    return rmse, sev_rmse, sev_bias


def select_additive_correction(df: DataFrame, objective: str, base: str = "prediction", moments: dict | None = None) -> tuple[dict | None, float]:
    """K1: best (threshold, offset, slope) by the objective; NaN scores skipped,
    ties -> first in (threshold, offset, slope) loop order.  ``moments`` of the same rows serve all objectives."""
    m = moments or correction_moments(df, base)
    best, best_score = None, math.inf
    for i, t in enumerate(THRESHOLDS):
        for o in OFFSETS:
            for s in SLOPES:
                rmse, sev_rmse, sev_bias = _scores(m, i, o, s)
                score = {"overall_rmse": rmse, "severe_rmse": sev_rmse,
                         "balanced": rmse + 0.2 * abs(sev_bias)}[objective]
                if math.isfinite(score) and round(score, 9) < round(best_score, 9):
                    best, best_score = {"threshold": t, "offset": o, "slope": s, "objective": objective}, score
    return best, best_score


def apply_additive_correction(base, threshold: float, offset: float, slope: float):
    """K2: max(0, base + offset*[base >= T] + slope*max(base - T, 0))."""
    b = F.col(base) if isinstance(base, str) else base
    return clip_nonneg(
        b + F.lit(offset) * (b >= threshold).cast("double") + F.lit(slope) * clip_nonneg(b - threshold)
    )


def fixed_slope_calibration(p, slope: float = 0.025, threshold: float = 150.0):
    """K3: max(0, p + slope * max(p - threshold, 0))."""
    p = F.col(p) if isinstance(p, str) else p
    return clip_nonneg(p + F.lit(slope) * clip_nonneg(p - threshold))


def correction_features(base) -> list:
    """K4: base, base^2, >= 75/100/125/150 flags and excesses over them."""
    b = F.col(base) if isinstance(base, str) else base
    out = [b.alias("base_pred"), (b * b).alias("base_pred_sq")]
    out += [(b >= t).cast("double").alias(f"base_gt_{t}") for t in (75, 100, 125, 150)]
    out += [clip_nonneg(b - t).alias(f"excess_{t}") for t in (75, 100, 125, 150)]
    return out


def calibrated(wide: DataFrame, models, base: str, early, keys, alpha: float = 25.0) -> DataFrame:
    """K7: every row's forecast of ``base`` as it is and corrected, fitted on the rows that meet ``early``:
    ``reference_<base>``, one additive correction per objective that has a finite score (K1, K2), a Ridge on the
    residual and one on the target (K5, K6: K4 features and all model columns, weights 1 + 0.5[y >= 75] + 4[y >= 150]).

    Long rows ``(keys..., model, prediction)`` over all of ``wide``."""
    from hourcast.functions.scalar import severe_weights
    from hourcast.operators.models import Assembled, ridge
    from hourcast.session import cut_lineage

    feats = cut_lineage(wide.select(*keys, *correction_features(base), *[F.col(m).alias(f"model_{m}") for m in models], F.col(base).alias("_base")))
    fit = feats.where(early)
    moments = correction_moments(fit, "base_pred")
    forms = {f"reference_{base}": F.col("base_pred")}
    for objective in OBJECTIVES:
        best, _ = select_additive_correction(fit, objective, "base_pred", moments)
        if best:
            forms[f"additive_threshold_{objective}"] = apply_additive_correction("base_pred", best["threshold"], best["offset"], best["slope"])
    plain = feats.select(*keys, F.explode(F.array(*[F.struct(F.lit(n).alias("model"), p.alias("prediction")) for n, p in forms.items()])).alias("x"))
    numeric = [c for c in feats.columns if c not in (*keys, "_base")]
    a = Assembled(fit, {"all": feats}, numeric, [], keys, extra=["_base"])
    weighted = a.train.withColumn("_w", severe_weights("y_true", 0.5, 4.0))
    residual = weighted.withColumn("y_true", F.col("y_true") - F.col("_base"))
    out = plain.select(*keys, "x.model", "x.prediction")
    for name, rows, back in (("residual_ridge", residual, lambda p: F.col("_base") + p), ("target_ridge", weighted, lambda p: p)):
        model = ridge(rows, alpha=alpha, weight_col="_w").fit(rows)
        out = out.unionByName(a.predict(model, "all", f"{name}_severe_weighted", back))
    return out


# --------------------------------------------------------------------------- P17 Box-Cox

def boxcox_expr(x, lam: float):
    x = F.col(x) if isinstance(x, str) else x
    return F.log(x) if abs(lam) < 1e-12 else (F.pow(x, F.lit(lam)) - 1.0) / F.lit(lam)


def boxcox_fit(df: DataFrame, col: str = "y_true", shift: float = 1.0, lo: float = -2.0, hi: float = 2.0,
               points: int = 41, passes: int = 5) -> dict:
    """Box-Cox lambda for ``col + shift`` by maximum likelihood
    (LLF = (lam-1) sum ln x - n/2 ln var_pop(boxcox(x, lam))).  Each pass is
    one aggregation over a lambda grid (two sums per grid point); the grid is
    refined around the best point.  Then the mean / population std of the
    transformed values (for standardising)."""
    x = F.col(col) + F.lit(shift)
    x = F.when(x <= 0, F.raise_error(F.lit("Box-Cox needs values above zero after the shift")).cast("double")).otherwise(x)
    base = df.select(x.alias("_x")).where(F.col("_x").isNotNull())
    best = None
    for _ in range(passes):
        grid = np.linspace(lo, hi, points).tolist()
        aggs = [F.count(F.lit(1)).alias("n"), F.sum(F.log("_x")).alias("sl")]
        for i, lam in enumerate(grid):
            b = boxcox_expr("_x", lam)
            aggs += [F.sum(b).alias(f"s{i}"), F.sum(b * b).alias(f"q{i}")]
        r = base.agg(*aggs).first()
        n = r["n"]
        llf = []
        for i, lam in enumerate(grid):
            var = r[f"q{i}"] / n - (r[f"s{i}"] / n) ** 2
            llf.append((lam - 1) * r["sl"] - n / 2 * math.log(var) if var > 0 else -math.inf)
        k = int(np.argmax(llf))
        best = grid[k]
        step = grid[1] - grid[0]
        lo, hi = best - step, best + step
    b = boxcox_expr("_x", best)
    m = base.agg(F.avg(b).alias("m"), F.stddev_pop(b).alias("s")).first()
    return {"lambda": best, "shift": shift, "mean": m["m"], "std": m["s"] or 1.0}


def boxcox_transform(y, fit: dict):
    y = F.col(y) if isinstance(y, str) else y
    return (boxcox_expr(y + F.lit(fit["shift"]), fit["lambda"]) - F.lit(fit["mean"])) / F.lit(fit["std"])


def boxcox_inverse(z, fit: dict):
    z = F.col(z) if isinstance(z, str) else z
    b = z * F.lit(fit["std"]) + F.lit(fit["mean"])
    lam = fit["lambda"]
    x = F.exp(b) if abs(lam) < 1e-12 else F.pow(clip_nonneg(b * lam + 1.0), F.lit(1.0 / lam))
    return x - F.lit(fit["shift"])
