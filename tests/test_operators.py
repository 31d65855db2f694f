"""Hand-made panels with exact expected values, bucketed vs unbucketed
equality, and closed-form checks of the sufficient-statistic rewrites."""

import datetime as dt
import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourcast.spec import PanelSpec

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "station string, datetime timestamp_ntz, pm25 double, wspm double, wd string"
SPEC = PanelSpec(numeric=("pm25", "wspm"), categorical=("wd",), chunk_hours=48)


def panel(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def hours(station, values, start=0, skip=()):
    out = []
    for i, v in enumerate(values):
        if i in skip:
            continue
        out.append((station, T0 + dt.timedelta(hours=start + i), v, 1.0, "N"))
    return out


def test_gap_rejects_windows(spark):
    from hourcast.operators.windows import build_windows

    rows = hours("A", [float(i) for i in range(40)], skip={10})
    w = build_windows(panel(spark, rows), SPEC).collect()
    # gap at hour 10: windows need 24 consecutive hours + the next hour -> ends 34..38
    ends = sorted(r["window_end"] for r in w)
    assert all(e >= T0 + dt.timedelta(hours=11 + 23) for e in ends)
    assert len(ends) == 40 - 11 - 24


def test_short_station_has_no_windows(spark):
    from hourcast.operators.windows import build_windows

    rows = hours("A", [1.0] * 24) + hours("B", [2.0] * 40)
    w = build_windows(panel(spark, rows), SPEC)
    assert w.where("station = 'A'").count() == 0
    assert w.where("station = 'B'").count() == 40 - 24


def test_bucketed_windows_equal_unbucketed(spark):
    from hourcast.operators.windows import build_windows

    rng = np.random.default_rng(3)
    rows = []
    for s in ("A", "B", "C"):
        vals = [None if rng.random() < 0.2 else float(rng.integers(0, 200)) for _ in range(200)]
        rows += hours(s, vals, skip=set(rng.choice(200, 5, replace=False).tolist()))
    df = panel(spark, rows)
    a = build_windows(df, SPEC.with_chunk(24 + 2)).select("station", "window_end", "y_true", "w").collect()
    b = build_windows(df, SPEC.with_chunk(None)).select("station", "window_end", "y_true", "w").collect()
    assert sorted(map(str, a)) == sorted(map(str, b)) and len(a) > 0


def test_ffill_carry_across_buckets(spark):
    from hourcast.operators.impute import bfill_by_series, ffill_by_series

    vals = [None, 5.0] + [None] * 100 + [7.0, None]
    df = panel(spark, hours("A", vals))
    f = [r["pm25"] for r in ffill_by_series(df, SPEC).orderBy("datetime").collect()]
    assert f[0] is None and f[1:102] == [5.0] * 101 and f[102:] == [7.0, 7.0]
    b = [r["pm25"] for r in bfill_by_series(df, SPEC).orderBy("datetime").collect()]
    assert b[0] == 5.0 and b[2:103] == [7.0] * 101 and b[103] is None


def test_leading_null_takes_median_not_backfill(spark):
    from hourcast.operators.impute import causal_impute, impute_stats_fit

    df = panel(spark, hours("A", [None, 4.0, 2.0, 6.0]))
    stats = impute_stats_fit(df, SPEC)
    assert stats.medians["pm25"] == 4.0
    out = [r["pm25"] for r in causal_impute(df, stats, SPEC).orderBy("datetime").collect()]
    assert out == [4.0, 4.0, 2.0, 6.0]


def test_mode_tie_smallest(spark):
    from hourcast.functions.quantiles import most_frequent

    df = spark.createDataFrame([("NE",), ("E",), ("NE",), ("E",), (None,)], "wd string")
    assert most_frequent(df, "wd") == "E"


@pytest.mark.parametrize("n", [1, 2, 7, 1000, 4001])
def test_exact_quantiles_match_numpy(spark, n):
    from hourcast.functions.quantiles import exact_quantiles

    rng = np.random.default_rng(n)
    vals = np.round(rng.normal(50, 20, n), 1)
    df = spark.createDataFrame([(float(v), int(i % 3)) for i, v in enumerate(vals)], "v double, g int")
    probs = [0.05, 0.25, 0.5, 0.95]
    row = exact_quantiles(df, "v", probs, accuracy=100).first()  # small accuracy: wide brackets not needed
    for j, p in enumerate(probs):
        assert math.isclose(row[f"q{j}"], float(np.quantile(vals, p)), abs_tol=1e-9)
    by = {r["g"]: r for r in exact_quantiles(df, "v", [0.5], by=["g"], accuracy=50).collect()}
    for g, r in by.items():
        assert math.isclose(r["q0"], float(np.median(vals[np.arange(n) % 3 == g])), abs_tol=1e-9)


def test_band_edges_and_weights(spark):
    from hourcast.functions.scalar import band, severe_weights

    df = spark.createDataFrame([(35.0,), (35.01,), (75.0,), (150.0,), (150.01,)], "y double")
    r = df.select(band("y").alias("b"), severe_weights("y").alias("w")).collect()
    assert [x["b"] for x in r] == ["low_<=35", "moderate_35_75", "moderate_35_75", "high_75_150", "severe_>150"]
    assert [x["w"] for x in r] == [1.0, 1.0, 2.0, 6.0, 6.0]


def test_interpolation_matches_pandas(spark):
    import pandas as pd

    from hourcast.operators.impute import ImputeStats, interpolated_windows, rowwise_impute_supplied
    from hourcast.operators.windows import build_windows

    rng = np.random.default_rng(7)
    vals = [None if rng.random() < 0.4 else float(rng.integers(0, 100)) for _ in range(80)]
    vals[:5] = [None] * 5
    df = panel(spark, hours("A", vals)).withColumn("pm25_raw", F.lit(1.0))
    stats = ImputeStats({"pm25": 42.0, "wspm": 1.0}, {"wd": "N"})
    spec = replace(SPEC, chunk_hours=30)
    got = {r["window_end"]: [x["pm25"] for x in r["w"]] for r in interpolated_windows(df, stats, spec).collect()}
    raw = build_windows(df, spec.with_chunk(None)).select("window_end", "w").collect()
    for r in raw:
        arr = pd.Series([x["pm25"] for x in r["w"]], dtype=float)
        exp = arr.interpolate(limit_direction="both").fillna(42.0).tolist()
        assert np.allclose(got[r["window_end"]], exp)
    sup = spark.createDataFrame([(str(i), r["w"]) for i, r in enumerate(raw)],
                                "id string, w array<struct<pm25:double, wspm:double, wd:string>>")
    long = rowwise_impute_supplied(sup, stats, spec).collect()
    by_id = {}
    for x in long:
        by_id.setdefault(x["id"], {})[x["lag"]] = x["pm25"]
    for i, r in enumerate(raw):
        exp = pd.Series([x["pm25"] for x in r["w"]], dtype=float).interpolate(limit_direction="both").fillna(42.0).tolist()
        assert np.allclose([by_id[str(i)][24 - k] for k in range(24)], exp)


def test_grid_blend_equals_brute_force(spark):
    from hourcast.operators.ensemble import grid_blend, simplex_grid

    rng = np.random.default_rng(1)
    y = rng.normal(50, 10, 300)
    p = np.stack([y + rng.normal(0, s, 300) for s in (5, 8, 12)], axis=1)
    df = spark.createDataFrame([(float(a), float(b), float(c), float(t)) for (a, b, c), t in zip(p, y)],
                               "m0 double, m1 double, m2 double, y_true double")
    w, rmse = grid_blend(df, ["m0", "m1", "m2"])
    grid = simplex_grid(3)
    assert len(grid) == 66 and len(simplex_grid(5)) == 1001
    brute = min(grid, key=lambda g: np.mean((p @ np.array(g) - y) ** 2))
    assert tuple(w.values()) == brute
    assert math.isclose(rmse, math.sqrt(np.mean((p @ np.array(brute) - y) ** 2)), rel_tol=1e-9)


def test_additive_correction_equals_brute_force(spark):
    from hourcast.operators import calibrate as K

    rng = np.random.default_rng(2)
    y = np.abs(rng.normal(80, 60, 500))
    b = np.abs(y + rng.normal(-10, 25, 500))
    df = spark.createDataFrame([(float(u), float(v)) for u, v in zip(y, b)], "y_true double, prediction double")
    for obj in K.OBJECTIVES:
        best, score = K.select_additive_correction(df, obj)
        bs, bp = math.inf, None
        for t in K.THRESHOLDS:
            for o in K.OFFSETS:
                for s in K.SLOPES:
                    pred = np.clip(b + o * (b >= t) + s * np.maximum(b - t, 0), 0, None)
                    e = pred - y
                    sev = y > 150
                    val = {"overall_rmse": math.sqrt(np.mean(e ** 2)), "severe_rmse": math.sqrt(np.mean(e[sev] ** 2)),
                           "balanced": math.sqrt(np.mean(e ** 2)) + 0.2 * abs(np.mean(e[sev]))}[obj]
                    if round(val, 9) < round(bs, 9):
                        bs, bp = val, (t, o, s)
        assert (best["threshold"], best["offset"], best["slope"]) == bp
        assert math.isclose(score, bs, rel_tol=1e-9)


def test_ridge_matches_closed_form(spark):
    from hourcast.operators import models as R

    rng = np.random.default_rng(4)
    n, k, alpha = 200, 4, 10.0
    x = rng.normal(0, 1, (n, k))
    y = x @ np.array([3.0, -2.0, 0.5, 1.0]) + 7 + rng.normal(0, 1, n)
    rows = [(str(i), dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1), float(y[i]), *map(float, x[i])) for i in range(n)]
    cols = [f"x{j}" for j in range(k)]
    df = spark.createDataFrame(rows, "station string, window_end timestamp_ntz, target_time timestamp_ntz, y_true double, "
                               + ", ".join(f"{c} double" for c in cols))
    pred, model, _ = R.fit_predict(R.ridge(df, alpha), df, df, cols, [], name="ridge", clip=False)
    mu, sd = x.mean(0), x.std(0)
    xs = (x - mu) / sd
    xc, yc = xs - xs.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(k), xc.T @ yc)
    assert np.allclose(model.coefficients.toArray(), w, atol=1e-8)


def test_nnls_small_matches_enumeration():
    from hourcast.operators.ensemble import nnls_small

    rng = np.random.default_rng(5)
    a = rng.normal(size=(50, 4))
    yv = a @ np.array([1.0, -0.5, 0.3, 0.0]) + rng.normal(0, 0.1, 50)
    w = nnls_small(a.T @ a, a.T @ yv)
    assert np.all(w >= 0)
    # KKT: gradient non-negative on zero weights, ~0 on active ones
    g = a.T @ (a @ w - yv)
    assert np.all(g[w == 0] >= -1e-8) and np.allclose(g[w > 0], 0, atol=1e-8)


def test_split_rules():
    from hourcast.operators.splits import cutoff_index

    assert cutoff_index(720, 0.8) == 575
    assert cutoff_index(2, 0.8) == 0
    with pytest.raises(ValueError):
        cutoff_index(1, 0.8)
