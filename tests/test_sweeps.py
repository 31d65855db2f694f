"""Sufficient statistics, sweeps, many series, early stopping and time ranks against plain fits and numpy."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

T0 = dt.datetime(2024, 1, 1)


def frame(spark, n=600, series=4, seed=0, gaps=True):
    """Hourly rows of a few series with NULLs in one feature and a level that only late rows have."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        x1, x2 = rng.normal(50, 10), rng.normal(0.01, 0.002)
        s = int(rng.integers(series))
        rows.append((f"s{s}", "late" if i > n - 40 else "NE" if i % 3 else "SW", T0 + dt.timedelta(hours=i // 2),
                     float(x1), None if gaps and i % 7 == 0 else float(x2), float(max(0, 2 * x1 + 900 * x2 + 5 * s + rng.normal(0, 3)))))
    df = spark.createDataFrame(rows, "station string, wd_lag_1 string, window_end timestamp_ntz, pm25_a double, temp_b double, y_true double")
    return df.withColumn("target_time", F.col("window_end") + F.expr("INTERVAL 1 HOUR"))


def test_sweep_equals_separate_fits(spark):
    from hourcast.operators import grams as G
    from hourcast.operators import models as R
    from hourcast.operators.splits import expanding_folds, ts_lit

    df = frame(spark).cache()
    num, cat = ["pm25_a", "temp_b"], ["station", "wd_lag_1"]
    candidates = [{"alpha": 0.5, "group": "all_features"}, {"alpha": 200.0, "group": "pollution_only"}]
    got = {(r.candidate, r.fold): r for r in G.ridge_sweep(df, num, cat, candidates).collect()}
    assert len(got) == 6
    for fold, (a, b) in enumerate(expanding_folds(df, "window_end", 3)):
        tr = df.where(F.col("window_end") <= ts_lit(a))
        va = df.where((F.col("window_end") > ts_lit(a)) & (F.col("window_end") <= ts_lit(b)))
        for i, c in enumerate(candidates):
            pr, _, _ = R.fit_predict(R.ridge(tr, alpha=c["alpha"]), tr, va, *R.feature_group(num, cat, c["group"]), clip=False)
            want = pr.agg(F.sqrt(F.avg((F.col("y_true") - F.col("prediction")) ** 2)), F.count(F.lit(1))).first()
            assert got[i, fold].rmse == pytest.approx(want[0], rel=1e-6)
            assert (got[i, fold].train_rows, got[i, fold].valid_rows) == (tr.count(), want[1])


def test_sweep_summary_and_json(spark, tmp_path):
    from hourcast.operators import grams as G

    assert G.ridge_candidates(5, 1) == G.ridge_candidates(5, 1) != G.ridge_candidates(5, 2)
    scores = spark.createDataFrame(
        [(i, float(10**i), "all_features", f, 5, 5, r) for i, rs in enumerate([(3.0, 4.0), (1.0, 2.0), (2.0, 1.0)]) for f, r in enumerate(rs)],
        "candidate int, alpha double, feature_group string, fold int, train_rows long, valid_rows long, rmse double")
    out = G.sweep_summary(scores)
    assert [(r.candidate, r.mean_rmse, r.folds) for r in out.orderBy("rank").collect()] == [(1, 1.5, 2), (2, 1.5, 2), (0, 3.5, 2)]
    best = G.best_params(out, str(tmp_path / "best"))
    assert best == {"alpha": 10.0, "feature_group": "all_features"} == json.loads(spark.read.text(str(tmp_path / "best")).first()[0])


@pytest.mark.parametrize("weighted", [False, True])
def test_gram_by_group(spark, weighted):
    from hourcast.operators import grams as G

    rng = np.random.default_rng(3)
    x, g, w = rng.normal(size=(500, 3)), rng.integers(0, 40, 500), rng.random(500)
    rows = [(int(k), None if k == 3 else "ab"[k % 2], *map(float, r), float(v)) for k, r, v in zip(g, x, w)]
    df = spark.createDataFrame(rows, "k long, t string, a double, b double, c double, w double").repartition(7)
    whole, G.HELD = G.HELD, 50  # matrices are passed on early
    try:
        got = G.matrices(G.gram(df, [F.col(c) for c in "abc"], ["k", "t"], F.col("w") if weighted else None), ["k", "t"])
    finally:
        G.HELD = whole
    assert len(got) == len(set(g.tolist()))
    for (k, _), m in got.items():
        z = x[g == k]
        assert np.allclose(m, z.T @ (z * (w[g == k][:, None] if weighted else 1)))
    assert np.allclose(G.matrices(G.gram(df, [F.col("a")]))[()], (x[:, 0] ** 2).sum())
    assert G.matrices(G.gram(df.limit(0), [F.col("a")])) == {}


@pytest.mark.parametrize("weight", [None, "w"])
def test_series_ridge_equals_plain_ridge(spark, weight):
    from hourcast.operators import grams as G
    from hourcast.operators import models as R

    df = frame(spark, series=12).withColumn("w", 1 + (F.col("y_true") > 100).cast("double")).cache()
    tr, va = df.where("window_end < '2024-01-10'"), df.where("window_end >= '2024-01-10'")
    keys = ["station", "window_end", "target_time", "y_true"]
    plain, _, _ = R.fit_predict(R.ridge(tr, weight_col=weight), tr, va, ["pm25_a", "temp_b"], ["station", "wd_lag_1"],
                                keys=keys, extra_train_cols=[weight] if weight else ())
    fit = G.series_ridge(tr, ["pm25_a", "temp_b"], "station", ["wd_lag_1"], weight=weight)
    own = fit.predict(va, keys)
    order = lambda d: np.array([r[0] for r in d.orderBy("window_end", "y_true").select("prediction").collect()])
    assert np.allclose(order(plain), order(own), atol=1e-6)


def test_series_ridge_many_series(spark):
    """4,500 series (beyond the solver's 4,096 columns) against the closed form; an unseen series has no effect."""
    from hourcast.operators import grams as G

    rng = np.random.default_rng(4)
    n, k = 13_500, 4_500
    s, x = np.arange(n) % k, rng.normal(size=n)
    y = 100 + 3 * x + 10 * np.sin(s) + rng.normal(size=n)
    df = spark.createDataFrame([(f"u{a}", float(b), float(c)) for a, b, c in zip(s, x, y)], "station string, x double, y_true double")
    fit = G.series_ridge(df, ["x"], alpha=2.0)
    z = (x - x.mean()) / x.std()
    # eliminate the intercept instead, and solve for all 4,501 coefficients
    a = np.zeros((n, k + 1))
    a[np.arange(n), s], a[:, k] = 1.0, z
    ac = a - a.mean(0)
    coef = np.linalg.solve(ac.T @ ac + 2.0 * np.eye(k + 1), ac.T @ (y - y.mean()))
    assert np.allclose(fit.coef, [y.mean() - a.mean(0) @ coef, coef[k]], atol=1e-7)
    effects = {r.series: r.effect for r in fit.effects.collect()}
    assert len(effects) == k and np.allclose([effects[f"u{i}"] for i in range(k)], coef[:k], atol=1e-7)
    new = spark.createDataFrame([("unseen", float(x.mean()), 0.0)], "station string, x double, y_true double")
    assert fit.predict(new, ["station"]).first().prediction == pytest.approx(float(fit.coef[0]))
    with pytest.raises(ValueError):
        G.series_ridge(df, ["x"], alpha=0.0)


def test_boosting_stops_early(spark):
    from hourcast.operators import models as R

    df = frame(spark, gaps=False).cache()
    tr, va = df.where("window_end < '2024-01-10'"), df.where("window_end >= '2024-01-10'")
    rows = R.Assembled(tr, {"valid": va}, ["pm25_a", "temp_b"], ["station", "wd_lag_1"])
    preds, trees = R.boosted_forms(rows, "valid", dt.datetime(2024, 1, 8), iters=40, depth=4, step=0.5)
    assert len(trees) == 4 and all(1 <= k < 40 for k in trees.values())
    by = {r.model: (r.n, r.p, r.y) for r in preds.groupBy("model").agg(
        F.count(F.lit(1)).alias("n"), F.avg("prediction").alias("p"), F.avg("y_true").alias("y")).collect()}
    assert set(by) == set(trees) and all(n == va.count() and abs(p - y) < 15 for n, p, y in by.values())
    with pytest.raises(ValueError):
        R.target_form("sqrt", tr)


# --------------------------------------------------------------------------- time ranks

@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date", "long"])
def test_time_ranks(spark, kind):
    """Tiny intervals: many levels; every rank of a gappy axis with repeated times, by time and by row."""
    from hourcast.operators.splits import TimeRanks

    rng = np.random.default_rng(5)
    days = rng.choice([*range(-500, -460), *range(0, 60, 3), 20_000], 400)
    if kind == "long":
        values = [(int(d),) for d in days]
    else:
        values = [(T0.date() + dt.timedelta(days=int(d)),) for d in days] if kind == "date" else [
            (T0 + dt.timedelta(days=int(d), microseconds=int(d) % 3),) for d in days]
    df = spark.createDataFrame([*values, (None,)], f"t {kind}")
    t = TimeRanks(df, "t", fan=3, leaf=2)
    rows = sorted(v for v, in values)
    distinct = sorted(set(rows))
    assert (t.times, t.rows) == (len(distinct), 400)
    assert t.nth(range(len(distinct))) == distinct
    at = t.at(range(0, 400, 7), by_row=True)
    assert [v for v, _ in at] == rows[::7] and [b for _, b in at] == [rows.index(v) for v in rows[::7]]
    assert TimeRanks(df, "t").nth([5, 0, 5]) == [distinct[5], distinct[0], distinct[5]]
    with pytest.raises(ValueError):
        t.nth([len(distinct)])
    assert TimeRanks(df.limit(0), "t").times == 0


def test_fold_edges_of_ten_million_times(spark):
    """A second-level axis: all edges of all folds come from one table of times."""
    from hourcast.operators.splits import expanding_folds

    n = 10_000_000
    df = spark.range(n).select((F.lit(T0).cast("timestamp_ntz") + F.col("id") * F.expr("INTERVAL 1 SECOND")).alias("t"))
    at = lambda i: T0 + dt.timedelta(seconds=i)
    q = n // 4
    assert expanding_folds(df, "t", 3) == [(at(i * q - 1), at((i + 1) * q - 1)) for i in (1, 2, 3)]


def test_time_index_ignores_the_session_zone(spark):
    """Hours that daylight saving skips or repeats keep their order."""
    from hourcast.operators.splits import TimeRanks

    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        hours = [dt.datetime(2024, 3, 10) + dt.timedelta(minutes=20 * i) for i in range(24)]
        df = spark.createDataFrame([(h,) for h in hours], "t timestamp_ntz")
        assert TimeRanks(df, "t", fan=2, leaf=1).nth(range(24)) == hours
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
