"""Climatology, slices, group blends and categories against pandas and plain Python."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F


def test_climatology_many_groups(spark):
    """3,000 groups (beyond the broadcast bound of the quantiles), NULL keys, ties and fallback."""
    from hourcast.operators.slices import climatology, climatology_predict

    rng = np.random.default_rng(0)
    n = 30_000
    pdf = pd.DataFrame({"station": [f"s{i}" for i in rng.integers(0, 125, n)], "month": 1, "hour": rng.integers(0, 24, n), "y_true": np.round(rng.gamma(2, 30, n))})
    df = spark.createDataFrame(pdf).withColumn("station", F.when(F.col("station") != "s7", F.col("station")))
    table = climatology(df).cache()
    got = {(r.level, r.station, r.month, r.hour): (r.n, r.median) for r in table.collect()}
    pdf["station"] = pdf.station.replace("s7", "missing")
    want = {(3, "*", "*", "*"): (n, pdf.y_true.median())}
    for level, keys in ((0, ["station", "month", "hour"]), (1, ["station", "hour"]), (2, ["hour"])):
        for k, g in pdf.groupby(keys).y_true:
            k = dict(zip(keys, k if isinstance(k, tuple) else (k,)))
            want[(level, *[str(k.get(c, "*")) for c in ("station", "month", "hour")])] = (len(g), g.median())
    assert len(got) > 3000 and got == want
    rows = spark.createDataFrame([(1, "s1", 1, 5), (2, "s1", 9, 5), (3, "new", 1, 5), (4, "s1", 1, 77), (5, None, 1, 5)], "id int, station string, month int, hour int")
    out = {r.id: (r.level, r.prediction) for r in climatology_predict(rows, table, ["id"], least=1).collect()}
    assert out == {1: (0, want[0, "s1", "1", "5"][1]), 2: (1, want[1, "s1", "*", "5"][1]), 3: (2, want[2, "*", "*", "5"][1]),
                   4: (3, pdf.y_true.median()), 5: (0, want[0, "missing", "1", "5"][1])}
    assert {r.level for r in climatology_predict(rows, table, ["id"], least=10**6).collect()} == {3}
    assert climatology_predict(rows, climatology(df.limit(0)), ["id"]).where("prediction is not null").count() == 0


def test_error_slices(spark):
    from hourcast.operators.slices import error_slices

    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"model": rng.choice(["a", "b"], 900), "y_true": rng.normal(50, 20, 900), "prediction": rng.normal(50, 20, 900),
                        "hour": rng.integers(0, 5, 900), "wind": rng.choice(["N", "S"], 900)})
    df = spark.createDataFrame(pdf).withColumn("wind", F.when(F.col("wind") == "N", "N"))
    out = error_slices(df, ["hour", "wind"])
    assert len({r.slice for r in out.collect()}) == 2
    pdf["wind"] = pdf.wind.replace("S", "missing")
    pdf["e"] = pdf.prediction - pdf.y_true
    got = {(r.model, r.slice, r.value): tuple(r)[3:] for r in out.collect()}
    assert len(got) == 2 * (5 + 2)
    for s in ("hour", "wind"):
        for (m, v), e in pdf.groupby(["model", s]).e:
            want = (len(e), (e**2).mean() ** 0.5, e.abs().mean(), e.mean(), (e > 0).mean(), (e < 0).mean(), e.abs().quantile(0.95))
            assert np.allclose(got[m, s, str(v)], want)


@pytest.mark.parametrize("copies", [False, True])
def test_group_blend_equals_blends_apart(spark, copies):
    from hourcast.operators import ensemble as E
    from hourcast.operators.slices import group_blend, group_blend_weights

    rng = np.random.default_rng(2)
    models = ["m1", "m2", "m3"]
    y = rng.gamma(3, 20, 600)
    g = rng.integers(0, 5, 600)
    p = {m: y * rng.normal(1, 0.1 * (i + 1), 600) + 5 * (g == i) for i, m in enumerate(models)}
    if copies:
        p["m3"] = p["m1"]
    pdf = pd.DataFrame({"grp": [f"g{i}" for i in g], "id": range(600), "y_true": y, **p})
    pdf.loc[pdf.grp == "g4", models] *= -1  # nothing helps: equal weights
    df = spark.createDataFrame(pdf).cache()
    weights = group_blend_weights(df, models, ["grp"])
    got = {r.grp: r for r in weights.collect()}
    assert len(got) == 5
    for k, r in got.items():
        part = df.where(F.col("grp") == k)
        want = E.positive_linear_blend(part, models)
        sse = lambda w: part.select(F.sum((F.col("y_true") - sum(F.col(m) * float(w[m]) for m in models)) ** 2)).first()[0]
        assert r.rows == part.count() and sum(r.weights.values()) == pytest.approx(1) and min(r.weights.values()) >= 0
        assert sse(r.weights) == pytest.approx(sse(want), rel=1e-9)
    assert got["g4"].weights == pytest.approx(dict.fromkeys(models, 1 / 3))
    new = spark.createDataFrame([("g0", 1, 0.0, 1.0, 2.0, 3.0), ("none", 2, 0.0, 1.0, 2.0, 3.0)], "grp string, id int, y_true double, m1 double, m2 double, m3 double")
    out = {r.id: r.prediction for r in group_blend(new, weights, models, ["grp"], ["id"], "b").collect()}
    assert out[2] == pytest.approx(2.0) and out[1] == pytest.approx(sum(got["g0"].weights[m] * v for m, v in zip(models, (1, 2, 3))))


def test_categories(spark):
    from hourcast.operators import slices as S

    rows = [("a", y, p) for y, p in [(35, 35.1), (35, 10), (75, 70), (150.5, 100), (300, 251), (250, 250), (80, 20)]] + [("b", 10, 10), ("b", None, 5)]
    counts = S.confusion(spark.createDataFrame([(m, None if y is None else float(y), float(p)) for m, y, p in rows], "model string, y_true double, prediction double"))
    matrix = {(r.model, r.actual): tuple(r)[2:] for r in S.confusion_matrix(counts).collect()}
    assert matrix == {("a", "0-35"): (1, 1, 0, 0, 0), ("a", "35-75"): (0, 1, 0, 0, 0), ("a", "75-150"): (1, 0, 0, 0, 0),
                      ("a", "150-250"): (0, 0, 1, 1, 0), ("a", "250+"): (0, 0, 0, 0, 1), ("b", "0-35"): (1, 0, 0, 0, 0)}
    per = {(r.model, r.category): (r.support, r.precision, r.recall, r.f1) for r in S.class_metrics(counts).collect()}
    assert per["a", "0-35"] == (2, 0.5, 0.5, 0.5) and per["a", "75-150"] == (1, 0.0, 0.0, 0.0) and per["a", "250+"] == (1, 1.0, 1.0, 1.0)
    scores = {r.model: (r.rows, r.accuracy, r.macro_f1) for r in S.category_scores(counts).collect()}
    assert scores["b"] == (1, 1.0, 1.0) and scores["a"] == pytest.approx((7, 4 / 7, (0.5 + 2 / 3 + 0 + 2 / 3 + 1) / 5))
