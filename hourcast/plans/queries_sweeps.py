"""Sweeps, many-series Ridge, early-stopped boosting and fold queries.

Fits of many columns have no SQL form; the same library paths are run on one feature,
where SQL has a closed form, and their row counts are compared for all.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from hourcast.functions.scalar import severe_weights
from hourcast.operators import grams as G
from hourcast.operators import metrics as MT
from hourcast.operators import models as R
from hourcast.operators.splits import TimeRanks, chronological_cutoff, chronological_cutoffs, ts_lit
from hourcast.plans import oracle as O
from hourcast.plans.pipeline import once, prepare
from hourcast.plans.queries_models import KEYS, _frames, assembled
from hourcast.plans.registry import normalise, query
from hourcast.session import cut_lineage

ALPHAS = (0.1, 1.0, 10.0, 100.0, 10_000.0)

#: Training windows cut into expanding folds (W12), as in ``time_series_kfold``.
_FOLDS = """,
tr AS (SELECT station, window_end, y_true, pm25 AS x FROM win WHERE window_end <= (SELECT cutoff FROM cut)),
tt AS (SELECT window_end, row_number() OVER (ORDER BY window_end) - 1 AS i, count(*) OVER () AS n
       FROM (SELECT DISTINCT window_end FROM tr) d),
b AS (SELECT n // 4 AS test, n - 3 * (n // 4) AS first FROM (SELECT max(n) AS n FROM tt) x),
folds AS (SELECT f AS fold,
            (SELECT window_end FROM tt WHERE i = (SELECT first FROM b) + f * (SELECT test FROM b) - 1) AS tr_end,
            (SELECT window_end FROM tt WHERE i = (SELECT first FROM b) + (f + 1) * (SELECT test FROM b) - 1) AS va_end
          FROM range(3) r(f))"""

#: A one-feature Ridge on the standardised feature, per fold and penalty.
_SWEEP_SQL = O.prelude() + O.windows() + _FOLDS + f""",
m AS (SELECT fold, va_end, tr_end, count(*) AS n, avg(x) AS mx, stddev_pop(x) AS sx, avg(y_true) AS my, covar_pop(x, y_true) AS c
      FROM folds JOIN tr ON window_end <= tr_end GROUP BY ALL),
a AS (SELECT unnest({list(ALPHAS)}) AS alpha),
f AS (SELECT *, n * c / sx / (n + alpha) AS w FROM m, a),
s AS (SELECT alpha, fold, any_value(n) AS train_rows, count(*) AS valid_rows,
        sqrt(avg((y_true - my - w * (x - mx) / sx) * (y_true - my - w * (x - mx) / sx))) AS rmse
      FROM f JOIN tr ON window_end > tr_end AND window_end <= va_end GROUP BY alpha, fold)
SELECT alpha, CAST(fold AS BIGINT) AS fold, train_rows, valid_rows, round(rmse, 6) AS rmse FROM s"""


@query("ridge_sweep_latest", _SWEEP_SQL)
def q_sweep_latest(spark, sf_dir):
    """R12 on one feature (the latest target): five penalties x three expanding folds from one pass."""
    _, tr, _, _, _ = _frames(spark, sf_dir)
    out = G.ridge_sweep(tr, ["pm25_latest"], [], [{"alpha": a, "group": "all_features"} for a in ALPHAS])
    return normalise(out.select("alpha", "fold", "train_rows", "valid_rows", "rmse"))


def sweep(spark, sf_dir):
    _, tr, _, num, cat = _frames(spark, sf_dir)
    return once(spark, ("sweep", sf_dir), lambda: G.ridge_sweep(tr, num, cat, G.ridge_candidates(24, groups=tuple(R.FEATURE_GROUPS))))


@query("hyperparameter_sweep")
def q_r12(spark, sf_dir):
    """24 seeded candidates (penalty, feature group) x 3 expanding folds on all features; a row per
    candidate with mean fold rmse, rank and parameters as JSON."""
    return normalise(G.sweep_summary(sweep(spark, sf_dir)))


@query("hyperparameter_sweep_folds", O.prelude() + O.windows() + _FOLDS + """
SELECT CAST(fold AS BIGINT) AS fold, (SELECT count(*) FROM tr WHERE window_end <= tr_end) AS train_rows,
       (SELECT count(*) FROM tr WHERE window_end > tr_end AND window_end <= va_end) AS valid_rows,
       CAST(24 AS BIGINT) AS candidates, true AS scored FROM folds""")
def q_r12_folds(spark, sf_dir):
    """Fold sizes of the sweep, and that every candidate has a finite score on every fold."""
    ok = F.count_if(F.col("rmse").isNotNull() & ~F.isnan("rmse") & (F.col("rmse") > 0))
    return normalise(sweep(spark, sf_dir).groupBy("fold", "train_rows", "valid_rows").agg(
        F.count_distinct("candidate").alias("candidates"), (ok == F.count(F.lit(1))).alias("scored")))


# --------------------------------------------------------------------------- many series

def user_steps(spark, sf_dir):
    """Each user's events with the value of the user's previous event: thousands of short series."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "ts", "event_id", "value", "event_type")
    last = F.lag("value").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return e.select("user_id", "event_id", "event_type", last.alias("x"), F.col("value").alias("y_true")).where("x is not null")


_STEPS = "st AS (SELECT * FROM (SELECT user_id, event_id, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS x, value AS y FROM events) q WHERE x IS NOT NULL)"

#: Two unknowns (intercept, slope) are left when the series' effects are eliminated.
_SERIES_SQL = f"""WITH {_STEPS},
z AS (SELECT user_id, (x - (SELECT avg(x) FROM st)) / (SELECT stddev_pop(x) FROM st) AS x, y FROM st),
u AS (SELECT user_id, count(*) AS n, sum(x) AS sx, sum(y) AS sy FROM z GROUP BY user_id),
w AS (SELECT count(*) AS n, sum(x) AS sx, sum(x * x) AS sxx, sum(y) AS sy, sum(x * y) AS sxy FROM z),
d AS (SELECT sum(n * n / (n + 10.0)) AS n, sum(n * sx / (n + 10.0)) AS sx, sum(sx * sx / (n + 10.0)) AS sxx,
        sum(n * sy / (n + 10.0)) AS sy, sum(sx * sy / (n + 10.0)) AS sxy FROM u),
m AS (SELECT w.n - d.n AS a, w.sx - d.sx AS b, w.sxx + 10.0 - d.sxx AS c, w.sy - d.sy AS e, w.sxy - d.sxy AS f FROM w, d),
t AS (SELECT (e * c - b * f) / (a * c - b * b) AS b0, (a * f - b * e) / (a * c - b * b) AS b1 FROM m)
SELECT user_id AS series, n AS rows, round((sy - b0 * n - b1 * sx) / (n + 10.0), 6) AS effect FROM u, t"""


@query("series_ridge", _SERIES_SQL)
def q_series_ridge(spark, sf_dir):
    """R3/R4 with one series per user: Ridge (alpha 10) on the previous value, one effect a user by
    elimination of the series block."""
    fit = G.series_ridge(user_steps(spark, sf_dir), ["x"], "user_id", alpha=10.0)
    return normalise(fit.effects)


@query("series_ridge_predict")
def q_series_predict(spark, sf_dir):
    """R4/R11 with one series per user and the event type one-hot: rmse of the fit and of persistence."""
    rows = user_steps(spark, sf_dir)
    fit = G.series_ridge(rows, ["x"], "user_id", ["event_type"], alpha=10.0)
    keys = ["user_id", "event_id", "y_true"]
    both = fit.predict(rows, keys).unionByName(rows.select(*keys, F.lit("persistence").alias("model"), F.col("x").alias("prediction")))
    return normalise(MT.rmse_mae(both))


# --------------------------------------------------------------------------- closed forms of R4-R6

def _one_feature_sql() -> str:
    """Ridge on the standardised latest target, plain, weighted (1,4), (2,8) and on log1p(y); scored as A2."""
    cases = [
        ("ridge", "1.0", "y", "p"), ("weighted_1_4", "(1.0 + 1.0 * (y >= 75)::INT + 4.0 * (y >= 150)::INT)", "y", "p"),
        ("weighted_2_8", "(1.0 + 2.0 * (y >= 75)::INT + 8.0 * (y >= 150)::INT)", "y", "p"), ("log1p", "1.0", "ln(1 + y)", "exp(p) - 1"),
    ]
    parts = []
    for name, w, label, inverse in cases:
        parts.append(f"""
SELECT '{name}' AS model, y, greatest({inverse}, 0) AS p FROM (
  SELECT va.y, my + b * (va.z - mz) AS p FROM va, (
    SELECT sum(w * l) / sum(w) AS my, sum(w * z) / sum(w) AS mz,
      (sum(w * z * l) - sum(w * z) * sum(w * l) / sum(w)) / (sum(w * z * z) - sum(w * z) * sum(w * z) / sum(w) + 10.0) AS b
    FROM (SELECT z, {label} AS l, {w} AS w FROM tr) r) f) g""")
    return (O.prelude() + O.windows() + """,
o AS (SELECT window_end <= (SELECT cutoff FROM cut) AS train, pm25 AS x, y_true AS y FROM win),
k AS (SELECT avg(x) AS m, stddev_pop(x) AS s FROM o WHERE train),
tr AS (SELECT (x - m) / s AS z, y FROM o, k WHERE train),
va AS (SELECT (x - m) / s AS z, y FROM o, k WHERE NOT train),
pr AS (""" + " UNION ALL ".join(parts) + """)
SELECT model, count(*) AS rows, round(sqrt(avg((p - y) * (p - y))), 6) AS rmse, round(avg(abs(p - y)), 6) AS mae FROM pr GROUP BY model""")


@query("ridge_latest", _one_feature_sql())
def q_ridge_latest(spark, sf_dir):
    """R4, R5 and R6 through the same fit and predict functions as the large models, on one feature."""
    _, tr, va, _, _ = _frames(spark, sf_dir)
    fit = lambda est, rows, name, **k: R.fit_predict(est, rows, va, ["pm25_latest"], [], name=name, **k)[0]
    preds = [fit(R.ridge(tr), tr, "ridge")]
    for h, s in ((1.0, 4.0), (2.0, 8.0)):
        w = tr.withColumn("_w", severe_weights("y_true", h, s))
        preds.append(fit(R.ridge(w, weight_col="_w"), w, f"weighted_{int(h)}_{int(s)}", extra_train_cols=["_w"]))
    preds.append(fit(R.ridge(tr.withColumn("y_true", F.log1p("y_true"))), tr, "log1p", label_fn=F.log1p, inverse_fn=F.expm1))
    return normalise(MT.rmse_mae(reduce(lambda a, b: a.unionByName(b), preds)))


# --------------------------------------------------------------------------- R8

BOOST = {"iters": 30, "depth": 3, "step": 0.3}


def boosted(spark, sf_dir):
    """The four boosted models, fitted once a session; the last fifth of the training times decides when to stop."""
    def make():
        a = assembled(spark, sf_dir)
        preds, trees = R.boosted_forms(a, "valid", chronological_cutoff(a.train, "window_end", 0.8), **BOOST)
        return cut_lineage(preds), trees

    return once(spark, ("boosted", sf_dir), make)


@query("boosting_targets")
def q_r8(spark, sf_dir):
    """Early-stopped boosted trees on four target forms (raw, log1p, Box-Cox, severe weights), scored as A2."""
    preds, trees = boosted(spark, sf_dir)
    used = spark.createDataFrame(sorted(trees.items()), "model string, trees int")
    return normalise(MT.severe_score(preds).join(used, "model"))


@query("boosting_target_rows", O.prelude() + O.windows() + """,
tr AS (SELECT window_end FROM win WHERE window_end <= (SELECT cutoff FROM cut)),
tt AS (SELECT window_end, row_number() OVER (ORDER BY window_end) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT window_end FROM tr) d),
st AS (SELECT window_end AS stop FROM tt WHERE i = greatest(0, least(n - 2, CAST(floor(n * CAST(0.8 AS DOUBLE)) AS BIGINT) - 1))),
va AS (SELECT station, count(*) AS rows FROM win WHERE window_end > (SELECT cutoff FROM cut) GROUP BY station)
SELECT 'gradient_boosting_' || form AS model, station, rows, (SELECT count(*) FROM tr WHERE window_end <= (SELECT stop FROM st)) AS fit_rows,
  (SELECT count(*) FROM tr WHERE window_end > (SELECT stop FROM st)) AS stop_rows, true AS finite, true AS stopped_early
FROM va, (SELECT unnest(['raw', 'log1p', 'boxcox', 'weighted']) AS form) f""")
def q_r8_rows(spark, sf_dir):
    """Rows fitted, held back for stopping and predicted per station; every prediction finite and not negative,
    fewer trees than allowed."""
    _, tr, _, _, _ = _frames(spark, sf_dir)
    preds, trees = boosted(spark, sf_dir)
    stop = ts_lit(chronological_cutoff(tr, "window_end", 0.8))
    n = tr.agg(F.count_if(F.col("window_end") <= stop), F.count_if(F.col("window_end") > stop)).first()
    early = F.col("model").isin([m for m, k in trees.items() if k < BOOST["iters"]])
    p = F.col("prediction")
    good = p.isNotNull() & ~F.isnan(p) & (p >= 0) & (p < math.inf)
    return normalise(preds.groupBy("model", "station").agg(
        F.count(F.lit(1)).alias("rows"), F.lit(n[0]).alias("fit_rows"), F.lit(n[1]).alias("stop_rows"),
        (F.count_if(good) == F.count(F.lit(1))).alias("finite"), F.every(early).alias("stopped_early")))


# --------------------------------------------------------------------------- W13

_FRACTIONS = (0.5, 0.75, 0.8, 0.85, 0.9)


@query("cutoff_sweep_rows", f"""WITH t AS (SELECT ts, row_number() OVER (ORDER BY ts) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT ts FROM events) d),
c AS (SELECT fraction, ts AS cutoff FROM t, (SELECT unnest({list(_FRACTIONS)}) AS fraction) f
      WHERE i = greatest(0, least(n - 2, CAST(floor(n * CAST(fraction AS DOUBLE)) AS BIGINT) - 1)))
SELECT CAST(fraction AS DOUBLE) AS fraction, CAST(cutoff AS TIMESTAMP) AS cutoff, (SELECT count(*) FROM events WHERE ts <= cutoff) AS train_rows,
  (SELECT count(*) FROM events WHERE ts > cutoff) AS valid_rows, (SELECT max(n) FROM t) AS distinct_times FROM c""")
def q_w13_rows(spark, sf_dir):
    """W6/W13 on the raw event times (microseconds, nearly all distinct): all cutoffs from one look at the times."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("ts").cast("timestamp_ntz").alias("ts"))
    n = TimeRanks(e, "ts").times
    cuts = chronological_cutoffs(e, "ts", _FRACTIONS)
    rows = [e.agg(F.lit(f).alias("fraction"), F.lit(c).cast("timestamp_ntz").alias("cutoff"), F.count_if(F.col("ts") <= ts_lit(c)).alias("train_rows"),
                  F.count_if(F.col("ts") > ts_lit(c)).alias("valid_rows"), F.lit(n).alias("distinct_times")) for f, c in zip(_FRACTIONS, cuts, strict=True)]
    return normalise(reduce(lambda a, b: a.unionByName(b), rows))
