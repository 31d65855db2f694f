"""Experiment compositions (X1, X2, X4-X7), named folds, blends and frames of supplied windows.

Each experiment gathers its long forecasts once a session and reports them over all, per
station and per band.  Fitted models have no SQL form; the ``*_rows`` queries
compare with SQL what has: every metric of the baselines, and the row counts of all models.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.functions.scalar import band, clip_nonneg, make_hour_ts
from hourcast.operators import calibrate as K
from hourcast.operators import ensemble as E
from hourcast.operators import metrics as MT
from hourcast.operators import models as R
from hourcast.operators.context import city_context
from hourcast.operators.features import compact_frame, rich_frame
from hourcast.operators.impute import matrix_fill, refold
from hourcast.operators.joins import union_frames
from hourcast.operators.splits import rolling_origin_folds, split_by_time, ts_lit
from hourcast.plans import oracle as O
from hourcast.plans.pipeline import once, prepare
from hourcast.plans.queries_core import _supplied, _supplied_sql
from hourcast.plans.queries_models import KEYS, SMALL_BOOST, SMALL_FOREST, _frames, assembled, calibration, late_rows
from hourcast.plans.queries_reports import LATE_SQL, MODELS, P, _wide_sql, preds_of
from hourcast.plans.queries_supplied import _J1_SQL, _M8_SQL, _aligned, _m8_long
from hourcast.plans.queries_sweeps import boosted
from hourcast.plans.registry import normalise, query
from hourcast.session import cut_lineage

BAND_SQL = "CASE WHEN y_true <= 35 THEN 'low_<=35' WHEN y_true <= 75 THEN 'moderate_35_75' WHEN y_true <= 150 THEN 'high_75_150' ELSE 'severe_>150' END"


def report(preds: DataFrame) -> DataFrame:
    """``(scope, grp, model, rows, rmse, mae, bias)`` over all, per station (A6) and per band (A7), in one aggregation."""
    e = F.col("prediction") - F.col("y_true")
    rows = preds.select("model", "station", band("y_true").alias("band"), e.alias("e"))
    e = F.col("e")
    out = rows.groupingSets([["model"], ["model", "station"], ["model", "band"]], "model", "station", "band").agg(
        F.when(F.grouping("station") == 0, "station").when(F.grouping("band") == 0, "band").otherwise("overall").alias("scope"),
        F.count(F.lit(1)).alias("rows"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"), F.avg(e).alias("bias"))
    return out.select("scope", F.coalesce("station", "band", F.lit("all")).alias("grp"), "model", "rows", "rmse", "mae", "bias")


def only_baselines(df: DataFrame, models=MODELS) -> DataFrame:
    """The metrics of ``models`` and the row counts of all."""
    known = F.col("model").isin(list(models))
    return df.select("scope", "grp", "model", "rows", *[F.when(known, F.col(c)).alias(c) for c in ("rmse", "mae", "bias")])


def _report_sql(src: str, others: tuple[str, ...], like: str = "persistence") -> str:
    """SQL of :func:`only_baselines` for the forecasts ``src``; ``others`` are fitted models with the rows of ``like``."""
    names = ", ".join(f"'{m}'" for m in others)
    return f""",
rp AS (SELECT CASE WHEN GROUPING(station) = 0 THEN 'station' WHEN GROUPING(band) = 0 THEN 'band' ELSE 'overall' END AS scope, coalesce(station, band, 'all') AS grp,
    model, count(*) AS rows, sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae, avg(e) AS bias
  FROM (SELECT model, station, {BAND_SQL} AS band, prediction - y_true AS e FROM {src}) q
  GROUP BY GROUPING SETS ((model), (model, station), (model, band)))
SELECT scope, grp, model, rows, round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(bias, 6) AS bias FROM rp
UNION ALL SELECT scope, grp, o.model, rows, NULL, NULL, NULL FROM rp, (SELECT unnest([{names}]::VARCHAR[]) AS model) o WHERE rp.model = '{like}'"""


def experiment(name: str, others: tuple[str, ...], sql: str, models=MODELS):
    """Register ``name`` (the whole report) and ``name_rows`` (what SQL can check of it) for a function that gives long forecasts."""
    def deco(fn):
        def of(spark, sf_dir) -> DataFrame:
            return once(spark, ("experiment", name, sf_dir), lambda: cut_lineage(report(fn(spark, sf_dir))))

        def whole(spark, sf_dir):
            return normalise(of(spark, sf_dir))

        def checked(spark, sf_dir):
            return normalise(only_baselines(of(spark, sf_dir), models))

        whole.__doc__, checked.__doc__ = fn.__doc__, f"{name}: rows of all models, metrics of those without a fit."
        query(name)(whole)
        query(f"{name}_rows", sql)(checked)
        return fn

    return deco


# --------------------------------------------------------------------------- X1, X2

@experiment("baseline_experiment", ("ridge_alpha10", "random_forest"), P + _report_sql("preds", ("ridge_alpha10", "random_forest")))
def x1(spark, sf_dir):
    """Persistence, rolling means, Ridge and random forest, over all, per station and band."""
    a = assembled(spark, sf_dir)
    forest = a.predict(R.random_forest(**SMALL_FOREST).fit(a.train), "valid", "random_forest")
    return union_frames([preds_of(spark, sf_dir), ridges(spark, sf_dir).where("model = 'ridge_alpha10'"), forest])


def ridges(spark, sf_dir) -> DataFrame:
    return once(spark, ("ridges", sf_dir), lambda: cut_lineage(assembled(spark, sf_dir).ridges("valid")))


def strongest(long: DataFrame, most: int = 4, without: tuple[str, ...] = ("rolling_mean_3h",)) -> list[str]:
    """The candidates of the grid blend: the best by rmse, ties by name."""
    scored = MT.rmse_mae(long.where(~F.col("model").isin(list(without))))
    return [r["model"] for r in scored.orderBy(F.asc_nulls_last("rmse"), "model").limit(most).select("model").collect()]


def weighted_ensemble(long: DataFrame, name: str = "weighted_ensemble") -> tuple[DataFrame, dict]:
    """E4 over the four strongest models (286 weight vectors); one candidate alone is taken as it is."""
    names = strongest(long)
    wide = E.wide(long.where(F.col("model").isin(names)), names, KEYS)
    weights = E.grid_blend(wide, names)[0] if len(names) > 1 else {names[0]: 1.0}
    return E.weighted_prediction(wide, weights, name, KEYS), weights


_X2 = ("ridge_alpha10", "gradient_boosting_raw", "weighted_ensemble")


def boosting_forecasts(spark, sf_dir) -> DataFrame:
    def make():
        long = union_frames([preds_of(spark, sf_dir), ridges(spark, sf_dir).where("model = 'ridge_alpha10'"),
                             boosted(spark, sf_dir)[0].where("model = 'gradient_boosting_raw'")])
        return cut_lineage(long.unionByName(weighted_ensemble(long)[0]))

    return once(spark, ("boosting_forecasts", sf_dir), make)


@experiment("boosting_experiment", _X2, P + _report_sql("preds", _X2))
def x2(spark, sf_dir):
    """Baselines, Ridge, early-stopped boosted trees and their grid blend, over all, per station and band."""
    return boosting_forecasts(spark, sf_dir)


# --------------------------------------------------------------------------- X4

_X4 = ("ridge_alpha10", "ridge_weighted_1_4", "ridge_weighted_2_8", "ridge_log1p", "ridge_boxcox",
       "gradient_boosting_raw", "gradient_boosting_log1p", "gradient_boosting_boxcox", "gradient_boosting_weighted")


@experiment("severe_experiment", _X4, P + _report_sql("preds", _X4))
def x4(spark, sf_dir):
    """Ridge and boosted trees on raw, log, Box-Cox and severe-weighted targets, per band."""
    return union_frames([preds_of(spark, sf_dir), ridges(spark, sf_dir), boosted(spark, sf_dir)[0]])


def _k7_sql() -> str:
    """The reference and the additive corrections, fitted on the early half and scored on the late one."""
    return P + LATE_SQL + """,
base AS (SELECT y_true, prediction AS b, target_time <= (SELECT split_time FROM st) AS early FROM preds WHERE model = 'persistence'),
grid AS (SELECT t.t AS t, o.i * 2.0 AS o, s.i * 0.025 AS s, t.ti, o.i AS oi, s.i AS si
         FROM (SELECT unnest([60.0, 75.0, 90.0, 100.0, 115.0, 130.0, 150.0]) AS t, unnest([0, 1, 2, 3, 4, 5, 6]) AS ti) t, range(15) o(i), range(15) s(i)),
ev AS (SELECT g.*, greatest(b + o * CAST(b >= t AS DOUBLE) + s * greatest(b - t, 0.0), 0.0) - y_true AS e, y_true FROM grid g, base WHERE early),
sc AS (SELECT t, o, s, ti, oi, si, sqrt(avg(e * e)) AS r, sqrt(avg(e * e) FILTER (WHERE y_true > 150)) AS sr, avg(e) FILTER (WHERE y_true > 150) AS sb FROM ev GROUP BY ALL),
obj AS (SELECT 'overall_rmse' AS objective, *, r AS score FROM sc UNION ALL SELECT 'severe_rmse', *, sr FROM sc UNION ALL SELECT 'balanced', *, r + 0.2 * abs(sb) FROM sc),
best AS (SELECT *, row_number() OVER (PARTITION BY objective ORDER BY round(score, 9), ti, oi, si) AS rn FROM obj WHERE score IS NOT NULL AND isfinite(score)),
pr AS (SELECT 'reference_persistence' AS model, greatest(b, 0.0) AS p, y_true FROM base WHERE NOT early
  UNION ALL SELECT 'additive_threshold_' || objective, greatest(b + o * CAST(b >= t AS DOUBLE) + s * greatest(b - t, 0.0), 0.0), y_true FROM best, base WHERE rn = 1 AND NOT early)
SELECT model, count(*) AS rows, round(sqrt(avg((p - y_true) * (p - y_true))), 6) AS rmse, round(avg(abs(p - y_true)), 6) AS mae FROM pr GROUP BY model
UNION ALL SELECT m.model, count(*), NULL, NULL FROM base, (SELECT unnest(['residual_ridge_severe_weighted', 'target_ridge_severe_weighted']) AS model) m
  WHERE NOT early GROUP BY m.model"""


@query("calibration_rows", _k7_sql())
def q_k7_rows(spark, sf_dir):
    """K7: the reference and the three additive corrections on the late half; rows of the two Ridge corrections."""
    out = MT.rmse_mae(late_rows(calibration(spark, sf_dir), spark, sf_dir))
    plain = ~F.col("model").endswith("_severe_weighted")
    return normalise(out.select("model", "rows", *[F.when(plain, F.col(c)).alias(c) for c in ("rmse", "mae")]))


@query("calibration_full_length", P + """,
b AS (SELECT station, count(*) AS rows, round(sum(prediction), 3) AS total FROM preds WHERE model = 'persistence' GROUP BY station)
SELECT station, rows, total, true AS complete FROM b""")
def q_k7_full(spark, sf_dir):
    """K7: corrected forecasts over all validation rows: as many for each correction, none missing or negative."""
    pr = calibration(spark, sf_dir)
    n = pr.groupBy("station", "model").agg(F.count("prediction").alias("n"), F.min("prediction").alias("least"), F.sum("prediction").alias("s"))
    ref = F.col("model") == "reference_persistence"
    return normalise(n.groupBy("station").agg(
        F.max(F.when(ref, F.col("n"))).alias("rows"), F.round(F.max(F.when(ref, F.col("s"))), 3).alias("total"),
        ((F.min("n") == F.max("n")) & (F.min("least") >= 0)).alias("complete")))


# --------------------------------------------------------------------------- E4, E7 forms

_FIXED = {
    "blend_70_30": {"persistence": 0.7, "rolling_mean_3h": 0.3},
    "optimized_blend": {"persistence": 0.50, "rolling_mean_3h": 0.20, "rolling_mean_6h": 0.15, "rolling_mean_12h": 0.15},
    "validation_weights": {"persistence": 0.5, "rolling_mean_3h": 0.3, "not_there": 0.2},
}


def available(weights: dict, models) -> dict:
    """The weights of the models there are, to sum 1."""
    there = {m: w for m, w in weights.items() if m in models}
    total = sum(there.values())
    if total <= 0:
        raise ValueError("none of the blend's models is there")
    return {m: w / total for m, w in there.items()}


def _blends_sql() -> str:
    names = [m for m in MODELS if m != "rolling_mean_3h"]
    units = ", ".join(f"range(11) t{i}(u{i})" for i in range(4))
    pred = " + ".join(f"g.w{i} * v.{m}" for i, m in enumerate(names))
    fixed = " UNION ALL ".join(
        f"SELECT '{name}', {' + '.join(f'{w!r} * {m}' for m, w in available(ws, MODELS).items())}, y_true FROM v" for name, ws in _FIXED.items())
    return P + f""",
v AS ({_wide_sql()}),
g AS (SELECT {', '.join(f'u{i} / 10.0 AS w{i}' for i in range(4))} FROM {units} WHERE u0 + u1 + u2 + u3 = 10),
s AS (SELECT {', '.join(f'w{i}' for i in range(4))}, sum(({pred} - v.y_true) * ({pred} - v.y_true)) AS sse FROM g, v GROUP BY ALL),
b AS (SELECT * FROM s ORDER BY sse LIMIT 1),
pr AS (SELECT 'weighted_ensemble' AS model, {pred.replace('g.w', 'b.w')} AS p, v.y_true FROM v, b UNION ALL {fixed})
SELECT model, count(*) AS rows, round(sqrt(avg((p - y_true) * (p - y_true))), 6) AS rmse, round(avg(abs(p - y_true)), 6) AS mae FROM pr GROUP BY model"""


@query("blend_forms", _blends_sql())
def q_blend_forms(spark, sf_dir):
    """E4 over the four strongest without the 3 h mean; E7 as 70/30, as .50/.20/.15/.15 and renormalised where a model is missing."""
    long = preds_of(spark, sf_dir)
    wide = E.wide(long, MODELS, KEYS)
    parts = [weighted_ensemble(long)[0]]
    parts += [E.weighted_prediction(wide, available(w, MODELS), name, KEYS) for name, w in _FIXED.items()]
    return normalise(MT.rmse_mae(union_frames(parts)))


# --------------------------------------------------------------------------- W11

#: Named folds of the queries; the last one has no rows and is skipped.
FOLDS = {
    "fold_1": (_dt.datetime(2024, 1, 9), _dt.datetime(2024, 1, 13, 23)), "fold_2": (_dt.datetime(2024, 1, 14), _dt.datetime(2024, 1, 18, 23)),
    "fold_3": (_dt.datetime(2024, 1, 19), _dt.datetime(2024, 1, 23, 23)), "fold_4": (_dt.datetime(2024, 1, 24), _dt.datetime(2024, 2, 29, 23)),
    "fold_5": (_dt.datetime(2030, 1, 1), _dt.datetime(2030, 2, 1)),
}
#: What the focused model of the folds takes, by first word, and its calendar columns.
FOCUSED = ("pm25", "pm10", "no2")
FOCUSED_CALENDAR = ("hour", "month", "sin_hour", "cos_hour", "sin_month", "cos_month", "is_weekend")


def focused(numeric: list[str], most: int = 180) -> list[str]:
    """At most ``most`` columns of the target, its close companions and the calendar, in order."""
    return [c for c in numeric if c.split("_")[0] in FOCUSED or c in FOCUSED_CALENDAR][:most]


def _folds_sql() -> str:
    values = ", ".join(f"('{n}', TIMESTAMP '{a}', TIMESTAMP '{b}')" for n, (a, b) in FOLDS.items())
    return O.prelude() + O.windows() + f""",
f(fold, a, b) AS (VALUES {values}),
r AS (SELECT fold, count(*) FILTER (WHERE target_time < a) AS train_rows, count(*) FILTER (WHERE target_time BETWEEN a AND b) AS valid_rows,
  sqrt(avg((pm25 - y_true) * (pm25 - y_true)) FILTER (WHERE target_time BETWEEN a AND b)) AS rmse FROM f, win GROUP BY fold)
SELECT fold, train_rows, valid_rows, round(rmse, 6) AS persistence_rmse FROM r WHERE train_rows > 0 AND valid_rows > 0"""


def named_folds(spark, sf_dir) -> DataFrame:
    """Fold, role and the compact frame's rows."""
    def make():
        _, tr, va, num, cat = _frames(spark, sf_dir)
        cols = list(dict.fromkeys([*KEYS, *cat, *focused(num), "pm25_latest"]))
        return cut_lineage(rolling_origin_folds(tr.unionByName(va).select(*cols), "target_time", FOLDS))

    return once(spark, ("named_folds", sf_dir), make)


@query("rolling_origin_sizes", _folds_sql())
def q_w11_sizes(spark, sf_dir):
    """Sizes of the named folds and persistence on them; folds without rows are skipped."""
    train, valid = (F.col("role") == r for r in ("train", "valid"))
    e = F.when(valid, F.col("pm25_latest") - F.col("y_true"))
    out = named_folds(spark, sf_dir).groupBy("fold").agg(F.count_if(train).alias("train_rows"), F.count_if(valid).alias("valid_rows"),
                                                        F.sqrt(F.avg(e * e)).alias("persistence_rmse"))
    return normalise(out.where("train_rows > 0 and valid_rows > 0"))


@query("rolling_origin_named")
def q_w11_named(spark, sf_dir):
    """Ridge on the focused columns, fitted per named fold (scaler and encoder too), rmse and mae per fold."""
    rows = named_folds(spark, sf_dir)
    _, tr, _, num, cat = _frames(spark, sf_dir)
    sizes = {(r["fold"], r["role"]) for r in rows.groupBy("fold", "role").count().collect()}
    parts = []
    for fold in FOLDS:
        if {(fold, "train"), (fold, "valid")} <= sizes:
            a, b = (rows.where((F.col("fold") == fold) & (F.col("role") == r)).drop("fold", "role") for r in ("train", "valid"))
            parts.append(R.fit_predict(R.ridge(a), a, b, focused(num), cat, name=fold)[0])
    return normalise(MT.rmse_mae(union_frames(parts)).withColumnRenamed("model", "fold"))


# --------------------------------------------------------------------------- X5

def rich(spark, sf_dir) -> DataFrame:
    return once(spark, ("rich", sf_dir), lambda: cut_lineage(rich_frame(prepare(spark, sf_dir).windows).drop("w")))


_X5 = ("ridge_rich", "gradient_boosting_rich", "weighted_ensemble", "weighted_ensemble_calibrated")


@experiment("objective_experiment", _X5, P + _report_sql("preds", _X5))
def x5(spark, sf_dir):
    """Ridge and boosted trees on the rich frame (F12, P11, P12), their grid blend with the baselines (E4) and its
    fixed-slope calibration (K3)."""
    p = prepare(spark, sf_dir)
    feats = rich(spark, sf_dir)
    tr, va = split_by_time(feats, p.cutoff)
    a = R.Assembled(tr, {"valid": va}, *R.feature_columns(feats))
    fits = [("ridge_rich", R.ridge(a.train)), ("gradient_boosting_rich", R.gradient_boosting(**SMALL_BOOST))]
    long = cut_lineage(union_frames([preds_of(spark, sf_dir), *[a.predict(est.fit(a.train), "valid", name) for name, est in fits]]))
    blend, _ = weighted_ensemble(long)
    return union_frames([long, blend, blend.select(*KEYS, F.lit("weighted_ensemble_calibrated").alias("model"), K.fixed_slope_calibration("prediction").alias("prediction"))])


# --------------------------------------------------------------------------- X6: supplied windows

def supplied_windows(spark, sf_dir) -> DataFrame:
    """The supplied windows after M8, folded to arrays again, with their ids, window ends and wind code."""
    def make():
        p = prepare(spark, sf_dir)
        sup = _supplied(p).select("id", "station", make_hour_ts("year_lag_1", "month_lag_1", "day_lag_1", "hour_lag_1").alias("window_end"))
        w = refold(_m8_long(p))
        return cut_lineage(sup.join(w, "id").withColumn("wd_lag_1", F.col("w")[p.spec.window - 1]["wd"]))

    return once(spark, ("supplied_windows", sf_dir), make)


@query("supplied_frame", _M8_SQL + """,
f AS (SELECT id, max(pm25) FILTER (WHERE lag = 1) AS l1, max(pm25) FILTER (WHERE lag = 24) AS l24, max(wd) FILTER (WHERE lag = 1) AS wd_lag_1,
  avg(pm25) FILTER (WHERE lag <= 3) AS m3, avg(pm25) AS m24, stddev_samp(pm25) AS s24, max(pm25) AS x24, max(pm10) FILTER (WHERE lag = 1) AS p1,
  max(temp) FILTER (WHERE lag = 1) - max(dewp) FILTER (WHERE lag = 1) AS spread FROM m8 GROUP BY id)
SELECT f.id, wd_lag_1, CAST(hour_lag_1 AS BIGINT) AS hour, round(l1, 6) AS pm25_latest, round(m3, 6) AS pm25_mean_3h, round(m24, 6) AS pm25_mean_24h,
  round(s24, 6) AS pm25_std_24h, round(x24, 6) AS pm25_max_24h, round(l1 - l24, 6) AS pm25_trend_24h, round(l1 / (abs(p1) + 1), 6) AS pm25_pm10_ratio_lag1,
  round(spread, 6) AS temp_dewp_spread_lag1 FROM f JOIN sup USING (id)""")
def q_f12_supplied(spark, sf_dir):
    """F12 on supplied windows (M8 imputed): columns of the compact frame."""
    f = compact_frame(supplied_windows(spark, sf_dir))
    return normalise(f.select("id", "wd_lag_1", "hour", "pm25_latest", "pm25_mean_3h", "pm25_mean_24h", "pm25_std_24h", "pm25_max_24h", "pm25_trend_24h",
                              "pm25_pm10_ratio_lag1", "temp_dewp_spread_lag1"))


_X6 = ("ridge_alpha10", "gradient_boosting_raw", "simple_average_tree", "ridge_stack_nonneg")
_X6_SQL = _M8_SQL + """,
al AS (SELECT s.id, s.station, p.pm25 AS y_true FROM sup s JOIN panel p ON p.station = s.station AND p.datetime = s._end + INTERVAL 1 HOUR),
pr AS (SELECT 'persistence' AS model, station, y_true, max(pm25) FILTER (WHERE lag = 1) AS prediction FROM m8 JOIN al USING (id) GROUP BY id, station, y_true
  UNION ALL SELECT 'rolling_mean_3h', station, y_true, avg(pm25) FILTER (WHERE lag <= 3) FROM m8 JOIN al USING (id) GROUP BY id, station, y_true)""" + _report_sql("pr", _X6)


@experiment("diagnostic_audit", _X6, _X6_SQL, ("persistence", "rolling_mean_3h"))
def x6(spark, sf_dir):
    """Models of the training windows on the supplied windows, against the truth joined by key (J1): baselines,
    Ridge, boosted trees, their average (E6) and the non-negative stack (E5, fitted on the validation forecasts)."""
    p, tr, va, num, cat = _frames(spark, sf_dir)
    truth = _aligned(p).where(F.col("y_true").isNotNull()).select("id", "target_time", "y_true")
    sup = compact_frame(supplied_windows(spark, sf_dir)).drop("w").join(truth, "id")
    columns = list(dict.fromkeys([*KEYS, *num, *cat]))
    _, train, (valid, test) = matrix_fill(tr.select(columns), [va.select(columns), sup.select(columns)], num, cat)  # M9
    a = R.Assembled(train, {"valid": valid, "test": test}, num, cat)
    names = {"ridge_alpha10": R.ridge(a.train), "gradient_boosting_raw": R.gradient_boosting(**SMALL_BOOST)}
    fitted = {n: est.fit(a.train) for n, est in names.items()}
    plain = lambda df: MT.predictions_long(df, {"persistence": F.col("pm25_latest"), "rolling_mean_3h": F.col("pm25_mean_3h")})
    valid_long = union_frames([plain(valid), *[a.predict(m, "valid", n) for n, m in fitted.items()]])
    test_long = cut_lineage(union_frames([plain(test), *[a.predict(m, "test", n) for n, m in fitted.items()]]))
    stack_of = ["persistence", "rolling_mean_3h", *fitted]
    weights, intercept = E.ridge_stack_nonneg(cut_lineage(E.wide(valid_long, stack_of, KEYS)), stack_of)
    stack = E.weighted_prediction(E.wide(test_long, stack_of, KEYS), weights, "ridge_stack_nonneg", KEYS, intercept)
    return union_frames([test_long, E.mean_of(test_long, list(fitted), "simple_average_tree", KEYS),
                         stack.withColumn("prediction", clip_nonneg("prediction"))])


# --------------------------------------------------------------------------- X7

FRACTIONS = (0.75, 0.8, 0.85)


def _context_frame(spark, sf_dir, fraction: float) -> DataFrame:
    return once(spark, ("context_frame", sf_dir, fraction), lambda: cut_lineage(
        compact_frame(city_context(prepare(spark, sf_dir, fraction).windows)).drop("w")))


@query("final_candidates")
def q_x7(spark, sf_dir):
    """The validation reference, Ridge and boosted trees with city context at three cutoffs: rows, rmse and mae."""
    out = []
    for f in FRACTIONS:
        tr, va = split_by_time(_context_frame(spark, sf_dir, f), prepare(spark, sf_dir, f).cutoff)
        num, cat = R.feature_columns(tr)
        a = R.Assembled(tr, {"valid": va}, num, cat)
        fits = [("city_context_ridge", R.ridge(a.train)), ("city_context_boosting", R.gradient_boosting(**SMALL_BOOST))]
        long = cut_lineage(union_frames([va.select(*KEYS, F.lit("persistence").alias("model"), F.col("pm25_latest").alias("prediction")),
                                         *[a.predict(est.fit(a.train), "valid", n) for n, est in fits]]))
        blend = E.weighted_prediction(E.wide(long, [n for n, _ in fits], KEYS), {fits[0][0]: 0.7, fits[1][0]: 0.3}, "blend_70_30", KEYS)
        out.append(MT.rmse_mae(long.unionByName(blend)).select(F.lit(f).alias("fraction"), "*"))
    return normalise(reduce(lambda a, b: a.unionByName(b), out))


def _x7_sql() -> str:
    parts = []
    for f in FRACTIONS:
        rows = O.prelude(f) + O.windows() + f"""
SELECT {f}::DOUBLE AS fraction, count(*) FILTER (WHERE window_end <= (SELECT cutoff FROM cut)) AS train_rows, count(*) FILTER (WHERE window_end > (SELECT cutoff FROM cut)) AS valid_rows,
  round(sqrt(avg((pm25 - y_true) * (pm25 - y_true)) FILTER (WHERE window_end > (SELECT cutoff FROM cut))), 6) AS rmse FROM win"""
        parts.append(f"SELECT * FROM ({rows}) q{int(f * 100)}")
    return " UNION ALL ".join(parts)


@query("final_candidates_rows", _x7_sql())
def q_x7_rows(spark, sf_dir):
    """Window counts of the three cutoffs and the persistence reference on each."""
    out = []
    for f in FRACTIONS:
        train = F.col("window_end") <= ts_lit(prepare(spark, sf_dir, f).cutoff)
        e = F.when(~train, F.col("pm25_latest") - F.col("y_true"))
        out.append(_context_frame(spark, sf_dir, f).agg(F.lit(f).alias("fraction"), F.count_if(train).alias("train_rows"), F.count_if(~train).alias("valid_rows"),
                                                        F.sqrt(F.avg(e * e)).alias("rmse")))
    return normalise(reduce(lambda a, b: a.unionByName(b), out))


@query("final_submissions")
def q_x7_submissions(spark, sf_dir):
    """Models of the whole history with city context, applied to the supplied windows: A13 of each candidate and their 50/25/25 blend."""
    p = prepare(spark, sf_dir)
    feats = _context_frame(spark, sf_dir, 0.8)
    sup = compact_frame(city_context(supplied_windows(spark, sf_dir))).drop("w")
    num, cat = R.feature_columns(feats)
    _, train, (test,) = matrix_fill(feats.select(list(dict.fromkeys([*KEYS, *num, *cat]))), [sup.select("id", *num, *cat)], num, cat)
    train = train.where(F.col("window_end") <= ts_lit(p.cutoff))  # the supplied windows come after it
    a = R.Assembled(train.withColumn("id", F.lit("")), {"test": test}, num, cat, keys=["id"], extra=["y_true"])
    fits = {"city_context_ridge": R.ridge(a.train), "city_context_boosting": R.gradient_boosting(**SMALL_BOOST),
            "city_context_forest": R.random_forest(**SMALL_FOREST)}
    long = cut_lineage(union_frames([a.predict(est.fit(a.train), "test", n) for n, est in fits.items()]))
    blend = E.weighted_prediction(E.wide(long, list(fits), ["id"]), dict(zip(fits, (0.5, 0.25, 0.25))), "blend_50_25_25", ["id"])
    return normalise(MT.prediction_summary(long.unionByName(blend)))
