"""Metric, report, join, ensemble and calibration queries over the baseline
prediction table (persistence + rolling means on the validation windows)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from hourcast.functions.scalar import band, clip_nonneg, severe_weights
from hourcast.operators import calibrate as K
from hourcast.operators import ensemble as E
from hourcast.operators import metrics as MT
from hourcast.operators.features import Win, with_arrays
from hourcast.operators.joins import PRED_KEYS, merge_predictions, union_frames
from hourcast.operators.splits import late_split_time, ts_lit
from hourcast.plans.pipeline import once, panel_of, prepare
from hourcast.plans.queries_core import ALL, _baseline_sql_preds, baseline_models
from hourcast.plans import oracle as O
from hourcast.plans.registry import normalise, query
from hourcast.session import cut_lineage
from hourcast.spec import MEASURES

MODELS = ("persistence", "rolling_mean_3h", "rolling_mean_6h", "rolling_mean_12h", "rolling_mean_24h")
KEYS = ", ".join(PRED_KEYS)
P = _baseline_sql_preds()


def preds_of(spark, sf_dir):
    """Baseline forecasts of the validation windows, written once a session: every report reads them."""
    return once(spark, ("preds", sf_dir), lambda: cut_lineage(
        MT.predictions_long(with_arrays(prepare(spark, sf_dir).valid_windows, ["pm25"]), baseline_models(Win()))))


def _wide_sql(src: str = "preds") -> str:
    cols = ", ".join(f"max(prediction) FILTER (WHERE model = '{m}') AS {m}" for m in MODELS)
    return f"SELECT {KEYS}, {cols} FROM {src} GROUP BY {KEYS}"


LATE_SQL = """,
tt AS (SELECT target_time, row_number() OVER (ORDER BY target_time) AS i, count(*) OVER () AS n
       FROM (SELECT DISTINCT target_time FROM preds) d),
st AS (SELECT target_time AS split_time FROM tt
       WHERE i = greatest(1, least(n - 1, CAST(floor(n * CAST(0.5 AS DOUBLE)) AS BIGINT))))"""


def _metric_cols(e: str = "e") -> str:
    return (f"count(*) AS rows, round(sqrt(avg({e} * {e})), 6) AS rmse, round(avg(abs({e})), 6) AS mae")


# --------------------------------------------------------------------------- A metrics

_SEV = """SELECT model, count(*) AS rows, round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e)), 6) AS mae,
  round(sqrt(avg(e * e) FILTER (WHERE y_true > 150)), 6) AS severe_rmse,
  round(avg(abs(e)) FILTER (WHERE y_true > 150), 6) AS severe_mae,
  round(avg(e) FILTER (WHERE y_true > 150), 6) AS severe_bias{extra}
FROM (SELECT *, greatest(prediction, 0.0) - y_true AS e FROM preds) q GROUP BY model"""


@query("severe_scores", P + _SEV.format(extra=""))
def q_a2(spark, sf_dir):
    """A2: clipped rmse / mae and severe-band (y > 150) rmse, mae, bias per model."""
    return normalise(MT.severe_score(preds_of(spark, sf_dir)))


@query("diagnostic_scores", P + _SEV.format(extra=", round(avg(e), 6) AS bias"))
def q_a3(spark, sf_dir):
    """A3: A2 plus the overall bias."""
    return normalise(MT.severe_score(preds_of(spark, sf_dir), with_bias=True))


@query("station_metrics", P + """SELECT model, station, count(*) AS rows,
  round(sqrt(avg((prediction - y_true) * (prediction - y_true))), 6) AS rmse,
  round(avg(abs(prediction - y_true)), 6) AS mae, round(avg(prediction - y_true), 6) AS bias
FROM preds GROUP BY model, station""")
def q_a6(spark, sf_dir):
    """Per (model, station) rows, rmse, mae, bias."""
    return normalise(MT.station_metrics(preds_of(spark, sf_dir)))


@query("band_metrics", P + """SELECT model, CASE WHEN y_true <= 35 THEN 'low_<=35' WHEN y_true <= 75 THEN 'moderate_35_75'
  WHEN y_true <= 150 THEN 'high_75_150' ELSE 'severe_>150' END AS pm25_band, count(*) AS rows,
  round(sqrt(avg((prediction - y_true) * (prediction - y_true))), 6) AS rmse,
  round(avg(abs(prediction - y_true)), 6) AS mae, round(avg(prediction - y_true), 6) AS bias
FROM preds GROUP BY 1, 2""")
def q_a7(spark, sf_dir):
    """Per (model, right-closed band of y) rows, rmse, mae, bias."""
    return normalise(MT.band_metrics(preds_of(spark, sf_dir)))


@query("residual_summary", P + """SELECT model, round(avg(r), 6) AS bias_mean, round(stddev_samp(r), 6) AS residual_std,
  round(avg(CAST(r < 0 AS DOUBLE)), 6) AS underprediction_rate, round(quantile_cont(r, 0.05), 6) AS p05,
  round(quantile_cont(r, 0.5), 6) AS p50, round(quantile_cont(r, 0.95), 6) AS p95
FROM (SELECT model, prediction - y_true AS r FROM preds) q GROUP BY model""")
def q_a8(spark, sf_dir):
    """Residual mean, sample std, exact p05/p50/p95, under-prediction rate."""
    return normalise(MT.residual_summary(preds_of(spark, sf_dir)))


@query("individual_model_metrics", P + """,
m AS (SELECT model, count(*) AS rows, sqrt(avg((prediction - y_true) * (prediction - y_true))) AS rmse,
             avg(abs(prediction - y_true)) AS mae FROM preds GROUP BY model)
SELECT model, rows, round(rmse, 6) AS rmse, round(mae, 6) AS mae,
       row_number() OVER (ORDER BY rmse, model) AS rank FROM m""")
def q_a9(spark, sf_dir):
    """A9 + A15: per-model rmse / mae / rows ranked by rmse (ties by name)."""
    return normalise(MT.rank_models(MT.rmse_mae(preds_of(spark, sf_dir))))


@query("top_models", P + """,
m AS (SELECT model, sqrt(avg((prediction - y_true) * (prediction - y_true))) AS rmse FROM preds GROUP BY model)
SELECT model, round(rmse, 6) AS rmse FROM m ORDER BY rmse, model LIMIT 3""")
def q_a15(spark, sf_dir):
    """Top-3 models by rmse (a top-k report)."""
    ranked = MT.rank_models(MT.rmse_mae(preds_of(spark, sf_dir)), k=3)
    return normalise(ranked.select("model", "rmse"))


@query("prediction_summary", P + """SELECT model, count(*) AS rows, round(avg(prediction), 6) AS mean,
  round(stddev_pop(prediction), 6) AS std, round(min(prediction), 6) AS min, round(max(prediction), 6) AS max
FROM preds GROUP BY model""")
def q_a13(spark, sf_dir):
    """Per-model prediction rows, mean, population std, min, max."""
    return normalise(MT.prediction_summary(preds_of(spark, sf_dir)))


_EDA = O.prelude() + """,
e AS (SELECT CAST(count(*) AS DOUBLE) AS rows, CAST(count(DISTINCT station) AS DOUBLE) AS stations,
             CAST(min(year(datetime)) AS DOUBLE) AS year_min, CAST(max(year(datetime)) AS DOUBLE) AS year_max,
             CAST(count(*) FILTER (WHERE pm25 IS NULL) AS DOUBLE) AS pm25_missing, avg(pm25) AS pm25_mean,
             quantile_cont(pm25, 0.5) AS pm25_median, stddev_samp(pm25) AS pm25_std FROM panel)
SELECT metric, round(value, 6) AS value FROM (
  SELECT 'rows' AS metric, rows AS value FROM e UNION ALL SELECT 'columns', 14.0 FROM e
  UNION ALL SELECT 'stations', stations FROM e UNION ALL SELECT 'year_min', year_min FROM e
  UNION ALL SELECT 'year_max', year_max FROM e UNION ALL SELECT 'pm25_missing', pm25_missing FROM e
  UNION ALL SELECT 'pm25_mean', pm25_mean FROM e UNION ALL SELECT 'pm25_median', pm25_median FROM e
  UNION ALL SELECT 'pm25_std', pm25_std FROM e) t"""


@query("eda_summary", _EDA)
def q_a10(spark, sf_dir):
    """A10: tall (metric, value) summary of the raw panel."""
    return normalise(MT.eda_summary(panel_of(spark, sf_dir)))


@query("missing_values", O.prelude() + """,
c AS (SELECT count(*) AS n, """ + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in ("station", "datetime", *MEASURES, "wd")) + """ FROM panel)
SELECT column_name AS "column", missing_count, round(missing_count / n, 6) AS missing_fraction FROM (
  """ + " UNION ALL ".join(f"SELECT '{c}' AS column_name, {c} AS missing_count, n FROM c" for c in ("station", "datetime", *MEASURES, "wd")) + ") t")
def q_a11(spark, sf_dir):
    """Per-column NULL count and fraction of the raw panel."""
    return normalise(MT.missing_values(panel_of(spark, sf_dir)))


@query("split_summary", P + """SELECT (SELECT count(*) FROM panel) AS raw_rows, (SELECT count(*) FROM win) AS window_rows,
  (SELECT count(*) FROM win WHERE window_end <= (SELECT cutoff FROM cut)) AS train_windows,
  (SELECT count(*) FROM win WHERE window_end > (SELECT cutoff FROM cut)) AS valid_windows,
  (SELECT cutoff FROM cut) AS cutoff""")
def q_a12(spark, sf_dir):
    """Raw / window / train / validation counts and the cutoff."""
    p = prepare(spark, sf_dir)
    w = p.windows
    cnt = w.agg(F.count(F.lit(1)).alias("window_rows"),
                F.count_if(F.col("window_end") <= ts_lit(p.cutoff)).alias("train_windows"),
                F.count_if(F.col("window_end") > ts_lit(p.cutoff)).alias("valid_windows")).first()
    n = p.panel.count()
    return normalise(spark.createDataFrame(
        [(n, cnt["window_rows"], cnt["train_windows"], cnt["valid_windows"], p.cutoff)],
        "raw_rows long, window_rows long, train_windows long, valid_windows long, cutoff timestamp_ntz"))


# --------------------------------------------------------------------------- P13-P16 scalar transforms

@query("prediction_transforms", P + """SELECT station, window_end, model, round(greatest(prediction, 0.0), 6) AS clipped,
  CASE WHEN y_true <= 35 THEN 'low_<=35' WHEN y_true <= 75 THEN 'moderate_35_75' WHEN y_true <= 150 THEN 'high_75_150'
       ELSE 'severe_>150' END AS pm25_band,
  round(1.0 + 1.0 * CAST(y_true >= 75 AS DOUBLE) + 4.0 * CAST(y_true >= 150 AS DOUBLE), 6) AS weight,
  round(ln(1 + y_true), 6) AS log_y, round(exp(ln(1 + greatest(prediction, 0.0))) - 1, 6) AS roundtrip
FROM preds""")
def q_p13(spark, sf_dir):
    """P13 clip, P14 bands, P15 severe weights (1, 4), P16 log1p / expm1."""
    pr = preds_of(spark, sf_dir)
    c = clip_nonneg("prediction")
    return normalise(pr.select("station", "window_end", "model", c.alias("clipped"), band("y_true").alias("pm25_band"),
                               severe_weights("y_true", 1.0, 4.0).alias("weight"), F.log1p("y_true").alias("log_y"),
                               F.expm1(F.log1p(c)).alias("roundtrip")))


# --------------------------------------------------------------------------- J joins / set ops

@query("merge_predictions", P + "SELECT " + KEYS.replace("y_true", "round(y_true, 6) AS y_true")
       + ", model, round(prediction, 6) AS prediction FROM preds WHERE station <> 'S03' AND hour(window_end) <> 7")
def q_j2(spark, sf_dir):
    """Two prediction sources merged on the 4 keys (one-to-one enforced,
    duplicate model names rejected, only keys present in every source)."""
    pr = preds_of(spark, sf_dir)
    # each side misses keys that the other has
    a = pr.where((F.col("model") == "persistence") & (F.col("station") != "S03"))
    b = pr.where((F.col("model") != "persistence") & (F.hour("window_end") != 7))
    return normalise(merge_predictions({"baseline": a, "rolling": b}))


@query("union_frames", P + """SELECT model, NULL AS pm25_band, count(*) AS rows,
  round(sqrt(avg((prediction - y_true) * (prediction - y_true))), 6) AS rmse FROM preds GROUP BY model
UNION ALL BY NAME
SELECT model, CASE WHEN y_true <= 35 THEN 'low_<=35' WHEN y_true <= 75 THEN 'moderate_35_75'
  WHEN y_true <= 150 THEN 'high_75_150' ELSE 'severe_>150' END AS pm25_band, count(*) AS rows,
  round(sqrt(avg((prediction - y_true) * (prediction - y_true))), 6) AS rmse FROM preds GROUP BY 1, 2""")
def q_j6(spark, sf_dir):
    """Union by name of result tables with different columns."""
    pr = preds_of(spark, sf_dir)
    a = MT.rmse_mae(pr).select("model", "rows", "rmse")
    b = MT.band_metrics(pr).select("model", "pm25_band", "rows", "rmse")
    return normalise(union_frames([a, b]).select("model", "pm25_band", "rows", "rmse"))


# --------------------------------------------------------------------------- E ensembles

def _ensembles_sql() -> str:
    wide = _wide_sql()
    rank = """,
m AS (SELECT model, sqrt(avg((prediction - y_true) * (prediction - y_true))) AS rmse FROM preds GROUP BY model),
r AS (SELECT model, rmse, row_number() OVER (ORDER BY rmse, model) AS rk FROM m),
iw AS (SELECT model, (1.0 / greatest(rmse, 1e-9)) / sum(1.0 / greatest(rmse, 1e-9)) OVER () AS w FROM r WHERE rk <= 5),
late AS (SELECT * FROM preds WHERE target_time > (SELECT split_time FROM st)),
cand AS (
  SELECT p.station, p.window_end, 'ensemble_mean_top_' || k.k AS model, avg(p.prediction) AS prediction, max(p.y_true) AS y_true
  FROM late p JOIN r ON r.model = p.model JOIN (SELECT 2 AS k UNION ALL SELECT 3 UNION ALL SELECT 5) k ON r.rk <= k.k
  GROUP BY p.station, p.window_end, k.k
  UNION ALL
  SELECT p.station, p.window_end, 'ensemble_inverse_rmse_top_5', sum(iw.w * p.prediction), max(p.y_true)
  FROM late p JOIN iw ON iw.model = p.model GROUP BY p.station, p.window_end
  UNION ALL
  SELECT station, window_end, 'simple_average', avg(prediction), max(y_true) FROM late GROUP BY station, window_end
  UNION ALL
  SELECT p.station, p.window_end, 'fixed_blend_50_25_25', sum(f.w * p.prediction) / sum(f.w), max(p.y_true)
  FROM late p JOIN (SELECT 'persistence' AS model, 0.5 AS w UNION ALL SELECT 'rolling_mean_3h', 0.25
                    UNION ALL SELECT 'rolling_mean_6h', 0.25) f ON f.model = p.model GROUP BY p.station, p.window_end
  UNION ALL
  SELECT p.station, p.window_end, 'reference_' || p.model, p.prediction, p.y_true
  FROM late p JOIN r ON r.model = p.model WHERE r.rk <= 5)
SELECT model, count(*) AS rows, round(sqrt(avg((prediction - y_true) * (prediction - y_true))), 6) AS rmse,
       round(avg(abs(prediction - y_true)), 6) AS mae FROM cand GROUP BY model"""
    return P + LATE_SQL + rank


@query("ensembles_late", _ensembles_sql())
def q_ensembles(spark, sf_dir):
    """E1 mean of top 2/3/5, E2 inverse-rmse top 5, E6 simple average, E7
    fixed 50/25/25 blend, E8 single-model references: ranked on the full
    validation set, scored on its late half."""
    pr = preds_of(spark, sf_dir)
    metrics = MT.rmse_mae(pr)
    ranked = [r["model"] for r in MT.rank_models(metrics).orderBy("rank").collect()]
    split = late_split_time(pr, "target_time", 0.5)
    late = pr.where(F.col("target_time") > ts_lit(split))
    keys = ["station", "window_end", "target_time", "y_true"]
    cands = [E.mean_of(late, ranked[:k], f"ensemble_mean_top_{k}", keys) for k in (2, 3, 5)]
    wide_late = E.wide(late, MODELS, keys)
    cands.append(E.weighted_prediction(wide_late, E.inverse_rmse_weights(metrics, 5), "ensemble_inverse_rmse_top_5", keys))
    cands.append(E.mean_of(late, MODELS, "simple_average", keys))
    cands.append(E.weighted_prediction(wide_late, {"persistence": 0.5, "rolling_mean_3h": 0.25, "rolling_mean_6h": 0.25},
                                       "fixed_blend_50_25_25", keys, renormalise=True))
    cands.append(late.where(F.col("model").isin(ranked[:5])).withColumn("model", F.concat(F.lit("reference_"), "model")))
    allc = reduce(lambda a, b: a.unionByName(b), [c.select(*keys, "model", "prediction") for c in cands])
    return normalise(MT.rmse_mae(allc))


def _grid_sql() -> str:
    k = len(MODELS)
    units = ", ".join(f"range(11) t{i}(u{i})" for i in range(k))
    cond = " + ".join(f"u{i}" for i in range(k)) + " = 10"
    wsel = ", ".join(f"u{i} / 10.0 AS w{i}" for i in range(k))
    pred = " + ".join(f"g.w{i} * v.{m}" for i, m in enumerate(MODELS))
    order = ", ".join(f"u{i}" for i in range(k))
    return P + f""",
v AS ({_wide_sql()}),
g AS (SELECT {wsel}, row_number() OVER (ORDER BY {order}) AS gi FROM {units} WHERE {cond}),
s AS (SELECT g.gi, sum(({pred} - v.y_true) * ({pred} - v.y_true)) AS sse, count(*) AS n FROM g, v GROUP BY g.gi),
b AS (SELECT gi, sse, n FROM s ORDER BY round(sse, 6), gi LIMIT 1)
SELECT {', '.join(f'round(g.w{i}, 6) AS w_{m}' for i, m in enumerate(MODELS))}, round(sqrt(b.sse / b.n), 6) AS rmse
FROM b JOIN g USING (gi)"""


@query("grid_blend", _grid_sql())
def q_e4(spark, sf_dir):
    """Exhaustive simplex search (step 0.1, 1001 weight vectors over the 5
    baselines) from one Gram-matrix aggregation; best rmse on full validation."""
    pr = preds_of(spark, sf_dir)
    weights, rmse = E.grid_blend(E.wide(pr, MODELS), MODELS)
    row = tuple(float(weights[m]) for m in MODELS) + (rmse,)
    schema = ", ".join(f"w_{m} double" for m in MODELS) + ", rmse double"
    return normalise(spark.createDataFrame([row], schema))


# --------------------------------------------------------------------------- K calibration

def _k1_sql() -> str:
    return P + f""",
base AS (SELECT y_true, prediction AS b FROM preds WHERE model = 'persistence'),
grid AS (SELECT t.t AS threshold, o.i * 2.0 AS "offset", s.i * 0.025 AS slope, t.ti, o.i AS oi, s.i AS si
         FROM (SELECT unnest([60.0, 75.0, 90.0, 100.0, 115.0, 130.0, 150.0]) AS t,
                      unnest([0, 1, 2, 3, 4, 5, 6]) AS ti) t, range(15) o(i), range(15) s(i)),
ev AS (SELECT g.threshold, g."offset", g.slope, g.ti, g.oi, g.si,
         greatest(b.b + g."offset" * CAST(b.b >= g.threshold AS DOUBLE) + g.slope * greatest(b.b - g.threshold, 0.0), 0.0)
           - b.y_true AS e, b.y_true
       FROM grid g, base b),
sc AS (SELECT threshold, "offset", slope, ti, oi, si, sqrt(avg(e * e)) AS overall_rmse,
              sqrt(avg(e * e) FILTER (WHERE y_true > 150)) AS severe_rmse, avg(e) FILTER (WHERE y_true > 150) AS sb
       FROM ev GROUP BY ALL),
obj AS (SELECT 'overall_rmse' AS objective, *, overall_rmse AS score FROM sc
        UNION ALL SELECT 'severe_rmse', *, severe_rmse FROM sc
        UNION ALL SELECT 'balanced', *, overall_rmse + 0.2 * abs(sb) FROM sc),
best AS (SELECT *, row_number() OVER (PARTITION BY objective ORDER BY round(score, 9), ti, oi, si) AS rn
         FROM obj WHERE score IS NOT NULL AND isfinite(score))
SELECT objective, round(threshold, 6) AS threshold, round("offset", 6) AS "offset", round(slope, 6) AS slope,
       round(score, 6) AS score FROM best WHERE rn = 1"""


@query("additive_correction_search", _k1_sql())
def q_k1(spark, sf_dir):
    """K1: threshold x offset x slope search (1575 candidates, 3 objectives)
    from one pass of per-threshold moments."""
    pr = preds_of(spark, sf_dir).where(F.col("model") == "persistence")
    rows, moments = [], K.correction_moments(pr)
    for obj in K.OBJECTIVES:
        best, score = K.select_additive_correction(pr, obj, moments=moments)
        if best is None:  # no finite score (e.g. no severe rows): no selection, as in the oracle
            continue
        rows.append((obj, best["threshold"], best["offset"], best["slope"], score))
    return normalise(spark.createDataFrame(rows, "objective string, threshold double, offset double, slope double, score double"))


@query("correction_apply", P + """SELECT station, window_end, model,
  round(greatest(prediction + 4.0 * CAST(prediction >= 60 AS DOUBLE) + 0.025 * greatest(prediction - 60, 0.0), 0.0), 6) AS additive,
  round(greatest(prediction + 0.025 * greatest(prediction - 150, 0.0), 0.0), 6) AS fixed_slope,
  round(prediction, 6) AS base_pred, round(prediction * prediction, 6) AS base_pred_sq,
  """ + ", ".join(f"round(CAST(prediction >= {t} AS DOUBLE), 6) AS base_gt_{t}" for t in (75, 100, 125, 150)) + ", "
       + ", ".join(f"round(greatest(prediction - {t}, 0.0), 6) AS excess_{t}" for t in (75, 100, 125, 150)) + " FROM preds")
def q_k2(spark, sf_dir):
    """K2 additive correction (T=60, offset 4, slope 0.025), K3 fixed-slope
    calibration and K4 correction features, per prediction row."""
    pr = preds_of(spark, sf_dir)
    return normalise(pr.select(
        "station", "window_end", "model",
        K.apply_additive_correction("prediction", 60.0, 4.0, 0.025).alias("additive"),
        K.fixed_slope_calibration("prediction").alias("fixed_slope"),
        *K.correction_features("prediction"),
    ))
