"""Climatology, error slices, blends by group and category metrics over the baseline forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourcast.operators import ensemble as E
from hourcast.operators import metrics as MT
from hourcast.operators import slices as S
from hourcast.operators.features import Win, with_arrays
from hourcast.operators.joins import union_frames
from hourcast.operators.splits import late_split_time, ts_lit
from hourcast.plans import oracle as O
from hourcast.plans.pipeline import once, prepare
from hourcast.plans.queries_core import BASELINE_MODELS, baseline_models
from hourcast.plans.queries_reports import LATE_SQL, MODELS, P, _metric_cols, _wide_sql, preds_of
from hourcast.plans.registry import normalise, query
from hourcast.session import cut_lineage

KEYS = ["station", "window_end", "target_time", "y_true"]
LEAST = 5


# --------------------------------------------------------------------------- climatology

_CLIMATE = O.prelude() + O.windows({"m3": "avg(pm25) OVER f3"}) + """,
c AS (SELECT *, month(target_time)::VARCHAR AS m, hour(target_time)::VARCHAR AS h, window_end <= (SELECT cutoff FROM cut) AS tr FROM win),
g AS (SELECT GROUPING_ID(station, m, h) AS gid, station, m, h, count(*) AS n, quantile_cont(y_true, 0.5) AS median
      FROM c WHERE tr GROUP BY GROUPING SETS ((station, m, h), (station, h), (h), ())),
t AS (SELECT CASE gid WHEN 0 THEN 0 WHEN 2 THEN 1 WHEN 6 THEN 2 ELSE 3 END AS level, coalesce(station, '*') AS station, coalesce(m, '*') AS month,
        coalesce(h, '*') AS hour, n, median FROM g)"""


def _timed(windows):
    return windows.select(*KEYS, F.month("target_time").alias("month"), F.hour("target_time").alias("hour"), F.col("w"))


@query("climatology", _CLIMATE + "\nSELECT CAST(level AS BIGINT) AS level, station, month, hour, n, round(median, 6) AS median FROM t")
def q_climatology(spark, sf_dir):
    """Exact medians by (station, month, hour), (station, hour), (hour) and over all, of the training windows."""
    return normalise(S.climatology(_timed(prepare(spark, sf_dir).train_windows)))


@query("climatology_scores", _CLIMATE + f""",
p AS (SELECT c.y_true, c.pm25, c.m3, CASE WHEN a.median IS NOT NULL THEN 0 WHEN b.median IS NOT NULL THEN 1 WHEN d.median IS NOT NULL THEN 2 ELSE 3 END AS level,
        coalesce(a.median, b.median, d.median, (SELECT median FROM t WHERE level = 3)) AS cl
      FROM c LEFT JOIN t a ON a.level = 0 AND a.n >= {LEAST} AND a.station = c.station AND a.month = c.m AND a.hour = c.h
      LEFT JOIN t b ON b.level = 1 AND b.n >= {LEAST} AND b.station = c.station AND b.hour = c.h
      LEFT JOIN t d ON d.level = 2 AND d.n >= {LEAST} AND d.hour = c.h WHERE NOT c.tr),
u AS (SELECT 'climatology_level_' || level AS model, cl - y_true AS e FROM p UNION ALL SELECT 'climatology', cl - y_true FROM p
      UNION ALL SELECT 'hybrid_70_30', 0.7 * pm25 + 0.3 * m3 - y_true FROM p)
SELECT model, {_metric_cols()} FROM u GROUP BY model""")
def q_climatology_scores(spark, sf_dir):
    """Climatology on the validation windows, over all and by the level it fell back to, and the persistence / 3 h mean hybrid."""
    p = prepare(spark, sf_dir)
    table = cut_lineage(S.climatology(_timed(p.train_windows)))
    pred = S.climatology_predict(_timed(p.valid_windows), table, KEYS, LEAST)
    by_level = pred.select(*KEYS, F.concat(F.lit("climatology_level_"), F.col("level").cast("string")).alias("model"), "prediction")
    win = Win()
    mean3 = baseline_models(win)["rolling_mean_3h"]
    hybrid = MT.predictions_long(with_arrays(p.valid_windows, ["pm25"]), {"hybrid_70_30": 0.7 * win.lag("pm25", 1) + 0.3 * mean3})
    return normalise(MT.rmse_mae(union_frames([by_level, pred.select(*KEYS, F.lit("climatology").alias("model"), "prediction"), hybrid])))


# --------------------------------------------------------------------------- error slices

_SLICES = {
    "station": "station", "hour": "hour(target_time)::VARCHAR", "month": "month(target_time)::VARCHAR", "wind": "wd",
    "wind_speed": "CASE WHEN wspm < 2 THEN 'calm' WHEN wspm < 5 THEN 'light' WHEN wspm IS NOT NULL THEN 'strong' END",
    "rain": "CASE WHEN rain > 0 THEN 'rain' WHEN rain IS NOT NULL THEN 'dry' END",
    "target": "CASE WHEN y_true <= 35 THEN '0-35' WHEN y_true <= 75 THEN '35-75' WHEN y_true <= 150 THEN '75-150' WHEN y_true <= 250 THEN '150-250' ELSE '250+' END",
    "episode": "CASE WHEN y_true - pm25 >= 30 THEN 'rapid_rise' WHEN y_true - pm25 <= -30 THEN 'rapid_drop' ELSE 'steady' END",
}


def _slices_sql() -> str:
    models = {f"b{i}": e for i, e in enumerate(BASELINE_MODELS.values())}
    errors = " UNION ALL ".join(f"SELECT *, '{name}' AS model, b{i} - y_true AS e FROM win WHERE window_end > (SELECT cutoff FROM cut)"
                                for i, name in enumerate(BASELINE_MODELS))
    parts = " UNION ALL ".join(f"SELECT model, '{s}' AS slice, coalesce({expr}, 'missing') AS value, e FROM er" for s, expr in _SLICES.items())
    return (O.prelude() + O.windows(models) + f",\ner AS ({errors}),\nsl AS ({parts})\n" + """
SELECT model, slice, value, count(*) AS rows, round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e)), 6) AS mae, round(avg(e), 6) AS bias,
  round(avg((e > 0)::INT), 6) AS over_rate, round(avg((e < 0)::INT), 6) AS under_rate, round(quantile_cont(abs(e), 0.95), 6) AS p95_abs_error
FROM sl GROUP BY ALL""")


@query("error_slices", _slices_sql())
def q_error_slices(spark, sf_dir):
    """Errors of the baselines by station, hour, month, wind, wind speed, rain, target bucket and episode."""
    win = Win()
    w = with_arrays(prepare(spark, sf_dir).valid_windows, ["pm25", "wspm", "rain"])
    attributes = S.slice_attributes(win.lag("pm25", 1), win.lag("wspm", 1), win.lag("rain", 1))
    w = w.withColumns({f"_s_{k}": v for k, v in attributes.items()})
    preds = MT.predictions_long(w, baseline_models(win), keys=("y_true", *[f"_s_{k}" for k in attributes]))
    preds = preds.select("model", "prediction", "y_true", *[F.col(f"_s_{k}").alias(k) for k in attributes])
    return normalise(S.error_slices(preds, list(attributes)))


# --------------------------------------------------------------------------- blends by group

def blends(spark, sf_dir):
    """Weights by station and by level of the latest value, from the early half of the validation rows, and both blends on the late half."""
    def make():
        long = preds_of(spark, sf_dir)
        wide = cut_lineage(E.wide(long, MODELS, KEYS).withColumn("level", S.bucket("persistence")))
        split = ts_lit(late_split_time(wide, "target_time", 0.5))
        early, late = wide.where(F.col("target_time") <= split), wide.where(F.col("target_time") > split)
        weights = {by: cut_lineage(S.group_blend_weights(early, MODELS, [by])) for by in ("station", "level")}
        return weights, late

    return once(spark, ("blends", sf_dir), make)


@query("group_blend_rows", P + LATE_SQL + """,
wd AS (""" + _wide_sql() + """),
k AS (SELECT station, CASE WHEN persistence <= 35 THEN '0-35' WHEN persistence <= 75 THEN '35-75' WHEN persistence <= 150 THEN '75-150'
        WHEN persistence <= 250 THEN '150-250' ELSE '250+' END AS level FROM wd WHERE target_time <= (SELECT split_time FROM st))
SELECT 'station' AS kind, station AS grp, count(*) AS rows, true AS convex FROM k GROUP BY station
UNION ALL SELECT 'level', level, count(*), true FROM k GROUP BY level""")
def q_group_blend_rows(spark, sf_dir):
    """Rows behind each group's blend weights, and that the weights are non-negative and sum to 1."""
    weights, _ = blends(spark, sf_dir)
    w = F.map_values("weights")
    convex = F.forall(w, lambda x: x >= 0) & (F.abs(F.aggregate(w, F.lit(0.0), lambda a, x: a + x) - 1) < 1e-9)
    return normalise(union_frames([t.select(F.lit(by).alias("kind"), F.col(by).alias("grp"), "rows", convex.alias("convex")) for by, t in weights.items()]))


@query("group_blend")
def q_group_blend(spark, sf_dir):
    """E3 with weights of their own by station and by pollution level, scored on the late half."""
    weights, late = blends(spark, sf_dir)
    both = [S.group_blend(late, t, MODELS, [by], KEYS, f"blend_by_{by}") for by, t in weights.items()]
    return normalise(MT.rmse_mae(union_frames(both)))


# --------------------------------------------------------------------------- categories

def _label(x: str) -> str:
    return f"CASE WHEN {x} <= 35 THEN '0-35' WHEN {x} <= 75 THEN '35-75' WHEN {x} <= 150 THEN '75-150' WHEN {x} <= 250 THEN '150-250' ELSE '250+' END"


_CONFUSION = P + f""",
cf AS (SELECT model, {_label('y_true')} AS actual, {_label('prediction')} AS predicted, count(*) AS rows FROM preds GROUP BY ALL),
cl AS (SELECT model, category, sum(seen) AS support, sum(said) AS said, sum(hit) AS hit FROM (
  SELECT model, actual AS category, rows AS seen, 0 AS said, CASE WHEN actual = predicted THEN rows ELSE 0 END AS hit FROM cf
  UNION ALL SELECT model, predicted, 0, rows, 0 FROM cf) q GROUP BY ALL)"""


def _counts(spark, sf_dir):
    return once(spark, ("confusion", sf_dir), lambda: cut_lineage(S.confusion(preds_of(spark, sf_dir))))


@query("confusion_matrix", _CONFUSION + "\nSELECT model, actual, " + ", ".join(
    f'CAST(coalesce(sum(rows) FILTER (WHERE predicted = \'{x}\'), 0) AS BIGINT) AS "{x}"' for x in S.BUCKET_LABELS) + " FROM cf GROUP BY model, actual")
def q_confusion(spark, sf_dir):
    """Confusion matrix of the five target buckets per model."""
    return normalise(S.confusion_matrix(_counts(spark, sf_dir)))


@query("class_metrics", _CONFUSION + """
SELECT model, category, CAST(support AS BIGINT) AS support, round(coalesce(hit / nullif(said, 0), 0), 6) AS precision,
  round(coalesce(hit / nullif(support, 0), 0), 6) AS recall, round(2.0 * hit / (support + said), 6) AS f1 FROM cl""")
def q_class_metrics(spark, sf_dir):
    """Precision, recall and F1 per bucket."""
    return normalise(S.class_metrics(_counts(spark, sf_dir)))


@query("category_scores", _CONFUSION + """
SELECT a.model, a.rows, a.accuracy, b.macro_f1 FROM
  (SELECT model, CAST(sum(rows) AS BIGINT) AS rows, round(sum(CASE WHEN actual = predicted THEN rows ELSE 0 END) / sum(rows), 6) AS accuracy FROM cf GROUP BY model) a
  JOIN (SELECT model, round(avg(2.0 * hit / (support + said)), 6) AS macro_f1 FROM cl GROUP BY model) b USING (model)""")
def q_category_scores(spark, sf_dir):
    """Category accuracy and macro F1 per model."""
    return normalise(S.category_scores(_counts(spark, sf_dir)))
