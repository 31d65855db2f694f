"""Supplied (flattened) windows, in-window interpolation, submissions, target
alignment and city-context queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourcast.operators.context import CONTEXT_SPECS, city_context
from hourcast.operators.impute import interpolated_windows, rowwise_impute_supplied
from hourcast.operators.splits import ts_lit
from hourcast.operators.windows import build_windows, fold_lags
from hourcast.plans import oracle as O
from hourcast.plans.pipeline import prepare
from hourcast.plans.queries_core import _supplied, _supplied_sql
from hourcast.plans.queries_features import L, _lag_cte
from hourcast.plans.registry import normalise, query
from hourcast.spec import MEASURES

RAW_SRC = "(SELECT *, pm25 AS pm25_raw FROM panel) rp"


def _interp_sql(src: str, key: str, pos: str, stats: str = "stats") -> str:
    """DuckDB linear interpolation by position inside each window (exploded
    rows ``src`` with key ``key`` and position ``pos``)."""
    cols = []
    for m in MEASURES:
        pv = f"last_value({m} IGNORE NULLS) OVER bw"
        pp = f"last_value(CASE WHEN {m} IS NOT NULL THEN {pos} END IGNORE NULLS) OVER bw"
        nv = f"first_value({m} IGNORE NULLS) OVER aw"
        np_ = f"first_value(CASE WHEN {m} IS NOT NULL THEN {pos} END IGNORE NULLS) OVER aw"
        cols.append(f"{pv} AS {m}_pv, {pp} AS {m}_pp, {nv} AS {m}_nv, {np_} AS {m}_np")
    wd = ("coalesce(last_value(wd IGNORE NULLS) OVER bw, first_value(wd IGNORE NULLS) OVER aw, "
          "(SELECT mode_wd FROM wdmode)) AS wd_f")
    body = f"""SELECT *, {', '.join(cols)}, {wd} FROM {src}
  WINDOW bw AS (PARTITION BY {key} ORDER BY {pos} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         aw AS (PARTITION BY {key} ORDER BY {pos} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""
    fin = []
    for m in MEASURES:
        e = (f"CASE WHEN {m}_pp IS NULL THEN {m}_nv WHEN {m}_np IS NULL THEN {m}_pv WHEN {m}_pp = {m}_np THEN {m}_pv "
             f"ELSE {m}_pv + ({m}_nv - {m}_pv) * ({pos} - {m}_pp) / ({m}_np - {m}_pp) END")
        fin.append(f"coalesce({e}, (SELECT med_{m} FROM {stats})) AS {m}")
    return body, fin


def _raw_windows(p):
    """Valid 24 h windows on the raw (un-imputed) panel."""
    return build_windows(p.panel, p.spec)


def _explode_arr(df, key_cols, cols):
    e = df.select(*key_cols, F.posexplode("w").alias("pos", "x"))
    return e.select(*key_cols, (F.lit(24) - F.col("pos")).alias("lag"), *[F.col(f"x.{c}").alias(c) for c in cols])


# --------------------------------------------------------------------------- M7

_M7_BODY, _M7_FIN = _interp_sql("ex", "station, window_end", "pos")
_M7_SQL = (O.prelude() + O.windows(source=RAW_SRC) + f""",
ex AS (SELECT w.station, w.window_end, w.wd AS wd_lag_1, 24 - datediff('hour', s.datetime, w.window_end) - 1 AS pos,
              {', '.join('s.' + m for m in MEASURES)}, s.wd
       FROM win w JOIN panel s ON s.station = w.station
        AND s.datetime BETWEEN w.window_end - INTERVAL 23 HOUR AND w.window_end),
it AS ({_M7_BODY})
SELECT station, window_end, CAST(24 - pos AS BIGINT) AS lag, """
           + ", ".join(f"round({f.split(' AS ')[0]}, 6) AS {m}" for f, m in zip(_M7_FIN, MEASURES))
           + ", coalesce(wd_lag_1, (SELECT mode_wd FROM wdmode)) AS wd_lag_1 FROM it")


@query("window_interpolate", _M7_SQL)
def q_m7(spark, sf_dir):
    """M7: linear interpolation inside each raw window (edges nearest,
    all-NULL -> train median); wd_lag_1 -> train mode."""
    p = prepare(spark, sf_dir)
    it = interpolated_windows(p.panel, p.stats, p.spec)
    e = _explode_arr(it, ["station", "window_end", "wd_lag_1"], MEASURES)
    return normalise(e.select("station", "window_end", "lag", *MEASURES, "wd_lag_1"))


# --------------------------------------------------------------------------- supplied windows

_M8_BODY, _M8_FIN = _interp_sql("supx", "id", "pos")
_M8_SQL = (O.prelude() + _supplied_sql() + f""",
it AS ({_M8_BODY}),
m8 AS (SELECT id, CAST(24 - pos AS BIGINT) AS lag, {', '.join(_M8_FIN)}, wd_f AS wd FROM it)""")


def _m8_long(p):
    return rowwise_impute_supplied(fold_lags(_supplied(p), p.spec), p.stats, p.spec)


@query("rowwise_impute_supplied", _M8_SQL + "\nSELECT id, lag, "
       + ", ".join(f"round({m}, 6) AS {m}" for m in MEASURES) + ", wd FROM m8")
def q_m8(spark, sf_dir):
    """M8: supplied flattened windows folded to arrays; numeric lags
    interpolated with median fallback, wd lags ffill -> bfill -> mode."""
    return normalise(_m8_long(prepare(spark, sf_dir)))


@query("supplied_rolling_means", _M8_SQL + """
SELECT id, round(max(pm25) FILTER (WHERE lag = 1), 6) AS pm25_lag1_value,
       round(avg(pm25) FILTER (WHERE lag <= 2), 6) AS pm25_mean_2h,
       round(avg(pm25) FILTER (WHERE lag <= 3), 6) AS pm25_mean_3h FROM m8 GROUP BY id""")
def q_f11(spark, sf_dir):
    """lag 1 and 2 h / 3 h means of the interpolated supplied target lags."""
    long = _m8_long(prepare(spark, sf_dir))
    lag = F.col("lag")
    return normalise(long.groupBy("id").agg(
        F.max(F.when(lag == 1, F.col("pm25"))).alias("pm25_lag1_value"),
        F.avg(F.when(lag <= 2, F.col("pm25"))).alias("pm25_mean_2h"),
        F.avg(F.when(lag <= 3, F.col("pm25"))).alias("pm25_mean_3h")))


@query("add_datetime_from_lag1", O.prelude() + _supplied_sql() + """
SELECT id, make_timestamp(year_lag_1, month_lag_1, day_lag_1, hour_lag_1, 0, 0) AS window_end FROM sup""")
def q_p2(spark, sf_dir):
    """Window end from year/month/day/hour of lag 1 on supplied windows."""
    from hourcast.functions.scalar import make_hour_ts

    sup = _supplied(prepare(spark, sf_dir))
    return normalise(sup.select("id", make_hour_ts("year_lag_1", "month_lag_1", "day_lag_1", "hour_lag_1").alias("window_end")))


def _aligned(p):
    from hourcast.functions.scalar import make_hour_ts
    from hourcast.operators.joins import align_targets

    sup = _supplied(p).withColumn("window_end", make_hour_ts("year_lag_1", "month_lag_1", "day_lag_1", "hour_lag_1"))
    return align_targets(sup, p.panel)


_J1_SQL = O.prelude() + _supplied_sql() + """,
al AS (SELECT s.id, s.station, make_timestamp(s.year_lag_1, s.month_lag_1, s.day_lag_1, s.hour_lag_1, 0, 0) AS window_end,
              p.datetime AS target_time, p.pm25 AS y_true, s.pm25_lag_1
       FROM sup s LEFT JOIN panel p ON p.station = s.station
        AND p.datetime = make_timestamp(s.year_lag_1, s.month_lag_1, s.day_lag_1, s.hour_lag_1, 0, 0) + INTERVAL 1 HOUR)"""


@query("align_targets", _J1_SQL + "\nSELECT id, station, window_end, target_time, round(y_true, 6) AS y_true FROM al")
def q_j1(spark, sf_dir):
    """Supplied windows LEFT JOIN raw panel at window_end + 1 h."""
    return normalise(_aligned(prepare(spark, sf_dir)).select("id", "station", "window_end", "target_time", "y_true"))


_S7_SQL = _J1_SQL + """,
sub AS (SELECT id, coalesce(pm25_lag_1, (SELECT quantile_cont(pm25_lag_1, 0.5) FROM sup)) AS pred FROM sup)"""


@query("persistence_submission", _S7_SQL + '\nSELECT id, round(pred, 6) AS "PM2.5" FROM sub')
def q_s7(spark, sf_dir):
    """Id + latest target lag; missing -> median of the lags."""
    from hourcast.sources.files import persistence_submission

    return normalise(persistence_submission(_supplied(prepare(spark, sf_dir))))


@query("write_submission", _S7_SQL + '\nSELECT s.id, round(greatest(b.pred, 0.0), 6) AS "PM2.5" FROM sup s LEFT JOIN sub b ON b.id = s.id')
def q_s6(spark, sf_dir):
    """Sample ids left-joined to clipped predictions; any missing id raises."""
    from hourcast.sources.files import persistence_submission, submission

    sup = _supplied(prepare(spark, sf_dir))
    preds = persistence_submission(sup).withColumnRenamed("PM2.5", "prediction")
    return normalise(submission(sup.select("id"), preds))


@query("score_join_by_id", _S7_SQL + """
SELECT count(*) AS rows, count(y_true) AS scored_rows,
       round(sqrt(avg((b.pred - a.y_true) * (b.pred - a.y_true))), 6) AS rmse, round(avg(abs(b.pred - a.y_true)), 6) AS mae
FROM al a LEFT JOIN sub b ON b.id = a.id""")
def q_j4(spark, sf_dir):
    """Aligned truth LEFT JOIN predictions by id -> rmse / mae."""
    from hourcast.sources.files import persistence_submission

    p = prepare(spark, sf_dir)
    truth = _aligned(p)
    preds = persistence_submission(_supplied(p))
    j = truth.select("id", "y_true").join(preds, "id", "left")
    e = F.col("`PM2.5`") - F.col("y_true")
    return normalise(j.agg(F.count(F.lit(1)).alias("rows"), F.count("y_true").alias("scored_rows"),
                           F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae")))


# --------------------------------------------------------------------------- C1-C4

def half_up(x: str) -> str:
    """``x`` to 6 places, halves away from zero by its decimal digits, as Spark rounds doubles
    (DuckDB's ``round`` decides after a binary multiplication)."""
    return f"CAST(CAST(CAST({x} AS VARCHAR) AS DECIMAL(28,6)) AS DOUBLE)"


def _city_sql() -> str:
    vals = {f"{m}_lag_{k}": L(m, k) for m, lags in CONTEXT_SPECS.items() for k in lags}
    ex = O.windows({f"cv_{n}": f"CAST({e} AS DECIMAL(18,8))" for n, e in vals.items()}, source="lg")
    aggs = ["CAST(count(cv_pm25_lag_1) AS DOUBLE) AS city_station_count"]
    for n in vals:
        aggs.append(f"count(cv_{n}) AS n_{n}, sum(cv_{n}) AS s_{n}, max(cv_{n}) AS x_{n}, "
                    f"stddev_samp(CAST(cv_{n} AS DOUBLE)) AS sd_{n}")
    cols = ["city_station_count"]
    for m, lags in CONTEXT_SPECS.items():
        for k in lags:
            n, p = f"{m}_lag_{k}", f"city_{m}_lag{k}"
            mean = f"CAST(s_{n} AS DOUBLE) / nullif(n_{n}, 0)"
            other = f"coalesce(CAST(s_{n} - cv_{n} AS DOUBLE) / nullif(n_{n} - 1, 0), {mean})"
            from_sum = f"CAST(cv_{n} * CAST(n_{n} AS DECIMAL(9,0)) - s_{n} AS DOUBLE)"
            cols += [f"{mean} AS {p}_mean", f"CAST(x_{n} AS DOUBLE) AS {p}_max", f"coalesce(sd_{n}, 0.0) AS {p}_std",
                     f"{other} AS {p}_other_mean", f"{from_sum} / n_{n} AS {p}_station_minus_city",
                     f"CASE WHEN n_{n} = 1 THEN CAST(cv_{n} - s_{n} AS DOUBLE) ELSE {from_sum} / nullif(n_{n} - 1, 0) END AS {p}_station_minus_other"]
    names = [c.split(" AS ")[-1] for c in cols]
    names += ["city_pm25_mean_delta_1h", "city_pm25_other_mean_delta_1h", "city_pm25_peak_spread_lag1"]
    return (O.prelude() + _lag_cte() + ex + f""",
ph AS (SELECT window_end, {', '.join(aggs)} FROM win GROUP BY window_end),
cc AS (SELECT w.station, w.window_end, {', '.join(cols)} FROM win w JOIN ph USING (window_end)),
c2 AS (SELECT *, city_pm25_lag1_mean - city_pm25_lag2_mean AS city_pm25_mean_delta_1h,
              city_pm25_lag1_other_mean - city_pm25_lag2_other_mean AS city_pm25_other_mean_delta_1h,
              city_pm25_lag1_max - city_pm25_lag1_mean AS city_pm25_peak_spread_lag1 FROM cc)
SELECT station, window_end, """ + ", ".join(f"{half_up(n)} AS {n}" for n in names) + " FROM c2")


@query("city_context", _city_sql())
def q_city(spark, sf_dir):
    """Same-hour cross-station mean/max/std, leave-one-out mean,
    deviations, 1 h deltas and peak spread."""
    w = prepare(spark, sf_dir).windows
    out = city_context(w)
    return normalise(out.drop("w", "target_time", "y_true", "wd_lag_1"))


# --------------------------------------------------------------------------- A14 / J3 / J7

_A14_SQL = _S7_SQL + """,
roll AS (SELECT s.id, avg(x.pm25) AS pred FROM sup s JOIN supx x ON x.id = s.id WHERE x.pos >= 21 GROUP BY s.id),
j AS (SELECT coalesce(a.id, b.id) AS id, a.pred AS a, b.pred AS b FROM sub a FULL JOIN roll b ON a.id = b.id)
SELECT count(*) AS rows, count(*) FILTER (WHERE abs(a - b) > 1e-9) AS changed_rows,
       round(avg(abs(a - b)), 6) AS mean_abs_diff, round(max(abs(a - b)), 6) AS max_abs_diff,
       count(*) FILTER (WHERE a IS NULL) AS missing_new, count(*) FILTER (WHERE b IS NULL) AS missing_ref,
       round(avg(a), 6) AS mean_new, round(avg(b), 6) AS mean_ref, round(min(a), 6) AS min_new, round(max(a), 6) AS max_new
FROM j"""


@query("submission_diff", _A14_SQL)
def q_a14(spark, sf_dir):
    """Persistence submission vs a 3 h raw-mean submission of the same
    supplied windows: changed rows, mean / max abs difference, missing, stats."""
    from hourcast.sources.files import persistence_submission
    from hourcast.operators.metrics import submission_diff

    p = prepare(spark, sf_dir)
    sup = _supplied(p)
    new = persistence_submission(sup).withColumnRenamed("PM2.5", "prediction")
    lags = [F.col(f"pm25_lag_{k}") for k in (1, 2, 3)]
    nn = sum((F.when(c.isNotNull(), 1).otherwise(0) for c in lags), F.lit(0))
    tot = sum((F.coalesce(c, F.lit(0.0)) for c in lags), F.lit(0.0))
    ref = sup.select("id", F.when(nn > 0, tot / nn).alias("prediction"))
    return normalise(submission_diff(new, ref))


@query("attach_predictions", O.prelude() + O.windows({"rm3": "avg(pm25) OVER f3"}) + """
SELECT w.station, w.window_end, round(w.y_true, 6) AS y_true, round(w.pm25, 6) AS persistence, round(a.rm3, 6) AS rolling_mean_3h
FROM win w LEFT JOIN (SELECT station, window_end, rm3 FROM win WHERE window_end > (SELECT cutoff FROM cut)) a
  ON a.station = w.station AND a.window_end = w.window_end""")
def q_j3(spark, sf_dir):
    """LEFT one-to-one join of an extra prediction column (validation-only
    rolling mean) onto all windows; uniqueness of the right side is asserted."""
    from hourcast.functions import arrays as A
    from hourcast.operators.features import Win, with_arrays
    from hourcast.operators.joins import attach_predictions

    p = prepare(spark, sf_dir)
    w = with_arrays(p.windows, ["pm25"])
    win = Win()
    base = w.select("station", "window_end", "y_true", win.lag("pm25", 1).alias("persistence"))
    extra = with_arrays(p.valid_windows, ["pm25"]).select(
        "station", "window_end", A.mean(win.last("pm25", 3)).alias("rolling_mean_3h"))
    return normalise(attach_predictions(base, extra, ["station", "window_end"]))


@query("distinct_times", O.prelude() + O.windows() + "\nSELECT DISTINCT target_time FROM win")
def q_j7(spark, sf_dir):
    """Distinct target times of the windows."""
    from hourcast.operators.joins import distinct_times

    return normalise(distinct_times(prepare(spark, sf_dir).windows, "target_time"))
