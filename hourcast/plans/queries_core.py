"""Core queries: panel, imputation, alignment, windows, splits, baselines."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourcast.functions import arrays as A
from hourcast.operators import metrics as MT
from hourcast.operators.features import Win
from hourcast.plans import oracle as O
from hourcast.plans.pipeline import prepare, panel_of
from hourcast.plans.registry import normalise, query
from hourcast.session import cut_lineage
from hourcast.spec import MEASURES

ALL = ", ".join(f"round({m}, 6) AS {m}" for m in MEASURES)
BASELINE_MODELS = {
    "persistence": "pm25",
    **{f"rolling_mean_{k}h": f"avg(pm25) OVER f{k}" for k in (3, 6, 12, 24)},
}


def baseline_models(win: Win) -> dict:
    """R1 persistence + R2 rolling means as prediction expressions."""
    out = {"persistence": win.lag("pm25", 1)}
    out.update({f"rolling_mean_{k}h": A.mean(win.last("pm25", k)) for k in (3, 6, 12, 24)})
    return out


def _baseline_sql_preds(where: str = "window_end > (SELECT cutoff FROM cut)") -> str:
    extra = {f"bm_{i}": e for i, e in enumerate(BASELINE_MODELS.values())}
    unions = " UNION ALL ".join(
        f"SELECT station, window_end, target_time, y_true, '{name}' AS model, bm_{i} AS prediction FROM win WHERE {where}"
        for i, name in enumerate(BASELINE_MODELS)
    )
    return O.prelude() + O.windows(extra) + f",\npreds AS ({unions})\n"


# --------------------------------------------------------------------------- panel

@query("hourly_panel", O.prelude() + f"\nSELECT station, datetime, {ALL}, wd FROM panel")
def q_hourly_panel(spark, sf_dir):
    """Fixture: events -> regular station-hour panel with NULL gaps."""
    return normalise(panel_of(spark, sf_dir))


# --------------------------------------------------------------------------- flagship

@query("baseline_metrics", _baseline_sql_preds() + """
SELECT model, count(*) AS rows, round(sqrt(avg((prediction - y_true) * (prediction - y_true))), 6) AS rmse,
       round(avg(abs(prediction - y_true)), 6) AS mae
FROM preds GROUP BY model""")
def q_baseline_metrics(spark, sf_dir):
    """X1 core: causal impute -> 24 h windows -> persistence and rolling-mean
    baselines -> rmse / mae on the chronological validation split."""
    from hourcast.operators.features import with_arrays

    p = prepare(spark, sf_dir)
    preds = MT.predictions_long(with_arrays(p.valid_windows, ["pm25"]), baseline_models(Win()))
    return normalise(MT.rmse_mae(preds))


# --------------------------------------------------------------------------- helpers

def _panel_sql_select(src: str = "panel") -> str:
    return f"SELECT station, datetime, {ALL}, wd FROM {src}"


def _fill_sql(direction: str) -> str:
    """DuckDB ffill / bfill of every measure and wd per station."""
    if direction == "f":
        frame = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
        fn = "last_value"
    else:
        frame = "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
        fn = "first_value"
    cols = ", ".join(f"{fn}({m} IGNORE NULLS) OVER fw AS {m}" for m in (*MEASURES, "wd"))
    return f"SELECT station, datetime, {cols} FROM {{src}} WINDOW fw AS (PARTITION BY station ORDER BY datetime {frame})"


def _supplied(p):
    """Supplied flattened windows: un-imputed 24 h windows (continuous, target
    observed) ending after the cutoff, flattened to lag columns with the
    calendar parts of lag 1 and a key ``id``; the target is not included.  Written
    once a session, as the table a user would be given."""
    if p.supplied is not None:
        return p.supplied
    from hourcast.operators.splits import ts_lit
    from hourcast.operators.windows import build_windows, flatten_lags

    raw = build_windows(p.panel, p.spec).where(F.col("window_end") > ts_lit(p.cutoff))
    flat = flatten_lags(raw.drop("wd_lag_1"), p.spec, measures=(*MEASURES, "wd"))
    t = F.col("window_end")
    p.supplied = cut_lineage(flat.select(
        F.concat_ws("_", "station", F.date_format(t, "yyyyMMddHH")).alias("id"), "station",
        F.year(t).alias("year_lag_1"), F.month(t).alias("month_lag_1"),
        F.dayofmonth(t).alias("day_lag_1"), F.hour(t).alias("hour_lag_1"),
        *[c for c in flat.columns if "_lag_" in c],
    ))
    return p.supplied


def _supplied_sql() -> str:
    """DuckDB: the supplied windows (``sup``: id, station, calendar parts of
    lag 1, pm25_lag_1) and their lag rows (``supx``: id, pos, raw values),
    built from the raw panel."""
    raw_src = "(SELECT *, pm25 AS pm25_raw FROM panel) rp"
    return (O.windows(source=raw_src) + """,
sup AS (SELECT station || '_' || strftime(window_end, '%Y%m%d%H') AS id, station, window_end AS _end,
               year(window_end) AS year_lag_1, month(window_end) AS month_lag_1,
               day(window_end) AS day_lag_1, hour(window_end) AS hour_lag_1, pm25 AS pm25_lag_1
        FROM win WHERE window_end > (SELECT cutoff FROM cut)),
supx AS (SELECT s.id, 23 - datediff('hour', p.datetime, s._end) AS pos, """
            + ", ".join(f"p.{m}" for m in (*MEASURES, "wd")) + """
         FROM sup s JOIN panel p ON p.station = s.station
          AND p.datetime BETWEEN s._end - INTERVAL 23 HOUR AND s._end)""")


def _explode_sql(win: str = "win", src: str = "imp", cols=(*MEASURES, "wd")) -> str:
    """DuckDB: window rows exploded to (station, window_end, lag, values)."""
    sel = ", ".join(f"s.{c} AS {c}" if c == "wd" else f"round(s.{c}, 6) AS {c}" for c in cols)
    return f"""SELECT w.station, w.window_end, w.target_time, round(w.y_true, 6) AS y_true,
       CAST(datediff('hour', s.datetime, w.window_end) + 1 AS BIGINT) AS lag, {sel}
FROM {win} w JOIN {src} s ON s.station = w.station
  AND s.datetime BETWEEN w.window_end - INTERVAL 23 HOUR AND w.window_end"""


def _explode(windows, cols=(*MEASURES, "wd")):
    e = windows.select("station", "window_end", "target_time", "y_true", F.posexplode("w").alias("pos", "x"))
    return e.select("station", "window_end", "target_time", "y_true", (F.lit(24) - F.col("pos")).alias("lag"),
                    *[F.col(f"x.{c}").alias(c) for c in cols])


# --------------------------------------------------------------------------- P: time / scalar

@query("add_datetime", O.prelude() + """
SELECT station, CAST(year(datetime) AS BIGINT) AS year, CAST(month(datetime) AS BIGINT) AS month,
       CAST(day(datetime) AS BIGINT) AS day, CAST(hour(datetime) AS BIGINT) AS hour,
       make_timestamp(year(datetime), month(datetime), day(datetime), hour(datetime), 0, 0) AS datetime
FROM panel""")
def q_add_datetime(spark, sf_dir):
    """(year, month, day, hour) parts -> hourly TIMESTAMP_NTZ."""
    from hourcast.functions.scalar import make_hour_ts

    t = F.col("datetime")
    parts = panel_of(spark, sf_dir).select(
        "station", F.year(t).alias("year"), F.month(t).alias("month"), F.dayofmonth(t).alias("day"), F.hour(t).alias("hour")
    )
    return normalise(parts.select("*", make_hour_ts("year", "month", "day", "hour").alias("datetime")))


@query("period_slice", O.prelude() + "\n" + _panel_sql_select() +
       " WHERE datetime BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 23:00:00'")
def q_period_slice(spark, sf_dir):
    """Keep rows in [T0, T1] (a literal range filter, pushed to the scan)."""
    from hourcast.sources.files import period_slice

    return normalise(period_slice(panel_of(spark, sf_dir), "2024-01-05 00:00:00", "2024-01-20 23:00:00"))


@query("station_code", O.prelude() + """
SELECT station, CAST(dense_rank() OVER (ORDER BY station) - 1 AS DOUBLE) AS station_code
FROM (SELECT DISTINCT station FROM panel) s""")
def q_station_code(spark, sf_dir):
    """Station index in sorted distinct order, as a float."""
    from hourcast.operators.models import station_codes

    return normalise(station_codes(panel_of(spark, sf_dir)))


# --------------------------------------------------------------------------- M: imputation

@query("ffill_by_series", O.prelude() + ",\nff AS (" + _fill_sql("f").format(src="panel") + ")\n" + _panel_sql_select("ff"))
def q_ffill(spark, sf_dir):
    """M1: forward fill per station (bucketed windows + carry table)."""
    from hourcast.operators.impute import ffill_by_series

    return normalise(ffill_by_series(panel_of(spark, sf_dir)))


@query("bfill_by_series", O.prelude() + ",\nbf AS (" + _fill_sql("b").format(src="panel") + ")\n" + _panel_sql_select("bf"))
def q_bfill(spark, sf_dir):
    """M2: back fill per station (non-causal)."""
    from hourcast.operators.impute import bfill_by_series

    return normalise(bfill_by_series(panel_of(spark, sf_dir)))


_M3_CTE = (O.prelude() + ",\nff AS (" + _fill_sql("f").format(src="panel") + "),\nfb AS ("
           + _fill_sql("b").format(src="ff") + "),\nm3 AS (SELECT "
           + ", ".join(f"quantile_cont({m}, 0.5) AS md_{m}" for m in MEASURES)
           + ", (SELECT wd FROM fb WHERE wd IS NOT NULL GROUP BY wd ORDER BY count(*) DESC, wd LIMIT 1) AS md_wd FROM fb)")
_M3_SQL = (_M3_CTE + "\nSELECT station, datetime, "
           + ", ".join(f"round(coalesce({m}, (SELECT md_{m} FROM m3)), 6) AS {m}" for m in MEASURES)
           + ", coalesce(wd, (SELECT md_wd FROM m3), 'UNKNOWN') AS wd FROM fb")


@query("stationwise_time_impute", _M3_SQL)
def q_m3(spark, sf_dir):
    """M3: ffill -> bfill -> median of the filled columns; wd -> mode."""
    from hourcast.operators.impute import stationwise_time_impute

    return normalise(stationwise_time_impute(panel_of(spark, sf_dir)))


@query("impute_stats_fit", O.prelude() + "\nSELECT " + ", ".join(f"round(med_{m}, 6) AS median_{m}" for m in MEASURES)
       + ", (SELECT mode_wd FROM wdmode) AS mode_wd FROM stats")
def q_m4(spark, sf_dir):
    """M4: exact train-period medians + wd mode as a one-row table."""
    p = prepare(spark, sf_dir)
    return normalise(p.stats.to_df(spark))


@query("causal_impute_transform", O.prelude() + "\nSELECT station, datetime, round(pm25_raw, 6) AS pm25_raw, "
       + ALL + ", wd FROM imp")
def q_m5(spark, sf_dir):
    """M5: causal ffill + train median / mode fallback (raw target kept)."""
    p = prepare(spark, sf_dir)
    return normalise(p.imputed)


@query("median_impute", O.prelude() + "\nSELECT station, datetime, "
       + ", ".join(f"round(coalesce({m}, (SELECT med_{m} FROM stats)), 6) AS {m}" for m in MEASURES)
       + ", coalesce(wd, (SELECT mode_wd FROM wdmode)) AS wd FROM panel")
def q_m6(spark, sf_dir):
    """M6: train medians / mode only, no fill along time."""
    from hourcast.operators.impute import median_impute

    p = prepare(spark, sf_dir)
    return normalise(median_impute(p.panel, p.stats))


# --------------------------------------------------------------------------- W: alignment / windows

@query("one_hour_ahead", O.prelude() + """,
nx AS (SELECT *, lead(pm25) OVER o AS target_next, lead(datetime) OVER o AS next_time FROM panel
       WINDOW o AS (PARTITION BY station ORDER BY datetime))
SELECT station, datetime, round(pm25, 6) AS pm25, round(target_next, 6) AS target_next, next_time FROM nx
WHERE next_time = datetime + INTERVAL 1 HOUR AND target_next IS NOT NULL""")
def q_w1(spark, sf_dir):
    """Next-hour target per station, exactly 1 h gap and observed."""
    from hourcast.operators.windows import one_hour_ahead

    panel = panel_of(spark, sf_dir).select("station", "datetime", "pm25")
    return normalise(one_hour_ahead(panel))


@query("alignment_diagnostics", O.prelude() + """,
nx AS (SELECT *, lead(pm25) OVER o AS target_next, lead(datetime) OVER o AS next_time FROM panel
       WINDOW o AS (PARTITION BY station ORDER BY datetime)),
d AS (SELECT count(*) AS raw_rows, count(DISTINCT station) AS stations,
             count(*) FILTER (WHERE next_time = datetime + INTERVAL 1 HOUR AND target_next IS NOT NULL) AS valid FROM nx)
SELECT raw_rows, stations, raw_rows - stations AS candidate_one_step_rows, valid AS valid_one_hour_rows,
       raw_rows - stations - valid AS dropped_nonconsecutive_or_missing_target_rows FROM d""")
def q_w2(spark, sf_dir):
    """Raw rows, stations, candidates, valid and dropped one-step rows."""
    from hourcast.operators.windows import alignment_diagnostics

    return normalise(alignment_diagnostics(panel_of(spark, sf_dir)))


@query("build_windows", O.prelude() + O.windows() + "\n" + _explode_sql())
def q_w3(spark, sf_dir):
    """Valid 24 h windows (imputed features, raw target), exploded to one
    row per (window, lag) for the value check."""
    return normalise(_explode(prepare(spark, sf_dir).windows))


@query("continuity_filter", O.prelude() + """,
cq AS (SELECT station, datetime AS window_end, lead(datetime) OVER o AS target_time,
              count(*) OVER f AS n, min(datetime) OVER f AS first_t
       FROM (SELECT * FROM panel WHERE pm25 IS NOT NULL OR pm10 IS NOT NULL) q
       WINDOW o AS (PARTITION BY station ORDER BY datetime),
              f AS (PARTITION BY station ORDER BY datetime ROWS BETWEEN 23 PRECEDING AND CURRENT ROW))
SELECT station, window_end,
       (n = 24 AND first_t = window_end - INTERVAL 23 HOUR AND target_time = window_end + INTERVAL 1 HOUR) AS continuous
FROM cq""")
def q_w4(spark, sf_dir):
    """Continuity flag for every candidate window end on the observed
    rows only (gappy series): 24 consecutive hours and a next row 1 h later."""
    from hourcast.operators.windows import build_windows

    obs = panel_of(spark, sf_dir).where(F.col("pm25").isNotNull() | F.col("pm10").isNotNull())
    out = build_windows(obs, prepare(spark, sf_dir).spec, keep_invalid=True)
    return normalise(out.select("station", "window_end", "continuous"))


@query("flatten_lags", O.prelude() + O.windows({
    f"{m}_lag_{k}": O.lag(m, k) for m in MEASURES for k in range(24, 0, -1)}) + "\nSELECT station, window_end, target_time, "
    "round(y_true, 6) AS y_true, wd AS wd_lag_1, "
    + ", ".join(f"round({m}_lag_{k}, 6) AS {m}_lag_{k}" for m in MEASURES for k in range(24, 0, -1)) + " FROM win")
def q_w5(spark, sf_dir):
    """Window array -> 264 scalar lag columns (model boundary form)."""
    from hourcast.operators.windows import flatten_lags

    return normalise(flatten_lags(prepare(spark, sf_dir).windows))


@query("chronological_cutoff", O.prelude() + "\nSELECT cutoff, (SELECT count(*) FROM times) AS distinct_times FROM cut")
def q_w6(spark, sf_dir):
    """Cutoff index max(0, min(n-2, int(0.8 n)-1)) over distinct hours."""
    p = prepare(spark, sf_dir)
    n = p.panel.select(F.count_distinct("datetime")).first()[0]
    return normalise(spark.createDataFrame([(p.cutoff, n)], "cutoff timestamp_ntz, distinct_times long"))


@query("split_windows", O.prelude() + O.windows() + """
SELECT CASE WHEN window_end <= (SELECT cutoff FROM cut) THEN 'train' ELSE 'valid' END AS split,
       count(*) AS rows, min(window_end) AS first_end, max(window_end) AS last_end, round(avg(y_true), 6) AS mean_y
FROM win GROUP BY 1""")
def q_w7(spark, sf_dir):
    """Train (end <= cutoff) / valid split sizes and ranges."""
    from hourcast.operators.splits import split_by_time, split_guard

    p = prepare(spark, sf_dir)
    tr, va = split_by_time(p.windows, p.cutoff)
    split_guard(tr, va)
    agg = [F.count(F.lit(1)).alias("rows"), F.min("window_end").alias("first_end"),
           F.max("window_end").alias("last_end"), F.avg("y_true").alias("mean_y")]
    return normalise(tr.agg(*agg).select(F.lit("train").alias("split"), "*")
                     .unionByName(va.agg(*agg).select(F.lit("valid").alias("split"), "*")))


_W8_SQL = _M3_CTE + """,
filled AS (SELECT station, datetime, coalesce(pm25, (SELECT md_pm25 FROM m3)) AS pm25 FROM fb),
nx AS (SELECT *, lead(pm25) OVER o AS target_next, lead(datetime) OVER o AS next_time FROM filled
       WINDOW o AS (PARTITION BY station ORDER BY datetime)),
al AS (SELECT * FROM nx WHERE next_time = datetime + INTERVAL 1 HOUR),
rk AS (SELECT *, row_number() OVER (ORDER BY datetime, station) - 1 AS r, count(*) OVER () AS n FROM al),
hold AS (SELECT * FROM rk WHERE r >= CAST(floor(n * CAST(0.8 AS DOUBLE)) AS BIGINT))
SELECT 'persistence_latest_pm25' AS model, count(*) AS validation_rows,
       round(sqrt(avg((pm25 - target_next) * (pm25 - target_next))), 6) AS rmse,
       round(avg(abs(pm25 - target_next)), 6) AS mae, 0.2 AS validation_fraction FROM hold"""


@query("holdout_tail", _W8_SQL)
def q_w8(spark, sf_dir):
    """Persistence scored on the last 20 % of aligned imputed (M3) rows in time
    order (boundary hour found from per-hour counts; ties by station)."""
    from hourcast.operators.impute import stationwise_time_impute
    from hourcast.operators.splits import holdout_tail
    from hourcast.operators.windows import one_hour_ahead

    al = cut_lineage(one_hour_ahead(stationwise_time_impute(panel_of(spark, sf_dir).select("station", "datetime", "pm25"))))
    hold = holdout_tail(al, "datetime", "station", 0.2)
    e = F.col("pm25") - F.col("target_next")
    return normalise(hold.agg(
        F.lit("persistence_latest_pm25").alias("model"), F.count(F.lit(1)).alias("validation_rows"),
        F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"), F.lit(0.2).alias("validation_fraction"),
    ))


@query("latest_rows", O.prelude() + O.windows() + """
SELECT station, window_end, round(y_true, 6) AS y_true FROM win WHERE window_end <= (SELECT cutoff FROM cut)
ORDER BY window_end DESC, station DESC LIMIT 1000""")
def q_w9(spark, sf_dir):
    """The latest 1000 training windows (a top-k operator by design)."""
    from hourcast.operators.splits import latest_rows

    return normalise(latest_rows(prepare(spark, sf_dir).train_windows, 1000).select("station", "window_end", "y_true"))


@query("late_split", O.prelude() + O.windows() + """,
v AS (SELECT * FROM win WHERE window_end > (SELECT cutoff FROM cut)),
tt AS (SELECT target_time, row_number() OVER (ORDER BY target_time) AS i, count(*) OVER () AS n
       FROM (SELECT DISTINCT target_time FROM v) d),
st AS (SELECT target_time AS split_time FROM tt
       WHERE i = greatest(1, least(n - 1, CAST(floor(n * CAST(0.5 AS DOUBLE)) AS BIGINT))))
SELECT CASE WHEN target_time <= (SELECT split_time FROM st) THEN 'early' ELSE 'late' END AS part,
       count(*) AS rows, min(target_time) AS first_time, max(target_time) AS last_time FROM v GROUP BY 1""")
def q_w10(spark, sf_dir):
    """Early / late halves of the validation rows on distinct target times."""
    from hourcast.operators.splits import late_split_time, ts_lit

    v = prepare(spark, sf_dir).valid_windows
    st = late_split_time(v, "target_time", 0.5)
    part = F.when(F.col("target_time") <= ts_lit(st), "early").otherwise("late")
    return normalise(v.groupBy(part.alias("part")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("target_time").alias("first_time"), F.max("target_time").alias("last_time")))


@query("time_series_kfold", O.prelude() + O.windows() + """,
tr AS (SELECT * FROM win WHERE window_end <= (SELECT cutoff FROM cut)),
tt AS (SELECT window_end, row_number() OVER (ORDER BY window_end) - 1 AS i, count(*) OVER () AS n
       FROM (SELECT DISTINCT window_end FROM tr) d),
b AS (SELECT n // 4 AS test, n - 3 * (n // 4) AS first FROM (SELECT max(n) AS n FROM tt) x),
folds AS (SELECT f AS fold,
            (SELECT window_end FROM tt WHERE i = (SELECT first FROM b) + f * (SELECT test FROM b) - 1) AS tr_end,
            (SELECT window_end FROM tt WHERE i = (SELECT first FROM b) + (f + 1) * (SELECT test FROM b) - 1) AS va_end
          FROM range(3) r(f))
SELECT CAST(fold AS BIGINT) AS fold,
       (SELECT count(*) FROM tr WHERE window_end <= tr_end) AS train_rows,
       (SELECT count(*) FROM tr WHERE window_end > tr_end AND window_end <= va_end) AS valid_rows,
       tr_end, va_end FROM folds""")
def q_w12(spark, sf_dir):
    """3 expanding time-series folds over training windows (on time)."""
    from hourcast.operators.splits import assign_folds, expanding_folds

    tr = prepare(spark, sf_dir).train_windows.select("window_end")
    folds = expanding_folds(tr, "window_end", 3)
    sizes = assign_folds(tr, "window_end", folds).groupBy("fold").agg(
        F.count_if(F.col("role") == "train").alias("train_rows"), F.count_if(F.col("role") == "valid").alias("valid_rows"))
    bounds = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(folds)],
                                   "fold long, tr_end timestamp_ntz, va_end timestamp_ntz")
    return normalise(sizes.join(bounds, "fold"))
