"""Feature queries (P4-P11, F1-F11) and their DuckDB oracles.

On the DuckDB side the same features are written as window functions over
the imputed panel (``lg`` adds lag columns ``<m>_l<k>``), restricted to valid
windows; on the Spark side they are array expressions on the window column.
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from hourcast.functions import arrays as A
from hourcast.operators import features as FT
from hourcast.plans import oracle as O
from hourcast.plans.pipeline import prepare
from hourcast.plans.registry import normalise, query
from hourcast.spec import COMPASS_DEGREES, MEASURES

KEYS_SQL = "station, window_end"


def L(m: str, k: int) -> str:
    return f"{m}_l{k}"


def _lag_cte(measures=MEASURES, size: int = 24, src: str = "imp") -> str:
    lags = ", ".join(f"lag({m}, {k - 1}) OVER o AS {L(m, k)}" for m in measures for k in range(2, size + 1))
    ones = ", ".join(f"{m} AS {L(m, 1)}" for m in measures)
    return f""",
lg AS (SELECT *, {ones}, {lags} FROM {src} WINDOW o AS (PARTITION BY station ORDER BY datetime))"""


def _deg_sql(code: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in COMPASS_DEGREES.items())
    return f"(CASE {code} {whens} ELSE 0.0 END)"


def _rad_sql(code: str) -> str:
    return f"({_deg_sql(code)} * {math.pi / 180.0!r})"


def ratio(a: str, b: str) -> str:
    return f"({a}) / (abs({b}) + 1.0)"


def _features_query(feats: dict[str, str], ints: set[str] = frozenset(), strings: set[str] = frozenset(),
                    lag_measures=MEASURES) -> str:
    """prelude + lag CTE + windows with ``feats`` computed in ``wq``."""
    body = O.prelude() + _lag_cte(lag_measures) + O.windows(feats, source="lg")
    cols = []
    for name in feats:
        if name in ints:
            cols.append(f"CAST({name} AS BIGINT) AS {name}")
        elif name in strings:
            cols.append(name)
        else:
            cols.append(f"round({name}, 6) AS {name}")
    return body + f"\nSELECT {KEYS_SQL}, " + ", ".join(cols) + " FROM win"


def _spark_features(spark, sf_dir, cols):
    w = FT.with_arrays(prepare(spark, sf_dir).windows, MEASURES)
    return normalise(w.select("station", "window_end", *cols))


# --------------------------------------------------------------------------- P4/P5 calendar

CAL_SQL = {
    "hour": "hour(datetime)", "month": "month(datetime)", "dayofweek": "isodow(datetime) - 1",
    "is_weekend": "CAST(isodow(datetime) - 1 IN (5, 6) AS INTEGER)",
    "sin_hour": "sin(2 * pi() * hour(datetime) / 24.0)", "cos_hour": "cos(2 * pi() * hour(datetime) / 24.0)",
    "sin_month": "sin(2 * pi() * month(datetime) / 12.0)", "cos_month": "cos(2 * pi() * month(datetime) / 12.0)",
}
CAL_INTS = {"hour", "month", "dayofweek", "is_weekend"}


@query("calendar_features", _features_query(CAL_SQL, CAL_INTS))
def q_calendar(spark, sf_dir):
    """P4 + P5: hour, month, weekday (Mon=0), weekend flag, cyclic encodings."""
    return _spark_features(spark, sf_dir, FT.calendar_features(None))


# --------------------------------------------------------------------------- P6-P11 wind

WIND_SQL = {
    "wd_lag_1": "wd",
    "wind_degrees": _deg_sql("wd"),
    "wind_u_lag1": f"wspm * sin({_rad_sql('wd')})",
    "wind_v_lag1": f"wspm * cos({_rad_sql('wd')})",
    "wind_x_lag1": f"wspm * cos({_rad_sql('wd')})",
    "wind_y_lag1": f"wspm * sin({_rad_sql('wd')})",
    "wd_sin": f"sin({_rad_sql('wd')})",
    "wd_cos": f"cos({_rad_sql('wd')})",
    "station_wd_lag1": "station || '_' || wd",
    "pm25_pm10_ratio_lag1": ratio("pm25", "pm10"),
}


@query("wind_features", _features_query(WIND_SQL, strings={"wd_lag_1", "station_wd_lag1"}))
def q_wind(spark, sf_dir):
    """P6 degrees (unknown -> 0), P7 u/v (sin/cos), P8 x/y (cos/sin), P9
    direction unit vector, P10 safe ratio, P11 station x wind code."""
    from hourcast.functions.scalar import radians, safe_ratio, wind_degrees

    win = FT.Win()
    r = radians(F.col("wd_lag_1"))
    sp = win.lag("wspm", 1)
    cols = [
        F.col("wd_lag_1"), wind_degrees(F.col("wd_lag_1")).alias("wind_degrees"),
        (sp * F.sin(r)).alias("wind_u_lag1"), (sp * F.cos(r)).alias("wind_v_lag1"),
        (sp * F.cos(r)).alias("wind_x_lag1"), (sp * F.sin(r)).alias("wind_y_lag1"),
        *FT.wd_sincos(), F.concat_ws("_", "station", "wd_lag_1").alias("station_wd_lag1"),
        safe_ratio(win.lag("pm25", 1), win.lag("pm10", 1)).alias("pm25_pm10_ratio_lag1"),
    ]
    return _spark_features(spark, sf_dir, cols)


# --------------------------------------------------------------------------- F1 / F2

def _f1_sql(t: str = "pm25") -> dict[str, str]:
    d = {f"{t}_latest": t}
    d.update({f"{t}_mean_{k}h": f"avg({t}) OVER f{k}" for k in (3, 6, 12, 24)})
    d.update({f"{t}_std_{k}h": f"stddev_samp({t}) OVER f{k}" for k in (24, 6, 12)})
    d[f"{t}_min_24h"] = f"min({t}) OVER f24"
    d[f"{t}_max_24h"] = f"max({t}) OVER f24"
    d[f"{t}_trend_24h"] = f"{t} - {L(t, 24)}"
    return d


def _f2_sql() -> dict[str, str]:
    d = {}
    for m in FT.COMPACT_OTHERS:
        d[f"{m}_latest"] = m
        d[f"{m}_mean_24h"] = f"avg({m}) OVER f24"
        d[f"{m}_trend_24h"] = f"{m} - {L(m, 24)}"
        if m in FT.COMPACT_STD:
            d[f"{m}_std_24h"] = f"stddev_samp({m}) OVER f24"
    return d


@query("target_summary", _features_query(_f1_sql()))
def q_f1(spark, sf_dir):
    """F1: latest, means 3/6/12/24, std 24/6/12, min/max 24, trend of PM2.5."""
    return _spark_features(spark, sf_dir, FT.target_summary(FT.Win()))


@query("other_summary", _features_query(_f2_sql()))
def q_f2(spark, sf_dir):
    """latest, mean 24, trend 24 of nine measures; std 24 of wind, temperature."""
    return _spark_features(spark, sf_dir, FT.other_summary(FT.Win()))


# --------------------------------------------------------------------------- F9 compact interactions

def _f9_sql() -> dict[str, str]:
    rad = _rad_sql("wd")
    m3, m24 = "avg(pm25) OVER f3", "avg(pm25) OVER f24"
    return {
        "pm25_pm10_ratio_lag1": ratio("pm25", "pm10"),
        "pm25_low_wind_lag1": ratio("pm25", "wspm"),
        "ventilation_proxy_lag1": "pm25 * wspm",
        "pm25_rain_interaction_lag1": "pm25 * rain",
        "has_rain_lag1": "CAST(rain > 0 AS INTEGER)",
        "temp_dewp_spread_lag1": "temp - dewp",
        "pressure_change_24h": f"pres - {L('pres', 24)}",
        "pm25_short_vs_daily": f"{m3} - {m24}",
        "pm25_short_daily_ratio": ratio(m3, m24),
        "pm25_acceleration_3h": f"pm25 - 2 * {L('pm25', 2)} + {L('pm25', 3)}",
        "wind_u_lag1": f"wspm * sin({rad})",
        "wind_v_lag1": f"wspm * cos({rad})",
        "pm25_diff_1_2": f"pm25 - {L('pm25', 2)}",
        "pm25_diff_2_3": f"{L('pm25', 2)} - {L('pm25', 3)}",
        "o3_to_no2_ratio_lag1": ratio("o3", "no2"),
        "so2_to_no2_ratio_lag1": ratio("so2", "no2"),
        "temperature_acceleration_3h": f"temp - 2 * {L('temp', 2)} + {L('temp', 3)}",
        "wspm_kinetic": "wspm * wspm",
    }


@query("compact_interactions", _features_query(_f9_sql(), {"has_rain_lag1"}))
def q_f9(spark, sf_dir):
    """compact weather / pollution interactions."""
    return _spark_features(spark, sf_dir, FT.compact_interactions(FT.Win()))


# --------------------------------------------------------------------------- F3-F7 rich rolling

def _rich_sql(m: str) -> dict[str, str]:
    d = {f"{m}_latest": m}
    for k in (3, 6, 12, 24):
        p = f"{m}_{k}h"
        d[f"{p}_mean"] = f"avg({m}) OVER f{k}"
        d[f"{p}_std"] = f"stddev_samp({m}) OVER f{k}"
        d[f"{p}_min"] = f"min({m}) OVER f{k}"
        d[f"{p}_max"] = f"max({m}) OVER f{k}"
        if k in (6, 12, 24):
            d[f"{p}_median"] = f"quantile_cont({m}, 0.5) OVER f{k}"
        if k == 24:
            d[f"{p}_q25"] = f"quantile_cont({m}, 0.25) OVER f{k}"
            d[f"{p}_q75"] = f"quantile_cont({m}, 0.75) OVER f{k}"
        # least squares on x = 0..k-1: sum((x - mean) y) / sum((x - mean)^2), the latter k (k^2 - 1) / 12
        d[f"{p}_slope"] = " + ".join(
            f"(({k - i} - {k - 1} / 2.0::DOUBLE) / ({k} * ({k} * {k} - 1) / 12.0::DOUBLE)) * {L(m, i)}" for i in range(k, 0, -1))
    d[f"{m}_delta_1h"] = f"{m} - {L(m, 2)}"
    d[f"{m}_delta_3h"] = f"{m} - {L(m, 4)}"
    d[f"{m}_delta_6h"] = f"{m} - {L(m, 7)}"
    d[f"{m}_acceleration_3h"] = f"{m} - 2 * {L(m, 2)} + {L(m, 3)}"
    for a in FT.EWMA_ALPHAS:
        terms = " + ".join(f"{L(m, k)} * power(1 - {a}::DOUBLE, {k - 1})" for k in range(1, 25))
        d[f"{m}_ewma_a{str(a).replace('.', '')}"] = f"({terms}) / ((1 - power(1 - {a}::DOUBLE, 24)) / {a})"
    return d


def _rich_query(measures):
    feats = {}
    for m in measures:
        feats.update(_rich_sql(m))
    return feats


RICH_GROUPS = {
    "rich_rolling_pollution": ("pm25", "pm10", "so2", "no2", "co", "o3"),
    "rich_rolling_weather": ("temp", "pres", "dewp", "rain", "wspm"),
}


def _rich_spark(measures):
    def run(spark, sf_dir):
        win = FT.Win()
        cols = [c for m in measures for c in FT.rich_rolling(win, m)]
        w = FT.with_stats(FT.with_sorted(FT.with_arrays(prepare(spark, sf_dir).windows, MEASURES), measures), measures)
        return normalise(w.select("station", "window_end", *cols))

    return run


for _name, _ms in RICH_GROUPS.items():
    query(_name, _features_query(_rich_query(_ms), lag_measures=_ms))(_rich_spark(_ms))


# --------------------------------------------------------------------------- F8 / F10

def _f10_sql() -> dict[str, str]:
    rad = _rad_sql("wd")
    return {
        "pm25_pm10_ratio_lag1": ratio("pm25", "pm10"),
        "pm25_low_wind_lag1": ratio("pm25", "wspm"),
        "pm25_co_ratio_lag1": ratio("pm25", "co"),
        "no2_o3_ratio_lag1": ratio("no2", "o3"),
        "so2_no2_ratio_lag1": ratio("so2", "no2"),
        "pm10_low_wind_lag1": ratio("pm10", "wspm"),
        "pm25_wind_ventilation_lag1": "pm25 * wspm",
        "low_wind_flag_lag1": "CAST(wspm <= 1.0 AS INTEGER)",
        "rain_last_1h": "rain",
        "rain_flag_lag1": "CAST(rain > 0 AS INTEGER)",
        "pm25_rain_interaction_lag1": "pm25 * CAST(rain > 0 AS INTEGER)",
        "temp_dewp_spread_lag1": "temp - dewp",
        "wind_x_lag1": f"wspm * cos({rad})",
        "wind_y_lag1": f"wspm * sin({rad})",
        **{f"rain_sum_{k}h": f"coalesce(sum(rain) OVER f{k}, 0.0)" for k in FT.RAIN_SUM_SIZES},
    }


@query("rich_interactions", _features_query(_f10_sql(), {"low_wind_flag_lag1", "rain_flag_lag1"}))
def q_f10(spark, sf_dir):
    """F8 rain sums + F10 rich interactions (x/y wind axes, flags, ratios)."""
    win = FT.Win()
    w = FT.with_arrays(prepare(spark, sf_dir).windows, MEASURES)
    full = w.select("station", "window_end", *FT.rich_interactions(win), *FT.rain_sums(win))
    return normalise(full.select("station", "window_end", *_f10_sql()))
