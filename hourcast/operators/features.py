"""Row-wise window features (F1-F12), calendar (P4/P5) and wind.

Every feature is one expression over the window array ``w`` of the same row,
so a feature frame is a single projection after the one windowing shuffle:
no joins, no per-feature passes, no ``withColumn`` loops.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourcast.functions import arrays as A
from hourcast.functions.scalar import cyclic, finite_or_null, radians, safe_ratio, weekday_mon0
from hourcast.spec import PanelSpec

# Which measures get compact summaries and which get a 24 h std.
COMPACT_OTHERS = ("temp", "pres", "dewp", "rain", "wspm", "pm10", "no2", "co", "o3")
COMPACT_STD = ("wspm", "temp")
ROLL_SIZES = (3, 6, 12, 24)
MEDIAN_SIZES = (6, 12, 24)
EWMA_ALPHAS = (0.2, 0.4, 0.6)
RAIN_SUM_SIZES = (3, 6, 24)


class Win:
    """Accessors on the window array column ``w`` of ``size`` elements.

    Per-measure value arrays are read from columns ``_a_<m>`` made once by
    :func:`with_arrays`; features reference them instead of re-running
    ``transform(w, ...)`` inside every expression (and Catalyst does not inline
    a non-trivial projection that is referenced many times)."""

    def __init__(self, size: int = 24, col: str = "w"):
        self.size = size
        self.w = F.col(col)

    def v(self, m: str) -> Column:
        return F.col(f"_a_{m}")

    def lag(self, m: str, k: int) -> Column:
        return A.lag(self.v(m), k, self.size)

    def last(self, m: str, k: int) -> Column:
        return A.tail(self.v(m), k, self.size)

    def sorted_last(self, m: str, k: int) -> Column:
        """Sorted non-NULL newest ``k`` values (column made by :func:`with_sorted`)."""
        return F.col(f"_s_{m}_{k}")


def with_arrays(windows: DataFrame, measures, col: str = "w") -> DataFrame:
    """Add one value array ``_a_<m>`` per measure (computed once per row)."""
    return windows.select("*", *[A.field(F.col(col), m).alias(f"_a_{m}") for m in measures])


def with_sorted(df: DataFrame, measures, sizes=MEDIAN_SIZES, size: int = 24) -> DataFrame:
    """Add ``_s_<m>_<k>``: sorted non-NULL newest-k values, one sort per
    (measure, k) shared by the median and quartiles (needs ``_a_<m>``)."""
    return df.select("*", *[F.array_sort(A.nonnull(A.tail(F.col(f"_a_{m}"), k, size))).alias(f"_s_{m}_{k}")
                            for m in measures for k in sizes])


def drop_arrays(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(("_a_", "_s_", "_t_"))])


def calendar_features(df: DataFrame, time: str = "window_end") -> list[Column]:
    """P4 + P5: hour, month, weekday (Mon=0), weekend flag, sin/cos of hour and month."""
    t = F.col(time)
    sh, ch = cyclic(F.hour(t), 24.0)
    sm, cm = cyclic(F.month(t), 12.0)
    return [
        F.hour(t).alias("hour"), F.month(t).alias("month"), weekday_mon0(t).alias("dayofweek"),
        weekday_mon0(t).isin(5, 6).cast("int").alias("is_weekend"),
        sh.alias("sin_hour"), ch.alias("cos_hour"), sm.alias("sin_month"), cm.alias("cos_month"),
    ]


def target_summary(win: Win, target: str = "pm25") -> list[Column]:
    """latest, mean 3/6/12/24, std 24/6/12 (ddof 1), min/max 24, trend."""
    out = [win.lag(target, 1).alias(f"{target}_latest")]
    out += [A.mean(win.last(target, k)).alias(f"{target}_mean_{k}h") for k in ROLL_SIZES]
    out += [A.std(win.last(target, k)).alias(f"{target}_std_{k}h") for k in (24, 6, 12)]
    out += [
        A.amin(win.v(target)).alias(f"{target}_min_24h"),
        A.amax(win.v(target)).alias(f"{target}_max_24h"),
        (win.lag(target, 1) - win.lag(target, win.size)).alias(f"{target}_trend_24h"),
    ]
    return out


def other_summary(win: Win, measures=COMPACT_OTHERS) -> list[Column]:
    """latest, mean 24 and trend 24 for the listed measures; std 24 for wind and temperature."""
    out = []
    for m in measures:
        out += [
            win.lag(m, 1).alias(f"{m}_latest"),
            A.mean(win.v(m)).alias(f"{m}_mean_24h"),
            (win.lag(m, 1) - win.lag(m, win.size)).alias(f"{m}_trend_24h"),
        ]
        if m in COMPACT_STD:
            out.append(A.std(win.v(m)).alias(f"{m}_std_24h"))
    return out


def compact_interactions(win: Win, have_mean: bool = True) -> list[Column]:
    """compact interactions from lags 1-3, lag 24 and the F1 means."""
    L = win.lag
    deg_rad = radians(F.col("wd_lag_1"))
    out = [
        safe_ratio(L("pm25", 1), L("pm10", 1)).alias("pm25_pm10_ratio_lag1"),
        safe_ratio(L("pm25", 1), L("wspm", 1)).alias("pm25_low_wind_lag1"),
        (L("pm25", 1) * L("wspm", 1)).alias("ventilation_proxy_lag1"),
        (L("pm25", 1) * L("rain", 1)).alias("pm25_rain_interaction_lag1"),
        (L("rain", 1) > 0).cast("int").alias("has_rain_lag1"),
        (L("temp", 1) - L("dewp", 1)).alias("temp_dewp_spread_lag1"),
        (L("pres", 1) - L("pres", win.size)).alias("pressure_change_24h"),
    ]
    if have_mean:
        m3, m24 = A.mean(win.last("pm25", 3)), A.mean(win.v("pm25"))
        out += [(m3 - m24).alias("pm25_short_vs_daily"), safe_ratio(m3, m24).alias("pm25_short_daily_ratio")]
    out += [
        (L("pm25", 1) - 2 * L("pm25", 2) + L("pm25", 3)).alias("pm25_acceleration_3h"),
        (L("wspm", 1) * F.sin(deg_rad)).alias("wind_u_lag1"),
        (L("wspm", 1) * F.cos(deg_rad)).alias("wind_v_lag1"),
        (L("pm25", 1) - L("pm25", 2)).alias("pm25_diff_1_2"),
        (L("pm25", 2) - L("pm25", 3)).alias("pm25_diff_2_3"),
        safe_ratio(L("o3", 1), L("no2", 1)).alias("o3_to_no2_ratio_lag1"),
        safe_ratio(L("so2", 1), L("no2", 1)).alias("so2_to_no2_ratio_lag1"),
        (L("temp", 1) - 2 * L("temp", 2) + L("temp", 3)).alias("temperature_acceleration_3h"),
        (L("wspm", 1) * L("wspm", 1)).alias("wspm_kinetic"),
    ]
    return out


def with_stats(df: DataFrame, measures, sizes=ROLL_SIZES, size: int = 24) -> DataFrame:
    """Add ``_t_<m>_<k>``: count, sum, running mean and squares of the newest k values, NULLs skipped, in one
    pass over the array for all that is derived from them (needs ``_a_<m>``)."""
    return df.select("*", *[F.expr(f"{A.sql_stats(A.sql_tail(f'_a_{m}', k, size))} AS _t_{m}_{k}") for m in measures for k in sizes])


def rich_rolling(win: Win, m: str) -> list[Column]:
    """F3-F7 for one measure: rolling mean/std/min/max over 3/6/12/24,
    medians 6/12/24, q25/q75 over 24, OLS slopes, deltas, acceleration, EWMA.

    Needs the columns of :func:`with_arrays`, :func:`with_sorted` and :func:`with_stats`; written as SQL text, as
    hundreds of features cost the driver more to put together call by call than the rows cost to compute."""
    a, n = f"_a_{m}", win.size
    lag = lambda k: f"get({a}, {n - k})"
    out = {f"{m}_latest": lag(1)}
    for k in ROLL_SIZES:
        part, t, p = A.sql_tail(a, k, n), f"_t_{m}_{k}", f"{m}_{k}h"
        out[f"{p}_mean"] = f"if({t}.n > 0, {t}.s / {t}.n, NULL)"
        out[f"{p}_std"] = f"if({t}.n > 1, sqrt({t}.m2 / ({t}.n - 1)), NULL)"
        out[f"{p}_min"], out[f"{p}_max"] = f"array_min({part})", f"array_max({part})"
        if k in MEDIAN_SIZES:
            out[f"{p}_median"] = A.sql_quantile(f"_s_{m}_{k}", 0.5)
        if k == n:
            out[f"{p}_q25"], out[f"{p}_q75"] = A.sql_quantile(f"_s_{m}_{k}", 0.25), A.sql_quantile(f"_s_{m}_{k}", 0.75)
        out[f"{p}_slope"] = A.sql_dot(part, A.slope_weights(k))
    out[f"{m}_delta_1h"], out[f"{m}_delta_3h"], out[f"{m}_delta_6h"] = (f"{lag(1)} - {lag(j)}" for j in (2, 4, 7))
    out[f"{m}_acceleration_3h"] = f"{lag(1)} - 2 * {lag(2)} + {lag(3)}"
    for alpha in EWMA_ALPHAS:
        out[f"{m}_ewma_a{str(alpha).replace('.', '')}"] = A.sql_dot(a, A.ewma_weights(alpha, n))
    return [F.expr(f"{e} AS {name}") for name, e in out.items()]


def rain_sums(win: Win) -> list[Column]:
    """F8: rolling rain sums over 3/6/24 (NULLs count as 0)."""
    return [A.nsum(win.last("rain", k)).alias(f"rain_sum_{k}h") for k in RAIN_SUM_SIZES]


def rich_interactions(win: Win, series: str = "station") -> list[Column]:
    """ratios, ventilation, low-wind and rain flags, spread, wind x/y
    (x = speed*cos, y = speed*sin, the opposite axes of F9's u/v), station x wind code."""
    L = win.lag
    rad = radians(F.col("wd_lag_1"))
    rain_flag = (L("rain", 1) > 0).cast("int")
    return [
        safe_ratio(L("pm25", 1), L("pm10", 1)).alias("pm25_pm10_ratio_lag1"),
        safe_ratio(L("pm25", 1), L("co", 1)).alias("pm25_co_ratio_lag1"),
        safe_ratio(L("no2", 1), L("o3", 1)).alias("no2_o3_ratio_lag1"),
        safe_ratio(L("so2", 1), L("no2", 1)).alias("so2_no2_ratio_lag1"),
        safe_ratio(L("pm25", 1), L("wspm", 1)).alias("pm25_low_wind_lag1"),
        safe_ratio(L("pm10", 1), L("wspm", 1)).alias("pm10_low_wind_lag1"),
        (L("pm25", 1) * L("wspm", 1)).alias("pm25_wind_ventilation_lag1"),
        (L("wspm", 1) <= 1.0).cast("int").alias("low_wind_flag_lag1"),
        L("rain", 1).alias("rain_last_1h"),
        rain_flag.alias("rain_flag_lag1"),
        (L("pm25", 1) * rain_flag).alias("pm25_rain_interaction_lag1"),
        (L("temp", 1) - L("dewp", 1)).alias("temp_dewp_spread_lag1"),
        (L("wspm", 1) * F.cos(rad)).alias("wind_x_lag1"),
        (L("wspm", 1) * F.sin(rad)).alias("wind_y_lag1"),
        F.concat_ws("_", F.col(series), F.col("wd_lag_1")).alias("station_wd_lag1"),
    ]


def wd_sincos(code: str = "wd_lag_1") -> list[Column]:
    """Unit vector of the wind direction."""
    r = radians(F.col(code))
    return [F.sin(r).alias("wd_sin"), F.cos(r).alias("wd_cos")]


def compact_frame(windows: DataFrame, spec: PanelSpec = PanelSpec(), size: int | None = None) -> DataFrame:
    """F12 (compact): F1 + F2 + P4 + P5 + F9 in one projection."""
    win = Win(size or spec.window)
    arr = with_arrays(windows, spec.numeric)
    return drop_arrays(arr.select(
        "*", *target_summary(win, spec.target), *other_summary(win), *calendar_features(windows),
        *compact_interactions(win),
    ))


def rich_frame(windows: DataFrame, spec: PanelSpec = PanelSpec(), size: int | None = None) -> DataFrame:
    """F12 (rich): P4 + P5 + F3-F8 + F10, then +/-inf and NaN -> NULL."""
    win = Win(size or spec.window)
    cols = [*calendar_features(windows)]
    for m in spec.numeric:
        cols += rich_rolling(win, m)
    cols += rain_sums(win) + rich_interactions(win, spec.series)
    arrays = with_sorted(with_arrays(windows, spec.numeric), spec.numeric, size=win.size)
    feats = drop_arrays(with_stats(arrays, spec.numeric, size=win.size).select("*", *cols))
    doubles = {f.name for f in feats.schema.fields if f.dataType.simpleString() == "double"}
    return feats.select(*[finite_or_null(c).alias(c) if c in doubles else F.col(c) for c in feats.columns])


def supplied_rolling_means(windows: DataFrame, size: int = 24, target: str = "pm25") -> DataFrame:
    """lag 1 and 2 h / 3 h means of the (interpolated) target lags."""
    win = Win(size)
    return drop_arrays(with_arrays(windows, [target]).select(
        "*", win.lag(target, 1).alias(f"{target}_lag1_value"),
        A.mean(win.last(target, 2)).alias(f"{target}_mean_2h"),
        A.mean(win.last(target, 3)).alias(f"{target}_mean_3h"),
    ))
