"""Cross-series ("city context") features at each window-end hour.

Per hour, statistics over all series are one grouped aggregation (algebraic:
count, sum, sum of squares, max), joined back on the hour.  A group never
needs its rows together in memory; AQE broadcasts the per-hour table when it
is small and splits skewed hours otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourcast.operators.features import Win, drop_arrays, with_arrays

# Fixed values: (measure, lags) aggregated across series at each hour.
CONTEXT_SPECS = {
    "pm25": (1, 2, 3, 6, 24),
    "pm10": (1,), "no2": (1,), "co": (1,), "o3": (1,), "wspm": (1,), "temp": (1,), "pres": (1,),
}

#: Values are summed as decimals of this type.
EXACT = "decimal(18,8)"


def city_context(windows: DataFrame, time: str = "window_end", specs=CONTEXT_SPECS, size: int = 24) -> DataFrame:
    """Same-hour statistics across series (no target-hour values used).

    Adds ``city_station_count`` and, per (measure, lag): mean, max, sample std
    (single series -> 0), leave-one-out mean ((sum - x)/(n-1), n=1 -> mean),
    deviations from both, plus 1 h deltas and the peak spread of PM2.5.

    Values are taken to 8 decimals and summed exactly, so that results do not
    depend on the order in which rows meet."""
    win = Win(size)
    vals = {f"{m}_lag_{k}": win.lag(m, k) for m, lags in specs.items() for k in lags}
    base = drop_arrays(with_arrays(windows, list(specs)).select("*", *[c.cast(EXACT).alias(f"_cv_{n}") for n, c in vals.items()]))
    aggs = [F.count("_cv_pm25_lag_1").cast("double").alias("city_station_count")]
    for n in vals:
        v = F.col(f"_cv_{n}")
        aggs += [F.count(v).cast("decimal(9,0)").alias(f"_n_{n}"), F.sum(v).alias(f"_s_{n}"),
                 F.max(v).alias(f"_x_{n}"), F.stddev_samp(v.cast("double")).alias(f"_sd_{n}")]
    per_hour = base.groupBy(time).agg(*aggs)
    j = base.join(per_hour, time)

    def ratio(numerator: Column, count: Column) -> Column:
        """Exact numerator over a count, divided once; NULL for a count of 0."""
        return F.try_divide(numerator.cast("double"), count.cast("double"))

    def parts(n: str) -> tuple[Column, Column, Column]:
        return F.col(f"_cv_{n}"), F.col(f"_n_{n}"), F.col(f"_s_{n}")

    out = []
    for m, lags in specs.items():
        for k in lags:
            n = f"{m}_lag_{k}"
            p = f"city_{m}_lag{k}"
            x, cnt, tot = parts(n)
            mean, alone = ratio(tot, cnt), cnt == 1
            out += [
                mean.alias(f"{p}_mean"), F.col(f"_x_{n}").cast("double").alias(f"{p}_max"),
                F.coalesce(F.col(f"_sd_{n}"), F.lit(0.0)).alias(f"{p}_std"),
                F.coalesce(ratio(tot - x, cnt - 1), mean).alias(f"{p}_other_mean"),
                ratio(x * cnt - tot, cnt).alias(f"{p}_station_minus_city"),
                F.when(alone, ratio(x - tot, cnt)).otherwise(F.coalesce(ratio(x * cnt - tot, cnt - 1), x.cast("double") - mean)).alias(f"{p}_station_minus_other"),
            ]
    res = j.select(*windows.columns, "city_station_count", *out)
    return res.select(
        "*",
        (F.col("city_pm25_lag1_mean") - F.col("city_pm25_lag2_mean")).alias("city_pm25_mean_delta_1h"),
        (F.col("city_pm25_lag1_other_mean") - F.col("city_pm25_lag2_other_mean")).alias("city_pm25_other_mean_delta_1h"),
        (F.col("city_pm25_lag1_max") - F.col("city_pm25_lag1_mean")).alias("city_pm25_peak_spread_lag1"),
    )
