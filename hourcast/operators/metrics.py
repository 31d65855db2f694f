"""Error metrics and report tables over the long prediction table
``(station, window_end, target_time, y_true, model, prediction)``.

All metrics are algebraic aggregates (sums of errors, squares, counts), so a
model or station holding a third of the rows is combined map-side before the
shuffle.  Quantiles use the bounded exact form in ``functions.quantiles``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.functions.quantiles import exact_quantiles
from hourcast.functions.scalar import band, clip_nonneg

SEVERE = 150.0


def _err():
    return F.col("prediction") - F.col("y_true")


def rmse(err=None):
    e = _err() if err is None else err
    return F.sqrt(F.avg(e * e))


def mae(err=None):
    e = _err() if err is None else err
    return F.avg(F.abs(e))


def predictions_long(windows: DataFrame, models: dict, keys=("station", "window_end", "target_time", "y_true")) -> DataFrame:
    """Wide model expressions -> long (keys..., model, prediction) via one
    ``stack``-style explode (narrow, no shuffle)."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(name).alias("model"), expr.cast("double").alias("prediction")) for name, expr in models.items()
    ])).alias("_mp")
    return windows.select(*keys, pairs).select(*keys, "_mp.model", "_mp.prediction")


def rmse_mae(preds: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """A1: rows, rmse, mae per model (or other grouping)."""
    return preds.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), rmse().alias("rmse"), mae().alias("mae")
    )


def severe_score(preds: DataFrame, by: Sequence[str] = ("model",), clip: bool = True,
                 with_bias: bool = False) -> DataFrame:
    """A2/A3: (clipped) rmse, mae and severe-band (y > 150) rmse/mae/bias,
    NULL when the band is empty; ``with_bias`` adds the overall bias (A3)."""
    p = clip_nonneg("prediction") if clip else F.col("prediction")
    e = p - F.col("y_true")
    sev = F.col("y_true") > SEVERE
    es = F.when(sev, e)
    aggs = [
        F.count(F.lit(1)).alias("rows"),
        rmse(e).alias("rmse"),
        mae(e).alias("mae"),
        F.sqrt(F.avg(es * es)).alias("severe_rmse"),
        F.avg(F.abs(es)).alias("severe_mae"),
        F.avg(es).alias("severe_bias"),
    ]
    if with_bias:
        aggs.append(F.avg(e).alias("bias"))
    return preds.groupBy(*by).agg(*aggs)


def station_metrics(preds: DataFrame, series: str = "station") -> DataFrame:
    """Per (model, station): rows, rmse, mae, bias."""
    return preds.groupBy("model", series).agg(
        F.count(F.lit(1)).alias("rows"), rmse().alias("rmse"), mae().alias("mae"), F.avg(_err()).alias("bias")
    )


def band_metrics(preds: DataFrame) -> DataFrame:
    """Per (model, right-closed y band): rows, rmse, mae, bias; only
    observed bands appear."""
    return preds.withColumn("pm25_band", band("y_true")).groupBy("model", "pm25_band").agg(
        F.count(F.lit(1)).alias("rows"), rmse().alias("rmse"), mae().alias("mae"), F.avg(_err()).alias("bias")
    )


def residual_summary(preds: DataFrame) -> DataFrame:
    """residual = prediction - y: mean, sample std, p05/p50/p95 (linear),
    share of under-predictions."""
    r = preds.select("model", _err().alias("r"))
    base = r.groupBy("model").agg(
        F.avg("r").alias("bias_mean"), F.stddev_samp("r").alias("residual_std"),
        F.avg((F.col("r") < 0).cast("double")).alias("underprediction_rate"),
    )
    q = exact_quantiles(r, "r", [0.05, 0.5, 0.95], by=["model"])
    return base.join(q.select("model", F.col("q0").alias("p05"), F.col("q1").alias("p50"), F.col("q2").alias("p95")), "model")


def prediction_summary(preds: DataFrame) -> DataFrame:
    """Per model rows, mean, population std, min, max of predictions."""
    return preds.groupBy("model").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("prediction").alias("mean"),
        F.stddev_pop("prediction").alias("std"), F.min("prediction").alias("min"), F.max("prediction").alias("max"),
    )


def eda_summary(panel: DataFrame, target: str = "pm25", series: str = "station", time: str = "datetime") -> DataFrame:
    """A10: tall (metric, value) table: rows, columns, stations, year range and
    target missing count / mean / median / sample std."""
    one = panel.agg(
        F.count(F.lit(1)).cast("double").alias("rows"),
        F.count_distinct(series).cast("double").alias("stations"),
        F.min(F.year(time)).cast("double").alias("year_min"),
        F.max(F.year(time)).cast("double").alias("year_max"),
        F.count_if(F.col(target).isNull()).cast("double").alias("pm25_missing"),
        F.avg(target).alias("pm25_mean"),
        F.stddev_samp(target).alias("pm25_std"),
    )
    med = exact_quantiles(panel, target, [0.5]).select(F.col("q0").alias("pm25_median"))
    row = one.first().asDict()
    row["pm25_median"] = med.first()["pm25_median"]
    row["columns"] = float(len(panel.columns))
    order = ["rows", "columns", "stations", "year_min", "year_max", "pm25_missing", "pm25_mean", "pm25_median", "pm25_std"]
    return panel.sparkSession.createDataFrame([(k, row[k]) for k in order], "metric string, value double")


def missing_values(df: DataFrame) -> DataFrame:
    """Per column NULL count and fraction (one aggregation, then unpivot)."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = agg.select("_n", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("missing_count")) for c in cols
    ])).alias("kv")).select("kv.column", "kv.missing_count", (F.col("kv.missing_count") / F.col("_n")).alias("missing_fraction"))
    return long


def rank_models(metrics: DataFrame, k: int | None = None, score: str = "rmse", scope: Sequence[str] = ()) -> DataFrame:
    """Rank by score within scope (NULL scores last, ties by model name);
    keep the top ``k`` per scope."""
    from pyspark.sql import Window

    w = Window.partitionBy(*scope).orderBy(F.col(score).asc_nulls_last(), F.col("model"))
    out = metrics.withColumn("rank", F.row_number().over(w))
    return out.where(F.col("rank") <= k) if k else out


def submission_diff(new: DataFrame, ref: DataFrame, id_col: str = "id", value: str = "prediction") -> DataFrame:
    """Rows, changed rows, mean / max absolute difference, rows missing
    on either side, and summary stats of both submissions."""
    j = new.select(id_col, F.col(value).alias("a")).join(ref.select(id_col, F.col(value).alias("b")), id_col, "full")
    d = F.abs(F.col("a") - F.col("b"))
    return j.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(d > 1e-9).alias("changed_rows"),
        F.avg(d).alias("mean_abs_diff"),
        F.max(d).alias("max_abs_diff"),
        F.count_if(F.col("a").isNull()).alias("missing_new"),
        F.count_if(F.col("b").isNull()).alias("missing_ref"),
        F.avg("a").alias("mean_new"), F.avg("b").alias("mean_ref"),
        F.min("a").alias("min_new"), F.max("a").alias("max_new"),
    )
