"""Model operators as Spark ML jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourcast.functions.scalar import clip_nonneg


def station_codes(df: DataFrame, series: str = "station") -> DataFrame:
    """Index of each series in sorted distinct order, as a double.

    The distinct series are sorted in ranges; each range counts from the number of series before it, so
    no task ranks them all.  Only one count per range reaches the driver."""
    from hourcast.session import cut_lineage

    ranges = df.select(series).where(F.col(series).isNotNull()).distinct().repartitionByRange(series)
    d = cut_lineage(ranges.select(series, F.spark_partition_id().alias("_range")))
    before, at = 0, []
    for r in d.groupBy("_range").count().orderBy("_range").collect():
        at += [F.lit(r["_range"]), F.lit(before)]
        before += r["count"]
    if not at:
        return d.select(series, F.lit(0.0).alias("station_code"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(series)) - 1
    return d.select(series, (F.element_at(F.create_map(*at), F.col("_range")) + place).cast("double").alias("station_code"))


# --------------------------------------------------------------------------- feature matrices

from collections.abc import Sequence  # noqa: E402

from pyspark.ml import Pipeline  # noqa: E402
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler  # noqa: E402
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

ID_COLS = ("station", "window_end", "target_time", "y_true", "id", "target_pm25", "w", "model", "prediction")
CATEGORICAL = ("station", "wd_lag_1", "station_wd_lag1")


def feature_columns(df: DataFrame, exclude: Sequence[str] = ID_COLS) -> tuple[list[str], list[str]]:
    """numeric = numeric dtype minus ids / categoricals; categorical =
    the present subset of (station, wd_lag_1, station_wd_lag1).  Schema only."""
    cat = [c for c in CATEGORICAL if c in df.columns]
    num = [f.name for f in df.schema.fields
           if f.name not in set(exclude) | set(cat) and isinstance(f.dataType, T.NumericType)]
    return num, cat


#: Families of features by the first word of their names, and the calendar columns.
POLLUTION = ("pm25", "pm10", "so2", "no2", "co", "o3")
WEATHER = ("temp", "pres", "dewp", "rain", "wspm", "wind", "ventilation")
CALENDAR = ("hour", "month", "dayofweek", "is_weekend", "sin_hour", "cos_hour", "sin_month", "cos_month")
FEATURE_GROUPS = {
    "pollution_only": (POLLUTION, ()),
    "pollution_weather": (POLLUTION + WEATHER, ()),
    "pollution_weather_calendar": (POLLUTION + WEATHER, CALENDAR),
    "all_features": None,
}


def feature_group(numeric: Sequence[str], categorical: Sequence[str], group: str) -> tuple[list[str], list[str]]:
    """The columns of a feature group.  Families go by the word before the first ``_``;
    categoricals belong to ``all_features`` only."""
    if group not in FEATURE_GROUPS:
        raise ValueError(f"unknown feature group {group!r}; known: {sorted(FEATURE_GROUPS)}")
    if FEATURE_GROUPS[group] is None:
        return list(numeric), list(categorical)
    families, exact = FEATURE_GROUPS[group]
    return [c for c in numeric if c in exact or c.lower().replace(".", "").split("_")[0] in families], []


def scaler_stats(train: DataFrame, numeric: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Population mean / std of each numeric column on training rows (one aggregation)."""
    aggs = []
    for c in numeric:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
    r = train.agg(*aggs).first()
    return {c: (r[f"m_{c}"] or 0.0, r[f"s_{c}"] or 0.0) for c in numeric}


def varying(stats: dict) -> dict:
    """The columns that vary on the training rows; a constant one tells a model nothing and makes the normal
    equations of Ridge singular, which sends Spark to an iterative solver."""
    return {c: (m, s) for c, (m, s) in stats.items() if s > 0}


def scaled(df: DataFrame, stats: dict, keep: Sequence[str]) -> DataFrame:
    """(x - mean) / std (std 0 -> 1); missing -> 0 (= the training mean)."""
    cols = [F.coalesce((F.col(c) - F.lit(m)) / F.lit(s if s else 1.0), F.lit(0.0)).alias(c) for c, (m, s) in stats.items()]
    return df.select(*keep, *cols)


def encoder(categorical: Sequence[str], numeric: Sequence[str]) -> Pipeline:
    """StringIndexer(keep) -> OneHotEncoder(dropLast): unseen -> all zeros;
    then one feature vector."""
    cat = list(categorical)
    stages = []
    if cat:
        stages.append(StringIndexer(inputCols=cat, outputCols=[f"{c}_idx" for c in cat], handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=[f"{c}_idx" for c in cat], outputCols=[f"{c}_oh" for c in cat], dropLast=True))
    stages.append(VectorAssembler(inputCols=[*numeric, *[f"{c}_oh" for c in cat]], outputCol="features"))
    return Pipeline(stages=stages)


def ridge(train: DataFrame, alpha: float = 10.0, weight_col: str | None = None, label: str = "y_true") -> LinearRegression:
    """L2 regression with unpenalised intercept matching
    min ||y - Xw - b||^2 + alpha ||w||^2 (weighted variant with weightCol):
    regParam = alpha * sigma_y / sum(w) with population (weighted) sigma_y."""
    if weight_col:
        r = train.agg(F.sum(weight_col).alias("sw"), F.sum(F.col(weight_col) * F.col(label)).alias("swy"),
                      F.sum(F.col(weight_col) * F.col(label) * F.col(label)).alias("swyy")).first()
        mean = r["swy"] / r["sw"]
        sigma = max(r["swyy"] / r["sw"] - mean * mean, 0.0) ** 0.5
        n = r["sw"]
    else:
        r = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(label).alias("s")).first()
        sigma, n = r["s"] or 1.0, r["n"]
    lr = LinearRegression(featuresCol="features", labelCol=label, predictionCol="prediction", elasticNetParam=0.0,
                          regParam=alpha * sigma / n, standardization=False, solver="normal", fitIntercept=True)
    if weight_col:
        lr = lr.setWeightCol(weight_col)
    return lr


class Assembled:
    """Training rows and the rows to predict as feature vectors (R3), written once for any number of fits.

    The scaler and the encoder are fitted on ``train``; ``others`` names the frames to predict.  ``extra`` columns
    come along unscaled."""

    def __init__(self, train: DataFrame, others: dict[str, DataFrame], numeric: Sequence[str], categorical: Sequence[str],
                 keys: Sequence[str] = ("station", "window_end", "target_time", "y_true"), extra: Sequence[str] = ()):
        from hourcast.session import cut_lineage

        stats = varying(scaler_stats(train, numeric))
        self.numeric, self.categorical, self.keys = list(stats), list(categorical), list(keys)
        keep = list(dict.fromkeys([*keys, *categorical]))
        self.encoder = encoder(categorical, self.numeric).fit(scaled(train, stats, keep))

        def assembled(df: DataFrame) -> DataFrame:
            more = [c for c in extra if c in df.columns]
            rows = self.encoder.transform(scaled(df, stats, list(dict.fromkeys([*keep, *more]))))
            return cut_lineage(rows.select(*keys, *[c for c in extra if c in df.columns], "features"))

        self.others = {name: assembled(df) for name, df in others.items()}
        self.train = assembled(train)

    def predict(self, model, which: str, name: str, inverse_fn=None, clip: bool = True) -> DataFrame:
        """Long predictions of one of the frames."""
        p = F.col("prediction")
        p = inverse_fn(p) if inverse_fn else p
        return model.transform(self.others[which]).select(*self.keys, F.lit(name).alias("model"), (clip_nonneg(p) if clip else p).alias("prediction"))

    def ridges(self, which: str, forms: Sequence[str] = ("alpha10", "weighted_1_4", "weighted_2_8", "log1p", "boxcox")) -> DataFrame:
        """The Ridge (alpha 10) on each target form or weighting."""
        from hourcast.functions.scalar import severe_weights
        from hourcast.operators import calibrate as K

        preds = []
        for form in forms:
            rows, back, w = self.train, None, None
            if form.startswith("weighted_"):
                high, severe = map(float, form.split("_")[1:])
                rows, w = rows.withColumn("_w", severe_weights("y_true", high, severe)), "_w"
            elif form == "log1p":
                rows, back = rows.withColumn("y_true", F.log1p("y_true")), F.expm1
            elif form == "boxcox":
                fit = K.boxcox_fit(rows)
                rows, back = rows.withColumn("y_true", K.boxcox_transform("y_true", fit)), lambda p, fit=fit: K.boxcox_inverse(p, fit)
            preds.append(self.predict(ridge(rows, weight_col=w).fit(rows), which, f"ridge_{form}", back))
        out = preds[0]
        for p in preds[1:]:
            out = out.unionByName(p)
        return out


def random_forest(seed: int = 42, trees: int = 120, depth: int = 22) -> RandomForestRegressor:
    """Sqrt feature subsets, 0.75 row sample, min 3 rows per leaf."""
    return RandomForestRegressor(featuresCol="features", labelCol="y_true", numTrees=trees, maxDepth=depth,
                                 minInstancesPerNode=3, featureSubsetStrategy="sqrt", subsamplingRate=0.75, seed=seed)


def gradient_boosting(seed: int = 42, iters: int = 200, depth: int = 4, step: float = 0.1, stop_col: str | None = None,
                      tolerance: float = 0.01, weight_col: str | None = None) -> GBTRegressor:
    """Boosted trees with row / column sampling (a stand-in for the
    reference's boosting libraries; metric parity is not claimed).

    ``stop_col`` marks the training rows (true) that are held back: boosting ends once a tree no longer
    lowers their squared error by ``tolerance`` (relative), and the trees up to the best one are kept."""
    gbt = GBTRegressor(featuresCol="features", labelCol="y_true", maxIter=iters, maxDepth=depth, stepSize=step,
                       subsamplingRate=0.8, featureSubsetStrategy="0.8", minInstancesPerNode=3, seed=seed)
    if stop_col:
        gbt = gbt.setValidationIndicatorCol(stop_col).setParams(validationTol=tolerance)
    return gbt.setWeightCol(weight_col) if weight_col else gbt


def target_form(form: str, train: DataFrame):
    """``(transform, inverse, weight)`` of a target form: raw, log1p, boxcox (fitted on ``train``) or weighted
    (P15 weights 1 + 1[y >= 75] + 4[y >= 150]); None where nothing changes."""
    from hourcast.functions.scalar import severe_weights
    from hourcast.operators import calibrate as K

    if form == "boxcox":
        fit = K.boxcox_fit(train)
        return (lambda y: K.boxcox_transform(y, fit)), (lambda p: K.boxcox_inverse(p, fit)), None
    forms = {"raw": (None, None, None), "log1p": (F.log1p, F.expm1, None), "weighted": (None, None, severe_weights("y_true", 1.0, 4.0))}
    if form not in forms:
        raise ValueError(f"unknown target form {form!r}; known: {sorted([*forms, 'boxcox'])}")
    return forms[form]


def boosted_forms(rows: Assembled, which: str, stop_after, forms: Sequence[str] = ("raw", "log1p", "boxcox", "weighted"),
                  time: str = "window_end", prefix: str = "gradient_boosting", **params):
    """Boosted trees on each target form, early stopping on the training rows after the time ``stop_after``.
    Returns ``(predictions, trees used by model)``."""
    from hourcast.operators.splits import ts_lit

    preds, trees = [], {}
    for form in forms:
        forward, backward, weight = target_form(form, rows.train)
        tr = rows.train.select("*", (F.col(time) > ts_lit(stop_after)).alias("_stop"), (F.lit(1.0) if weight is None else weight).alias("_weight"))
        if forward:
            tr = tr.withColumn("y_true", forward(F.col("y_true")))
        model = gradient_boosting(stop_col="_stop", weight_col="_weight", **params).fit(tr)
        name = f"{prefix}_{form}"
        preds.append(rows.predict(model, which, name, backward))
        trees[name] = model.getNumTrees
    out = preds[0]
    for p in preds[1:]:
        out = out.unionByName(p)
    return out, trees


def fit_predict(estimator, train: DataFrame, valid: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                keys: Sequence[str] = ("station", "window_end", "target_time", "y_true"), name: str = "model",
                extra_train_cols: Sequence[str] = (), label_fn=None, inverse_fn=None, clip: bool = True):
    """Fit encoder + estimator on train (scaler statistics from train only),
    predict valid -> long predictions (clipped at 0).  Returns (preds, model, feature names)."""
    stats = varying(scaler_stats(train, numeric))
    numeric = list(stats)
    keep = list(dict.fromkeys([*keys, *categorical, *extra_train_cols]))
    tr = scaled(train, stats, keep)
    va = scaled(valid, stats, list(dict.fromkeys([*keys, *categorical])))
    if label_fn is not None:
        tr = tr.withColumn("y_true", label_fn(F.col("y_true")))
    enc = encoder(categorical, list(numeric)).fit(tr)
    model = estimator.fit(enc.transform(tr))
    out = model.transform(enc.transform(va))
    p = F.col("prediction")
    if inverse_fn is not None:
        p = inverse_fn(p)
    if clip:
        p = clip_nonneg(p)
    names = feature_names(enc, numeric, categorical)
    return out.select(*keys, F.lit(name).alias("model"), p.alias("prediction")), model, names


def feature_names(enc, numeric: Sequence[str], categorical: Sequence[str]) -> list[tuple[str, str]]:
    """(vector slot name, source column) for importances (one-hot levels map back to their column)."""
    out = [(c, c) for c in numeric]
    if categorical:
        si = enc.stages[0]
        for c, labels in zip(categorical, si.labelsArray):
            out += [(f"{c}={v}", c) for v in labels]  # dropLast removes the 'keep' bucket only
    return out


def feature_importance(model, names: list[tuple[str, str]], spark, name: str) -> DataFrame:
    """(model, feature, importance) summed back to source columns, sorted desc."""
    imp = model.featureImportances.toArray().tolist()
    agg: dict[str, float] = {}
    for (slot, src), v in zip(names, imp):
        agg[src] = agg.get(src, 0.0) + float(v)
    rows = sorted(agg.items(), key=lambda kv: (-kv[1], kv[0]))
    return spark.createDataFrame([(name, f, v) for f, v in rows], "model string, feature string, importance double")
