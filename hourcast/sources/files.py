"""File sources and sinks: station CSVs, known tables, prediction tables,
report tables and submissions."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourcast.functions.scalar import clip_nonneg, make_hour_ts
from hourcast.spec import MEASURES

# Column names of the station CSV files and our snake-case names.
CSV_COLUMNS = {
    "No": "no", "year": "year", "month": "month", "day": "day", "hour": "hour",
    "PM2.5": "pm25", "PM10": "pm10", "SO2": "so2", "NO2": "no2", "CO": "co", "O3": "o3",
    "TEMP": "temp", "PRES": "pres", "DEWP": "dewp", "RAIN": "rain", "wd": "wd", "WSPM": "wspm", "station": "station",
}
KNOWN_TABLES = ("train_raw", "test", "sample_submission", "test_raw")


def station_csv_schema() -> T.StructType:
    fields = []
    for src, dst in CSV_COLUMNS.items():
        if dst in MEASURES:
            typ = T.DoubleType()
        elif dst in ("wd", "station"):
            typ = T.StringType()
        else:
            typ = T.IntegerType()
        fields.append(T.StructField(src, typ, True))
    return T.StructType(fields)


def matches(spark: SparkSession, pattern: str) -> list:
    """Paths that match ``pattern``, looked up in whatever file system it names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return list(fs.globStatus(path) or [])


def read_station_files(spark: SparkSession, pattern: str, expected_files: int | None = 12) -> DataFrame:
    """Read per-station CSVs with an explicit schema ('NA' -> NULL),
    rename to snake case and derive the hourly timestamp.  The file count is
    checked from the listing (driver metadata only)."""
    if expected_files is not None:
        found = len(matches(spark, pattern))
        if found != expected_files:
            raise ValueError(f"Expected {expected_files} station files, found {found}")
    df = (
        spark.read.schema(station_csv_schema()).option("header", True).option("enforceSchema", False)
        .option("mode", "FAILFAST").option("nullValue", "NA").csv(pattern)
    )
    df = df.select(*[F.col(f"`{s}`").alias(d) for s, d in CSV_COLUMNS.items()])
    return df.withColumn("datetime", make_hour_ts("year", "month", "day", "hour"))


def period_slice(df: DataFrame, start: str | None, end: str, time: str = "datetime") -> DataFrame:
    """Rows with time <= end, or in [start, end] (literal bounds -> pushdown; see ``PanelTable.between`` for
    a panel stored by month)."""
    t = F.col(time)
    hi = F.expr(f"TIMESTAMP_NTZ '{end}'")
    cond = t <= hi if start is None else t.between(F.expr(f"TIMESTAMP_NTZ '{start}'"), hi)
    return df.where(cond)


def read_tables(spark: SparkSession, root: str, names: Sequence[str] = KNOWN_TABLES) -> dict[str, DataFrame]:
    """S3: load whichever known tables exist under ``root`` (parquet dir or csv)."""
    out = {}
    for name in names:
        for ext, reader in (("parquet", spark.read.parquet), ("csv", lambda p: spark.read.option("header", True).option("nullValue", "NA").csv(p))):
            path = os.path.join(root, f"{name}.{ext}")
            if matches(spark, path):
                out[name] = reader(path)
                break
    return out


def read_prediction_table(spark: SparkSession, path: str, prefix: str,
                          keys: Sequence[str] = ("station", "window_end", "target_time", "y_true")) -> DataFrame | None:
    """Saved wide predictions; keys checked, model columns cast to double
    and prefixed.  None when the path does not exist."""
    if not matches(spark, path):
        return None
    df = spark.read.parquet(path)
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"Prediction table misses key columns {missing}")
    return prefix_models(df, prefix, keys)


def prefix_models(df: DataFrame, prefix: str, keys: Sequence[str] = ("station", "window_end", "target_time", "y_true")) -> DataFrame:
    """Keys, text times parsed, and every numeric column as ``<prefix>_<column>`` in doubles; other columns go."""
    parse = lambda k: F.to_timestamp_ntz(k).alias(k) if k in ("window_end", "target_time") and dict(df.dtypes)[k] == "string" else F.col(k)
    models = [f.name for f in df.schema.fields if f.name not in keys and isinstance(f.dataType, T.NumericType)]
    return df.select(*[parse(k) for k in keys], *[F.col(f"`{c}`").cast("double").alias(f"{prefix}_{c}") for c in models])


def write_sorted(df: DataFrame, path: str, by: Sequence[str], files: int | None = None, fmt: str = "parquet", drop: Sequence[str] = (),
                 mode: str = "overwrite") -> None:
    """Write ``df`` in the global order of ``by``: a range of keys per file, each file sorted, file names in order.
    Readers that take the files by name see one sorted table; ``drop`` names columns that only order it."""
    keys = [F.asc_nulls_first(c) for c in by]
    ranged = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    w = ranged.sortWithinPartitions(*keys).drop(*drop).write.mode(mode)
    (w.option("header", True) if fmt == "csv" else w).format(fmt).save(path)


def read_in_order(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """The table at ``path`` with ``_file``, ``_block`` and ``_line``, which order its rows as its files hold them
    (files by name, however they are split over tasks)."""
    reader = spark.read.options(**options)
    df = (reader.option("header", True).option("inferSchema", True) if fmt == "csv" else reader).format(fmt).load(path)
    return df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                     F.monotonically_increasing_id().alias("_line"))


ORDER = ("_file", "_block", "_line")


def write_submission(sample: DataFrame, preds: DataFrame, path: str, id_col: str = "id", value: str = "prediction",
                     expected_rows: int | None = None, files: int | None = 1, fmt: str = "csv") -> None:
    """The submission of ``sample`` (from :func:`read_in_order`) in the sample's own row order."""
    out = submission(sample.select(id_col, *ORDER), preds, id_col, value, expected_rows)
    write_sorted(out, path, ORDER, files, fmt, drop=ORDER)


def write_report(df: DataFrame, path: str, partition_by: Sequence[str] = (), csv: bool = False) -> None:
    """Write a report / prediction table (parquet, optionally CSV too)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    if csv:
        df.write.mode("overwrite").option("header", True).csv(path + "_csv")


def submission(sample: DataFrame, preds: DataFrame, id_col: str = "id", value: str = "prediction",
               expected_rows: int | None = None) -> DataFrame:
    """Sample ids left-joined to clipped predictions; the caller's order
    column (if any) is kept; missing predictions raise at execution."""
    j = sample.join(preds.select(id_col, clip_nonneg(value).alias("PM2.5")), id_col, "left")
    p = F.col("`PM2.5`")
    checked = j.select(*[c for c in sample.columns], F.when(
        p.isNull(), F.raise_error(F.concat(F.lit("missing prediction for id "), F.col(id_col))).cast("double")
    ).otherwise(p).alias("PM2.5"))
    if expected_rows is not None:
        n = sample.count()
        if n != expected_rows:
            raise ValueError(f"submission has {n} rows, expected {expected_rows}")
    return checked


def persistence_submission(supplied: DataFrame, lag_col: str = "pm25_lag_1") -> DataFrame:
    """Id + latest target lag; a missing lag takes the median of the lags
    (exact, bounded-memory quantile; one literal)."""
    from hourcast.functions.quantiles import exact_quantiles

    med = exact_quantiles(supplied, lag_col, [0.5]).first()["q0"]
    return supplied.select("id", F.coalesce(F.col(lag_col), F.lit(med).cast("double")).alias("PM2.5"))
