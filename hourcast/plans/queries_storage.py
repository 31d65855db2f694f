"""Stored panel, sorted sinks and training tensors: written to the shared folder and read back."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.operators.models import scaler_stats, station_codes
from hourcast.operators.splits import ts_lit
from hourcast.operators.windows import SEQUENCE_EXTRA, sequence_rows, sequence_tensor, standardise_target
from hourcast.plans import oracle as O
from hourcast.plans.pipeline import once, panel_of, prepare
from hourcast.plans.queries_core import ALL, _panel_sql_select, _supplied, _supplied_sql
from hourcast.plans.registry import normalise, query
from hourcast.session import ensure_checkpoint_dir
from hourcast.sources.files import read_in_order, write_sorted, write_submission
from hourcast.sources.panel_table import PanelTable
from hourcast.spec import COMPASS_DEGREES, MEASURES

START, END = _dt.datetime(2024, 1, 20), _dt.datetime(2024, 2, 10, 23)


def scratch(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/hourcast/{name}-{uuid.uuid4().hex}"


def stored_panel(spark, sf_dir) -> PanelTable:
    """The imputed panel (raw target kept) as a stored table, opened again by its path."""
    def make():
        path = scratch(spark, "panel")
        PanelTable.create(prepare(spark, sf_dir).imputed, path, buckets=16).forget()
        return PanelTable.open(spark, path)

    return once(spark, ("stored", sf_dir), make)


@query("panel_table_slice", O.prelude() + f"\n{_panel_sql_select('imp')} WHERE datetime BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'")
def q_s2_table(spark, sf_dir):
    """S2 on the stored panel: only the months of the slice are read."""
    return normalise(stored_panel(spark, sf_dir).between(START, END).drop("pm25_raw"))


@query("panel_table_windows", O.prelude() + O.windows({"mean_24h": "avg(pm25) OVER f24", "oldest": O.lag("temp", 24)}) + f"""
SELECT station, window_end, target_time, round(y_true, 6) AS y_true, wd AS wd_lag_1, round(mean_24h, 6) AS mean_24h, round(oldest, 6) AS oldest
FROM win WHERE window_end BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'""")
def q_w3_table(spark, sf_dir):
    """W3 on the stored panel: windows without a shuffle, of the months of the slice."""
    w = stored_panel(spark, sf_dir).windows(START, END)
    mean = F.aggregate("w", F.lit(0.0), lambda a, x: a + x["pm25"]) / 24
    return normalise(w.select("station", "window_end", "target_time", "y_true", "wd_lag_1", mean.alias("mean_24h"), F.col("w")[0]["temp"].alias("oldest")))


@query("panel_export", O.prelude() + f"""
SELECT CAST(year(datetime) AS BIGINT) AS year, CAST(month(datetime) AS BIGINT) AS month, CAST(day(datetime) AS BIGINT) AS day,
  CAST(hour(datetime) AS BIGINT) AS hour, {ALL}, wd, station FROM imp WHERE datetime <= (SELECT cutoff FROM cut)""")
def q_export(spark, sf_dir):
    """S2 export up to the cutoff as CSV, without the derived time, read back."""
    path = scratch(spark, "export")
    stored_panel(spark, sf_dir).export(path, end=prepare(spark, sf_dir).cutoff, fmt="csv")
    back = spark.read.option("header", True).option("inferSchema", True).csv(path)
    return normalise(back.drop("pm25_raw"))


def _positions(df: DataFrame) -> DataFrame:
    """``df`` of :func:`read_in_order` with the row number over all its files (rows before each file from a count per file)."""
    spark = df.sparkSession
    df = df.select("*", F.struct("_file", "_block").alias("_part"))
    sizes = df.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), F.min("_line").alias("least")).orderBy("_part").collect()
    rows, before = [], 0
    for r in sizes:
        rows.append((r["_part"]["_file"], r["_part"]["_block"], before - r["least"]))
        before += r["n"]
    starts = spark.createDataFrame(rows, "_file string, _block long, _start long")
    return df.join(F.broadcast(starts), ["_file", "_block"]).withColumn("position", F.col("_line") + F.col("_start") + 1).drop("_part", "_start")


@query("sort_raw", O.prelude() + "\nSELECT row_number() OVER (ORDER BY station, datetime) AS position, station, datetime, round(pm25, 6) AS pm25 FROM panel")
def q_p3(spark, sf_dir):
    """The panel written in (station, time) order over several files; the row's place in the files."""
    path = scratch(spark, "sorted")
    write_sorted(panel_of(spark, sf_dir).select("station", "datetime", "pm25"), path, ["station", "datetime"], files=5)
    return normalise(_positions(read_in_order(spark, path)).select("position", "station", "datetime", "pm25"))


@query("submission_in_order", O.prelude() + _supplied_sql() + """
SELECT row_number() OVER (ORDER BY md5(id)) AS position, id, round(greatest(coalesce(pm25_lag_1, (SELECT quantile_cont(pm25_lag_1, 0.5) FROM sup)), 0), 6) AS pm25
FROM sup""")
def q_s6_order(spark, sf_dir):
    """A sample whose ids come in no sorted order, answered in that order; the row's place in the file."""
    from hourcast.sources.files import persistence_submission

    sample, answer = scratch(spark, "sample"), scratch(spark, "submission")
    sup = _supplied(prepare(spark, sf_dir)).select("id", "pm25_lag_1")
    write_sorted(sup.select("id", F.md5(F.col("id").cast("binary")).alias("o")), sample, ["o"], files=3, fmt="csv", drop=["o"])
    preds = persistence_submission(sup).withColumnRenamed("PM2.5", "prediction")
    write_submission(read_in_order(spark, sample, "csv"), preds, answer, files=4)
    back = _positions(read_in_order(spark, answer, "csv"))
    return normalise(back.select("position", "id", F.col("`PM2.5`").alias("pm25")))


# --------------------------------------------------------------------------- W14, W15

def sequences(spark, sf_dir) -> DataFrame:
    p = prepare(spark, sf_dir)
    rows = sequence_rows(p.imputed, station_codes(p.panel), p.spec)
    stats = scaler_stats(rows.where(F.col("datetime") <= ts_lit(p.cutoff)), [*MEASURES, *SEQUENCE_EXTRA])
    return sequence_tensor(rows, stats, p.spec)


def _sequence_sql() -> str:
    bearing = " ".join(f"WHEN '{c}' THEN {d}" for c, d in COMPASS_DEGREES.items())
    channels = [*MEASURES, *SEQUENCE_EXTRA]
    stats = ", ".join(f"avg({c}) FILTER (WHERE tr) AS m_{c}, coalesce(nullif(stddev_pop({c}) FILTER (WHERE tr), 0), 1) AS s_{c}" for c in channels)
    values = ", ".join(f"round(CAST(CAST((c.{c} - m_{c}) / s_{c} AS FLOAT) AS DOUBLE), 5) AS {c}" for c in channels)
    return O.prelude() + O.windows() + f""",
code AS (SELECT station, CAST(row_number() OVER (ORDER BY station) - 1 AS DOUBLE) AS station_code FROM (SELECT DISTINCT station FROM panel) d),
ch AS (SELECT imp.*, station_code, sin(2 * pi() * hour(datetime) / 24) AS sin_hour, cos(2 * pi() * hour(datetime) / 24) AS cos_hour,
  sin(2 * pi() * month(datetime) / 12) AS sin_month, cos(2 * pi() * month(datetime) / 12) AS cos_month,
  sin(radians(CASE wd {bearing} ELSE 0 END)) AS wd_sin, cos(radians(CASE wd {bearing} ELSE 0 END)) AS wd_cos,
  datetime <= (SELECT cutoff FROM cut) AS tr FROM imp JOIN code USING (station)),
st AS (SELECT {stats} FROM ch)
SELECT w.station, w.window_end, round(w.y_true, 6) AS y_true, datediff('hour', c.datetime, w.window_end) + 1 AS lag, {values}
FROM win w JOIN ch c ON c.station = w.station AND c.datetime BETWEEN w.window_end - INTERVAL 23 HOUR AND w.window_end, st"""


@query("sequence_tensor", _sequence_sql())
def q_w14(spark, sf_dir):
    """Standardised sequences of 24 steps x 18 channels, a row per window and step."""
    channels = [*MEASURES, *SEQUENCE_EXTRA]
    steps = sequences(spark, sf_dir).select("station", "window_end", "y_true", F.posexplode("seq").alias("i", "x"))
    return normalise(steps.select("station", "window_end", "y_true", (24 - F.col("i")).alias("lag"),
                                  *[F.round(F.col("x")[k].cast("double"), 5).alias(c) for k, c in enumerate(channels)]))


@query("target_standardise", O.prelude() + O.windows() + """,
k AS (SELECT avg(y_true) AS m, stddev_pop(y_true) AS s FROM win WHERE window_end <= (SELECT cutoff FROM cut))
SELECT station, window_end, round((y_true - m) / (s + 0.000001), 6) AS y_true_std FROM win, k""")
def q_w15(spark, sf_dir):
    """Targets standardised by the training windows' mean and population deviation."""
    p = prepare(spark, sf_dir)
    y = p.train_windows.agg(F.avg("y_true").alias("m"), F.stddev_pop("y_true").alias("s")).first()
    return normalise(standardise_target(p.windows.select("station", "window_end", "y_true"), y["m"], y["s"]).drop("y_true"))
