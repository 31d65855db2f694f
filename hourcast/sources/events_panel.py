"""Driver fixture: the ``events`` table turned into a regular station-hour panel.

Each (station, hour) cell aggregates the events of 1/12 of the users; a spine of
every station x every hour between the global first and last hour is left-joined
to the cells, so missing cells show up as NULL rows, like gaps in sensor data.

The same derivation is given as a DuckDB CTE (:data:`PANEL_CTE`) so every
oracle query starts from an identical panel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.spec import COMPASS_CODES

N_STATIONS = 12

# Measure <- event type whose mean value it takes.
TYPED_MEANS = {"so2": "view", "no2": "purchase", "co": "signup", "o3": "error", "dewp": "click"}


def _wd_from_code(code):
    """Code 0..15 -> compass code, 16 -> 'XX' (an unknown direction)."""
    codes = F.array(*[F.lit(c) for c in COMPASS_CODES], F.lit("XX"))
    return F.when(code.isNull(), F.lit(None).cast("string")).otherwise(F.element_at(codes, (code + 1).cast("int")))


def station_cells(events: DataFrame, n_stations: int = N_STATIONS) -> DataFrame:
    """Aggregate events to observed (station, hour) cells.

    One hash aggregation with map-side partial aggregates: a hot user or hot
    hour is combined inside each input task before the shuffle.
    """
    v = F.col("value")
    et = F.col("event_type")
    ts = F.col("ts")
    station = F.concat(F.lit("S"), F.lpad((F.col("user_id") % n_stations).cast("string"), 2, "0"))
    hour = F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), F.lit(0))
    aggs = [
        F.avg(v).alias("pm25"),
        F.max(v).alias("pm10"),
        *[F.avg(F.when(et == kind, v)).alias(m) for m, kind in TYPED_MEANS.items()],
        F.min(v).alias("temp"),
        F.count(F.lit(1)).cast("double").alias("pres"),
        F.sum(F.when(et == "click", v)).alias("rain"),
        (F.avg(v) / 10).alias("wspm"),
        F.min("event_id").alias("_wd_code"),
    ]
    cells = events.groupBy(station.alias("station"), hour.alias("datetime")).agg(*aggs)
    return cells.select(
        "station", "datetime", "pm25", "pm10", "so2", "no2", "co", "o3", "temp", "pres", "dewp", "rain", "wspm",
        _wd_from_code(F.col("_wd_code") % 17).alias("wd"),
    )


def hour_spine(cells: DataFrame, series: str = "station", time: str = "datetime") -> DataFrame:
    """Every series x every hour between the global first and last hour.

    Only the two bounds reach the driver; the distinct series table is exploded
    on the executors (no cross join).
    """
    lo, hi = cells.agg(F.min(time), F.max(time)).first()
    seq = F.sequence(
        F.expr(f"TIMESTAMP_NTZ '{lo}'"), F.expr(f"TIMESTAMP_NTZ '{hi}'"), F.expr("INTERVAL 1 HOUR")
    )
    return cells.select(series).distinct().select(series, F.explode(seq).alias(time))


def hourly_panel(spark: SparkSession, sf_dir: str, n_stations: int = N_STATIONS) -> DataFrame:
    """events.parquet -> regular (station, datetime) panel with NULL gaps.

    The aggregated cells (far smaller than the events) are materialised once
    with a reliable checkpoint, so the bounds, the distinct stations and the
    spine join read them instead of scanning the events three times."""
    from hourcast.session import cut_lineage

    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type", "value")
    cells = cut_lineage(station_cells(events, n_stations))
    return hour_spine(cells).join(cells, ["station", "datetime"], "left")


def _duck_wd(code: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(COMPASS_CODES))
    return f"CASE {code} {whens} WHEN 16 THEN 'XX' END"


# DuckDB form of ``hourly_panel`` (views ``cells`` and ``panel``).
PANEL_CTE = f"""
cells AS (
  SELECT 'S' || lpad(CAST(user_id % {N_STATIONS} AS VARCHAR), 2, '0') AS station,
         CAST(date_trunc('hour', ts) AS TIMESTAMP) AS datetime,
         avg(value) AS pm25,
         max(value) AS pm10,
         avg(value) FILTER (WHERE event_type = 'view') AS so2,
         avg(value) FILTER (WHERE event_type = 'purchase') AS no2,
         avg(value) FILTER (WHERE event_type = 'signup') AS co,
         avg(value) FILTER (WHERE event_type = 'error') AS o3,
         min(value) AS temp,
         CAST(count(*) AS DOUBLE) AS pres,
         avg(value) FILTER (WHERE event_type = 'click') AS dewp,
         sum(value) FILTER (WHERE event_type = 'click') AS rain,
         avg(value) / 10 AS wspm,
         min(event_id) % 17 AS wd_code
  FROM events GROUP BY 1, 2
),
spine AS (
  SELECT s.station, h.datetime
  FROM (SELECT DISTINCT station FROM cells) s,
       (SELECT unnest(generate_series(min(datetime), max(datetime), INTERVAL 1 HOUR)) AS datetime FROM cells) h
),
panel AS (
  SELECT spine.station, spine.datetime, c.pm25, c.pm10, c.so2, c.no2, c.co, c.o3, c.temp, c.pres, c.dewp,
         c.rain, c.wspm, {_duck_wd('c.wd_code')} AS wd
  FROM spine LEFT JOIN cells c ON c.station = spine.station AND c.datetime = spine.datetime
)"""
