"""The panel as a stored table: partitioned by month, bucketed for window operators.

Rows are written into the time buckets of :mod:`hourcast.operators.windows`, the few rows
that a neighbouring bucket needs written to both, and the table is bucketed and sorted by
a hash of (series, time bucket).  So a slice reads the months it covers and nothing
else, and every window operator runs on the table as it lies, without a shuffle; a series of a
third of all rows is spread over as many buckets as it has time buckets.

One file per (month, bucket) is written, whatever the number of tasks.
"""

from __future__ import annotations

import dataclasses
import datetime as _dt
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.operators.splits import ts_lit
from hourcast.operators.windows import bucketed, build_windows
from hourcast.sources.files import matches
from hourcast.spec import PanelSpec

HELPERS = ("_part", "_home", "_cell", "month")


def month_of(t: Column) -> Column:
    return F.year(t) * 100 + F.month(t)


def month_number(t: _dt.datetime) -> int:
    return t.year * 100 + t.month


class PanelTable:
    """A stored panel.  ``create`` writes one, ``open`` finds one by its path in a later session."""

    def __init__(self, spark: SparkSession, path: str, spec: PanelSpec, buckets: int, back: int, forward: int, name: str):
        self.spark, self.path, self.spec, self.buckets, self.back, self.forward, self.name = spark, path, spec, buckets, back, forward, name

    @classmethod
    def create(cls, df: DataFrame, path: str, spec: PanelSpec = PanelSpec(), buckets: int = 64, back: int = 23, forward: int = 1) -> PanelTable:
        """Write ``df``; windows of up to ``back + 1`` rows with a target up to ``forward`` rows ahead will not shuffle."""
        if matches(df.sparkSession, path):
            raise FileExistsError(f"{path} exists; open it instead")
        if not spec.chunk_hours:
            raise ValueError("a stored panel needs time buckets (chunk_hours)")
        table = cls(df.sparkSession, path, spec, buckets, back, forward, f"panel_{uuid.uuid4().hex}")
        rows, _ = bucketed(df, spec, back, forward)
        rows = rows.drop("_chunk").withColumns({"_cell": F.xxhash64(spec.series, "_part"), "month": month_of(F.col(spec.time))})
        bucket = F.pmod(F.hash("_cell"), F.lit(buckets))  # as the writer deals rows over buckets
        (
            rows.repartition("month", bucket).sortWithinPartitions("month", bucket, "_cell", spec.time)
            .write.partitionBy("month").bucketBy(buckets, "_cell").sortBy("_cell", spec.time).option("path", path).saveAsTable(table.name)
        )
        meta = json.dumps({"spec": dataclasses.asdict(spec), "buckets": buckets, "back": back, "forward": forward,
                           "schema": rows.drop("month").schema.simpleString()[len("struct<"):-1]})
        df.sparkSession.createDataFrame([(meta,)], "value string").coalesce(1).write.text(f"{path}-spec")
        return table

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> PanelTable:
        meta = json.loads(spark.read.text(f"{path}-spec").first()[0])
        spec = PanelSpec(**{k: tuple(v) if isinstance(v, list) else v for k, v in meta["spec"].items()})
        table = cls(spark, path, spec, meta["buckets"], meta["back"], meta["forward"], f"panel_{uuid.uuid4().hex}")
        columns = ", ".join(f"`{n}` {t}" for n, t in (x.split(":", 1) for x in meta["schema"].split(",")))
        spark.sql(
            f"CREATE TABLE {table.name} ({columns}, month INT) USING parquet PARTITIONED BY (month) "
            f"CLUSTERED BY (_cell) SORTED BY (_cell, {spec.time}) INTO {table.buckets} BUCKETS LOCATION '{path}'"
        )
        spark.sql(f"MSCK REPAIR TABLE {table.name}")
        return table

    def forget(self) -> None:
        """Take the table out of the catalog; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def stored(self, start: _dt.datetime | None = None, end: _dt.datetime | None = None) -> DataFrame:
        """The rows as they lie, copies included, of the months from ``start`` to ``end``."""
        df = self.spark.table(self.name)
        if start is not None:
            df = df.where(F.col("month") >= month_number(start))
        return df if end is None else df.where(F.col("month") <= month_number(end))

    def between(self, start: _dt.datetime | None = None, end: _dt.datetime | None = None) -> DataFrame:
        """The panel's rows with start <= time <= end; only the months in between are read."""
        df, t = self.stored(start, end).where("_home"), F.col(self.spec.time)
        if start is not None:
            df = df.where(t >= ts_lit(start))
        if end is not None:
            df = df.where(t <= ts_lit(end))
        return df.drop(*HELPERS)

    def windows(self, start: _dt.datetime | None = None, end: _dt.datetime | None = None, size: int | None = None, **options) -> DataFrame:
        """W3/W4 for window ends from ``start`` to ``end``, without a shuffle."""
        size = size or self.spec.window
        if size - 1 > self.back or self.forward < 1:
            raise ValueError(f"the table keeps {self.back} rows of history a bucket; windows of {size} need {size - 1}")
        first = None if start is None else start - _dt.timedelta(hours=size - 1)
        last = None if end is None else end + _dt.timedelta(hours=1)
        out = build_windows(self.stored(first, last), self.spec, size, **options)
        t = F.col("window_end")
        if start is not None:
            out = out.where(t >= ts_lit(start))
        return out if end is None else out.where(t <= ts_lit(end))

    def export(self, path: str, start: _dt.datetime | None = None, end: _dt.datetime | None = None, fmt: str = "parquet") -> None:
        """A slice with year, month, day and hour instead of the derived time, sorted by series and time."""
        from hourcast.sources.files import write_sorted

        t, s = F.col(self.spec.time), self.spec.series
        df = self.between(start, end)
        parts = [F.year(t).alias("year"), F.month(t).alias("month"), F.dayofmonth(t).alias("day"), F.hour(t).alias("hour")]
        rest = [c for c in df.columns if c not in (self.spec.time, s)]
        write_sorted(df.select(*parts, *rest, s), path, [s, "year", "month", "day", "hour"], fmt=fmt)
