"""Stored panels, sorted sinks, submissions in order, training tensors."""

import datetime as dt
import glob
import json
import os

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from hourcast.spec import MEASURES, PanelSpec

T0 = dt.datetime(2023, 12, 20)


def panel(spark, hours=24 * 100, stations=("A", "B", "C"), seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for s in stations:
        for h in range(hours):
            if s == "B" and 500 <= h < 520 or s == "C" and h > 30:  # a gap, and a short series
                continue
            rows.append((s, T0 + dt.timedelta(hours=h), None if h % 97 == 5 else float(rng.normal(50, 9)), *rng.normal(5, 1, 10).tolist(), "NE" if h % 2 else None))
    cols = ", ".join(f"{m} double" for m in MEASURES)
    return spark.createDataFrame(rows, f"station string, datetime timestamp_ntz, {cols}, wd string")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    from hourcast.sources.panel_table import PanelTable

    df = panel(spark).cache()
    path = str(tmp_path_factory.mktemp("panel") / "p")
    table = PanelTable.create(df.repartition(40), path, buckets=4)  # more tasks than buckets
    return df, path, table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_one_file_per_month_and_bucket(stored):
    _, path, table = stored
    months = glob.glob(f"{path}/month=*")
    assert len(months) == 4 and all(len(glob.glob(f"{m}/*.parquet")) <= table.buckets for m in months)


def test_slice_reads_its_months_only(spark, stored):
    df, path, table = stored
    a, b = dt.datetime(2024, 1, 5), dt.datetime(2024, 2, 3, 7)
    got = table.between(a, b)
    assert rows_of(got) == rows_of(df.where(F.col("datetime").between(F.lit(a).cast("timestamp_ntz"), F.lit(b).cast("timestamp_ntz"))))
    text = plan(got)
    assert "PartitionFilters: [" in text and "month" in text.split("PartitionFilters: [")[1].split("]")[0]
    files = {r[0].split("month=")[1][:6] for r in table.stored(a, b).select(F.input_file_name()).distinct().collect()}
    assert files == {"202401", "202402"} and rows_of(table.between()) == rows_of(df)


def test_windows_of_a_stored_panel_do_not_shuffle(stored):
    from hourcast.operators.windows import build_windows

    df, _, table = stored
    got = table.windows()
    assert "Exchange" not in plan(got) and "Window" in plan(got)
    want = build_windows(df, PanelSpec(chunk_hours=None))
    assert rows_of(got) == rows_of(want) and got.count() > 3000
    a, b = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 31, 23)  # window ends at the months' edges
    inside = F.col("window_end").between(F.lit(a).cast("timestamp_ntz"), F.lit(b).cast("timestamp_ntz"))
    assert rows_of(table.windows(a, b)) == rows_of(want.where(inside))
    assert rows_of(table.windows(size=6)) == rows_of(build_windows(df, PanelSpec(chunk_hours=None), 6))
    with pytest.raises(ValueError, match="history"):
        table.windows(size=48)


def test_reopen_by_path(spark, stored):
    """In a session that knows nothing of the table but its path; nothing is lost or written."""
    from hourcast.sources.panel_table import PanelTable

    df, path, table = stored
    other = spark.newSession()
    again = PanelTable.open(other, path)
    assert (again.spec, again.buckets, again.back) == (table.spec, 4, 23) and again.name != table.name
    assert rows_of(again.between()) == rows_of(df) and "Exchange" not in plan(again.windows())
    again.forget()
    assert rows_of(PanelTable.open(spark, path).between()) == rows_of(df)
    with pytest.raises(FileExistsError):
        PanelTable.create(df, path)
    with pytest.raises(ValueError, match="chunk_hours"):
        PanelTable.create(df, path + "x", PanelSpec(chunk_hours=None))


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_export_round_trip(spark, stored, tmp_path, fmt):
    from hourcast.functions.scalar import make_hour_ts

    df, _, table = stored
    end = dt.datetime(2024, 1, 9, 23)
    table.export(str(tmp_path / "out"), end=end, fmt=fmt)
    back = spark.read.parquet(str(tmp_path / "out")) if fmt == "parquet" else (
        spark.read.schema(spark.read.option("header", True).option("inferSchema", True).csv(str(tmp_path / "out")).schema).option("header", True).csv(str(tmp_path / "out")))
    assert "datetime" not in back.columns and back.columns[:4] == ["year", "month", "day", "hour"]
    again = back.withColumn("datetime", make_hour_ts("year", "month", "day", "hour")).select(df.columns)
    assert rows_of(again) == rows_of(df.where(F.col("datetime") <= F.lit(end).cast("timestamp_ntz")))


def test_sorted_sink(spark, tmp_path):
    from hourcast.sources.files import write_sorted

    rng = np.random.default_rng(1)
    values = [(int(a), None if b == 3 else int(b)) for a, b in rng.integers(0, 30, (2000, 2))]
    write_sorted(spark.createDataFrame(values, "a int, b int").repartition(9), str(tmp_path / "s"), ["a", "b"], files=5)
    files = sorted(glob.glob(str(tmp_path / "s" / "*.parquet")))
    got = [(r["a"], r["b"]) for f in files for r in pq.read_table(f).to_pylist()]
    assert len(files) == 5 and got == sorted(values, key=lambda r: (r[0], r[1] is not None, r[1] or 0))


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_submission_keeps_the_order_of_the_sample(spark, tmp_path, fmt):
    from hourcast.sources.files import read_in_order, write_submission

    ids = [f"id_{i * 7919 % 3001}" for i in range(3000)]
    sample = str(tmp_path / "sample")
    os.makedirs(sample)
    for k in range(3):  # several files, and several blocks a file
        part = ids[k * 1000:(k + 1) * 1000]
        if fmt == "csv":
            with open(f"{sample}/part-{k}.csv", "w") as f:
                f.write("id\n" + "\n".join(part) + "\n")
        else:
            import pyarrow as pa

            pq.write_table(pa.table({"id": part}), f"{sample}/part-{k}.parquet", row_group_size=100)
    preds = spark.createDataFrame([(x, float(i) - 1) for i, x in enumerate(sorted(ids))], "id string, prediction double")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        write_submission(read_in_order(spark, sample, fmt), preds, str(tmp_path / "out"), files=4, expected_rows=3000)
        with pytest.raises(ValueError, match="expected 5"):
            write_submission(read_in_order(spark, sample, fmt), preds, str(tmp_path / "bad"), expected_rows=5)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    lines = [x for f in sorted(glob.glob(str(tmp_path / "out" / "*.csv"))) for x in open(f).read().split("\n")[1:] if x]
    assert [x.split(",")[0] for x in lines] == ids and lines[0].split(",")[1] == str(max(0.0, sorted(ids).index(ids[0]) - 1.0))


def test_prediction_table_with_text(spark):
    from hourcast.sources.files import prefix_models

    df = spark.createDataFrame([("A", "2024-01-01 05:00:00", "2024-01-01 06:00:00", 1.0, 2, "note")],
                               "station string, window_end string, target_time string, y_true double, ridge int, notes string")
    out = prefix_models(df, "saved")
    assert out.columns == ["station", "window_end", "target_time", "y_true", "saved_ridge"]
    assert out.first().target_time == dt.datetime(2024, 1, 1, 6) and out.first().saved_ridge == 2.0


def test_station_codes_by_ranges(spark):
    from hourcast.operators.models import station_codes

    names = [f"s{i * 37 % 5000}" for i in range(5000)] + ["s1", None]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.station: r.station_code for r in station_codes(spark.createDataFrame([(n,) for n in names], "station string")).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == {n: float(i) for i, n in enumerate(sorted({n for n in names if n}))}
    assert station_codes(spark.createDataFrame([], "station string")).count() == 0


def test_tensor_sink(spark, tmp_path):
    from hourcast.operators.models import scaler_stats, station_codes
    from hourcast.operators.windows import SEQUENCE_EXTRA, sequence_rows, sequence_tensor, write_tensor

    df = panel(spark, hours=60, stations=("A", "B")).na.fill(0.0).na.fill("N")
    rows = sequence_rows(df, station_codes(df))
    stats = scaler_stats(rows, [*MEASURES, *SEQUENCE_EXTRA])
    tensor = sequence_tensor(rows, stats)
    write_tensor(tensor, str(tmp_path / "t"), files=2)
    shape = json.loads(spark.read.text(str(tmp_path / "t-shape")).first()[0])
    assert (shape["steps"], shape["width"]) == (24, 18) and shape["channels"] == [*MEASURES, *SEQUENCE_EXTRA]
    back = [r for f in sorted(glob.glob(str(tmp_path / "t" / "*.parquet"))) for r in pq.read_table(f).to_pylist()]
    assert len(back) == 2 * 36 and [(r["target_time"], r["station"]) for r in back] == sorted((r["target_time"], r["station"]) for r in back)
    pdf = rows.toPandas().sort_values(["station", "datetime"])
    for r in (back[0], back[-1]):
        w = pdf[(pdf.station == r["station"]) & (pdf.datetime <= r["window_end"])].tail(24)
        want = np.array([(w[c] - stats[c][0]) / (stats[c][1] or 1) for c in shape["channels"]]).T
        assert np.allclose(np.array(r["x"]).reshape(24, 18), want, atol=1e-5) and r["window_end"] + dt.timedelta(hours=1) == r["target_time"]
