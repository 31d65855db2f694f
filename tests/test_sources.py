"""Station CSV source (S1), table loader (S3), prediction tables (S4), sinks."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

HEADER = "No,year,month,day,hour,PM2.5,PM10,SO2,NO2,CO,O3,TEMP,PRES,DEWP,RAIN,wd,WSPM,station"


def _write_station_files(root, n_files, hours=5):
    for s in range(n_files):
        with open(os.path.join(root, f"PRSA_Data_S{s:02d}.csv"), "w") as f:
            f.write(HEADER + "\n")
            for h in range(hours):
                pm = "NA" if h == 2 else str(10.0 + h)
                f.write(f"{h + 1},2013,3,1,{h},{pm},20,3,4,300,50,1.5,1020,-10,0,NNE,2.5,S{s:02d}\n")


def test_read_station_files(spark):
    from hourcast.sources.files import read_station_files

    root = tempfile.mkdtemp(dir=os.environ["HOURCAST_SCRATCH"])
    _write_station_files(root, 12)
    df = read_station_files(spark, os.path.join(root, "*.csv"), expected_files=12)
    assert df.count() == 60
    assert df.where(F.col("pm25").isNull()).count() == 12  # 'NA' -> NULL
    r = df.where("station = 'S00' AND hour = 3").first()
    assert str(r["datetime"]) == "2013-03-01 03:00:00" and r["pm25"] == 13.0


def test_read_station_files_count_guard(spark):
    from hourcast.sources.files import read_station_files

    root = tempfile.mkdtemp(dir=os.environ["HOURCAST_SCRATCH"])
    _write_station_files(root, 3)
    with pytest.raises(ValueError):
        read_station_files(spark, os.path.join(root, "*.csv"), expected_files=12)


def test_tables_predictions_and_sinks(spark):
    from hourcast.sources.files import read_prediction_table, read_tables, write_report

    root = tempfile.mkdtemp(dir=os.environ["HOURCAST_SCRATCH"])
    preds = spark.createDataFrame(
        [("S01", "2024-01-01 00:00:00", "2024-01-01 01:00:00", 5.0, 4.0)],
        "station string, window_end string, target_time string, y_true double, ridge float",
    )
    write_report(preds, os.path.join(root, "validation_predictions"))
    got = read_prediction_table(spark, os.path.join(root, "validation_predictions"), "saved")
    assert got.columns == ["station", "window_end", "target_time", "y_true", "saved_ridge"]
    assert dict(got.dtypes)["saved_ridge"] == "double"
    assert read_prediction_table(spark, os.path.join(root, "absent"), "x") is None
    write_report(preds, os.path.join(root, "train_raw.parquet"))
    assert set(read_tables(spark, root)) == {"train_raw"}
