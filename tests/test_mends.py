"""NULLs, ties and paths: cases in which values were once altered or lost."""

import numpy as np
import pytest
from pyspark.sql import functions as F


def test_clip_keeps_null(spark):
    from hourcast.functions.scalar import clip_nonneg
    from hourcast.operators.calibrate import apply_additive_correction, fixed_slope_calibration

    df = spark.createDataFrame([(None,), (-1.0,), (200.0,)], "p double")
    assert [r[0] for r in df.select(clip_nonneg("p")).collect()] == [None, 0.0, 200.0]
    assert [r[0] for r in df.select(apply_additive_correction("p", 150.0, 5.0, 0.1)).collect()] == [None, 0.0, 210.0]
    assert [r[0] for r in df.select(fixed_slope_calibration("p")).collect()] == [None, 0.0, 201.25]


def test_submission_raises_on_null_prediction(spark):
    from hourcast.sources.files import submission

    sample = spark.createDataFrame([("a",), ("b",)], "id string")
    preds = spark.createDataFrame([("a", 1.0), ("b", None)], "id string, prediction double")
    with pytest.raises(Exception, match="missing prediction"):
        submission(sample, preds).collect()


def test_quantile_of_tied_values_collects_nothing(spark):
    from hourcast.functions.quantiles import exact_quantiles

    rng = np.random.default_rng(3)
    x = np.where(rng.random(20_000) < 0.95, 0.0, rng.normal(size=20_000))
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    q = exact_quantiles(df, "v", [0.01, 0.5, 0.99], accuracy=100)
    assert "collect_list" not in q._jdf.queryExecution().optimizedPlan().toString()
    assert np.allclose(list(q.first())[1:], np.quantile(x, [0.01, 0.5, 0.99]))


def test_std_is_linear_and_right(spark):
    from hourcast.functions import arrays as A

    df = spark.createDataFrame([([1.0, None, 4.0, 4.5],), ([2.0],), ([],)], "a array<double>")
    got = [r[0] for r in df.select(A.std(F.col("a"))).collect()]
    assert got[0] == pytest.approx(np.std([1.0, 4.0, 4.5], ddof=1)) and got[1:] == [None, None]


def test_tables_are_found_by_uri(spark, tmp_path):
    from hourcast.sources.files import read_prediction_table, read_tables

    spark.range(3).write.parquet(f"file://{tmp_path}/panel.parquet")
    assert read_tables(spark, f"file://{tmp_path}", ["panel"])["panel"].count() == 3
    with pytest.raises(ValueError, match="key columns"):
        read_prediction_table(spark, f"file://{tmp_path}/panel.parquet", "x")
    assert read_prediction_table(spark, f"file://{tmp_path}/absent.parquet", "x") is None


def test_boxcox_raises_below_zero(spark):
    from hourcast.operators.calibrate import boxcox_fit

    with pytest.raises(Exception, match="above zero"):
        boxcox_fit(spark.createDataFrame([(-5.0,), (2.0,)], "y_true double"))


def test_holdout_uses_imputed_rows(spark):
    from hourcast.plans.registry import QUERIES

    assert QUERIES["holdout_tail"](spark, "/root/testdata/sf0.01").first()["validation_rows"] == 1726
