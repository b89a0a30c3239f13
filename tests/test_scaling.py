import math

import numpy as np
import pytest
from conftest import plan
from pyspark.sql import functions as F

from rowmill.operators import scaling
from rowmill.sources import artifacts

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@pytest.fixture
def items(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", *FEATURES)


def test_scaled_features_have_mean_0_and_population_std_1(items):
    scaled, _ = scaling.normalize_features(items, FEATURES)
    assert scaled.columns == items.columns
    found = scaled.agg(*[f(c).alias(f"{n}_{c}") for c in FEATURES
                         for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    for c in FEATURES:
        assert abs(found[f"m_{c}"]) < 1e-10
        assert found[f"s_{c}"] == pytest.approx(1.0)


def test_a_scaler_is_applied_without_refitting(items):
    low = items.where("l_quantity <= 25")
    high = items.where("l_quantity > 25")
    _, scaler = scaling.normalize_features(low, FEATURES)
    scaled, same = scaling.normalize_features(high, FEATURES, scaler, fit=False)
    assert same is scaler
    assert scaled.agg(F.min("l_quantity")).first()[0] > 1
    with pytest.raises(ValueError):
        scaling.normalize_features(high, FEATURES, fit=False)


def test_population_not_sample_deviation(spark):
    df = spark.createDataFrame([(float(i),) for i in range(4)], "x double")
    assert scaling.scaler_values(scaling.fit_scaler(df, ["x"]))["x"].std == pytest.approx(1.1180340)


def test_constant_missing_and_nan_cells(spark):
    df = spark.createDataFrame(
        [(0.1, 1.0, None), (0.1, None, None), (0.1, math.nan, None), (0.1, 3.0, None)],
        "flat double, gaps double, nothing double",
    )
    scaler = scaling.scaler_values(scaling.fit_scaler(df, df.columns))
    assert scaler["flat"] == (0.1, 1.0)
    assert scaler["gaps"] == (2.0, 1.0)
    assert scaler["nothing"] == (None, None)
    scaled = scaling.apply_scaler(df, scaler).collect()
    assert [r["flat"] for r in scaled] == [0.0] * 4
    assert scaled[0]["gaps"] == -1.0 and scaled[1]["gaps"] is None and math.isnan(scaled[2]["gaps"])
    assert all(r["nothing"] is None for r in scaled)
    # A constant feature is divided by 1 on new data too.
    fresh = spark.createDataFrame([(2.1, 1.0, 1.0)], df.schema)
    assert scaling.apply_scaler(fresh, scaler).first()["flat"] == pytest.approx(2.0)


def test_large_offsets_do_not_cancel(spark):
    values = [1e9 + v for v in (4.0, 7.0, 13.0, 16.0)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    assert scaling.scaler_values(scaling.fit_scaler(df, ["x"]))["x"].std == pytest.approx(
        np.std(values), rel=1e-9
    )


def test_scaling_needs_no_shuffle(items):
    scaler = scaling.scaler_values(scaling.fit_scaler(items, FEATURES))
    assert "Exchange" not in plan(scaling.apply_scaler(items, scaler))


def test_a_stored_scaler_is_the_same(spark, items, tmp_path):
    fitted = scaling.fit_scaler(items, FEATURES)
    artifacts.save_scaler(fitted, str(tmp_path / "s"))
    loaded = artifacts.load_scaler(spark, str(tmp_path / "s"))
    assert scaling.scaler_values(loaded) == scaling.scaler_values(fitted)


def test_a_scaler_for_other_columns_raises(items):
    with pytest.raises(ValueError, match="l_tax"):
        scaling.apply_scaler(items.drop("l_tax"), scaling.fit_scaler(items, FEATURES))


def test_parameters_join_the_long_form(spark):
    long = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "feature string, value double")
    params = spark.createDataFrame([("a", 2.0, 1.0), ("b", 5.0, 1.0)],
                                   "feature string, mean double, std double")
    found = scaling.apply_params(long, params)
    assert sorted((r["feature"], r["scaled"]) for r in found.collect()) == [
        ("a", -1.0), ("a", 1.0), ("b", 0.0)
    ]
