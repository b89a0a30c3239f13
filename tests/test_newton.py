"""The Newton solver: its optimum, its agreement with MLlib, damping, saving."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowmill.operators import models
from rowmill.sources import artifacts

FEATURES = ["a", "b", "c"]
NEWTON = {"solver": "newton-cholesky", "tol": 1e-12}


@pytest.fixture(scope="module")
def table(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(
        F.col("event_id").alias("id"), F.log1p("value").alias("a"), (F.col("user_id") / 15).alias("b"),
        F.length("props").cast("double").alias("c"),
        F.when(F.log1p("value") + F.col("user_id") / 15 + F.rand(3) > 3.5, "yes").otherwise("no").alias("target"),
    ).cache()


def fit(df, **params):
    return models.train_model(df, FEATURES, "target", "id", "logistic_regression", {**NEWTON, **params})


@pytest.mark.parametrize("params", [{}, {"C": 0.01}, {"C": 100.0, "class_weight": {"yes": 3.0}},
                                    {"fit_intercept": False}, {"penalty": None}])
def test_gradient_vanishes(table, params):
    model = fit(table, **params)
    pdf = table.toPandas()
    x, y = pdf[FEATURES].to_numpy(), (pdf["target"] == "yes").to_numpy().astype(float)
    w, s = np.array(model.coefficients), np.where(y == 1, (params.get("class_weight") or {}).get("yes", 1.0), 1.0)
    p = 1 / (1 + np.exp(-(x @ w + model.intercept)))
    ridge = 0.0 if "penalty" in params else 1 / params.get("C", 1.0)
    assert np.abs(ridge * w + x.T @ (s * (p - y))).max() < 1e-5
    if params.get("fit_intercept", True):
        assert abs((s * (p - y)).sum()) < 1e-6
    else:
        assert model.intercept == 0.0


def test_agrees_with_the_other_solver(table):
    ours = models.score(fit(table), table).select("id", "y_pred", F.col("y_pred_proba").alias("p"))
    other = models.train_model(table, FEATURES, "target", "id", "logistic_regression", {"tol": 1e-12})
    both = ours.join(models.score(other, table).select("id", "y_pred_proba", F.col("y_pred").alias("q")), "id")
    found = both.agg(F.max(F.abs(F.col("p") - F.col("y_pred_proba"))), F.count_if(F.col("q") != F.col("y_pred"))).first()
    assert found[0] < 1e-4 and found[1] <= 1


def test_any_layout_gives_the_same_model(table):
    first = fit(table)
    again = fit(table.orderBy(F.desc("a")).repartition(5))
    assert np.allclose(first.coefficients, again.coefficients, rtol=1e-9, atol=1e-12)


def test_separated_classes_end(spark):
    """Without overlap the penalty alone bounds the coefficients; steps are damped."""
    rows = [(i, 1e3 * (1 if i % 2 else -1), 0.0, float(i % 3), "yes" if i % 2 else "no") for i in range(60)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, target string")
    model = fit(df, C=1e6)
    found = models.score(model, df).select("target", "y_pred", "y_pred_proba").collect()
    assert all(r["target"] == r["y_pred"] and 0 <= r["y_pred_proba"] <= 1 for r in found)


def test_saving(table, tmp_path):
    model = fit(table)
    path = str(tmp_path / "m")
    artifacts.save_model(model, path)
    artifacts.save_model(model, path)
    again = artifacts.load_model(path)
    assert again == model
    chances = models.predict_proba(again, table).select("y_proba").first()[0]
    assert len(chances) == 2 and sum(chances) == pytest.approx(1.0)


def test_what_it_cannot_do_raises(table):
    with pytest.raises(ValueError, match="two classes"):
        fit(table.withColumn("target", F.lit("one")))
    with pytest.raises(ValueError, match="takes the penalty"):
        fit(table, penalty="l1")
    with pytest.raises(ValueError, match="unknown solver"):
        fit(table, solver="saga")
    with pytest.raises(Exception, match="missing"):
        fit(table.withColumn("a", F.when(F.col("id") > 5, F.col("a"))))
    with pytest.raises(Exception, match="missing"):
        models.score(fit(table), table.withColumn("a", F.lit(None).cast("double"))).collect()
