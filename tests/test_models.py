import numpy as np
import pytest
from pyspark.ml.linalg import DenseVector
from pyspark.sql import functions as F

from rowmill.operators import models
from rowmill.sources import artifacts

FEATURES = ["a", "b", "c"]
SMALL = {"n_estimators": 10, "max_depth": 4}


@pytest.fixture(scope="module")
def table(spark, sf_dir):
    """Three features of the events; the target follows two of them."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(
        F.col("event_id").alias("id"),
        F.log1p("value").alias("a"),
        (F.col("user_id") / 15).alias("b"),
        F.length("props").cast("double").alias("c"),
        (F.log1p("value") + F.col("user_id") / 15 > 3.5).cast("int").alias("target"),
    ).cache()


def labels(model, df):
    return {r["id"]: r["y_pred"] for r in models.predict(model, df).collect()}


@pytest.mark.parametrize("algorithm,params", [("random_forest", SMALL), ("logistic_regression", {})])
def test_predictions_probabilities_and_accuracy(table, algorithm, params):
    model = models.train_model(table, FEATURES, "target", "id", algorithm, params)
    scored = models.score(model, table)
    assert scored.columns == [*table.columns, "y_pred", "y_pred_proba"]
    assert scored.count() == table.count()
    found = scored.agg(
        F.avg((F.col("target") == F.col("y_pred")).cast("double")).alias("accuracy"),
        F.min("y_pred_proba").alias("low"),
        F.max("y_pred_proba").alias("high"),
        F.collect_set("y_pred").alias("labels"),
    ).first()
    assert found["accuracy"] > 0.9 and 0 <= found["low"] <= found["high"] <= 1
    assert set(found["labels"]) == {0, 1}
    both = models.predict_proba(model, table).select("y_proba").first()[0]
    assert sum(both) == pytest.approx(1.0)


def test_the_same_seed_gives_the_same_forest_in_any_layout(table):
    def fit(df, **params):
        model = models.train_model(df, FEATURES, "target", "id", params={**SMALL, **params})
        return {r["id"]: r["y_pred_proba"] for r in models.score(model, table).collect()}

    first = fit(table)
    assert first == fit(table.repartition(7))
    assert first == fit(table.orderBy(F.desc("a")).coalesce(1))
    assert first != fit(table, random_state=7)


def test_a_forest_does_not_depend_on_the_session(spark, table):
    found = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for number in ("8", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", number)
        model = models.train_model(table, FEATURES, "target", "id", params=SMALL)
        found.append({r["id"]: r["y_pred_proba"] for r in models.score(model, table).collect()})
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]


@pytest.mark.parametrize("algorithm", models.ALGORITHMS)
@pytest.mark.parametrize("kind", ["text", "number", "date"])
def test_any_label_comes_back(spark, tmp_path, table, algorithm, kind):
    low, high = {
        "text": (F.lit("it's \\ low"), F.lit("up")), "number": (F.lit(-3), F.lit(40)),
        "date": (F.lit("2020-01-01").cast("date"), F.lit("2021-01-01").cast("date")),
    }[kind]
    named = table.withColumn("target", F.when(F.col("target") == 1, high).otherwise(low))
    params = SMALL if algorithm == "random_forest" else None
    model = models.train_model(named, FEATURES, "target", "id", algorithm, params)
    model.write().overwrite().save(str(tmp_path / "m"))
    found = models.score(type(model).load(str(tmp_path / "m")), named)
    assert dict(found.dtypes)["y_pred"] == dict(named.dtypes)["target"]
    assert found.agg(F.avg((F.col("y_pred") == F.col("target")).cast("int"))).first()[0] > 0.9
    high_first = found.groupBy("target").agg(F.avg("y_pred_proba").alias("p")).orderBy("target")
    assert [r["p"] > 0.5 for r in high_first.collect()] == [False, True]


@pytest.mark.parametrize("algorithm", models.ALGORITHMS)
def test_class_weights_move_the_scores(table, algorithm):
    def mean(weight):
        params = {**(SMALL if algorithm == "random_forest" else {}), "class_weight": weight}
        model = models.train_model(table, FEATURES, "target", "id", algorithm, params)
        return models.score(model, table).agg(F.avg("y_pred_proba")).first()[0]

    assert mean({0: 20.0}) < mean(None) < mean({1: 20.0})
    with pytest.raises(ValueError, match="class_weight"):
        mean({"x": 2.0})
    counts = [r["n"] for r in models.class_table(table, "target").collect()]
    assert models.class_weights([0, 1], counts, "balanced") == [sum(counts) / 2 / n for n in counts]


def test_penalties(table):
    def coefficients(**params):
        model = models.train_model(table, FEATURES, "target", "id", "logistic_regression", params)
        return [float(c) for c in model.stages[1].coefficients]

    assert any(c == 0.0 for c in coefficients(penalty="l1", C=0.01))
    assert all(c != 0.0 for c in coefficients(penalty="elasticnet", l1_ratio=0.0))
    for wrong in ({"penalty": "elasticnet"}, {"penalty": "l3"}):
        with pytest.raises(ValueError):
            models.logistic_settings(10, wrong)


def test_regression_meets_its_optimum(table):
    """The gradient of |w|^2 / 2 + C * sum of losses vanishes."""
    c = 0.5
    model = models.train_model(table, FEATURES, "target", "id", "logistic_regression",
                               {"C": c, "tol": 1e-12})
    fitted = model.stages[1]
    pdf = table.toPandas()
    x, y = pdf[FEATURES].to_numpy(), pdf["target"].to_numpy()
    w = np.array(fitted.coefficients)
    p = 1 / (1 + np.exp(-(x @ w + fitted.intercept)))
    assert np.abs(w + c * x.T @ (p - y)).max() < 1e-3
    assert abs(c * (p - y).sum()) < 1e-3


def test_a_saved_model_predicts_the_same(table, tmp_path):
    model = models.train_model(table, FEATURES, "target", "id", params=SMALL)
    path = str(tmp_path / "deep" / "model")
    artifacts.save_model(model, path)
    artifacts.save_model(model, path)
    assert labels(artifacts.load_model(path), table) == labels(model, table)


def test_trees_are_available_on_demand(table):
    forest = models.train_model(table, FEATURES, "target", "id", params=SMALL).stages[1]
    assert len(forest.trees) == 10 and forest.trees[0].depth <= 4
    assert isinstance(forest.featureImportances.toArray(), np.ndarray)
    assert 0.0 <= forest.predict(DenseVector([0.0, 0.0, 1.0])) <= 1.0


def test_unknown_algorithm_is_rejected_before_reading(spark):
    with pytest.raises(ValueError, match="unknown algorithm"):
        models.train_model(None, FEATURES, "target", "id", "svm")


@pytest.mark.parametrize(
    "algorithm,params,error",
    [
        ("random_forest", {"max_depth": -1}, ValueError),
        ("random_forest", {"max_depth": 2.5}, ValueError),
        ("random_forest", {"min_samples_split": 1}, ValueError),
        ("random_forest", {"min_samples_split": 1.5}, ValueError),
        ("random_forest", {"min_samples_leaf": 0}, ValueError),
        ("random_forest", {"criterion": "other"}, ValueError),
        ("random_forest", {"C": 1.0}, TypeError),
        ("logistic_regression", {"solver": "saga"}, ValueError),
        ("logistic_regression", {"penalty": "l3"}, ValueError),
        ("logistic_regression", {"C": 0}, ValueError),
        ("logistic_regression", {"n_estimators": 5}, TypeError),
    ],
)
def test_parameters_that_cannot_be_honoured_are_rejected(algorithm, params, error):
    with pytest.raises(error):
        models.check_params(algorithm, params)


def test_accepted_parameters():
    forest = models.forest_settings(
        {"n_estimators": 3, "max_features": None, "max_samples": 0.5, "n_jobs": -1, "verbose": 0}
    )
    assert forest["numTrees"] == 3 and forest["impurity"] == "variance"
    assert forest["featureSubsetStrategy"] == "all" and forest["subsamplingRate"] == 0.5
    for own in ({"criterion": "entropy"}, {"max_depth": None}, {"max_depth": 31}, {"min_samples_split": 3},
                {"max_bins": None}):
        assert models.needs_own_trees(own, 2) and not models.needs_own_trees({}, 2)
    assert models.needs_own_trees({}, 3)
    settings = models.tree_settings({"min_samples_split": 0.1, "criterion": "log_loss"}, 95, 64)
    assert settings.min_split == 10 and settings.features == 8 and settings.criterion == "entropy"
    plain = models.logistic_settings(10, {"penalty": None, "fit_intercept": False})
    assert plain["regParam"] == 0.0 and not plain["fitIntercept"]
    assert models.logistic_settings(10, {"C": 2.0})["regParam"] == pytest.approx(0.05)
