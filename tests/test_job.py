import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

import __spark_entry__ as bindings
from rowmill.__main__ import main
from rowmill.operators import scaling, splitting
from rowmill.plans.config import JobConfig
from rowmill.plans.job import run_job
from rowmill.sources import artifacts
from rowmill.sources.tables import write_dataset

FEATURES = bindings.EMBEDDING_FEATURES[:12]
CONFIG = JobConfig(n_features=5, random_forest={"n_estimators": 10, "max_depth": 5})


@pytest.fixture(scope="module")
def table(spark, sf_dir):
    """Embeddings with a target that follows some dimensions, two damaged rows and copies."""
    source = bindings.embeddings(spark, sf_dir).select("vec_id", *FEATURES)
    target = (F.col("e01") + F.col("e03") - F.col("e07") > 0).cast("int").alias("target")
    whole = source.select("vec_id", target, *FEATURES)
    copies = whole.where("vec_id < 5").withColumn("vec_id", F.col("vec_id") + 100_000)
    broken = F.when(~F.col("vec_id").isin(10, 20), F.col("e00"))
    return whole.unionByName(copies).withColumn("e00", broken)


@pytest.fixture(scope="module")
def result(table, tmp_path_factory):
    out = tmp_path_factory.mktemp("job")
    return run_job(table, "vec_id", "target", str(out), CONFIG, FEATURES, run_id="one"), out


def test_rows_are_cleaned_with_their_target(spark, table, result):
    job, out = result
    cleaned = spark.read.parquet(str(out / "cleaned_data"))
    assert cleaned.count() == table.count() - 2 - 5
    assert cleaned.agg(F.max("vec_id")).first()[0] < 100_000
    same = cleaned.join(table.select("vec_id", F.col("target").alias("t")), "vec_id")
    assert same.where("target <> t").count() == 0


def test_metrics_and_quality(result):
    job, _ = result
    found = job.metrics.first()
    assert found["accuracy"] > 0.8 and found["roc_auc"] > 0.85
    assert job.train_accuracy.first()["accuracy"] > 0.8
    assert found["n"] == job.predictions.count() == splitting.side_sizes(498, 0.3)[1]
    assert sum(r["n"] for r in job.confusion.collect()) == found["n"]
    assert {"e01", "e03", "e07"} <= set(job.selected) and len(job.selected) == 5


def test_results_are_stored(spark, result):
    job, out = result
    assert artifacts.load_model(str(out / "model")).stages
    assert artifacts.load_scaler(spark, str(out / "feature_scaler")).count() == len(FEATURES)
    assert spark.read.text(str(out / "classification_report.txt")).count() == 8
    stored = spark.read.json(str(out / "metrics.json")).first()
    assert stored["accuracy"] == job.metrics.first()["accuracy"]
    runs = artifacts.read_run_results(spark, str(out / "runs"))
    assert runs.where("run_id = 'one'").count() == job.predictions.count()


def test_a_repeated_run_is_identical(table, result, tmp_path):
    job, _ = result
    again = run_job(table.repartition(5), "vec_id", "target", str(tmp_path), CONFIG, FEATURES)
    assert rows(again.predictions) == rows(job.predictions)
    assert rows(again.metrics) == rows(job.metrics)


def test_scaler_sees_training_rows_only_unless_told_otherwise(spark, result, table, tmp_path):
    job, out = result
    cleaned = spark.read.parquet(str(out / "cleaned_data"))
    train, _ = splitting.train_test_split(cleaned, "vec_id", "target", 0.3, 42)
    fitted = scaling.scaler_values(scaling.fit_scaler(train, FEATURES))
    for name, scale in scaling.scaler_values(job.scaler).items():
        assert scale == pytest.approx(fitted[name], rel=1e-9)
    everything = run_job(table, "vec_id", "target", str(tmp_path),
                         CONFIG.with_changes(fit_on="all", algorithm="logistic_regression"),
                         FEATURES)
    fitted = scaling.scaler_values(scaling.fit_scaler(cleaned, FEATURES))
    for name, scale in scaling.scaler_values(everything.scaler).items():
        assert scale == pytest.approx(fitted[name], rel=1e-9)
    assert everything.metrics.first()["accuracy"] > 0.9


def test_stage_tables(spark, table, tmp_path):
    config = CONFIG.with_changes(
        keep_stages=True, use_scaling=False, metrics=("accuracy", "f1")
    )
    job = run_job(table, "vec_id", "target", str(tmp_path), config, FEATURES)
    assert job.metrics.columns == ["n", "accuracy", "f1", "tn", "fp", "fn", "tp"]
    raw = spark.read.parquet(str(tmp_path / "raw_target"))
    assert raw.columns == ["vec_id", "target"] and raw.count() == table.count()
    normalized = spark.read.parquet(str(tmp_path / "normalized_data"))
    assert normalized.columns == ["vec_id", "target", *FEATURES]
    prepared = spark.read.parquet(str(tmp_path / "prepared_data"))
    assert set(prepared.columns) == {"vec_id", "target", "split", *job.selected}


def test_config_from_nested_settings(tmp_path):
    settings = {
        "data": {"raw_path": "x.csv"},
        "feature_engineering": {"test_size": 0.25, "n_features_to_select": 7, "random_state": 3,
                                "use_scaling": False, "scaler_type": "standard"},
        "model": {"algorithm": "logistic_regression", "random_forest": {"n_estimators": 5},
                  "logistic_regression": {"C": 2.0}},
        "evaluation": {"metrics": ["accuracy"], "compute_confusion_matrix": True},
        "paths": {"metrics_dir": "m"},
    }
    config = JobConfig.from_mapping(settings)
    assert (config.test_size, config.n_features, config.random_state) == (0.25, 7, 3)
    assert not config.use_scaling and config.metrics == ("accuracy",)
    # The parameters of the chosen algorithm, not always those of the forest.
    assert config.model_params() == {"C": 2.0}
    (tmp_path / "c.json").write_text(json.dumps(settings))
    assert JobConfig.load(str(tmp_path / "c.json")) == config
    yaml = pytest.importorskip("yaml")
    (tmp_path / "c.yml").write_text(yaml.safe_dump(settings))
    assert JobConfig.load(str(tmp_path / "c.yml")) == config


def test_command_line(spark, table, tmp_path, capsys):
    raw = table.select("vec_id", F.when(F.col("target") == 1, "M").otherwise("B").alias("diagnosis"),
                       *FEATURES)
    write_dataset(raw, str(tmp_path / "raw.csv"), "csv")
    settings = {"feature_engineering": {"n_features_to_select": 5},
                "model": {"algorithm": "logistic_regression"}}
    (tmp_path / "c.json").write_text(json.dumps(settings))
    for name in ("one", "two"):
        main(["run", str(tmp_path / "raw.csv"), str(tmp_path / "out"), "--key", "vec_id",
              "--config", str(tmp_path / "c.json"), "--run-id", name])
    assert "weighted avg" in capsys.readouterr().out
    main(["compare", str(tmp_path / "out" / "runs"), "one", "--key", "vec_id"])
    out = capsys.readouterr().out
    assert "two" in out and "false" not in out


def test_config_is_checked():
    for changes in ({"fit_on": "test"}, {"algorithm": "svm"}, {"metrics": ("loss",)}):
        with pytest.raises(ValueError):
            JobConfig(**changes)
    with pytest.raises(TypeError):
        CONFIG.with_changes(trees=3)
