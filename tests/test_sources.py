import json
import math
import os
from pathlib import Path
from types import SimpleNamespace

import pytest
from conftest import plan, rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from rowmill.functions import remove_folders, shared_folder, small_table, stored, tables
from rowmill.operators import comparison, metrics
from rowmill.sources import artifacts, versions
from rowmill.sources.tables import (
    Catalog, read_dataset, read_labeled, read_stage, write_dataset, write_stage,
)

CSV = """id,diagnosis,concave points_mean,area
7,M,1.5,10
3,B,NA,11
5,,2.5,
9,M,NaN,12
"""


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(CSV)
    return str(path)


def test_csv_with_missing_cells(spark, csv):
    table = read_labeled(spark, csv)
    assert table.dtypes == [
        ("id", "bigint"), ("target", "int"), ("concave points_mean", "double"), ("area", "double")
    ]
    found = {r["id"]: tuple(r)[1:] for r in table.collect()}
    assert found[7] == (1, 1.5, 10.0)
    assert found[3] == (0, None, 11.0)
    assert found[5] == (0, 2.5, None)
    assert found[9][0] == 1 and math.isnan(found[9][1])


def test_csv_with_an_encoded_target_and_no_id(spark, tmp_path):
    (tmp_path / "t.csv").write_text("target,a\n1,2.0\n0,3.0\n")
    table = read_labeled(spark, str(tmp_path / "t.csv"))
    assert table.columns == ["id", "target", "a"]
    assert sorted((r["target"], r["a"]) for r in table.collect()) == [(0, 3.0), (1, 2.0)]


def test_csv_with_text_keys(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,diagnosis,a\nx1,M,2.0\nx2,B,3.0\n")
    table = read_labeled(spark, str(tmp_path / "t.csv"), key_type="string")
    assert rows(table) == [("x1", 1, 2.0), ("x2", 0, 3.0)]


def test_missing_file_and_missing_label_raise(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_labeled(spark, str(tmp_path / "nothing.csv"))
    (tmp_path / "t.csv").write_text("id,a\n1,2.0\n")
    with pytest.raises(ValueError, match="target"):
        read_labeled(spark, str(tmp_path / "t.csv"))


def test_catalogue_entries(spark, tmp_path):
    catalog = Catalog.from_mapping(
        spark,
        str(tmp_path),
        {
            "X_train": {"type": "pandas.CSVDataset", "filepath": "p/x.csv"},
            "metrics": {"type": "json.JSONDataset", "filepath": "m.json"},
            "stage": {"format": "parquet", "filepath": "s"},
        },
    )
    df = spark.createDataFrame([(1, 0.1), (2, None)], "id long, a double")
    for name in ("X_train", "metrics", "stage"):
        catalog.write(name, df)
        catalog.write(name, df)
        assert rows(catalog.read(name, df.schema)) == rows(df)
    with pytest.raises(KeyError):
        catalog.read("other")
    with pytest.raises(ValueError):
        Catalog.from_mapping(spark, "", {"a": {"type": "x.Unknown", "filepath": "f"}})


def test_doubles_survive_csv(spark, events, tmp_path):
    df = events.select("event_id", (F.col("value") / 7).alias("value"))
    write_dataset(df, str(tmp_path / "c"), "csv")
    assert rows(read_dataset(spark, str(tmp_path / "c"), "csv", df.schema)) == rows(df)


def predictions(spark):
    return spark.createDataFrame(
        [(1, 0, 0, 0.2), (2, 1, 1, 0.9), (3, 1, 0, 0.4)],
        "id long, y_true int, y_pred int, y_pred_proba double",
    )


def text_of(path):
    parts = [p for p in Path(path).iterdir() if p.name.startswith("part-")]
    return "".join(p.read_text() for p in parts)


def test_result_files(spark, tmp_path):
    df = predictions(spark)
    artifacts.write_metrics_json(
        metrics.binary_metrics(df, score="y_pred_proba"), str(tmp_path / "m.json")
    )
    found = json.loads(text_of(tmp_path / "m.json"))
    assert found["accuracy"] == pytest.approx(2 / 3) and found["roc_auc"] == 1.0
    matrix = metrics.confusion_matrix(df, labels=[0, 1])
    artifacts.write_confusion_csv(matrix, str(tmp_path / "c.csv"))
    assert text_of(tmp_path / "c.csv").splitlines() == [
        "actual,Predicted 0,Predicted 1", "Actual 0,1,0", "Actual 1,1,1"
    ]
    artifacts.write_predictions(df, str(tmp_path / "p.csv"), ["id"])
    stored_rows = spark.read.csv(str(tmp_path / "p.csv"), header=True)
    assert rows(stored_rows) == [("1", "0", "0", "1"), ("2", "1", "1", "1"), ("3", "1", "0", "0")]
    text = artifacts.write_report_text(metrics.classification_report(df), str(tmp_path / "r.txt"))
    assert text_of(tmp_path / "r.txt") == text and "weighted avg" in text


def test_repeating_a_run_replaces_only_that_run(spark, tmp_path):
    path, df = str(tmp_path / "runs"), predictions(spark)
    artifacts.write_run_result(df, path, "a", "id")
    artifacts.write_run_result(df, path, "b", "id")
    artifacts.write_run_result(df.where("id < 3"), path, "a", "id")
    counts = artifacts.read_run_results(spark, path).groupBy("run_id").count()
    assert rows(counts) == [("a", 2), ("b", 3)]


def test_stored_tables_live_in_the_shared_folder(spark, events):
    kept = stored(events.select("event_id"))
    assert shared_folder(spark).split(":")[-1] in kept.inputFiles()[0]
    assert kept.count() == events.count()


def session_with(**settings):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default=None: settings.get(name, default)))


def test_the_shared_folder_comes_from_the_session():
    warehouse = {"spark.sql.warehouse.dir": "hdfs://x/warehouse"}
    assert shared_folder(session_with(**warehouse)) == "hdfs://x/warehouse/rowmill-stages"
    named = session_with(**warehouse, **{"spark.checkpoint.dir": "hdfs://x/shared"})
    assert shared_folder(named) == "hdfs://x/shared"


def test_stored_tables_can_be_removed(spark, monkeypatch):
    monkeypatch.setattr(tables, "_folders", [])
    path = stored(spark.range(3)).inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path)
    remove_folders()
    assert not os.path.exists(path)


def test_small_tables_become_local(spark, events):
    types = events.select("event_type").distinct()
    assert small_table(types) is not types
    assert rows(small_table(types)) == rows(types)


@pytest.mark.parametrize("names", [("1", "01"), ("2024-01-01", "2024-1-1"), ("1.0", "1")])
def test_run_names_stay_text(spark, tmp_path, names):
    path, df = str(tmp_path / "runs"), predictions(spark)
    for name in names:
        artifacts.write_run_result(df, path, name, "id")
    found = artifacts.read_run_results(spark, path)
    assert dict(found.dtypes)["run_id"] == "string" and dict(found.dtypes)["id"] == dict(df.dtypes)["id"]
    assert rows(found.groupBy("run_id").count()) == sorted((n, 3) for n in names)


@pytest.mark.parametrize("cell", ["abc", "1;5"])
def test_bad_cells_are_named(spark, tmp_path, cell):
    (tmp_path / "t.csv").write_text(f"id,diagnosis,a\n1,M,1.5\n2,B,{cell}\n3,B,NA\n")
    with pytest.raises(Exception, match=f"column a holds a cell that is no double: {cell}"):
        read_labeled(spark, str(tmp_path / "t.csv")).collect()


def test_the_catalogue_keeps_a_scaler(spark, tmp_path, events):
    entries = {"scaler": {"filepath": "scaler.pkl", "type": "pickle.PickleDataset"}}
    catalog = Catalog.from_mapping(spark, str(tmp_path), entries)
    scaler = events.agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
    catalog.write("scaler", scaler)
    assert rows(catalog.read("scaler")) == rows(scaler)


def test_usual_spellings_of_missing_cells(spark, tmp_path):
    cells = ["N/A", "n/a", "null", "NULL", "nan", "None", "#N/A", "<NA>", "-1.#IND", ""]
    lines = "".join(f"{i},M,{c},1\n" for i, c in enumerate(cells))
    (tmp_path / "t.csv").write_text("id,diagnosis,a,b\n" + lines + "99,B,2.5,1\n")
    table = read_labeled(spark, str(tmp_path / "t.csv"))
    assert table.where("a IS NULL OR isnan(a)").count() == len(cells)
    assert table.where("id = 99").first()["a"] == 2.5
    with pytest.raises(Exception, match="holds a cell that is no double"):
        read_labeled(spark, str(tmp_path / "t.csv"), missing=["N/A", "n/a"]).collect()
    (tmp_path / "u.csv").write_text("id,diagnosis,a\n1,M,absent\n")
    assert read_labeled(spark, str(tmp_path / "u.csv"), missing=["absent"]).first()["a"] is None


def broken(df, column):
    """The table, but reading its largest key fails."""
    last = df.agg(F.max(column)).first()[0]
    wrong = F.raise_error(F.lit("lost half-way")).cast(dict(df.dtypes)[column])
    return df.repartition(3).withColumn(column, F.when(F.col(column) == last, wrong).otherwise(F.col(column)))


def test_a_failed_write_leaves_the_old_run(spark, tmp_path):
    path, df = str(tmp_path / "runs"), predictions(spark)
    artifacts.write_run_result(df, path, "a", "id")
    artifacts.write_run_result(df, path, "b", "id")
    before = rows(artifacts.read_run_results(spark, path))
    with pytest.raises(Exception, match="half-way"):
        artifacts.write_run_result(broken(df, "id"), path, "a", "id")
    assert rows(artifacts.read_run_results(spark, path)) == before
    assert len(versions.clear_unfinished(spark, path)) == 1
    assert rows(artifacts.read_run_results(spark, path)) == before
    artifacts.write_run_result(df.where("id = 1"), path, "a", "id")
    assert rows(artifacts.read_run_results(spark, path).groupBy("run_id").count()) == [("a", 1), ("b", 3)]
    one = artifacts.read_run_results(spark, path).where("run_id = 'b'")
    assert "PartitionFilters: [isnotnull(run_id" in plan(one)


def test_a_failed_write_leaves_the_old_stage(spark, tmp_path):
    path, df = str(tmp_path / "stage"), predictions(spark)
    assert rows(write_stage(df, path)) == rows(df)
    with pytest.raises(Exception, match="half-way"):
        write_stage(broken(df, "id"), path)
    assert rows(read_stage(spark, path)) == rows(df)
    smaller = df.where("id > 1").drop("y_pred")
    assert rows(write_stage(smaller, path)) == rows(smaller)
    assert spark.read.parquet(path).count() == 2  # nothing but the current version is left
    with pytest.raises(FileNotFoundError):
        read_stage(spark, str(tmp_path / "nothing"))


def test_a_switch_that_never_comes_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    path, df = str(tmp_path / "stage"), predictions(spark)
    write_stage(df, path)
    monkeypatch.setattr(versions.Folder, "replace_text", lambda *_: (_ for _ in ()).throw(OSError("no switch")))
    with pytest.raises(OSError):
        write_stage(df.where("id = 1"), path)
    assert rows(read_stage(spark, path)) == rows(df)


def test_a_summary_from_states_equals_the_full_one(spark, tmp_path):
    path = str(tmp_path / "runs")
    base = spark.range(400).select(
        "id", (F.col("id") % 3 == 0).cast("int").alias("y_true"), (F.col("id") % 4 == 0).cast("int").alias("y_pred"),
        ((F.col("id") * 7 % 50) / 50).alias("y_pred_proba"),
    )
    made = {"a": base, "b": base.repartition(3), "c": base.withColumn("y_pred", 1 - F.col("y_pred"))}
    for name, df in made.items():
        artifacts.write_run_result(df, path, name, "id")
    with pytest.raises(ValueError, match="without a state"):
        artifacts.summarise_runs(spark, path, "a", "id")
    for name in made:
        artifacts.write_run_state(spark, path, name, "id")
    # another run comes: only its own rows are read for its state
    artifacts.write_run_result(base.where("id < 300"), path, "d", "id")
    artifacts.write_run_state(spark, path, "d", "id")
    runs = artifacts.read_run_results(spark, path)
    full = comparison.run_summary(runs, "a", "id")
    assert rows(artifacts.summarise_runs(spark, path, "a", "id")) == rows(full)
    one = comparison.run_scores(runs.where("run_id = 'd'"))
    assert "PartitionFilters: [isnotnull(run_id" in plan(one)
    assert rows(runs.groupBy("run_id").count())[0] == ("a", 400)
    with pytest.raises(ValueError, match="no run 'x'"):
        artifacts.write_run_state(spark, path, "x", "id")
    # a run that is written again needs its state again
    artifacts.write_run_result(base, path, "d", "id")
    artifacts.write_run_state(spark, path, "d", "id")
    again = {r["run_id"]: r for r in artifacts.summarise_runs(spark, path, "a", "id").collect()}
    assert again["d"]["same_scores"] is True and again["d"]["n"] == 400
