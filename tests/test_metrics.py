import math

import pytest
from conftest import plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rowmill.operators import metrics, profiles

# 5 true positives, 2 false ones, 3 missed, 4 true negatives; scores with ties across classes
TRUE = [1, 1, 1, 1, 1, 0, 0, 1, 1, 1, 0, 0, 0, 0]
PRED = [1, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0]
SCORE = [9.0, 8.0, 8.0, 7.0, 6.0, 8.0, 6.0, 5.0, 3.0, 1.0, 5.0, 4.0, 2.0, 2.0]
SCHEMA = "y_true int, y_pred int, score double"


def frame(spark, true, pred, score=None):
    score = score or [None] * len(true)
    return spark.createDataFrame(list(zip(true, pred, score)), SCHEMA)


def expanded(spark, cells):
    """Rows for given counts of (true, predicted) pairs."""
    data = [pair for pair, n in cells.items() for _ in range(n)]
    return frame(spark, [t for t, _ in data], [p for _, p in data])


def area_by_pairs(true, score):
    won = [
        1.0 if s > t else 0.5 if s == t else 0.0
        for y, s in zip(true, score) if y == 1
        for z, t in zip(true, score) if z == 0
    ]
    return sum(won) / len(won) if won else None


def test_hand_counted_table(spark):
    found = metrics.binary_metrics(frame(spark, TRUE, PRED, SCORE), score="score").first()
    assert [found[c] for c in ("tn", "fp", "fn", "tp")] == [4, 2, 3, 5]
    assert found["accuracy"] == pytest.approx(9 / 14)
    assert found["precision"] == pytest.approx(5 / 7) and found["recall"] == pytest.approx(5 / 8)
    assert found["f1"] == pytest.approx(2 / 3)
    # pairs won of 48: 6, 5.5, 5.5, 5, 4.5, 3.5, 2, 0
    assert found["roc_auc"] == pytest.approx(32 / 48) == area_by_pairs(TRUE, SCORE)


def test_all_right_and_all_wrong(spark):
    right = metrics.binary_metrics(frame(spark, [1, 0, 1], [1, 0, 1])).first()
    assert {right[c] for c in ("accuracy", "precision", "recall", "f1")} == {1.0}
    wrong = metrics.binary_metrics(frame(spark, [1, 0, 1], [0, 1, 0])).first()
    assert {wrong[c] for c in ("accuracy", "precision", "recall", "f1")} == {0.0}


@pytest.mark.parametrize("score", [None, "score"])
@pytest.mark.parametrize(
    "true,pred,message",
    [
        ([0, 1, 2, 1], [0, 1, 1, 1], "more than two classes"),
        ([0, 1, 0], [0, 1, 7], "more than two classes"),
        ([0, None, 1], [0, 1, 1], "1 rows have a missing label"),
        ([0, 1, 1], [None, None, 1], "2 rows have a missing label"),
    ],
)
def test_labels_without_a_place_fail(spark, true, pred, message, score):
    df = frame(spark, true, pred, [0.5] * len(true))
    with pytest.raises(Exception, match=message):
        metrics.binary_metrics(df, score=score).collect()


def test_two_classes_may_have_any_names(spark):
    df = frame(spark, [5, 5, 9], [5, 9, 9])
    found = metrics.binary_metrics(df, positive=9).first()
    assert (found["tp"], found["fp"], found["tn"], found["fn"]) == (1, 1, 1, 0)


def test_nothing_to_divide_by_is_zero(spark):
    found = metrics.binary_metrics(frame(spark, [0, 0], [0, 0])).first()
    assert (found["accuracy"], found["precision"], found["recall"], found["f1"]) == (1, 0, 0, 0)


def test_area_is_unknown_without_both_classes_or_with_missing_scores(spark):
    one = metrics.roc_auc(frame(spark, [1, 1], [1, 1], [0.1, 0.2]), "y_true", "score")
    assert one.first()["roc_auc"] is None
    for gap in (None, math.nan):
        df = frame(spark, [0, 1, 1], [1, 1, 1], [0.1, 0.2, gap])
        assert metrics.roc_auc(df, "y_true", "score").first()["roc_auc"] is None


@pytest.mark.parametrize("rows_per_bucket", [10**6, 50, 3])
def test_area_over_many_ranges(spark, events, rows_per_bucket):
    df = events.select((F.col("event_type") == "click").cast("int").alias("y"), "value")
    pairs = [(r["y"], r["value"]) for r in df.collect()]
    wanted = area_by_pairs(*zip(*pairs))
    found = metrics.roc_auc(df, "y", "value", rows_per_bucket=rows_per_bucket).first()
    assert found["roc_auc"] == pytest.approx(wanted, abs=1e-12)


def test_area_with_one_score_on_a_third_of_the_rows(spark, events):
    df = events.select(
        (F.col("event_type") == "click").cast("int").alias("y"),
        F.when(F.col("user_id") % 3 == 0, 0.5).otherwise(F.col("value")).alias("s"),
    )
    wanted = area_by_pairs(*zip(*[(r["y"], r["s"]) for r in df.collect()]))
    found = metrics.roc_auc(df, "y", "s", rows_per_bucket=20).first()["roc_auc"]
    assert found == pytest.approx(wanted, abs=1e-12)


@settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.tuples(st.integers(0, 1), st.integers(0, 1), st.integers(0, 5)), min_size=1, max_size=30
    )
)
def test_metrics_match_counting(spark, data):
    true, pred, score = (list(c) for c in zip(*data))
    df = frame(spark, true, pred, [float(s) for s in score])
    found = metrics.binary_metrics(df, score="score", rows_per_bucket=4).first()
    assert found["tp"] == sum(t and p for t, p in zip(true, pred))
    assert found["n"] == len(data) == found["tn"] + found["fp"] + found["fn"] + found["tp"]
    assert found["accuracy"] == pytest.approx(
        sum(t == p for t, p in zip(true, pred)) / len(data)
    )
    wanted = area_by_pairs(true, score)
    assert found["roc_auc"] == (wanted if wanted is None else pytest.approx(wanted))


def test_metrics_per_run(spark):
    a = frame(spark, TRUE, PRED, SCORE).withColumn("run_id", F.lit("a"))
    b = frame(spark, TRUE, TRUE, [float(t) for t in TRUE]).withColumn("run_id", F.lit("b"))
    both = a.unionByName(b).withColumnRenamed("score", "y_pred_proba")
    found = {r["run_id"]: r for r in metrics.metrics_by_run(both, rows_per_bucket=3).collect()}
    assert found["a"]["roc_auc"] == pytest.approx(32 / 48)
    assert found["a"]["accuracy"] == pytest.approx(9 / 14)
    assert found["b"]["roc_auc"] == 1.0 and found["b"]["accuracy"] == 1.0


def test_empty_table_has_no_metrics(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert metrics.binary_metrics(empty).count() == 0
    assert metrics.binary_metrics(empty, score="score").count() == 0
    assert metrics.classification_report(empty).count() == 0


def test_matrix_rows_are_actual_columns_predicted(spark):
    matrix = metrics.confusion_matrix(frame(spark, [1, 1, 1, 0, 0], [0, 1, 0, 0, 0]))
    assert rows(matrix) == [(0, 0, 2), (0, 1, 0), (1, 0, 2), (1, 1, 1)]
    wide = metrics.confusion_table(matrix, [0, 1])
    assert wide.columns == ["actual", "Predicted 0", "Predicted 1"]
    assert [tuple(r) for r in wide.collect()] == [("Actual 0", 2, 0), ("Actual 1", 2, 1)]


def test_labels_that_were_not_given_stay(spark):
    df = frame(spark, [0, 1, 2, 2, 1], [0, 1, 1, 2, 2])
    matrix = metrics.confusion_matrix(df, labels=[0, 1])
    assert sum(r["n"] for r in matrix.collect()) == 5 and matrix.count() == 9
    wide = metrics.confusion_table(matrix, [1, 0])
    assert wide.columns == ["actual", "Predicted 1", "Predicted 0", "Predicted 2"]


def test_missing_labels_raise(spark):
    df = frame(spark, [0, None, 1], [0, 1, None])
    with pytest.raises(ValueError, match="2 rows have a missing label"):
        metrics.confusion_matrix(df)
    with pytest.raises(ValueError, match="2 rows have a missing label"):
        metrics.classification_report(df)


def test_very_many_labels(spark):
    df = spark.range(150_000).select(F.col("id").alias("y_true"), (F.col("id") % 1000).alias("y_pred"))
    cells = metrics.confusion_matrix(df, dense=False)
    assert cells.agg(F.sum("n"), F.count(F.lit(1))).first() == (150_000, 150_000)
    report = metrics.classification_report(df)
    assert report.count() == 150_003
    assert report.where("position = 150000").first()["label"] == "149999"


def test_matrix_with_given_labels_and_one_class(spark):
    only = frame(spark, [1, 1], [1, 1])
    assert rows(metrics.confusion_matrix(only)) == [(1, 1, 2)]
    assert rows(metrics.confusion_matrix(only, labels=[0, 1])) == [
        (0, 0, 0), (0, 1, 0), (1, 0, 0), (1, 1, 2)
    ]


def test_printed_report(spark):
    report = metrics.classification_report(
        expanded(spark, {(0, 0): 107, (1, 0): 4, (1, 1): 60})
    )
    # The printed layout.
    assert metrics.report_text(report) == (
        "              precision    recall  f1-score   support\n"
        "\n"
        "           0       0.96      1.00      0.98       107\n"
        "           1       1.00      0.94      0.97        64\n"
        "\n"
        "    accuracy                           0.98       171\n"
        "   macro avg       0.98      0.97      0.97       171\n"
        "weighted avg       0.98      0.98      0.98       171\n"
    )


def test_report_with_a_class_that_is_never_predicted(spark):
    report = metrics.classification_report(frame(spark, [0, 1, 2, 2], [0, 0, 2, 0]))
    found = {r["label"]: r for r in report.collect()}
    assert found["1"]["precision"] == 0.0 and found["1"]["support"] == 1
    assert found["2"]["precision"] == 1.0 and found["2"]["recall"] == 0.5
    assert found["accuracy"]["f1"] == 0.5 and found["accuracy"]["precision"] is None
    assert found["macro avg"]["recall"] == pytest.approx(0.5)


def test_train_accuracy(spark):
    assert metrics.train_accuracy(frame(spark, TRUE, PRED)).first()[0] == pytest.approx(9 / 14)


def test_cells_are_counted_before_the_shuffle(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    text = plan(metrics.confusion_cells(labels, "quality", "toxic"))
    assert "partial_count" in text and text.count("Exchange") == 1


def test_profiles(spark):
    df = spark.createDataFrame(
        [("a", 1.0, None), ("a", 3.0, "x"), ("b", math.nan, None)], "c string, v double, t string"
    )
    assert rows(profiles.null_counts(df)) == [("c", 0), ("t", 2), ("v", 1)]
    found = profiles.feature_profile(df, ["v"]).first()
    assert (found["n"], found["n_missing"], found["mean"]) == (2, 1, 2.0)
    assert found["std"] == pytest.approx(math.sqrt(2))
    shares = {r["c"]: r["share"] for r in profiles.class_distribution(df, "c").collect()}
    assert shares == {"a": pytest.approx(2 / 3), "b": pytest.approx(1 / 3)}
    summary = profiles.profile_summary(df, ["v"]).first()
    assert (summary["n_rows"], summary["n_features"]) == (3, 1)
