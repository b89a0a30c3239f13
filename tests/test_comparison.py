import math

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from rowmill.operators import comparison

SCHEMA = "run_id string, id long, y_true int, y_pred int, y_pred_proba double"
FIRST = [(1, 0, 0, 0.2), (2, 1, 1, 0.9), (3, 1, 0, 0.4)]


def runs(spark, **others):
    data = [("first", *r) for r in FIRST]
    for name, values in others.items():
        data += [(name, *r) for r in values]
    return spark.createDataFrame(data, SCHEMA)


def flags(df):
    found = comparison.compare_runs(df, "first", "id").collect()
    return {
        r["run_id"]: (r["same_labels"], r["same_predictions"], r["same_scores"]) for r in found
    }


def test_agreement_flags(spark):
    found = flags(runs(
        spark,
        echo=[(i, t, p, s * (1 + 1e-12)) for i, t, p, s in reversed(FIRST)],
        other=[(i, t, 1 - p, s) for i, t, p, s in FIRST],
        shifted=[(i, t, p, s + 1e-6) for i, t, p, s in FIRST],
        relabelled=[(i, 1 - t, p, s) for i, t, p, s in FIRST],
    ))
    assert found == {
        "echo": (True, True, True),
        "other": (True, False, True),
        "shifted": (True, True, False),
        "relabelled": (False, False, False),
    }


def test_keys_missing_on_either_side_break_agreement(spark):
    found = flags(runs(spark, short=FIRST[:2], long=FIRST + [(4, 0, 0, 0.1)],
                       moved=FIRST[:2] + [(9, 1, 0, 0.4)]))
    assert set(found.values()) == {(False, False, False)} and len(found) == 3


@pytest.mark.parametrize(
    "first,other,same",
    [
        (math.nan, math.nan, False),
        (math.inf, math.inf, True),
        (1.0, math.inf, False),
        (-math.inf, math.inf, False),
        (None, None, False),
        (1e-11, 0.0, True),
        (2e-10, 0.0, False),
        (1.0 + 9e-9, 1.0, True),
        (1.0 + 2e-8, 1.0, False),
    ],
)
def test_score_tolerance(spark, first, other, same):
    df = spark.createDataFrame(
        [("first", 1, 1, 1, first), ("b", 1, 1, 1, other)], SCHEMA
    )
    assert comparison.compare_scores(df, "first", "id").first()["same_scores"] is same


def test_tolerance_is_relative_to_the_other_run(spark):
    df = spark.createDataFrame([("first", 1, 1, 1, 1.0), ("b", 1, 1, 1, 2.0)], SCHEMA)
    assert comparison.compare_scores(df, "first", "id", rtol=0.5, atol=0.0).first()[1] is True
    df = spark.createDataFrame([("first", 1, 1, 1, 2.0), ("b", 1, 1, 1, 1.0)], SCHEMA)
    assert comparison.compare_scores(df, "first", "id", rtol=0.5, atol=0.0).first()[1] is False


def test_single_flags(spark):
    df = runs(spark, other=[(i, t, 1 - p, s) for i, t, p, s in FIRST])
    assert rows(comparison.compare_labels(df, "first", "id")) == [("other", True)]
    assert rows(comparison.compare_predictions(df, "first", "id")) == [("other", False)]


def test_summary_has_every_run(spark):
    df = runs(spark, echo=FIRST)
    found = {r["run_id"]: r for r in comparison.run_summary(df, "first", "id").collect()}
    assert found["first"]["same_labels"] is None and found["echo"]["same_scores"] is True
    assert found["first"]["accuracy"] == found["echo"]["accuracy"] == pytest.approx(2 / 3)


def test_stored_predictions_join_their_truth(spark):
    truth = spark.createDataFrame([(1, 0), (2, 1)], "id long, y_true int")
    good = spark.createDataFrame([(2, 1), (1, 1)], "id long, y_pred int")
    assert rows(comparison.join_predictions(truth, good, "id", check=True)) == [
        (1, 0, 1, 0), (2, 1, 1, 1)
    ]
    with pytest.raises(ValueError, match="1 keys without"):
        comparison.join_predictions(truth, good.where("id = 1"), "id")
    assert comparison.join_predictions(truth, good.where("id = 1"), "id", check=False).count() == 1


def test_features_without_a_target_raise(spark):
    features = spark.createDataFrame([(1, 0.5), (2, 0.5)], "id long, a double")
    targets = spark.createDataFrame([(1, 0)], "id long, target int")
    with pytest.raises(ValueError, match="1 values of id"):
        comparison.attach_target(features, targets, "id")
    assert comparison.attach_target(features, targets, "id", partial=True).count() == 1


def test_an_unknown_first_run_raises(spark):
    with pytest.raises(ValueError, match="no run 'nobody'"):
        comparison.compare_runs(runs(spark, echo=FIRST), "nobody", "id")


@pytest.mark.parametrize("repeated", ["first", "echo"])
def test_a_key_repeated_in_a_run_fails(spark, repeated):
    df = runs(spark, echo=FIRST)
    df = df.union(df.where(F.col("run_id") == repeated).limit(1))
    with pytest.raises(Exception, match="holds a key more than once"):
        comparison.compare_runs(df, "first", "id").collect()


def test_a_repeated_target_key_raises(spark):
    features = spark.createDataFrame([(1, 0.5)], "id long, a double")
    targets = spark.createDataFrame([(1, 0), (1, 1)], "id long, target int")
    with pytest.raises(ValueError, match="not unique"):
        comparison.attach_target(features, targets, "id")
    assert comparison.attach_target(features, targets.limit(1), "id").count() == 1


def test_unmatched_keys(spark):
    a, b = spark.range(4).toDF("id"), spark.range(2, 7).toDF("id")
    assert tuple(comparison.unmatched_keys(a, b, "id").first()) == (2, 2, 3)
    assert comparison.unmatched_keys(a.where(F.lit(False)), b, "id").first()["n_matched"] == 0


def many(spark, n=3000):
    """A first run, and others that differ from it in few places or none."""
    base = spark.range(n).select(
        "id", (F.col("id") % 3 == 0).cast("int").alias("y_true"), (F.col("id") % 5 == 0).cast("int").alias("y_pred"),
        F.when(F.col("id") % 100 != 7, F.col("id") / 7).alias("y_pred_proba"),
    )
    def run(name, df):
        return df.select(F.lit(name).alias("run_id"), "id", "y_true", "y_pred", "y_pred_proba")

    score = F.col("y_pred_proba")
    return {
        "first": run("first", base), "echo": run("echo", base.repartition(5)),
        "one": run("one", base.withColumn("y_pred", F.when(F.col("id") == 11, 9).otherwise(F.col("y_pred")))),
        "short": run("short", base.where("id <> 12")), "nudged": run("nudged", base.withColumn("y_pred_proba", score * (1 + 1e-12))),
        "swapped": run("swapped", base.withColumns({"y_true": F.col("y_pred"), "y_pred": F.col("y_true")})),
    }


def brute(df):
    """All counts by one join of every row."""
    base = df.where("run_id = 'first'").select("id", *[F.col(c).alias(f"_{c}") for c in ("y_true", "y_pred", "y_pred_proba")])
    close = F.abs(F.col("_y_pred_proba") - F.col("y_pred_proba")) <= 1e-10 + 1e-8 * F.abs("y_pred_proba")
    met = F.col("_y_true").isNotNull()
    return df.where("run_id <> 'first'").join(base, "id", "left").groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_run"), F.count_if(met).alias("n_matched"),
        F.count_if(met & (F.col("y_true") != F.col("_y_true"))).alias("n_label_diff"),
        F.count_if(met & (F.col("y_pred") != F.col("_y_pred"))).alias("n_prediction_diff"),
        F.count_if(met & ~F.coalesce(close, F.lit(False))).alias("n_score_diff"),
    )


def test_ranges_that_differ_are_found(spark):
    every = many(spark)
    df = every["first"]
    for name, other in every.items():
        if name != "first":
            df = df.unionByName(other)
    wanted = brute(df)
    found = comparison.compare_runs(df, "first", "id")
    assert rows(found.select(wanted.columns)) == rows(wanted)
    # a missing score is no agreement, though the runs are equal
    assert found.where("run_id = 'echo'").select("same_predictions", "same_scores").first() == (True, False)


def test_equal_runs_are_compared_without_their_rows(spark, tmp_path):
    every = many(spark)
    every["first"].unionByName(every["echo"]).write.parquet(str(tmp_path / "r"))
    df = spark.read.parquet(str(tmp_path / "r"))
    found = comparison.compare_runs(df, "first", "id")
    assert "FileScan" not in plan(found) and found.first()["same_labels"]
    every["one"].write.mode("append").parquet(str(tmp_path / "r"))
    differing = comparison.run_digests(spark.read.parquet(str(tmp_path / "r")), "id")
    marks = [c for c in differing.columns if c not in ("run_id",)]
    first, one = (differing.where(F.col("run_id") == n).select(marks) for n in ("first", "one"))
    assert first.exceptAll(one).count() == 1
