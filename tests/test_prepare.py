import math

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from rowmill.operators import models, prepare, splitting

SCHEMA = "id long, target int, `concave points` double, area double"


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [
            (7, 1, 1.0, 2.0),
            (3, 0, 1.0, 2.0),
            (5, 1, None, 2.0),
            (4, 0, 4.0, math.nan),
            (9, 0, 0.0, 5.0),
            (8, 1, -0.0, 5.0),
            (1, None, 6.0, 6.0),
        ],
        SCHEMA,
    )


FEATURES = ["concave points", "area"]


def test_binary_target_counts_a_missing_label_as_negative(spark):
    df = spark.createDataFrame([(1, "M"), (2, "B"), (3, None)], "id long, diagnosis string")
    labelled = prepare.derive_binary_target(df, "diagnosis", "M")
    assert rows(labelled) == [(1, 1), (2, 0), (3, 0)]
    assert dict(labelled.dtypes)["target"] == "int"


def test_label_table_keeps_an_existing_target(spark):
    df = spark.createDataFrame([(1, 1, 2)], "id long, target long, area int")
    shaped = prepare.label_table(df, "id")
    assert shaped.dtypes == [("id", "bigint"), ("target", "int"), ("area", "double")]


def test_label_table_without_label_or_target_raises(spark):
    with pytest.raises(ValueError, match="target"):
        prepare.label_table(spark.createDataFrame([(1, 2)], "id long, area int"), "id")


def test_label_table_derives_a_key_from_the_content(spark):
    df = spark.createDataFrame([("M", 1.0), ("M", 1.0), ("B", 1.0)], "diagnosis string, a double")
    shaped = prepare.label_table(df, None)
    assert shaped.select("id").distinct().count() == 3
    assert shaped.select(F.split("id", "-")[0]).distinct().count() == 2
    other = prepare.label_table(df.repartition(3), None)
    assert rows(shaped) == rows(other)
    assert prepare.clean_data(shaped, ["a"], "id").count() == 1


def test_equal_rows_without_a_key_stay_apart(spark):
    """Through loading, split and scoring, in any layout, one content held by most rows."""
    source = [("M", 1.0, 2.0)] * 70 + [("B", 0.0, 2.0)] * 50 + [("M", 1.0 + i, None) for i in range(3)]
    df = spark.createDataFrame(source, "diagnosis string, a double, b double")
    shaped = prepare.label_table(df, None, features=["a", "b"])
    assert shaped.columns == ["id", "target", "a", "b"]
    assert rows(shaped) == rows(prepare.label_table(df.repartition(7), None, features=["a", "b"]))
    assert shaped.select("id").distinct().count() == len(source)
    numbers = [int((r["id"].split("-") + ["0"])[1]) for r in shaped.where("a = 1 AND b = 2").collect()]
    assert sorted(numbers) == list(range(70))
    whole = shaped.where("b IS NOT NULL")
    train, test = splitting.train_test_split(whole, "id", "target", 0.25)
    assert (train.count(), test.count()) == (90, 30)
    model = models.train_model(train, ["a"], "target", "id", params={"n_estimators": 3})
    assert models.score(model, test).select("id", "y_pred").distinct().count() == 30
    assert prepare.label_table(df.limit(0), None, features=["a", "b"]).count() == 0


def test_incomplete_rows_are_dropped_for_null_and_nan(table):
    assert [r[0] for r in rows(prepare.drop_incomplete(table, FEATURES))] == [1, 3, 7, 8, 9]
    # The target is not inspected.
    assert prepare.drop_incomplete(table, ["area"]).where("target is null").count() == 1


def test_duplicates_keep_the_lowest_key_with_its_own_label(table):
    kept = prepare.dedup_rows(table, FEATURES, "id")
    assert kept.columns == table.columns
    found = {r["id"]: r["target"] for r in kept.collect()}
    # 0.0 and -0.0 are the same value.
    assert found == {1: None, 3: 0, 4: 0, 5: 1, 8: 1}


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_cleaning_does_not_depend_on_the_layout(table, partitions):
    shuffled = table.orderBy(F.rand(partitions)).repartition(partitions)
    cleaned = prepare.clean_data(shuffled, FEATURES, "id", "index")
    assert [(r["id"], r["index"]) for r in cleaned.orderBy("id").collect()] == [
        (1, 0), (3, 1), (8, 2)
    ]


def test_cleaning_an_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prepare.clean_data(empty, FEATURES, "id", "index").count() == 0


def test_appended_duplicates_are_removed(events):
    features = ["user_id", "event_type", "value", "ts"]
    again = events.limit(5).withColumn("event_id", F.col("event_id") + 10**9)
    cleaned = prepare.clean_data(events.unionByName(again), features, "event_id")
    assert cleaned.count() == events.count()
    assert cleaned.agg(F.max("event_id")).first()[0] < 10**9


def test_unknown_feature_raises(table):
    with pytest.raises(ValueError, match="nope"):
        prepare.drop_incomplete(table, ["nope"])


def test_text_labels_get_codes_in_order(spark):
    labels = ["malignant", "benign", "malignant"]
    df = spark.createDataFrame(list(enumerate(labels)), "id long, y string")
    coded = prepare.encode_target(df, "y")
    assert [r[-1] for r in rows(coded)] == [1, 0, 1]
    assert dict(coded.dtypes)["code"] == "int"


def test_a_missing_label_gets_the_last_code(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a")], "id long, y string")
    assert [r[-1] for r in rows(prepare.encode_target(df, "y"))] == [1, 2, 0]


@pytest.mark.parametrize("kind", ["int", "bigint", "double"])
def test_numeric_labels_pass_through(spark, kind):
    df = spark.createDataFrame([(5,), (9,)], "y int").select(F.col("y").cast(kind))
    coded = prepare.encode_target(df, "y")
    assert sorted(r["code"] for r in coded.collect()) == [5, 9]
    assert dict(coded.dtypes)["code"] == kind


@pytest.mark.parametrize("kind", ["boolean", "float", "smallint"])
def test_other_label_types_are_coded(spark, kind):
    df = spark.createDataFrame([(0,), (1,)], "y int").select(F.col("y").cast(kind))
    assert sorted(r["code"] for r in prepare.encode_target(df, "y").collect()) == [0, 1]


def test_many_labels_are_coded(spark):
    df = spark.range(150_000).select("id", F.format_string("v%06d", F.col("id")).alias("y"))
    coded = prepare.encode_target(df, "y")
    assert coded.where("code <> id").isEmpty() and coded.count() == 150_000


def test_removing_duplicates_needs_no_sort(spark):
    df = spark.range(100).select("id", (F.col("id") % 7).cast("double").alias("x"), F.lit(1).alias("target"))
    text = plan(prepare.clean_data(df, ["x"], "id"))
    assert "SortAggregate" not in text and "HashAggregate" in text


def test_present_feature_test_reaches_the_scan(events):
    text = plan(prepare.drop_incomplete(events.select("event_id", "value"), ["value"]))
    assert "PushedFilters: [IsNotNull(value)]" in text
    assert "ReadSchema: struct<event_id:bigint,value:double>" in text


def test_duplicates_collapse_before_the_shuffle(events):
    text = plan(prepare.dedup_rows(events.select("event_id", "user_id"), ["user_id"], "event_id"))
    assert "partial_min" in text and text.count("Exchange") == 1
