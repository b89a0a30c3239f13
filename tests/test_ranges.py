import math

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from rowmill.operators.ranges import dense_index, range_count, with_range


def test_missing_values_come_first_and_nan_last(spark):
    df = spark.createDataFrame([(None,), (math.nan,), (1.0,), (5.0,)] * 5, "v double")
    found = with_range(df, ["v"], "r", rows_per_bucket=2).collect()
    ends = {str(r["v"]): r["r"] for r in found}
    assert ends["None"] <= ends["1.0"] <= ends["5.0"] <= ends["nan"]
    assert all(r["r"] == ends[str(r["v"])] for r in found)


def test_whole_numbers_beyond_double_precision_stay_in_order(spark):
    big = 2**60
    df = spark.range(big, big + 500).toDF("k")
    found = dense_index(df, "k", rows_per_bucket=50).collect()
    assert all(r["index"] == r["k"] - big for r in found)


def test_ranges_follow_the_rows_without_a_ceiling(spark):
    assert range_count(spark.range(0), 10) == 1
    assert range_count(spark.range(100_001), 5) == 20_001


def test_ranges_are_balanced(spark):
    df = spark.range(20_000).select((F.col("id") * F.col("id")).cast("double").alias("v"))
    counts = with_range(df, ["v"], "r", rows_per_bucket=1000).groupBy("r").count().collect()
    assert len(counts) == 20 and max(r["count"] for r in counts) < 4000


@pytest.mark.parametrize("rows_per_bucket", [10**6, 100, 7])
def test_index_is_dense_and_in_key_order(spark, rows_per_bucket):
    df = spark.range(1000).select((F.col("id") * 17 % 1009 - 300).alias("k"), F.lit("x").alias("o"))
    indexed = dense_index(df.repartition(5), "k", rows_per_bucket=rows_per_bucket)
    assert indexed.columns == ["k", "o", "index"]
    ordered = sorted(r["k"] for r in df.collect())
    assert {r["k"]: r["index"] for r in indexed.collect()} == {k: i for i, k in enumerate(ordered)}


def test_index_in_a_given_order(spark):
    df = spark.createDataFrame([(1, "b"), (2, "b"), (1, "a"), (2, "a")], "n int, v string")
    found = dense_index(df, [F.desc("n"), F.asc("v")], rows_per_bucket=1)
    assert {(r["n"], r["v"]): r["index"] for r in found.collect()} == {
        (2, "a"): 0, (2, "b"): 1, (1, "a"): 2, (1, "b"): 3
    }


@pytest.mark.parametrize("kind", ["string", "timestamp", "timestamp_ntz", "date", "decimal(12,2)"])
def test_index_over_other_key_types(spark, kind):
    number = F.col("id") * 37 % 401
    key = {
        "string": F.format_string("k%d", number),
        "timestamp": F.timestamp_seconds(number * 86_400 + 5),
        "timestamp_ntz": F.timestamp_seconds(number * 86_400 + 5).cast("timestamp_ntz"),
        "date": F.date_add(F.lit("2020-01-01").cast("date"), number.cast("int")),
        "decimal(12,2)": number.cast("decimal(12,2)"),
    }[kind]
    df = spark.range(400).select(key.alias("k"))
    found = dense_index(df, "k", rows_per_bucket=20).collect()
    ordered = sorted(r["k"] for r in df.collect())
    assert {r["k"]: r["index"] for r in found} == {k: i for i, k in enumerate(ordered)}


def test_index_of_an_empty_table(spark):
    assert rows(dense_index(spark.createDataFrame([], "k long"), "k")) == []


def test_no_row_passes_through_a_single_task(spark):
    text = plan(dense_index(spark.range(1000).toDF("k"), "k", rows_per_bucket=100))
    above, _, below = text.partition("SinglePartition")
    assert "SinglePartition" not in below and "_rows" in above
