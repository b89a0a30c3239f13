"""Data profiles and checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rowmill.functions import missing_condition, quoted, require_columns, settled
from rowmill.operators.moments import moments


def class_distribution(df: DataFrame, target: str) -> DataFrame:
    """(class, n, share)."""
    counts = settled(df.groupBy(F.col(quoted(target))).agg(F.count(F.lit(1)).alias("n")))
    total = F.lit(counts.agg(F.sum("n")).first()[0]).cast("double")
    share = F.try_divide(F.col("n").cast("double"), total)
    return counts.withColumn("share", share)


def prediction_distribution(df: DataFrame, y_pred: str = "y_pred") -> DataFrame:
    """(prediction, n): distinct predicted values and their counts."""
    return df.groupBy(F.col(quoted(y_pred))).agg(F.count(F.lit(1)).alias("n"))


def feature_profile(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, n, n_missing, mean, std): std is the sample standard deviation."""
    found = moments(df, features)
    spread = F.try_divide(F.col("var_pop") * F.col("n"), (F.col("n") - 1).cast("double"))
    return found.select("feature", "n", "n_missing", "mean", F.sqrt(spread).alias("std"))


def profile_summary(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(n_rows, n_features, mean_of_means, mean_of_stds) in one row."""
    return feature_profile(df, features).agg(
        F.max(F.col("n") + F.col("n_missing")).alias("n_rows"),
        F.count(F.lit(1)).alias("n_features"),
        F.avg("mean").alias("mean_of_means"),
        F.avg("std").alias("mean_of_stds"),
    )


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n_missing) for columns of any type; NaN counts as missing."""
    names = list(columns) if columns else df.columns
    require_columns(df, names)
    counted = df.agg(
        *[
            F.expr(f"count_if({missing_condition(c, df.schema[c].dataType)})").alias(f"_{i}")
            for i, c in enumerate(names)
        ]
    )
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("n_missing"))
        for i, c in enumerate(names)
    ]
    return counted.select(F.explode(F.array(*entries)).alias("entry")).select("entry.*")
