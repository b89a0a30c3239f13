"""Count, mean, variance and range per feature, optionally per class.

The features are laid out as (position, value) pairs inside the scanning task and
folded by a partial aggregation in the same stage, so what is shuffled is one row
per task, class and feature. The variance is the central-moment form that merges
partial results without cancellation. The layout keeps the generated code small
for any number of features and lets each feature skip its own missing values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rowmill.functions import quoted, require_columns, settled


def long_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(kept columns, position, value): one row per input row and feature.

    NaN becomes NULL, so both count as missing.
    """
    require_columns(df, [*features, *keep])
    kept = [quoted(c) for c in keep]
    values = ", ".join(f"CAST({quoted(c)} AS DOUBLE)" for c in features)
    pairs = df.selectExpr(*kept, f"posexplode(array({values})) AS (position, _raw)")
    return pairs.selectExpr(*kept, "position", "IF(isnan(_raw), NULL, _raw) AS value")


def feature_name(features: Sequence[str]) -> Column:
    """Feature name of a position; applied to per-feature tables only."""
    return F.get(F.lit(list(features)), F.col("position")).alias("feature")


def moments(df: DataFrame, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, position, feature, n, n_missing, mean, var_pop, low, high).

    The mean of a feature that is constant within its group is that constant
    exactly, not a rounded quotient.
    """
    kept = [quoted(c) for c in by]
    folded = (
        long_features(df, features, by)
        .groupBy(*kept, "position")
        .agg(
            F.count("value").alias("n"),
            F.count_if(F.col("value").isNull()).alias("n_missing"),
            F.avg("value").alias("_mean"),
            F.var_pop("value").alias("var_pop"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
        )
    )
    mean = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.col("_mean"))
    return folded.select(
        *kept,
        "position",
        feature_name(features),
        "n",
        "n_missing",
        mean.alias("mean"),
        "var_pop",
        "low",
        "high",
    )


def combine_classes(class_moments: DataFrame) -> DataFrame:
    """Per-feature moments from per-class ones, without another scan.

    (position, feature, n, mean, var_pop, low, high, classes, between, within):
    ``between`` and ``within`` are the sums of squares of the class means around
    the overall mean and of the values around their class mean.
    """
    # read twice, so evaluated once; classes meet in sums, however many there are
    class_moments = settled(class_moments)
    # A class in which every value is missing has neither mean nor variance.
    overall = class_moments.groupBy("position", "feature").agg(
        F.sum("n").alias("n"),
        F.count_if(F.col("n") > 0).alias("classes"),
        F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n")).alias("_mean"),
        F.sum(F.col("n") * F.col("var_pop")).alias("within"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )
    constant = F.col("low") == F.col("high")
    centre = overall.select("position", F.col("_mean").alias("_centre"))
    spread = (
        class_moments.where("n > 0")
        .join(centre, "position")
        .groupBy("position")
        .agg(F.sum(F.col("n") * F.pow(F.col("mean") - F.col("_centre"), F.lit(2))).alias("_between"))
    )
    between = F.coalesce("_between", F.lit(0.0))
    return overall.join(spread, "position", "left").select(
        "position",
        "feature",
        "n",
        F.when(constant, F.col("low")).otherwise(F.col("_mean")).alias("mean"),
        F.when(constant, F.lit(0.0))
        .otherwise(F.try_divide(F.col("within") + between, F.col("n")))
        .alias("var_pop"),
        "low",
        "high",
        "classes",
        F.when(constant, F.lit(0.0)).otherwise(between).alias("between"),
        "within",
    )
