"""Univariate feature selection by the one-way analysis-of-variance F score."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from rowmill.functions import quoted
from rowmill.operators.moments import combine_classes, moments


def f_scores_from_moments(combined: DataFrame) -> DataFrame:
    """(position, feature, f_score) from combined class moments.

    A feature constant over all rows has no score (NULL); one constant within
    each class but different between classes scores +infinity.
    """
    explained = F.try_divide(F.col("between"), (F.col("classes") - 1).cast("double"))
    residual = F.try_divide(F.col("within"), (F.col("n") - F.col("classes")).cast("double"))
    none = F.lit(None).cast("double")
    score = (
        F.when(F.col("low") == F.col("high"), none)
        .when(explained.isNull() | residual.isNull(), none)
        .when(residual == 0, F.lit(float("inf")))
        .otherwise(F.try_divide(explained, residual))
    )
    return combined.select("position", "feature", score.alias("f_score"))


def anova_f(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """F score of every feature against the class label: one scan of the table."""
    return f_scores_from_moments(combine_classes(moments(df, features, [target])))


def rank_features(scores: DataFrame, k: int) -> DataFrame:
    """Add rank and selected flag. Highest score first, the later column wins a
    tie, features without a score come last. One row per feature throughout."""
    if k < 1:
        raise ValueError(f"number of features to select must be positive, got {k}")
    order = Window.orderBy(F.col("f_score").desc_nulls_last(), F.col("position").desc())
    return scores.withColumn("rank", F.row_number().over(order)).withColumn(
        "selected", (F.col("rank") <= F.lit(k)).cast("int")
    )


def select_k_best(
    df: DataFrame, features: Sequence[str], target: str, k: int = 20
) -> DataFrame:
    """(position, feature, f_score, rank, selected) for all features."""
    if k > len(features):
        warnings.warn(f"k={k} exceeds the {len(features)} features; all are kept", stacklevel=2)
    return rank_features(anova_f(df, features, target), k)


def selected_names(ranked: DataFrame) -> list[str]:
    """Names of the selected features in the table's column order."""
    rows = ranked.where(F.col("selected") == 1).select("position", "feature").collect()
    return [r["feature"] for r in sorted(rows)]


def top_features(ranked: DataFrame, n: int = 5) -> DataFrame:
    """First n selected features in column order (not the n highest scores)."""
    chosen = ranked.where(F.col("selected") == 1)
    return chosen.orderBy("position").limit(n).select("position", "feature")


def project_selected(
    df: DataFrame, names: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Kept columns and the named features, in the table's column order."""
    wanted = set(names) | set(keep)
    return df.select(*[F.col(quoted(c)) for c in df.columns if c in wanted])


def preprocess_features(
    df: DataFrame, features: Sequence[str], target: str, key: str, n_features: int = 20
) -> tuple[DataFrame, list[str]]:
    """Table reduced to its best features, and their names."""
    names = selected_names(select_k_best(df, features, target, n_features))
    return project_selected(df, names, (key, target)), names
