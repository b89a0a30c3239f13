"""Standardisation with the population standard deviation."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from rowmill.functions import quoted, small_table
from rowmill.operators.moments import moments


class Scale(NamedTuple):
    """Centre and divisor of one feature."""

    mean: float
    std: float


def scaler_from_moments(features: DataFrame) -> DataFrame:
    """(position, feature, mean, std) from per-feature moments.

    A constant feature gets std 1, so it is centred and not divided.
    """
    std = F.sqrt("var_pop")
    return features.select(
        "position",
        "feature",
        "mean",
        F.when(std == 0, F.lit(1.0)).otherwise(std).alias("std"),
    )


def fit_scaler(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Per-feature mean and population standard deviation, missing values ignored."""
    return scaler_from_moments(moments(df, features))


def scaler_values(scaler: DataFrame) -> dict[str, Scale]:
    """Fetch a scaler table: one entry per feature."""
    rows = scaler.select("feature", "mean", "std").collect()
    return {r["feature"]: Scale(r["mean"], r["std"]) for r in rows}


def standardised(name: str, scale: Scale) -> Column:
    """(x - mean) / std; a feature without any value at fit time stays NULL."""
    value = F.col(quoted(name)).cast("double")
    if scale.mean is None or scale.std is None:
        return F.lit(None).cast("double").alias(name)
    return ((value - F.lit(scale.mean)) / F.lit(scale.std)).alias(name)


def apply_scaler(df: DataFrame, scaler: DataFrame | dict[str, Scale]) -> DataFrame:
    """Standardise the scaler's features in place; names, order and other columns
    are kept. One projection, no shuffle."""
    scales = scaler if isinstance(scaler, dict) else scaler_values(scaler)
    absent = [c for c in scales if c not in df.columns]
    if absent:
        raise ValueError(f"the scaler was fitted on columns the table lacks: {absent}")
    return df.select(
        *[standardised(c, scales[c]) if c in scales else F.col(quoted(c)) for c in df.columns]
    )


def apply_params(long: DataFrame, scaler: DataFrame, value: str = "value") -> DataFrame:
    """Standardise a table in (feature, value) layout by joining its parameters.

    The parameter table is broadcast when it is small enough, else shuffled.
    """
    params = small_table(scaler.select("feature", "mean", "std"))
    joined = long.join(params, "feature")
    scaled = (F.col(quoted(value)) - F.col("mean")) / F.col("std")
    return joined.withColumn("scaled", scaled).drop("mean", "std")


def normalize_features(
    df: DataFrame,
    features: Sequence[str],
    scaler: DataFrame | None = None,
    fit: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Scaled table and the scaler used. ``fit=False`` needs a fitted scaler."""
    if fit:
        scaler = small_table(fit_scaler(df, features))
    elif scaler is None:
        raise ValueError("fit=False needs a fitted scaler")
    return apply_scaler(df, scaler), scaler
