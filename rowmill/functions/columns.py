"""Scalar expressions. All stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType


def binary_target(label: Column, positive) -> Column:
    """1 where the label is the positive value, else 0; a missing label is 0."""
    return F.coalesce((label == F.lit(positive)).cast("int"), F.lit(0))


def match_flag(y_true: Column, y_pred: Column) -> Column:
    """1 where the prediction equals the truth, else 0."""
    return F.coalesce((y_true == y_pred).cast("int"), F.lit(0))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as a double, 0 where the denominator is 0."""
    return F.coalesce(
        F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0)
    )


def quoted(name: str) -> str:
    """Column name as it is written inside an SQL expression."""
    return "`" + name.replace("`", "``") + "`"


def missing_condition(name: str, data_type: DataType) -> str:
    """SQL condition: the cell is NULL or, in floating point columns, NaN.

    Wide tables state it per column, which as text is one expression to build.
    A plain IS NULL test lets the scan push its negation down.
    """
    column = quoted(name)
    if isinstance(data_type, (DoubleType, FloatType)):
        return f"({column} IS NULL OR isnan({column}))"
    return f"({column} IS NULL)"


def key_hash(key: str | Sequence[str], seed: int) -> Column:
    """Hex digest of seed and row key: a reproducible random order of the rows.

    Depends on nothing but the key and the seed, so membership decided from it
    survives repartitioning, reordering and additional columns.
    """
    names = [key] if isinstance(key, str) else list(key)
    parts = [F.lit(str(seed))] + [F.col(quoted(n)).cast("string") for n in names]
    return F.md5(F.concat_ws(":", *parts))


def within_tolerance(value: Column, reference: Column, rtol: float, atol: float) -> Column:
    """|value - reference| <= atol + rtol * |reference|; infinities only match
    themselves and NaN or NULL match nothing."""
    infinite = F.abs(reference) == F.lit(float("inf"))
    close = F.abs(value - reference) <= F.lit(atol) + F.lit(rtol) * F.abs(reference)
    return F.coalesce(
        ~F.isnan(value)
        & ~F.isnan(reference)
        & ((value == reference) | (~infinite & close)),
        F.lit(False),
    )
