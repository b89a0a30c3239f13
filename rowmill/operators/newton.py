"""Logistic regression of two classes by Newton steps on Gram matrices.

A step is one pass over the rows: each task adds up loss, gradient and the weighted Gram matrix
of its rows and hands out one row of these sums, Spark adds them by position, and the driver
solves a system of as many equations as there are features. The sums don't grow with the rows.
A step that raises the loss is halved, so the fit ends at the one optimum from any start.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowmill.functions import join_path, quoted, require_columns, stored

#: Features, at most: the Gram matrix of so many is a bounded row of a task.
MAX_FEATURES = 2_000
#: Rows whose matrix a task holds at a time.
CHUNK = 8_192
HALVINGS = 40
#: Gains of a step, as a share of the loss, that rounding hides.
ROUNDING = 1e-15
ABOUT = (
    "features array<string>, classes array<string>, class_type string, coefficients array<double>, "
    "intercept double, n_steps int"
)


@dataclass(frozen=True)
class LinearModel:
    """A fitted regression: the second class is the one whose chance grows with the score."""

    features: Sequence[str]
    classes: Sequence[str]
    class_type: str
    coefficients: Sequence[float]
    intercept: float
    n_steps: int

    def chance(self) -> Column:
        """The chance of the second class, inside generated code; missing features fail."""
        score = F.lit(self.intercept)
        for name, weight in zip(self.features, self.coefficients):
            score = score + F.lit(weight) * F.col(quoted(name)).cast("double")
        whole = F.when(score.isNotNull() & ~F.isnan(score), score).otherwise(
            F.raise_error(F.lit("a feature to be scored is missing")).cast("double")
        )
        return 1 / (1 + F.exp(-whole))

    def class_array(self) -> Column:
        return F.array(*[F.lit(c).cast(self.class_type) for c in self.classes])


def row_sums(x: np.ndarray, y: np.ndarray, weight: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """Loss, gradient and upper triangle of the Gram matrix of rows x, whose last column is
    the intercept's, at the coefficients beta."""
    score = x @ beta
    chance = 0.5 * (1 + np.tanh(score / 2))
    loss = float(weight @ (np.logaddexp(0, score) - y * score))
    gradient = x.T @ (weight * (chance - y))
    gram = x.T @ (x * (weight * chance * (1 - chance))[:, None])
    return np.concatenate(([loss], gradient, gram[np.triu_indices(len(beta))]))


def sums_at(rows: DataFrame, beta: np.ndarray, size: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, gradient and Gram matrix over all rows (x, y, weight)."""
    width = 1 + size + size * (size + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, size - 1)
                x = np.column_stack((x, np.ones(part.num_rows)))
                y, weight = (part.column(c).to_numpy(zero_copy_only=False) for c in ("y", "weight"))
                total += row_sums(x, y, weight, beta)
        yield pa.record_batch([pa.array([total], pa.list_(pa.float64()))], ["sums"])

    # a row per task; added by position, so the driver gets one number per position
    found = rows.mapInArrow(run, "sums array<double>").select(F.posexplode("sums").alias("at", "v"))
    table = found.groupBy("at").agg(F.sum("v").alias("v")).toArrow()
    sums = np.zeros(width)
    sums[table.column("at").to_numpy()] = table.column("v").to_numpy()
    gram = np.zeros((size, size))
    gram[np.triu_indices(size)] = sums[1 + size :]
    return float(sums[0]), sums[1 : 1 + size], gram + np.triu(gram, 1).T


def fit_newton(
    df: DataFrame, features: Sequence[str], label: Column, classes: Sequence, class_type: str,
    penalty: float, intercept: bool = True, weights: Sequence[float] | None = None,
    max_steps: int = 1000, tolerance: float = 1e-9,
) -> LinearModel:
    """Minimise the sum of the rows' losses plus ``penalty`` / 2 times the squared length of
    the coefficients; the intercept isn't penalised. ``label`` is 0 or 1. Ends where no part of
    the gradient exceeds ``tolerance`` per row, or a step's gain is lost in rounding."""
    require_columns(df, features)
    if len(classes) != 2:
        raise ValueError(f"this solver takes two classes, the rows have {len(classes)}")
    if len(features) > MAX_FEATURES:
        raise ValueError(f"this solver takes {MAX_FEATURES} features at most, got {len(features)}")
    values = F.array(*[F.col(quoted(c)).cast("double") for c in features])
    whole = F.when(F.forall(values, lambda v: v.isNotNull() & ~F.isnan(v)), values).otherwise(
        F.raise_error(F.lit("a feature of a training row is missing")).cast("array<double>")
    )
    weight = F.get(F.lit([float(w) for w in weights or (1.0, 1.0)]), F.col("y").cast("int"))
    rows = stored(df.select(whole.alias("x"), label.cast("double").alias("y")).withColumn("weight", weight))
    n, size = rows.count(), len(features) + 1
    ridge = np.full(size, float(penalty))
    ridge[-1] = 0.0
    free = np.arange(size if intercept else size - 1)

    def at(beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        loss, gradient, gram = sums_at(rows, beta, size)
        return loss + float(ridge @ beta**2) / 2, gradient + ridge * beta, gram + np.diag(ridge)

    beta = np.zeros(size)
    loss, gradient, gram = at(beta)
    steps = 0
    while steps < max_steps and np.abs(gradient[free]).max(initial=0.0) > tolerance * max(n, 1):
        step = np.zeros(size)
        step[free] = np.linalg.lstsq(gram[np.ix_(free, free)], gradient[free], rcond=None)[0]
        if gradient @ step <= ROUNDING * abs(loss):
            beta, steps = beta - step, steps + 1  # the loss can't show what is left to gain
            break
        for halved in range(HALVINGS):
            tried = beta - step / 2**halved
            found = at(tried)
            if found[0] < loss:
                break
        else:
            break
        beta, (loss, gradient, gram), steps = tried, found, steps + 1
    return LinearModel(
        tuple(features), tuple(map(str, classes)), class_type, tuple(beta[:-1].tolist()), float(beta[-1]), steps
    )


def save_linear(spark: SparkSession, model: LinearModel, path: str) -> None:
    """Write the model as one row of JSON, replacing an older one."""
    row = (list(model.features), list(model.classes), model.class_type, list(model.coefficients), model.intercept, model.n_steps)
    spark.createDataFrame([row], ABOUT).coalesce(1).write.mode("overwrite").json(join_path(path, "linear"))


def load_linear(spark: SparkSession, path: str) -> LinearModel:
    """A model written by save_linear."""
    row = spark.read.schema(ABOUT).json(join_path(path, "linear")).first()
    return LinearModel(*(tuple(v) if isinstance(v, list) else v for v in row))
