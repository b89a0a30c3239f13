"""Sinks for metrics, matrix, report, predictions, scaler, model and run results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from rowmill.functions import join_path, match_flag, quoted, require_columns
from rowmill.operators.comparison import run_digests, run_scores, run_summary
from rowmill.operators.metrics import confusion_table, report_text
from rowmill.operators.models import read_model, store_model
from rowmill.sources.tables import write_dataset
from rowmill.sources.versions import commit, manifests, read_committed

# Layout of a stored scaler.
SCALER_SCHEMA = StructType(
    [
        StructField("position", IntegerType()),
        StructField("feature", StringType()),
        StructField("mean", DoubleType()),
        StructField("std", DoubleType()),
    ]
)


def write_metrics_json(metrics: DataFrame, path: str) -> None:
    """One JSON object per metrics row; there are as many rows as runs, so one file."""
    metrics.coalesce(1).write.mode("overwrite").json(path)


def write_confusion_csv(matrix: DataFrame, path: str, labels: Sequence = (0, 1)) -> None:
    """The matrix with rows headed Actual and columns headed Predicted, one row per
    label, given or found, in one file."""
    confusion_table(matrix, labels).coalesce(1).write.mode("overwrite").csv(path, header=True)


def write_predictions(
    df: DataFrame, path: str, keep: Sequence[str] = (), format: str = "csv"
) -> None:
    """(kept columns, y_true, y_pred, match), one file per partition."""
    require_columns(df, [*keep, "y_true", "y_pred"])
    flag = match_flag(F.col("y_true"), F.col("y_pred")).alias("match")
    write_dataset(df.select(*keep, "y_true", "y_pred", flag), path, format)


def write_report_text(report: DataFrame, path: str) -> str:
    """The report as text, one line per class and summary row; returns it too."""
    text = report_text(report)
    lines = report.sparkSession.createDataFrame([(text.rstrip("\n"),)], "value string")
    lines.coalesce(1).write.mode("overwrite").text(path)
    return text


def save_scaler(scaler: DataFrame, path: str) -> None:
    """One row per feature."""
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in SCALER_SCHEMA]
    scaler.select(*columns).coalesce(1).write.mode("overwrite").parquet(path)


def load_scaler(spark: SparkSession, path: str) -> DataFrame:
    """A scaler written by save_scaler."""
    return spark.read.schema(SCALER_SCHEMA).parquet(path)


def save_model(model, path: str) -> None:
    """Persist a fitted model, creating folders and replacing an older one."""
    store_model(model, path)


def load_model(path: str):
    """A model written by save_model."""
    return read_model(SparkSession.active(), path)


def write_run_result(df: DataFrame, path: str, run_id: str, key: str) -> None:
    """Store one run's (key, y_true, y_pred, y_pred_proba) in a table partitioned by
    run. Repeating a run replaces its own rows and no others, in one step: until the new ones
    are complete, and if their write fails, readers get the old ones."""
    require_columns(df, [key, "y_true", "y_pred", "y_pred_proba"])
    rows = df.select(
        F.col(quoted(key)), "y_true", "y_pred", "y_pred_proba", F.lit(str(run_id)).alias("run_id")
    )
    if str(run_id) == "":
        raise ValueError("a run needs a name")
    commit(rows, path, str(run_id), ["run_id"])


def read_run_results(spark: SparkSession, path: str) -> DataFrame:
    """All stored runs; a filter on run_id reads only that run's files.

    Run names are text, whatever they look like: their type isn't inferred, so runs "1"
    and "01" stay two.
    """
    return read_committed(spark, path, ["run_id"])


# Where the states of a table of runs lie below it; readers of the rows don't see them.
SCORES, DIGESTS = "_scores", "_digests"


def write_run_state(spark: SparkSession, path: str, run_id: str, key: str) -> None:
    """Store what a summary needs of one stored run, reading only that run: how often it has each
    combination of labels and score, and digests of its key ranges. To be called after
    ``write_run_result``; a repeated call replaces the state."""
    one = read_run_results(spark, path).where(F.col("run_id") == F.lit(str(run_id)))
    if one.isEmpty():
        raise ValueError(f"no run {run_id!r} is stored at {path}")
    commit(run_scores(one), join_path(path, SCORES), str(run_id), ["run_id"])
    commit(run_digests(one, key), join_path(path, DIGESTS), str(run_id), ["run_id"])


def summarise_runs(spark: SparkSession, path: str, first: str, key: str) -> DataFrame:
    """``run_summary`` of all stored runs from their states. Runs without a state raise."""
    runs = read_run_results(spark, path)
    states = [set(manifests(spark, join_path(path, x))) for x in (SCORES, DIGESTS)]
    lacking = sorted(set(manifests(spark, path)) - (states[0] & states[1]))
    if lacking:
        raise ValueError(f"runs without a state: {lacking}")
    scores, digests = (read_committed(spark, join_path(path, x), ["run_id"]) for x in (SCORES, DIGESTS))
    return run_summary(runs, first, key, scores=scores, digests=digests)
