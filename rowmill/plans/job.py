"""The whole job: clean, split, scale, select, train, score, evaluate, store.

What leaves the executors is bounded: class counts, one digest per class, moments
per class and feature, the selected names, the report. Everything else is a
DataFrame plan over stage tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from rowmill.functions import join_path, match_flag, quoted, require_columns, settled, small_table
from rowmill.operators import metrics as m
from rowmill.operators.models import TreeModel, score, train_model
from rowmill.operators.moments import combine_classes, moments
from rowmill.operators.newton import LinearModel
from rowmill.operators.prepare import clean_data, feature_names
from rowmill.operators.scaling import apply_scaler, scaler_from_moments, scaler_values
from rowmill.operators.selection import f_scores_from_moments, rank_features, selected_names
from rowmill.operators.splitting import assign_split, split_cuts
from rowmill.plans.config import JobConfig
from rowmill.sources import artifacts
from rowmill.sources.tables import write_dataset, write_stage


@dataclass(frozen=True)
class JobResult:
    """Small results as evaluated tables, large ones as stored tables."""

    metrics: DataFrame
    confusion: DataFrame
    report: DataFrame
    train_accuracy: DataFrame
    ranking: DataFrame
    scaler: DataFrame
    selected: list[str]
    predictions: DataFrame
    model: PipelineModel | TreeModel | LinearModel


def run_job(
    df: DataFrame,
    key: str,
    target: str,
    out: str,
    config: JobConfig | None = None,
    features: Sequence[str] | None = None,
    run_id: str | None = None,
) -> JobResult:
    """Run the job on a (key, target, features) table and store it below ``out``.

    The cleaned table is written once and every later pass reads from it only the
    columns it needs: class and key for the split, the features once for scaler
    and scores together, the selected features for training and scoring.
    """
    config = config or JobConfig()
    names = list(features) if features else feature_names(df, key, target)
    require_columns(df, [key, target, *names])
    wanted = [F.col(quoted(c)) for c in (key, target, *names)]

    def place(*parts: str) -> str:
        return join_path(out, *parts)

    cleaned = write_stage(clean_data(df.select(*wanted), names, key), place("cleaned_data"))
    cuts = split_cuts(cleaned, key, target, config.test_size, config.random_state)
    assigned = assign_split(cleaned, cuts, key, target, config.random_state)
    train_rows = assigned.where(F.col("split") == "train")

    basis = cleaned if config.fit_on == "all" else train_rows
    # One scan serves scaler and scores; from here on one row per feature.
    found = small_table(combine_classes(moments(basis, names, [target])))
    scaler = scaler_from_moments(found)
    artifacts.save_scaler(scaler, place("feature_scaler"))
    ranking = small_table(rank_features(f_scores_from_moments(found), config.n_features))
    chosen = selected_names(ranking)
    scales = scaler_values(scaler)
    if config.keep_stages:
        write_dataset(df.select(quoted(key), quoted(target)), place("raw_target"))
        write_dataset(apply_scaler(cleaned, scales), place("normalized_data"))

    prepared = assigned.select(
        F.col(quoted(key)), F.col(quoted(target)), *[F.col(quoted(c)) for c in chosen], "split"
    )
    if config.use_scaling:
        prepared = apply_scaler(prepared, {c: scales[c] for c in chosen})
    # One pass writes both sides; reading one side opens only its folder.
    prepared.write.mode("overwrite").partitionBy("split").parquet(place("prepared_data"))
    stored = df.sparkSession.read.schema(prepared.schema).parquet(place("prepared_data"))
    train = stored.where(F.col("split") == "train").drop("split")
    test = stored.where(F.col("split") == "test").drop("split")

    model = train_model(
        train, chosen, target, key, config.algorithm, config.model_params(), config.partitions
    )
    artifacts.save_model(model, place("model"))

    result_columns = [
        F.col(quoted(key)),
        F.col(quoted(target)).cast("int").alias("y_true"),
        F.col("y_pred").cast("int").alias("y_pred"),
        "y_pred_proba",
    ]
    scored = score(model, test).select(*result_columns)
    predictions = write_stage(
        scored.withColumn("match", match_flag(F.col("y_true"), F.col("y_pred"))),
        place("predictions"),
    )
    if run_id is not None:
        artifacts.write_run_result(predictions, place("runs"), run_id, key)

    on_train = small_table(
        m.train_accuracy(score(model, train).withColumnRenamed(target, "y_true"))
    )
    area = "y_pred_proba" if "roc_auc" in config.metrics else None
    evaluated = m.binary_metrics(predictions, score=area)
    evaluated = small_table(evaluated.select("n", *config.metrics, "tn", "fp", "fn", "tp"))
    cells = settled(m.confusion_cells(predictions))
    m.require_labels(cells)
    confusion = m.matrix_from_cells(cells, labels=[0, 1])
    report = m.report_from_cells(cells)
    artifacts.write_metrics_json(evaluated.select(*config.metrics), place("metrics.json"))
    artifacts.write_confusion_csv(confusion, place("confusion_matrix.csv"))
    artifacts.write_report_text(report, place("classification_report.txt"))
    return JobResult(
        metrics=evaluated,
        confusion=confusion,
        report=report,
        train_accuracy=on_train,
        ranking=ranking,
        scaler=scaler,
        selected=chosen,
        predictions=predictions,
        model=model,
    )
