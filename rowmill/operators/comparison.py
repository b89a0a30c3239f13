"""Key-aligned joins of predictions and comparison of several runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rowmill.functions import match_flag, quoted, require_columns, settled, within_tolerance
from rowmill.operators.metrics import metrics_by_run

# Tolerances of the score comparison.
RTOL = 1e-8
ATOL = 1e-10

#: Ranges of keys that runs are digested in.
RANGES = 1024


def require_unique(df: DataFrame, key: str) -> None:
    """Raise ValueError if a key value occurs more than once."""
    repeated = df.groupBy(F.col(quoted(key))).count().where(F.col("count") > 1)
    example = repeated.limit(1).collect()
    if example:
        raise ValueError(f"{key} is not unique: {example[0][0]!r} occurs {example[0][1]} times")


def attach_target(
    features: DataFrame, targets: DataFrame, key: str, check: bool = True, partial: bool = False
) -> DataFrame:
    """Features with the target row of the same key. With ``check`` a repeated key on the
    target side raises instead of multiplying rows. Features without a target raise too,
    unless the targets are known to be ``partial``; such features are then left out."""
    require_columns(features, [key])
    require_columns(targets, [key])
    if check:
        require_unique(targets, key)
    if not partial:
        alone = unmatched_keys(features, targets, key).first()["n_left_only"]
        if alone:
            raise ValueError(f"{alone} values of {key} have features but no target")
    return features.join(targets, key)


def unmatched_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(n_matched, n_left_only, n_right_only): one shuffle of the keys."""
    on_left = left.select(quoted(key), F.lit(1).alias("_l"), F.lit(0).alias("_r"))
    on_right = right.select(quoted(key), F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    sides = on_left.unionByName(on_right)
    per_key = sides.groupBy(quoted(key)).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    return per_key.agg(
        F.count_if((F.col("_l") == 1) & (F.col("_r") == 1)).alias("n_matched"),
        F.count_if(F.col("_r") == 0).alias("n_left_only"),
        F.count_if(F.col("_l") == 0).alias("n_right_only"),
    )


def join_predictions(
    truth: DataFrame, predictions: DataFrame, key: str, check: bool = True
) -> DataFrame:
    """Truth and stored predictions of the same key, with the match flag.

    A key found on one side only raises ValueError, unless ``check`` is off.
    """
    if check:
        found = unmatched_keys(truth, predictions, key).first()
        if found["n_left_only"] or found["n_right_only"]:
            raise ValueError(
                f"truth and predictions differ in length: {found['n_left_only']} keys without "
                f"prediction, {found['n_right_only']} predictions without truth"
            )
    joined = truth.join(predictions, key)
    return joined.withColumn("match", match_flag(F.col("y_true"), F.col("y_pred")))


def compare_runs(
    runs: DataFrame,
    first: str,
    key: str,
    run_id: str = "run_id",
    rtol: float = RTOL,
    atol: float = ATOL,
    digests: DataFrame | None = None,
) -> DataFrame:
    """(run_id, n_first, n_run, n_matched, n_label_diff, n_prediction_diff,
    n_score_diff, same_labels, same_predictions, same_scores) of every other run
    against the first, row by row on the key.

    Labels are the same only if both runs hold exactly the same keys; if they are
    not, predictions and scores count as different too.

    Runs are compared by digests of key ranges first: counts and order-free digests of labels,
    predictions and scores. Where a range's digests agree with the first run's, so do its
    rows; rows meet in a join on the key only in ranges that differ, and equal runs are never
    joined. ``digests`` are those of ``run_digests``, if they are known already.
    Keys missing on either side show in the counts. A first run without rows raises
    ValueError, a key that it holds twice too; a key that another run holds twice fails the query.
    """
    require_columns(runs, [run_id, key, "y_true", "y_pred", "y_pred_proba"])
    is_first = F.col(quoted(run_id)) == F.lit(first)
    digests = settled(run_digests(runs, key, run_id) if digests is None else digests)
    base, others = digests.where(is_first), digests.where(~is_first)
    n_first = base.agg(F.sum("n")).first()[0]
    if not n_first:
        raise ValueError(f"no run {first!r} in {run_id}")
    repeated = runs.where(is_first).groupBy(F.col(quoted(key))).count().where("count > 1").limit(1)
    if not repeated.isEmpty():
        raise ValueError(f"a run ({first}) holds a key more than once")

    # equal digests, so equal rows: what holds for the run's range holds for the first run's
    marks = [c for c in digests.columns if c not in (run_id, "_range", "n_unscored")]
    known = base.select("_range", *[F.col(c).alias(f"_first_{c}") for c in marks])
    same = F.lit(True)
    for c in marks:
        same = same & F.coalesce(F.col(c) == F.col(f"_first_{c}"), F.lit(False))
    judged = settled(
        others.join(known, "_range", "left").select(F.col(quoted(run_id)), "_range", "n", "n_unscored", same.alias("_same"))
    )
    equal = F.when(F.col("_same"), F.col("n")).otherwise(F.lit(0))
    totals = judged.groupBy(F.col(quoted(run_id))).agg(
        F.sum("n").alias("n_run"),
        F.sum(equal).alias("n_matched"),
        # a missing score is close to nothing, not even to another one
        F.sum(F.when(F.col("_same"), F.col("n_unscored")).otherwise(F.lit(0))).alias("n_score_diff"),
    )
    differing = judged.where(~F.col("_same")).select(F.col(quoted(run_id)), "_range")
    zero = F.lit(0).cast("long")
    if differing.isEmpty():
        counts = totals.withColumns({"n_label_diff": zero, "n_prediction_diff": zero})
    else:
        found = _row_differences(runs, first, key, run_id, differing, rtol, atol)
        joined = totals.join(settled(found), run_id, "left")
        counts = joined.select(
            F.col(quoted(run_id)), "n_run",
            (F.col("n_matched") + F.coalesce("_matched", zero)).alias("n_matched"),
            F.coalesce("_labels", zero).alias("n_label_diff"),
            F.coalesce("_predictions", zero).alias("n_prediction_diff"),
            (F.col("n_score_diff") + F.coalesce("_scores", zero)).alias("n_score_diff"),
        )
    counts = counts.select(
        F.col(quoted(run_id)), F.lit(n_first).cast("long").alias("n_first"),
        *[F.col(c).cast("long").alias(c) for c in ("n_run", "n_matched", "n_label_diff", "n_prediction_diff", "n_score_diff")],
    )
    same_keys = (F.col("n_matched") == F.col("n_first")) & (F.col("n_matched") == F.col("n_run"))
    labels = same_keys & (F.col("n_label_diff") == 0)
    return (
        counts.withColumn("same_labels", labels)
        .withColumn("same_predictions", F.col("same_labels") & (F.col("n_prediction_diff") == 0))
        .withColumn("same_scores", F.col("same_labels") & (F.col("n_score_diff") == 0))
    )


def run_digests(runs: DataFrame, key: str, run_id: str = "run_id") -> DataFrame:
    """(run_id, _range, n, n_unscored, digests): a row per run and key range, mergeable in any
    order. Each digest is 128 bits over (key, value) of a column, a missing value included."""
    own = F.col(quoted(key))
    values = {"label": F.col("y_true"), "prediction": F.col("y_pred"), "score": F.col("y_pred_proba").cast("double")}
    score = values["score"]
    digests = [
        F.bit_xor(F.xxhash64(F.lit(salt), own, value.isNull(), value)).alias(f"{name}_{salt}")
        for name, value in values.items() for salt in (1, 2)
    ]
    place = F.pmod(F.xxhash64(own), F.lit(RANGES)).alias("_range")
    return runs.groupBy(F.col(quoted(run_id)), place).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(score.isNull() | F.isnan(score)).alias("n_unscored"), *digests
    )


def _row_differences(
    runs: DataFrame, first: str, key: str, run_id: str, differing: DataFrame, rtol: float, atol: float
) -> DataFrame:
    """(run_id, _matched, _labels, _predictions, _scores) from a join of rows on the key, in
    the key ranges that differ."""
    own = F.col(quoted(key))
    placed = runs.select(
        F.col(quoted(run_id)), own.alias("_key"), "y_true", "y_pred",
        F.col("y_pred_proba").cast("double").alias("y_pred_proba"), F.pmod(F.xxhash64(own), F.lit(RANGES)).alias("_range"),
    )
    is_first = F.col(quoted(run_id)) == F.lit(first)
    base = placed.where(is_first).join(differing.select("_range").distinct(), "_range", "left_semi").select(
        "_key", F.col("y_true").alias("_true"), F.col("y_pred").alias("_pred"), F.col("y_pred_proba").alias("_score"),
        F.lit(True).alias("_base"),
    )
    others = placed.where(~is_first).join(differing, [run_id, "_range"], "left_semi").drop("_range")
    others = _once_per_key(others, [run_id, "_key"], "compared with it")
    joined = others.join(base, "_key", "left")
    matched = F.col("_base").isNotNull()
    close = within_tolerance(F.col("_score"), F.col("y_pred_proba"), rtol, atol)

    def differ(same: Column) -> Column:
        return F.count_if(matched & ~F.coalesce(same, F.lit(False)))

    return joined.groupBy(F.col(quoted(run_id))).agg(
        F.count_if(matched).alias("_matched"),
        differ(F.col("y_true").eqNullSafe(F.col("_true"))).alias("_labels"),
        differ(F.col("y_pred").eqNullSafe(F.col("_pred"))).alias("_predictions"),
        differ(close).alias("_scores"),
    )


def _once_per_key(rows: DataFrame, names: list[str], run: str) -> DataFrame:
    """The rows, folded by key; the query fails where a key is repeated."""
    once = F.when(F.count(F.lit(1)) == 1, F.lit(True)).otherwise(
        F.raise_error(F.lit(f"a run ({run}) holds a key more than once")).cast("boolean")
    )
    rest = [c for c in rows.columns if c not in names]
    folded = rows.groupBy(*[quoted(c) for c in names]).agg(
        *[F.max(quoted(c)).alias(c) for c in rest], once.alias("_once")
    )
    return folded.where("_once").drop("_once")


def compare_labels(runs: DataFrame, first: str, key: str, run_id: str = "run_id") -> DataFrame:
    """(run_id, same_labels)."""
    return compare_runs(runs, first, key, run_id).select(F.col(quoted(run_id)), "same_labels")


def compare_predictions(runs: DataFrame, first: str, key: str, run_id: str = "run_id") -> DataFrame:
    """(run_id, same_predictions); False whenever the labels differ."""
    return compare_runs(runs, first, key, run_id).select(F.col(quoted(run_id)), "same_predictions")


def compare_scores(
    runs: DataFrame,
    first: str,
    key: str,
    run_id: str = "run_id",
    rtol: float = RTOL,
    atol: float = ATOL,
) -> DataFrame:
    """(run_id, same_scores) within tolerance; False whenever the labels differ."""
    compared = compare_runs(runs, first, key, run_id, rtol, atol)
    return compared.select(F.col(quoted(run_id)), "same_scores")


def run_summary(
    runs: DataFrame, first: str, key: str, run_id: str = "run_id",
    scores: DataFrame | None = None, digests: DataFrame | None = None,
) -> DataFrame:
    """Metrics of every run and its agreement with the first (NULL for the first).

    With the runs' states, ``scores`` of ``run_scores`` and ``digests`` of ``run_digests``, rows are
    read only of the first run, for its keys, and in key ranges that differ.
    """
    flags = compare_runs(runs, first, key, run_id, digests=digests).select(
        F.col(quoted(run_id)), "same_labels", "same_predictions", "same_scores"
    )
    if scores is None:
        found = metrics_by_run(runs, run_id)
    else:
        found = metrics_by_run(scores, run_id, weight="n")
    return found.join(settled(flags), run_id, "left")


def run_scores(runs: DataFrame, run_id: str = "run_id") -> DataFrame:
    """(run_id, y_true, y_pred, y_pred_proba, n): how often each run has each combination. All
    metrics of a run follow from it, and those of two parts of a run add up."""
    names = [quoted(run_id), "y_true", "y_pred", "y_pred_proba"]
    return runs.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
