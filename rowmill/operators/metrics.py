"""Confusion matrix, rates, exact ROC area and per-class report.

Everything starts from a grouped count or sum, combined inside each task before
it is shuffled; what follows works on one row per class, cell or score range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowmill.functions import match_flag, quoted, require_columns, safe_ratio, settled, stored
from rowmill.operators.ranges import ROWS_PER_BUCKET, dense_index, with_range

# Names and order of the binary metrics.
METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc")


def _columns(names: Sequence[str]) -> list[Column]:
    return [F.col(quoted(c)) for c in names]


def confusion_cells(
    df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred", by: Sequence[str] = ()
) -> DataFrame:
    """(by, y_true, y_pred, n) for the label pairs that occur."""
    return df.groupBy(
        *_columns(by), F.col(quoted(y_true)).alias("y_true"), F.col(quoted(y_pred)).alias("y_pred")
    ).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(
    df: DataFrame,
    y_true: str = "y_true",
    y_pred: str = "y_pred",
    labels: Sequence | None = None,
    dense: bool = True,
) -> DataFrame:
    """(y_true, y_pred, n) for every pair of labels, 0 where none occurs; the sum of n is
    the number of rows.

    The labels are those found in either column and the given ones. A missing label
    raises ValueError. A dense matrix has a row per pair of labels; with ``dense`` off
    only pairs that occur have one, which suits columns of very many values.
    """
    cells = settled(confusion_cells(df, y_true, y_pred))
    require_labels(cells)
    return matrix_from_cells(cells, labels) if dense else cells


def require_labels(cells: DataFrame) -> None:
    """Raise ValueError with the number of rows that lack a label."""
    gap = F.col("y_true").isNull() | F.col("y_pred").isNull()
    missing = cells.agg(F.sum(F.when(gap, F.col("n")))).first()[0]
    if missing:
        raise ValueError(f"{missing} rows have a missing label")


def matrix_from_cells(cells: DataFrame, labels: Sequence | None = None) -> DataFrame:
    """Fill the grid of all label pairs from the counted ones, which are read twice.

    The grid has one row per pair of labels, found or given, whatever the table's size.
    """
    found = cells.agg(F.collect_set("y_true").alias("_t"), F.collect_set("y_pred").alias("_p"))
    axis = F.array_union("_t", "_p")
    if labels:
        axis = F.array_union(axis, F.lit(list(labels)).cast(f"array<{dict(cells.dtypes)['y_true']}>"))
    axis = found.select(axis.alias("_labels"))
    grid = axis.select("_labels", F.explode("_labels").alias("y_true")).select(
        "y_true", F.explode("_labels").alias("y_pred")
    )
    filled = grid.join(cells, ["y_true", "y_pred"], "left")
    return filled.select("y_true", "y_pred", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def confusion_table(matrix: DataFrame, labels: Sequence) -> DataFrame:
    """The matrix with one row per actual and one column per predicted label: the given
    labels in their order, then others that occur."""
    found = {r[0] for r in matrix.select("y_true").union(matrix.select("y_pred")).distinct().collect()}
    labels = [*labels, *sorted(found - set(labels))]
    counts = [
        F.sum(F.when(F.col("y_pred") == F.lit(v), F.col("n")).otherwise(F.lit(0).cast("long")))
        .alias(f"Predicted {v}")
        for v in labels
    ]
    wide = matrix.groupBy("y_true").agg(*counts).coalesce(1).sortWithinPartitions("y_true")
    actual = F.concat(F.lit("Actual "), F.col("y_true").cast("string")).alias("actual")
    return wide.select(actual, *[quoted(f"Predicted {v}") for v in labels])


def _rates(n: Column, hits: Column, tp: Column, fp: Column, positives: Column) -> list[Column]:
    return [
        safe_ratio(hits, n).alias("accuracy"),
        safe_ratio(tp, tp + fp).alias("precision"),
        safe_ratio(tp, positives).alias("recall"),
        safe_ratio(F.lit(2) * tp, tp + fp + positives).alias("f1"),
    ]


def binary_metrics(
    df: DataFrame,
    y_true: str = "y_true",
    y_pred: str = "y_pred",
    score: str | None = None,
    by: Sequence[str] = (),
    positive=1,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    weight: str | None = None,
) -> DataFrame:
    """accuracy, precision, recall, f1, the cells tn, fp, fn, tp and, when a score
    is given, roc_auc; one row per ``by`` group. A rate with nothing to divide by
    is 0.

    roc_auc is exact: the share of (positive, negative) pairs ranked rightly,
    ties counting half. It is NULL if a class or a score is missing. Rows are
    first folded per distinct score, so equal scores, however many, meet as one
    row per task; the folded table is stored, and the rows aren't read again. The
    distinct scores are then cut into ranges: each range counts the negatives below a
    score inside the range, and one row per range carries the count below the whole range.

    ``weight`` names a column that says how many rows a row stands for.

    The query fails if a label is missing or a group holds more than one label
    besides ``positive``: such rows have no place in two classes.
    """
    require_columns(df, [*by, y_true, y_pred, *([score] if score else []), *([weight] if weight else [])])
    actual = match_flag(F.col(quoted(y_true)), F.lit(positive)).cast("long")
    called = match_flag(F.col(quoted(y_pred)), F.lit(positive)).cast("long")
    counts = [
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("n"),
        F.sum(F.col("_hit") * F.col("_rows")).alias("_hits"),
        F.sum(F.col("_actual") * F.col("_called") * F.col("_rows")).alias("tp"),
        F.sum((F.lit(1) - F.col("_actual")) * F.col("_called") * F.col("_rows")).alias("fp"),
        F.sum(F.col("_actual") * F.col("_rows")).alias("_pos"),
        F.count_if(F.col("_gap")).alias("_gaps"),
        F.min("_low").alias("_low"),
        F.max("_high").alias("_high"),
    ]
    truth, call = F.col(quoted(y_true)), F.col(quoted(y_pred))
    others = [F.when(c != F.lit(positive), c) for c in (truth, call)]
    flagged = df.select(
        *_columns(by),
        *([F.col(quoted(score)).alias("_score")] if score else []),
        (F.col(quoted(weight)) if weight else F.lit(1)).cast("long").alias("_rows"),
        actual.alias("_actual"),
        called.alias("_called"),
        match_flag(truth, call).cast("long").alias("_hit"),
        (truth.isNull() | call.isNull()).alias("_gap"),
        F.least(*others).alias("_low"),
        F.greatest(*others).alias("_high"),
    )
    rates = _rates(F.col("n"), F.col("_hits"), F.col("tp"), F.col("fp"), F.col("_pos"))
    cells = [
        (F.col("n") - F.col("_pos") - F.col("fp")).alias("tn"),
        F.col("fp"),
        (F.col("_pos") - F.col("tp")).alias("fn"),
        F.col("tp"),
    ]
    if score is None:
        totals = flagged.groupBy(*_columns(by)).agg(*counts)
        return totals.where((F.col("n") > 0) & _two_classes()).select(*_columns(by), "n", *rates, *cells)

    folded = stored(flagged.groupBy(*_columns(by), "_score").agg(*counts))
    folded = with_range(
        folded.withColumn("_neg", F.col("n") - F.col("_pos")),
        [*by, "_score"], "_range", rows_per_bucket,
    )
    below = Window.partitionBy(*_columns(by), "_range").orderBy("_score")
    below = below.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("_neg").over(below), F.lit(0)).cast("double")
    unknown = F.col("_score").isNull() | F.isnan(F.col("_score").cast("double"))
    sums = ["n", "_hits", "tp", "fp", "_pos", "_neg", "_gaps"]
    ends = [F.min("_low").alias("_low"), F.max("_high").alias("_high")]
    ranges = (
        folded.withColumn("_won", F.col("_pos") * (inside + F.col("_neg") / F.lit(2.0)))
        .groupBy(*_columns(by), "_range")
        .agg(
            *[F.sum(c).alias(c) for c in sums],
            F.sum("_won").alias("_won"),
            F.count_if(unknown).alias("_unknown"),
            *ends,
        )
    )
    # One row per group and range from here on.
    earlier = Window.partitionBy(*_columns(by)).orderBy("_range")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    passed = F.coalesce(F.sum("_neg").over(earlier), F.lit(0)).cast("double")
    totals = (
        ranges.withColumn("_won", F.col("_won") + F.col("_pos") * passed)
        .groupBy(*_columns(by))
        .agg(
            *[F.sum(c).alias(c) for c in sums],
            F.sum("_won").alias("_won"),
            F.sum("_unknown").alias("_unknown"),
            *ends,
        )
    )
    pairs = F.col("_pos").cast("double") * F.col("_neg").cast("double")
    area = F.when(F.col("_unknown") == 0, F.try_divide(F.col("_won"), pairs))
    return totals.where((F.col("n") > 0) & _two_classes()).select(
        *_columns(by), "n", *rates, area.alias("roc_auc"), *cells
    )


def _two_classes() -> Column:
    """True; fails for a group with missing labels or labels of a third class."""
    def refused(text: Column) -> Column:
        return F.raise_error(text).cast("boolean")

    gaps = F.concat(F.col("_gaps").cast("string"), F.lit(" rows have a missing label"))
    third = F.concat(
        F.lit("more than two classes, among them "),
        F.col("_low").cast("string"), F.lit(" and "), F.col("_high").cast("string"),
    )
    return (
        F.when(F.col("_gaps") > 0, refused(gaps))
        .when(F.col("_low") != F.col("_high"), refused(third))
        .otherwise(F.lit(True))
    )


def roc_auc(
    df: DataFrame, y_true: str, score: str, by: Sequence[str] = (), **ranges
) -> DataFrame:
    """Exact area under the ROC curve, one row per ``by`` group."""
    metrics = binary_metrics(df, y_true, y_true, score, by, **ranges)
    return metrics.select(*_columns(by), "roc_auc")


def metrics_by_run(df: DataFrame, run_id: str = "run_id", **ranges) -> DataFrame:
    """binary_metrics of every run in a table of run results."""
    return binary_metrics(df, "y_true", "y_pred", "y_pred_proba", [run_id], **ranges)


def train_accuracy(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """Share of rows whose prediction equals the truth."""
    hit = match_flag(F.col(quoted(y_true)), F.col(quoted(y_pred))).cast("double")
    return df.agg(F.avg(hit).alias("accuracy"))


def classification_report(
    df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred"
) -> DataFrame:
    """(position, label, precision, recall, f1, support): one row per class in
    ascending order, then accuracy, macro avg and weighted avg.

    The accuracy row has its value in ``f1`` and no precision or recall, as in
    the printed report.
    """
    cells = settled(confusion_cells(df, y_true, y_pred))
    require_labels(cells)
    return report_from_cells(cells)


def report_from_cells(cells: DataFrame) -> DataFrame:
    """The report from the counted label pairs."""
    zero = F.lit(0).cast("long")
    hit = F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(zero)
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(
                    F.col("y_true").alias("value"),
                    F.col("n").alias("support"),
                    zero.alias("predicted"),
                    hit.alias("tp"),
                ),
                F.struct(
                    F.col("y_pred").alias("value"),
                    zero.alias("support"),
                    F.col("n").alias("predicted"),
                    zero.alias("tp"),
                ),
            )
        ).alias("side")
    ).select("side.*")
    classes = sides.groupBy("value").agg(
        *[F.sum(c).alias(c) for c in ("support", "predicted", "tp")]
    )
    # One row per class from here on.
    per_class = dense_index(settled(classes), "value", "_place").select(
        (F.col("_place") + 1).alias("position"),
        F.col("value").cast("string").alias("label"),
        safe_ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        safe_ratio(F.col("tp"), F.col("support")).alias("recall"),
        safe_ratio(F.lit(2) * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1"),
        "support",
        "tp",
    )
    rates = ("precision", "recall", "f1")
    overall = per_class.agg(
        F.count(F.lit(1)).alias("k"),
        F.sum("support").alias("support"),
        F.sum("tp").alias("tp"),
        *[F.avg(c).alias(f"macro_{c}") for c in rates],
        *[
            safe_ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(f"weighted_{c}")
            for c in rates
        ],
    ).where(F.col("k") > 0)
    nothing = F.lit(None).cast("double")

    def line(step: int, label: str, values: Sequence[Column]) -> Column:
        named = [v.alias(c) for v, c in zip(values, rates)]
        place = (F.col("k") + F.lit(step)).alias("position")
        return F.struct(place, F.lit(label).alias("label"), *named, F.col("support"))

    accuracy = safe_ratio(F.col("tp"), F.col("support"))
    averages = overall.select(
        F.explode(
            F.array(
                line(1, "accuracy", [nothing, nothing, accuracy]),
                line(2, "macro avg", [F.col(f"macro_{c}") for c in rates]),
                line(3, "weighted avg", [F.col(f"weighted_{c}") for c in rates]),
            )
        ).alias("line")
    ).select("line.*")
    return per_class.drop("tp").unionByName(averages)


def report_text(report: DataFrame, digits: int = 2) -> str:
    """The report as aligned text: a header, the classes and three summary rows."""
    rows = sorted(report.collect(), key=lambda r: r["position"])
    width = max(len("weighted avg"), *(len(r["label"]) for r in rows)) if rows else 12

    def cell(value) -> str:
        return f"{'' if value is None else format(value, f'.{digits}f'):>10}"

    # Column headings and widths of the printed report.
    lines = [f"{'':>{width}} {'precision':>10}{'recall':>10}{'f1-score':>10}{'support':>10}", ""]
    for row in rows:
        if row["label"] == "accuracy":
            lines.append("")
        rates = cell(row["precision"]) + cell(row["recall"]) + cell(row["f1"])
        lines.append(f"{row['label']:>{width}} {rates}{row['support']:>10}")
    return "\n".join(lines) + "\n"
