"""Target derivation, label codes and row cleaning."""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import DataFrame, Window, functions as F

from rowmill.functions import (
    binary_target,
    missing_condition,
    quoted,
    require_columns,
    settled,
    stored,
)
from rowmill.operators.ranges import POSITION_BITS, dense_index

# The label types that are taken as numeric codes already.
NUMERIC_LABEL_TYPES = ("bigint", "int", "double")


def derive_binary_target(
    df: DataFrame, label: str, positive, target: str = "target"
) -> DataFrame:
    """Replace the label column by a 0/1 target."""
    require_columns(df, [label])
    flagged = df.withColumn("_target", binary_target(F.col(quoted(label)), positive))
    return flagged.drop(label).withColumnRenamed("_target", target)


def label_table(
    df: DataFrame,
    key: str | None,
    label: str = "diagnosis",
    positive="M",
    target: str = "target",
    features: Sequence[str] | None = None,
) -> DataFrame:
    """Bring a raw table into the form (key, target, features as double).

    The target comes from ``label`` if that column exists, else an existing
    ``target`` column is taken as it is. Without a key column, one is derived
    from the row's content, and equal rows are numbered, so each row has a key of its own
    however the table is laid out; see ``content_key``.
    """
    if label in df.columns:
        labelled = derive_binary_target(df, label, positive, target)
    else:
        require_columns(df, [target])
        labelled = df.withColumn(target, F.col(quoted(target)).cast("int"))
    names = list(features) if features else [
        c for c in labelled.columns if c not in (key, target)
    ]
    require_columns(labelled, names)
    values = [F.col(quoted(c)).cast("double").alias(c) for c in names]
    if key is None or key not in labelled.columns:
        key = key or "id"
        return content_key(labelled.select(F.col(quoted(target)), *values), key)
    return labelled.select(F.col(quoted(key)), F.col(quoted(target)), *values)


def content_key(df: DataFrame, key: str) -> DataFrame:
    """The table with a text key in front: the digest of the row's content, and behind it -1, -2
    and so on for the second and further rows with the same content.

    Equal rows are alike but for their numbers, so the result doesn't depend on the layout of
    the table. They are numbered within the parts of the stored table, and a row per content
    and part carries what lies before, so content that a third of all rows share is no one
    task's work; rows whose content is their own take no part in it.
    """
    columns = [F.col(quoted(c)) for c in df.columns]
    digest = F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))
    rows = stored(df.select(digest.alias("_content"), F.monotonically_increasing_id().alias("_row"), *columns))
    # the upper bits of such a number are the part, the lower ones count its rows
    part = F.shiftright("_row", POSITION_BITS).alias("_part")
    groups = stored(rows.groupBy("_content", part).agg(F.count(F.lit(1)).alias("_n")))
    several = groups.groupBy("_content").agg(F.sum("_n").alias("_all")).where("_all > 1").select("_content")
    upward = Window.partitionBy("_content").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = groups.join(several, "_content").select(
        "_content", "_part", F.coalesce(F.sum("_n").over(upward), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("_content", "_part").orderBy("_row")
    numbers = (
        rows.select("_content", "_row", part)
        .join(before, ["_content", "_part"])
        .select("_row", (F.col("_before") + F.row_number().over(inside) - 1).alias("_number"))
        .where("_number > 0")
    )
    own = F.when(F.col("_number").isNull(), F.col("_content")).otherwise(F.concat_ws("-", "_content", "_number"))
    return rows.join(numbers, "_row", "left").select(own.alias(key), *columns)


def feature_names(df: DataFrame, key: str, target: str) -> list[str]:
    """Columns other than key and target, in table order."""
    return [c for c in df.columns if c not in (key, target)]


def drop_incomplete(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Keep rows whose features are all present (neither NULL nor NaN)."""
    require_columns(df, features)
    present = [f"NOT {missing_condition(c, df.schema[c].dataType)}" for c in features]
    return df.where(" AND ".join(present)) if present else df


def dedup_rows(df: DataFrame, features: Sequence[str], key: str) -> DataFrame:
    """One row per distinct feature combination: the one with the lowest key.

    A grouped minimum, so copies collapse inside each task before the shuffle
    and a combination held by a third of all rows costs one row per task. With
    columns of fixed width it needs no sort.
    """
    require_columns(df, [*features, key])
    own = F.col(quoted(key))
    rest = [
        F.min_by(F.col(quoted(c)), own).alias(c)
        for c in df.columns
        if c != key and c not in features
    ]
    kept = df.groupBy(*[quoted(c) for c in features]).agg(F.min(own).alias(key), *rest)
    return kept.select(*[quoted(c) for c in df.columns])


def clean_data(
    df: DataFrame, features: Sequence[str], key: str, index: str | None = None
) -> DataFrame:
    """Complete, distinct rows; key, target and other columns stay attached.

    With ``index`` a contiguous row number in key order is added; numbering reads
    the keys more than once, so the cleaned table is stored first.
    """
    cleaned = dedup_rows(drop_incomplete(df, features), features, key)
    return dense_index(stored(cleaned), key, index) if index else cleaned


def label_codes(df: DataFrame, label: str) -> DataFrame:
    """Codes 0..k-1 of the distinct label values in ascending order.

    A missing label, if there is one, gets the last code. The distinct values are
    found once.
    """
    values = settled(df.select(F.col(quoted(label))).distinct())
    present = F.col(quoted(label)).isNotNull()
    coded = dense_index(values.where(present), label, "code")
    coded = coded.select(F.col(quoted(label)), F.col("code").cast("int").alias("code"))
    missing = values.where(~present)
    if missing.isEmpty():
        return coded
    last = F.lit(values.count() - 1).cast("int").alias("code")
    return coded.unionByName(missing.select(F.col(quoted(label)), last))


def encode_target(df: DataFrame, label: str, code: str = "code") -> DataFrame:
    """Add integer codes for a label column; numeric labels are passed through."""
    require_columns(df, [label])
    if df.schema[label].dataType.simpleString() in NUMERIC_LABEL_TYPES:
        return df.withColumn(code, F.col(quoted(label)))
    codes = label_codes(df, label).select(
        F.col(quoted(label)).alias("_label"), F.col("code").alias("_code")
    )
    joined = df.join(codes, F.col(quoted(label)).eqNullSafe(F.col("_label")), "left")
    return joined.withColumn(code, F.col("_code")).drop("_label", "_code")
