"""Ranges over orderable columns, and the dense row index built on them.

A window without partitioning sends a whole table through one task. Here Spark cuts
the rows into ranges of about equal size first; each range is a task of its own, and
one row per range carries what lies before it. The number of ranges follows from the
number of rows, and the result is the same wherever the cuts fall. Only tables of SMALL_ROWS
rows at most are numbered by one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowmill.functions import SMALL_ROWS, quoted, require_columns, stored

ROWS_PER_BUCKET = 100_000
# monotonically_increasing_id: partition above, position in the partition below.
POSITION_BITS = 33


def range_count(df: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """Ranges for the table's rows, at least one."""
    return max(1, math.ceil(df.count() / rows_per_bucket))


def with_range(
    df: DataFrame, columns: Sequence[str], name: str, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """The stored table with the number of each row's range. Rows equal in all columns
    share a range; missing values come first and NaN last, as in Spark's order."""
    ranges = range_count(df, rows_per_bucket)
    placed = df.repartitionByRange(ranges, *[F.col(quoted(c)) for c in columns])
    return stored(placed.withColumn(name, F.spark_partition_id()))


def dense_index(
    df: DataFrame,
    key: str | Sequence[Column],
    name: str = "index",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Add a contiguous index 0..n-1 in the order of a unique key, or of the given
    order expressions."""
    if isinstance(key, str):
        require_columns(df, [key])
        key = [F.col(quoted(key))]
    rows = df.count()
    if rows <= min(SMALL_ROWS, rows_per_bucket):  # so few may be numbered by one task
        place = F.row_number().over(Window.orderBy(*key)) - 1
        return df.withColumn(name, place.cast("long"))
    ranges = max(1, math.ceil(rows / rows_per_bucket))
    ordered = df.repartitionByRange(ranges, *key).sortWithinPartitions(*key)
    placed = stored(ordered.withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", POSITION_BITS)
    position = F.col("_place").bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    # one row per range
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        placed.withColumn("_part", part)
        .join(offsets, "_part")
        .select(*[quoted(c) for c in df.columns], (F.col("_offset") + position).alias(name))
    )
