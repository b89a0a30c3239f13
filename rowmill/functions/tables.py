"""Helpers for tables that are small by construction and for tables stored between steps."""

from __future__ import annotations

import atexit
import contextlib
import os
import posixpath
import uuid
from collections.abc import Iterable, Sequence

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Rows that a table may have to be handled as a whole, by the driver or by one task.
SMALL_ROWS = 10_000

# Folders that this process has asked for and not yet removed.
_folders: list[tuple[SparkSession, str]] = []


def small_table(df: DataFrame) -> DataFrame:
    """Evaluate a table once and hand it back as a local relation.

    Only for tables that are small by construction: one row in all, or one per
    feature. Its exact size is then known to the optimiser.
    """
    return df.sparkSession.createDataFrame(df.toArrow(), schema=df.schema)


def settled(df: DataFrame, most: int = SMALL_ROWS) -> DataFrame:
    """The table evaluated once: a local relation if it has ``most`` rows at most, else stored.
    The rows are the same either way; what a task or the driver gets is bounded."""
    head = df.limit(most + 1).toArrow()
    return df.sparkSession.createDataFrame(head, schema=df.schema) if head.num_rows <= most else stored(df)


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    """Raise ValueError naming the columns that the table lacks."""
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise ValueError(f"columns not found: {absent}; the table has {df.columns}")


def local_table(spark: SparkSession, rows: Iterable[Sequence], schema: StructType) -> DataFrame:
    """A local relation from driver rows; its size is known to the optimiser."""
    columns = list(zip(*rows)) or [()] * len(schema)
    values = {f.name: pa.array(list(c)) for f, c in zip(schema, columns)}
    return spark.createDataFrame(pa.table(values), schema)


def join_path(base: str, *parts: str) -> str:
    """Path below a base folder, local or remote."""
    return posixpath.join(base, *parts) if "://" in base else os.path.join(base, *parts)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: spark.checkpoint.dir, or where that is not set a
    folder in the session's warehouse. The rule is the same on every master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or join_path(spark.conf.get("spark.sql.warehouse.dir"), "rowmill-stages")


def new_folder(spark: SparkSession) -> str:
    """An unused path below the shared folder, removed when the process ends or by
    ``remove_folders``."""
    path = join_path(shared_folder(spark), f"rowmill-{uuid.uuid4().hex}")
    if not _folders:
        atexit.register(remove_folders)
    _folders.append((spark, path))
    return path


def remove_folders() -> None:
    """Delete the folders that ``new_folder`` gave out; tables stored there are gone."""
    while _folders:
        spark, path = _folders.pop()
        with contextlib.suppress(Py4JError, OSError):  # the JVM may have ended before
            jvm = spark._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(target, True)


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """The table written as Parquet and read back.

    What led to it is not computed again, later steps read only the columns they
    use, and a lost executor costs a re-read. Goes to a new shared folder unless a
    path is given.
    """
    target = path or new_folder(df.sparkSession)
    df.write.mode("overwrite").parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)
