"""Stored tables that are replaced in one step.

A table, or a named part of one, is written to a folder of its own version; then a small
manifest file that names the version takes the place of the one before, by a rename, which
file systems do in one step. Readers follow the manifests, so they see the old rows or the new
ones, whatever happens to a write. The version that was replaced is deleted afterwards; folders
of writes that never ended are named by no manifest and deleted with the next one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from urllib.parse import quote

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from rowmill.functions import join_path, quoted

MANIFESTS, VERSION = "_manifests", "version"


class Folder:
    """A folder in whatever file system its path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.jvm = spark._jvm
        self.conf = spark._jsparkSession.sessionState().newHadoopConf()
        self.files = self._path(path).getFileSystem(self.conf)

    def _path(self, path: str) -> JavaObject:
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, *parts: str) -> list[str]:
        """What lies below, nothing if the folder doesn't exist."""
        target = self._path(join_path(self.path, *parts))
        if not self.files.exists(target):
            return []
        return [s.getPath().getName() for s in self.files.listStatus(target)]

    def text(self, *parts: str) -> str:
        stream = self.files.open(self._path(join_path(self.path, *parts)))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace_text(self, text: str, folder: str, name: str) -> None:
        """Put a file in the place of another in one step."""
        draft = self._path(join_path(self.path, folder, f".{uuid.uuid4().hex}"))
        target = self._path(join_path(self.path, folder, name))
        stream = self.files.create(draft, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        overwrite = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 1)
        overwrite[0] = self.jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.files.getUri(), self.conf).rename(
            self.files.makeQualified(draft), self.files.makeQualified(target), overwrite
        )

    def delete(self, *parts: str) -> None:
        self.files.delete(self._path(join_path(self.path, *parts)), True)


def file_name(name: str) -> str:
    """The file of a part's manifest; different names have different files."""
    return "m-" + quote(name, safe="")


def manifests(spark: SparkSession, path: str) -> dict[str, dict]:
    """The committed parts of a table by name: their version and columns."""
    folder = Folder(spark, path)
    # a file per part of the table
    found = [json.loads(folder.text(MANIFESTS, n)) for n in folder.names(MANIFESTS) if n.startswith("m-")]
    return {m["name"]: m for m in found}


def commit(df: DataFrame, path: str, name: str = "", partition_by: Sequence[str] = ()) -> None:
    """Write a table as the part ``name`` of the table at ``path`` and switch to it."""
    spark, version = df.sparkSession, uuid.uuid4().hex
    before = manifests(spark, path)
    df.write.partitionBy(*partition_by).parquet(join_path(path, f"{VERSION}={version}"))
    folder = Folder(spark, path)
    # types of the columns, for readers that read several parts together
    manifest = {"name": name, "version": version, "columns": json.loads(df.schema.json())}
    folder.replace_text(json.dumps(manifest), MANIFESTS, file_name(name))
    if name in before:
        folder.delete(f"{VERSION}={before[name]['version']}")


def clear_unfinished(spark: SparkSession, path: str) -> list[str]:
    """Delete versions that no manifest names, left behind by writes that never ended. Not
    to be called while something is being written."""
    named = {f"{VERSION}={m['version']}" for m in manifests(spark, path).values()}
    folder = Folder(spark, path)
    lost = [n for n in folder.names() if n.startswith(f"{VERSION}=") and n not in named]
    for n in lost:
        folder.delete(n)
    return lost


def read_committed(spark: SparkSession, path: str, text_columns: Sequence[str] = ()) -> DataFrame:
    """All committed parts of the table. Columns in ``text_columns`` are text, whatever the
    folder names that hold them look like."""
    found = manifests(spark, path)
    if not found:
        raise FileNotFoundError(f"no table has been committed at {path}")
    first = StructType.fromJson(next(iter(found.values()))["columns"])
    fields = [StructField(f.name, StringType()) if f.name in text_columns else f for f in first]
    schema = StructType([*fields, StructField(VERSION, StringType())])
    folders = [join_path(path, f"{VERSION}={m['version']}") for m in found.values()]
    read = spark.read.schema(schema).option("basePath", path).parquet(*folders)
    return read.select(*[quoted(f.name) for f in fields])
