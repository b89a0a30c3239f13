"""Labelled CSV tables and a catalogue of named datasets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

from rowmill.functions import join_path, quoted
from rowmill.operators.models import read_model, store_model
from rowmill.operators.prepare import label_table
from rowmill.sources.versions import commit, read_committed


def labelled_schema(
    names: Sequence[str],
    key: str = "id",
    label: str = "diagnosis",
    target: str = "target",
    key_type: str = "bigint",
) -> str:
    """Types by column role: key, string label, integer target, double features."""
    types = {key: key_type, label: "string", target: "int"}
    return ", ".join(f"{quoted(name)} {types.get(name, 'double')}" for name in names)


# Cells that stand for a missing value.
MISSING_CELLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_labeled(
    spark: SparkSession,
    path: str,
    key: str | None = "id",
    label: str = "diagnosis",
    positive="M",
    target: str = "target",
    schema: StructType | str | None = None,
    key_type: str = "bigint",
    missing: Sequence[str] = MISSING_CELLS,
) -> DataFrame:
    """(key, target, features) from CSV files with a header line.

    The schema follows from the header, so nothing is read for inference and one odd cell
    cannot turn a column into text. Cells that are empty or one of ``missing`` are missing
    values (NaN stays NaN, which counts as missing); any other cell that isn't of its column's type fails the query
    and is named, with its column. A missing path raises. Files whose headers disagree raise too.
    """
    if schema is None:
        header = spark.read.csv(path, header=True, inferSchema=False).columns
        schema = labelled_schema(header, key or "id", label, target, key_type)
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    texts = StructType([StructField(f.name, StringType()) for f in schema])
    raw = spark.read.schema(texts).csv(path, header=True, mode="FAILFAST", enforceSchema=False)
    cells = raw.select(*[_typed(f.name, f.dataType, missing) for f in schema])
    return label_table(cells, key, label, positive, target)


def _typed(name: str, data_type: DataType, missing: Sequence[str]) -> Column:
    """The text cells of a column in its type; what is neither missing nor of it fails."""
    cell = F.trim(F.col(quoted(name)))
    if isinstance(data_type, StringType):
        return F.col(quoted(name))
    value = cell.try_cast(data_type)
    wrong = F.raise_error(F.concat(F.lit(f"column {name} holds a cell that is no {data_type.simpleString()}: "), cell))
    return (
        F.when(value.isNotNull(), value)
        .when(cell.isNull() | cell.isin(*missing), F.lit(None).cast(data_type))
        .otherwise(wrong.cast(data_type))
        .alias(name)
    )


# Catalogue type suffixes and the formats they stand for.
DATASET_TYPES = {
    "CSVDataset": "csv",
    "JSONDataset": "json",
    "ParquetDataset": "parquet",
    "PickleDataset": "model",
}


# Where a table lies below an entry that may also hold a model.
TABLE_FOLDER = "table"


@dataclass(frozen=True)
class Dataset:
    """Where a named table or model is kept and in which format."""

    format: str
    path: str
    options: Mapping[str, str] = field(default_factory=dict)


class Catalog:
    """Named datasets: name -> format and path below one base folder."""

    def __init__(self, spark: SparkSession, base: str, datasets: Mapping[str, Dataset]):
        self.spark = spark
        self.base = base
        self.datasets = dict(datasets)

    @classmethod
    def from_mapping(cls, spark: SparkSession, base: str, entries: Mapping) -> Catalog:
        """From entries with ``filepath`` and ``type`` (e.g. pandas.CSVDataset) or
        a plain ``format``."""
        datasets = {}
        for name, entry in entries.items():
            kind = entry.get("format") or DATASET_TYPES.get(str(entry.get("type")).split(".")[-1])
            if kind is None:
                raise ValueError(f"dataset {name!r} has no known type: {entry.get('type')!r}")
            datasets[name] = Dataset(kind, entry["filepath"], entry.get("options", {}))
        return cls(spark, base, datasets)

    def _entry(self, name: str) -> Dataset:
        if name not in self.datasets:
            raise KeyError(f"no dataset named {name!r}; known: {sorted(self.datasets)}")
        return self.datasets[name]

    def path(self, name: str) -> str:
        return join_path(self.base, self._entry(name).path)

    def read(self, name: str, schema: StructType | None = None):
        """The table or, for format "model", what was written there: a fitted model or a
        table such as a scaler."""
        entry = self._entry(name)
        if entry.format == "model":
            if self._holds_table(name):
                return read_dataset(self.spark, join_path(self.path(name), TABLE_FOLDER), "parquet", schema)
            return read_model(self.spark, self.path(name))
        return read_dataset(self.spark, self.path(name), entry.format, schema, entry.options)

    def _holds_table(self, name: str) -> bool:
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(join_path(self.path(name), TABLE_FOLDER))
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        return folder.getFileSystem(conf).exists(folder)

    def write(self, name: str, data) -> None:
        """Replace the dataset."""
        entry = self._entry(name)
        if entry.format == "model" and isinstance(data, DataFrame):
            write_dataset(data, join_path(self.path(name), TABLE_FOLDER), "parquet")
        elif entry.format == "model":
            store_model(data, self.path(name))
        else:
            write_dataset(data, self.path(name), entry.format, entry.options)


def read_dataset(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    schema: StructType | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read a table; text formats are typed only by the given schema."""
    reader = spark.read.format(format).options(**(options or {}))
    if format == "csv":
        reader = reader.option("header", True)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def write_dataset(
    df: DataFrame,
    path: str,
    format: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> None:
    """Replace the table at ``path``; one file per partition, written in parallel."""
    writer = df.write.format(format).mode("overwrite").options(**(options or {}))
    if format == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def write_stage(df: DataFrame, path: str, format: str = "parquet") -> DataFrame:
    """Write a stage table and return it as read back, so that later steps scan
    only the columns they need and never recompute what led to it.

    A Parquet stage is replaced in one step: if the write fails, ``read_stage`` gives the old
    table. Other formats are replaced in place.
    """
    if format == "parquet":
        commit(df, path)
        return read_stage(df.sparkSession, path)
    write_dataset(df, path, format)
    return read_dataset(df.sparkSession, path, format, df.schema)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """The stage table that was last written completely."""
    return read_committed(spark, path)
