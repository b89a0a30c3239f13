"""Shared pieces: Arrow batches cut into slices of bounded size, words as integer codes."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Bytes of an Arrow batch between Spark and a Python worker, at most.
BATCH_BYTES = 8 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

#: Bytes of text that a task handles at a time; a longer text is a slice of its own.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(df: DataFrame) -> DataFrame:
    """The same table, after lowering the session's bound of Arrow batches to BATCH_BYTES: a
    batch exists in the JVM and in the worker, and long texts make it large."""
    conf = df.sparkSession.conf
    if _bytes(conf.get(BATCH_SETTING)) > BATCH_BYTES:
        conf.set(BATCH_SETTING, str(BATCH_BYTES))
    return df


def _bytes(setting: str) -> int:
    digits, unit = setting.lower().rstrip("b"), 1
    if digits[-1:] in "kmgt":
        digits, unit = digits[:-1], 1 << 10 * (1 + "kmgt".index(digits[-1]))
    number = int(digits)
    return number * unit if number > 0 else 1 << 62


def give_back() -> None:
    """Return freed memory to the system: workers outlive their tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tokenizer_path(name: str) -> str:
    """The default place of a public tokenizer's file; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def keyed_texts(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Just (doc_id, text); whatever else the table holds can't clash with results."""
    named = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return small_batches(named)


def offsets_of(array: pa.Array) -> np.ndarray:
    """Offsets of a string, binary or list array, from its own first entry on."""
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type) or pa.types.is_large_list(array.type)
    kind = np.int64 if wide else np.int32
    if len(array) == 0:
        return np.zeros(1, np.int64)
    return np.frombuffer(array.buffers()[1], kind)[array.offset : array.offset + len(array) + 1].astype(np.int64)


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", max_bytes: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in the same order, in slices of about ``max_bytes`` of text."""
    for batch in batches:
        ends = offsets_of(batch.column(column))
        at = 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(ends, ends[at] + max_bytes, "right")) - 1)
            yield batch.slice(at, stop - at)
            at = stop
    give_back()


def filled(texts: pa.Array) -> pa.Array:
    return pc.fill_null(texts, pa.scalar("", texts.type))


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Words between ASCII white space: (offsets per text, flat words). Null has none."""
    lists = pc.ascii_split_whitespace(filled(texts))
    flat, ends = lists.flatten(), offsets_of(lists)
    ends = ends - ends[0]
    full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    if not full.all():
        flat = flat.filter(pa.array(full))
        ends = np.concatenate(([0], np.cumsum(full)))[ends]
    return ends, flat


def word_codes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(offsets per text, code of each word, distinct words); equal codes are equal words."""
    ends, flat = split_words(pc.ascii_lower(filled(texts)) if lower else texts)
    coded = flat.dictionary_encode()
    return ends, coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def hash_words(words: pa.Array) -> np.ndarray:
    """64-bit hashes of distinct words."""
    return np.fromiter(
        map(xxhash.xxh3_64_intdigest, words.cast(pa.binary()).to_pylist()), np.uint64, len(words)
    )


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolled(values: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` neighbours in order; one per start, over text bounds too.
    The values have to be well mixed."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = values[:n].copy()
    for i in range(1, width):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += values[i : n + i]
    return mix(out)


def sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of the values of each text."""
    total = np.concatenate((np.zeros(1, values.dtype if values.dtype.kind == "f" else np.int64), np.cumsum(values)))
    return total[ends[1:]] - total[ends[:-1]]


def binary_rows(rows: list[bytes]) -> pa.Array:
    return pa.array(rows, pa.binary())


def scratch(spark: SparkSession) -> str:
    """A new folder that all executors share, from spark.checkpoint.dir."""
    from rowmill.functions import new_folder

    return new_folder(spark)


def mkdirs(spark: SparkSession, path: str) -> None:
    """Make a folder through the file system that Spark uses for it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(target)


def as_uri(path: str) -> str:
    return path if "://" in path or path.startswith("file:") else "file://" + os.path.abspath(path)
