"""Token ids in files of independent Zstandard frames with a seek table (see ``seekable``).

A file holds the ids of consecutive documents, 2 bytes each where the vocabulary allows
it, else 4. Its index has a row per document. The manifest, a stored table with a row per
file, is what makes a file count: a lost or repeated task leaves at most a file that no
manifest names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from rowmill.functions import stored
from rowmill.llm.bpe import unit_table
from rowmill.llm.common import SLICE_BYTES, as_uri, binary_rows, filled, keyed_texts, mkdirs, text_slices
from rowmill.llm.seekable import SeekableReader, SeekableWriter

#: Ids after which a file is closed.
FILE_IDS = 64 << 20
MANIFEST = "part int, seq int, path string, n_docs long, n_tokens long, id_bytes int"
INDEX = pa.schema(
    [("doc_id", pa.int64()), ("frame", pa.int32()), ("offset", pa.int64()), ("n_tokens", pa.int64())]
)


def write_token_files(
    docs: DataFrame, tokenizer: str, end_id: int, folder: str,
    key: str = "doc_id", text: str = "text", file_ids: int = FILE_IDS,
) -> DataFrame:
    """Write the ids of every whole text, each followed by ``end_id``, in ascending order
    of the key, and return the stored manifest with ``base``, the ids before each file.

    Null texts are empty, null keys come first, rows with equal keys follow each other in
    the order of a hash of their text. One shuffle of the texts, by key range.
    """
    spark = docs.sparkSession
    target = as_uri(folder)
    mkdirs(spark, target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = unit_table(tokenizer)
        kind = np.uint16 if max(len(table.pieces) - 1, end_id) < 1 << 16 else np.uint32
        part, seq, out, held = TaskContext.get().partitionId(), 0, None, 0

        def closed() -> pa.RecordBatch:
            columns = [pa.concat_arrays(c) for c in zip(*index)]
            out.close(pa.Table.from_arrays(columns, schema=INDEX))
            size = np.dtype(kind).itemsize
            row = [[part], [seq], [path], [sum(map(len, columns[:1]))], [held], [size]]
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int32()]
            return pa.record_batch(
                [pa.array(v, k) for v, k in zip(row, kinds)],
                ["part", "seq", "path", "n_docs", "n_tokens", "id_bytes"],
            )

        for piece in text_slices(batches, max_bytes=2 * SLICE_BYTES):
            if out is None:
                path, index = f"{target}/{uuid.uuid4().hex}.ids.zst", []
                out, held = SeekableWriter(path), 0
            first, ids = table.encode_array(filled(piece.column("text")))
            # each text's ids, then the end
            closing = np.insert(ids.astype(kind), first[1:], kind(end_id)).tobytes()
            counts = (np.diff(first) + 1).tolist()
            cuts = ((first + np.arange(len(first))) * np.dtype(kind).itemsize).tolist()
            places = [out.add(closing[a:b]) for a, b in zip(cuts, cuts[1:])]
            frames, offsets = zip(*places)
            index.append([
                piece.column("doc_id"), pa.array(frames, pa.int32()),
                pa.array(offsets, pa.int64()), pa.array(counts, pa.int64()),
            ])
            held += sum(counts)
            if held >= file_ids:
                yield closed()
                seq, out = seq + 1, None
        if out is not None:
            yield closed()
        table.release()

    rows = keyed_texts(docs, key, text).withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    files = stored(ordered.select("doc_id", "text").mapInArrow(run, MANIFEST))
    # one row per file, so the running total is over a small table
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the files, ids as little-endian uint32.

    ``start`` counts the ids of all documents before. With ``wanted``, a table of keys
    ``doc_id``, only frames that hold one of them are fetched and decompressed.
    """
    spark = manifest.sparkSession
    files = manifest.select("path", "base", "id_bytes")
    tasks = max(1, files.count())
    if wanted is None:
        return files.repartition(tasks).mapInArrow(
            _read_all, "doc_id long, start long, n_tokens long, ids binary"
        )
    places = files.repartition(tasks).mapInArrow(
        _read_index,
        "path string, id_bytes int, frame int, offset long, n_tokens long, doc_id long, start long",
    )
    keys = wanted.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    chosen = places.join(keys, "doc_id").repartition(
        max(tasks, spark.sparkContext.defaultParallelism), "path", "frame"
    )
    return chosen.sortWithinPartitions("path", "frame", "offset").mapInArrow(
        _read_places, "doc_id long, start long, n_tokens long, ids binary"
    )


def _starts(index: pa.Table, base: int) -> np.ndarray:
    counts = index.column("n_tokens").to_numpy()
    return base + np.cumsum(counts) - counts


def _wide(data: bytes, offset: int, count: int, size: int) -> bytes:
    return np.frombuffer(data, f"<u{size}", count, offset).astype("<u4").tobytes()


def _read_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in (r for b in batches for r in b.to_pylist()):
        with SeekableReader(row["path"]) as file:
            index = file.index()
            starts = _starts(index, row["base"])
            frames = index.column("frame").to_numpy()
            cuts = np.flatnonzero(np.diff(frames, prepend=-1, append=-1))
            offsets, counts = index.column("offset").to_pylist(), index.column("n_tokens").to_pylist()
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                data = file.frame(int(frames[a]))
                ids = [_wide(data, offsets[i], counts[i], row["id_bytes"]) for i in range(a, b)]
                yield pa.record_batch(
                    [
                        index.column("doc_id").slice(a, b - a).combine_chunks(),
                        pa.array(starts[a:b]), pa.array(counts[a:b], pa.int64()), binary_rows(ids),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )


def _read_index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in (r for b in batches for r in b.to_pylist()):
        with SeekableReader(row["path"]) as file:
            index = file.index()
        n = index.num_rows
        out = pa.table({
            "path": pa.array([row["path"]] * n, pa.string()),
            "id_bytes": pa.array([row["id_bytes"]] * n, pa.int32()),
            "frame": index.column("frame"), "offset": index.column("offset"),
            "n_tokens": index.column("n_tokens"), "doc_id": index.column("doc_id"),
            "start": pa.array(_starts(index, row["base"])),
        })
        yield from out.combine_chunks().to_batches()


def _read_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, data = None, b""
    for batch in batches:
        ids = []
        for row in batch.select(["path", "id_bytes", "frame", "offset", "n_tokens"]).to_pylist():
            if (row["path"], row["frame"]) != at:
                at = (row["path"], row["frame"])
                with SeekableReader(row["path"]) as file:
                    data = file.frame(row["frame"])
            ids.append(_wide(data, row["offset"], row["n_tokens"], row["id_bytes"]))
        yield pa.record_batch(
            [*(batch.column(c) for c in ("doc_id", "start", "n_tokens")), binary_rows(ids)],
            ["doc_id", "start", "n_tokens", "ids"],
        )
