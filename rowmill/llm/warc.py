"""WARC records in seekable Zstandard bundles (see ``seekable``): written, indexed, read.

Equal payloads are stored once: the record with the smallest page id is a ``response``,
the others are ``revisit`` records that name it and repeat its digest and length.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rowmill.functions import stored
from rowmill.llm.common import as_uri, mkdirs, text_slices
from rowmill.llm.seekable import SeekableReader, SeekableWriter

#: Bytes of records after which a bundle is closed.
FILE_BYTES = 256 << 20
# Fixed values of the WARC 1.1 format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSION = "WARC/1.1"

RECORDS = (
    "page_id long, url string, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, payload binary"
)
INDEX = pa.schema(
    [("page_id", pa.int64()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]
)


def record_bytes(
    page_id: int | None, url: str | None, payload: bytes, digest: str,
    refers_to: int | None, revisit: bool, date: str,
) -> bytes:
    """One record. A revisit has the HTTP header of the full payload but no body."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    lines = [
        VERSION,
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        safe = re.sub(r"[\x00-\x20%\x7f]", lambda m: quote(m[0], safe=""), url)
        lines.append(f"WARC-Target-URI: {safe}")
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, start: int = 0) -> tuple[dict, int]:
    """The record that starts there, and where the next one starts."""
    stop = data.index(b"\r\n\r\n", start)
    first, *lines = data[start:stop].decode().split("\r\n")
    if first != VERSION:
        raise ValueError(f"no WARC record at {start}")
    fields = dict(line.split(": ", 1) for line in lines)
    size = int(fields["Content-Length"])
    block = data[stop + 4 : stop + 4 + size]
    head, _, body = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"\r\nContent-Length: (\d+)", head)[1])
    revisit = fields["WARC-Type"] == "revisit"
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and (len(body) != length or payload_digest(body) != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    number = lambda field: int(n) if (n := field[len("<urn:page:") : -1]) else None
    return {
        "page_id": number(fields["WARC-Record-ID"]),
        "url": unquote(fields["WARC-Target-URI"]) if "WARC-Target-URI" in fields else None,
        "record_type": fields["WARC-Type"],
        "refers_to": number(fields["WARC-Refers-To"]) if revisit else None,
        "payload_bytes": length,
        "payload_digest": digest,
        "payload": None if revisit else body,
    }, stop + 4 + size + 4


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def write_warc(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html",
    min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write one record per row and return the stored manifest (path, n_records).

    A null payload is empty. Of equal payloads of at least ``min_bytes`` bytes the row with
    the smallest page id is the response and the others revisit it; rows that repeat this
    smallest id are responses too, null ids are revisits, and where all ids of equal payloads
    are null every row is a response. Digests travel, payloads only where the join on them
    has to shuffle.
    """
    spark = pages.sparkSession
    target = as_uri(folder)
    mkdirs(spark, target)
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("payload"),
    ).withColumns({"sha": F.sha1("payload"), "size": F.octet_length("payload")})
    copies = stored(
        rows.where(F.col("size") >= min_bytes)
        .groupBy("sha", "size")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND first IS NOT NULL")
        .drop("n")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, names = None, ["path", "n_records"]

        def closed() -> pa.RecordBatch:
            out.close(pa.table(list(map(list, zip(*index))), schema=INDEX))
            return pa.record_batch([pa.array([path]), pa.array([len(index)], pa.int64())], names)

        for part in text_slices(batches, "payload"):
            if out is None:
                path, index, held = f"{target}/{uuid.uuid4().hex}.warc.zst", [], 0
                out = SeekableWriter(path)
            columns = [part.column(c).to_pylist() for c in ("page_id", "url", "sha", "first")]
            payloads = part.column("payload").cast(pa.binary()).to_pylist()
            for page_id, link, sha, first, payload in zip(*columns, payloads):
                digest = base64.b32encode(bytes.fromhex(sha)).decode()
                revisit = first is not None and page_id != first
                data = record_bytes(page_id, link, payload, digest, first, revisit, date)
                index.append((page_id, *out.add(data), len(data)))
                held += len(data)
            if held >= file_bytes:
                yield closed()
                out = None
        if out is not None:
            yield closed()

    joined = rows.join(copies, ["sha", "size"], "left").select("page_id", "url", "sha", "first", "payload")
    return stored(joined.mapInArrow(run, "path string, n_records long"))


def read_warc(manifest: DataFrame, wanted: DataFrame | None = None, payloads: bool = True) -> DataFrame:
    """The records of the bundles: page_id, url, record_type, refers_to, payload_bytes,
    payload_digest and payload (null for revisits, or if ``payloads`` is false).

    Digest and length of a response are checked against its payload. With ``wanted``, a
    table of keys ``page_id``, only frames that hold one of them are decompressed.
    """
    files = manifest.select("path")
    tasks = max(1, files.count())
    if wanted is not None:
        places = files.repartition(tasks).mapInArrow(
            _read_index, "path string, page_id long, frame int, offset long, length long"
        )
        keys = wanted.select(F.col("page_id").cast("long").alias("page_id")).distinct()
        chosen = places.join(keys, "page_id").repartition(tasks, "path", "frame")
        return chosen.sortWithinPartitions("path", "frame", "offset").mapInArrow(_read_places, RECORDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in (p for b in batches for p in b.column("path").to_pylist()):
            with SeekableReader(path) as file:
                for number in range(len(file.table)):
                    data, at, records = file.frame(number), 0, []
                    while at < len(data):
                        record, at = parse_record(data, at)
                        records.append(record if payloads else record | {"payload": None})
                    yield _batch(records)

    return files.repartition(tasks).mapInArrow(run, RECORDS)


def _batch(records: list[dict]) -> pa.RecordBatch:
    kinds = {
        "page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(),
        "refers_to": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
        "payload": pa.binary(),
    }
    return pa.RecordBatch.from_pylist(records, schema=pa.schema(list(kinds.items())))


def _read_index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for path in (p for b in batches for p in b.column("path").to_pylist()):
        with SeekableReader(path) as file:
            index = file.index()
        paths = pa.array([path] * index.num_rows, pa.string())
        yield from index.add_column(0, "path", paths).combine_chunks().to_batches()


def _read_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, data = None, b""
    for batch in batches:
        records = []
        for row in batch.select(["path", "frame", "offset"]).to_pylist():
            if (row["path"], row["frame"]) != at:
                at = (row["path"], row["frame"])
                with SeekableReader(row["path"]) as file:
                    data = file.frame(row["frame"])
            records.append(parse_record(data, row["offset"])[0])
        yield _batch(records)


def archive(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the records of
    all rows, read back from the bundles written to the folder."""
    manifest = write_warc(pages, folder, min_bytes=min_bytes)
    return read_warc(manifest, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
