"""Files of independent Zstandard frames that end in a seek table.

Layout: the frames; a skippable frame with an index (a compressed Arrow table whose rows
say which frame holds a key, and where); and the seek table of the public Zstandard
seekable format, a skippable frame with the sizes of every frame and the low 32 bits of
the XXH64 of its content. Any Zstandard decoder reads the whole file; a reader that
wants few keys fetches the tail, then just the frames it needs.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard

# Fixed values of the Zstandard seekable format.
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
FOOTER = struct.Struct("<IBI")
HEADER = struct.Struct("<II")

#: The skippable frame of the index.
SKIPPABLE_INDEX = 0x184D2A50
#: Bytes of content after which a frame is closed.
FRAME_BYTES = 1 << 20


def open_uri(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri)


class SeekableWriter:
    """Collects content into frames; ``add`` tells where it will be found."""

    def __init__(self, uri: str, frame_bytes: int = FRAME_BYTES, level: int = 3):
        fs, path = open_uri(uri)
        self.out = fs.open_output_stream(path, compression=None)
        self.packer = zstandard.ZstdCompressor(level=level)
        self.frame_bytes = frame_bytes
        self.content: list[bytes] = []
        self.held = 0
        self.table: list[tuple[int, int, int]] = []
        self.written = 0

    def add(self, data: bytes) -> tuple[int, int]:
        """(frame, offset in its content) of the data; data is never cut."""
        if self.held and self.held + len(data) > self.frame_bytes:
            self.flush()
        place = (len(self.table), self.held)
        self.content.append(data)
        self.held += len(data)
        return place

    def flush(self) -> None:
        if not self.held:
            self.content = []
            return
        data = b"".join(self.content)
        packed = self.packer.compress(data)
        self.out.write(packed)
        self.written += len(packed)
        self.table.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.content, self.held = [], 0

    def close(self, index: pa.Table) -> None:
        self.flush()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, index.schema) as writer:
            writer.write_table(index)
        packed = self.packer.compress(sink.getvalue().to_pybytes())
        self.out.write(HEADER.pack(SKIPPABLE_INDEX, len(packed)) + packed)
        entries = np.array(self.table, "<u4").reshape(-1, 3).tobytes()
        footer = FOOTER.pack(len(self.table), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.out.write(HEADER.pack(SKIPPABLE_SEEK_TABLE, len(entries) + len(footer)) + entries + footer)
        self.out.close()


class SeekableReader:
    """Reads single frames and checks each against its checksum."""

    def __init__(self, uri: str):
        fs, path = open_uri(uri)
        self.file, self.uri = fs.open_input_file(path), uri
        size = self.file.size()
        count, flags, magic = FOOTER.unpack(self._at(size - FOOTER.size, FOOTER.size))
        if magic != SEEKABLE_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError(f"{uri} has no seek table with checksums")
        entries = self._at(size - FOOTER.size - 12 * count, 12 * count)
        self.table = np.frombuffer(entries, "<u4").reshape(-1, 3).astype(np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.table[:, 0])))
        self.unpacker = zstandard.ZstdDecompressor()

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.file.close()

    def _at(self, start: int, length: int) -> bytes:
        return self.file.read_at(length, start)

    def index(self) -> pa.Table:
        start = int(self.starts[-1])
        magic, length = HEADER.unpack(self._at(start, HEADER.size))
        if magic != SKIPPABLE_INDEX:
            raise ValueError(f"{self.uri} has no index")
        data = self.unpacker.decompress(self._at(start + HEADER.size, length))
        with pa.ipc.open_stream(data) as reader:
            return reader.read_all()

    def frame(self, number: int) -> bytes:
        packed, size, check = self.table[number].tolist()
        data = self.unpacker.decompress(
            self._at(int(self.starts[number]), packed), max_output_size=size
        )
        if len(data) != size or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {number} of {self.uri} is damaged")
        return data
