"""Byte-level BPE over tables of distinct units, one table per Python worker.

Texts are cut at places that no pre-token of a byte-level BPE reaches over (see ``units``) and
dictionary-encoded slice by slice; each distinct unit goes through the tokenizer once per table,
and the ids of a text are those of its units, gathered by position. Decoding gathers the bytes
of the ids' pieces. There is no table of all distinct words of the corpus and no join: a row
per distinct word and slice would have to be shuffled to it and back. Beyond ``MAX_UNITS``, and
at the end of a task, only the most used units stay, so memory is bounded whatever the
vocabulary.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from rowmill.llm.common import SLICE_BYTES, filled, give_back, keyed_texts, offsets_of, text_slices
from rowmill.llm.units import SOLID, ranges, unit_codes

#: Units that a task's table holds at most, when a slice begins.
MAX_UNITS = 600_000
#: Units that stay with a worker between tasks, at most.
KEPT_UNITS = 150_000
#: Bytes of units that the tokenizer gets as one string.
RUN_BYTES = 1 << 16


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins that byte-level BPE files use for bytes."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(hidden)}


class UnitTable:
    """Encodes texts as the tokenizers library does with ``add_special_tokens=False``,
    without truncation or padding; special tokens written in a text are recognised."""

    def __init__(self, path: str, max_units: int = MAX_UNITS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(self.tokenizer.to_str())
        first, added = spec.get("pre_tokenizer") or {}, spec["added_tokens"]
        plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in added)
        if not (
            first.get("type") == "ByteLevel" and first.get("use_regex") and not first["add_prefix_space"]
            and spec["model"]["type"] == "BPE" and not spec["normalizer"] and plain
        ):
            raise ValueError(f"{path} is no plain byte-level BPE")
        alphabet = byte_alphabet()
        special = {t["id"]: t["content"] for t in added}
        self.pieces = [b""] * self.tokenizer.get_vocab_size(with_added_tokens=True)
        for piece, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.pieces[i] = piece.encode() if i in special else bytes(alphabet[c] for c in piece)
        self.lengths = np.array([len(p) for p in self.pieces], np.int64)
        self.piece_bytes = np.frombuffer(b"".join(self.pieces), np.uint8)
        self.piece_at = np.cumsum(self.lengths) - self.lengths
        self.special = {t["content"]: t["id"] for t in added}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.max_units = max_units
        self.number: dict[bytes, int] = {}
        self.clear()

    def clear(self) -> None:
        self.number.clear()
        self.ids = np.zeros(0, np.uint32)
        self.first = np.zeros(1, np.int64)  # the first id of each unit
        self.uses = np.zeros(0, np.int32)  # slices that had it

    def release(self) -> None:
        """At the end of a task: a worker outlives it, so only the most used units stay."""
        self.shrink(KEPT_UNITS)
        give_back()

    def shrink(self, most: int) -> None:
        """Keep ``most`` units of those that several slices had, the most used ones."""
        kept = np.flatnonzero(self.uses > 1)
        if len(kept) > most:
            kept = np.sort(kept[np.argsort(-self.uses[kept], kind="stable")[:most]])
        units = list(self.number)
        sizes = self.first[kept + 1] - self.first[kept]
        self.ids = self.ids[ranges(self.first[kept], sizes)]
        self.first = np.concatenate(([0], np.cumsum(sizes)))
        self.number = {units[i]: n for n, i in enumerate(kept.tolist())}
        self.uses = np.ones(len(kept), np.int32)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        first, ids = self.encode_array(pa.array(texts, pa.large_string()))
        packed, cuts = ids.tobytes(), (4 * first).tolist()
        return [packed[a:b] for a, b in zip(cuts, cuts[1:])]

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(where each text's ids begin, and their number at the end; ids of all texts)."""
        marked = [pc.any(pc.match_substring(texts, s)).as_py() for s in self.special] if len(texts) else []
        if not any(marked):
            return self._plain(texts)
        # between special tokens each part is a text by itself, ended by a token's id
        parts, ends, behind = [], [0], []
        for text in texts.to_pylist():
            found = self.cut.split(text)
            parts += found[::2]
            behind += [self.special[x] for x in found[1::2]] + [-1]
            ends.append(len(parts))
        first, ids = self._plain(pa.array(parts, pa.large_string()))
        behind = np.array(behind)
        more = np.concatenate(([0], np.cumsum(behind >= 0)))
        out = np.empty(len(ids) + int(more[-1]), np.uint32)
        begins, sizes = first[:-1] + more[:-1], np.diff(first)
        out[ranges(begins, sizes)] = ids
        ended = behind >= 0
        out[(begins + sizes)[ended]] = behind[ended]
        return (first + more)[np.array(ends)], out

    def _plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ends, codes, units = unit_codes(texts)
        if not len(codes):
            return ends, np.zeros(0, np.uint32)
        held = list(map(self.number.get, units))
        new = [u for u, n in zip(units, held) if n is None]
        if len(self.number) + len(new) > self.max_units and self.number:
            self.shrink(self.max_units // 2)
            held = list(map(self.number.get, units))
            new = [u for u, n in zip(units, held) if n is None]
        if new:
            self._add(new)
            held = [self.number[u] if n is None else n for u, n in zip(units, held)]
        number = np.array(held, np.int64)
        self.uses[number] += 1
        number = number[codes]
        sizes = self.first[number + 1] - self.first[number]
        upto = np.concatenate(([0], np.cumsum(sizes)))
        return upto[ends], self.ids[ranges(self.first[number], sizes)]

    def _add(self, new: list[bytes]) -> None:
        """Encode units. Those that begin with a space before a non-blank and end in one are
        words to the tokenizer wherever they stand, so many go through it as one string."""
        apart, runs, room, solid = [], [], 0, SOLID.tolist()
        for unit in new:
            if len(unit) > 1 and unit[0] == 32 and solid[unit[1]] and (
                solid[unit[-1]] if unit[-1] < 128 else not unit.decode()[-1].isspace()
            ):
                if room <= 0:
                    runs.append([])
                    room = RUN_BYTES
                runs[-1].append(unit)
                room -= len(unit)
            else:
                apart.append(unit)
        strings = [b"".join(run).decode() for run in runs] + [u.decode() for u in apart]
        found = self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)
        counts, parts = [], []
        for run, e in zip(runs, found):
            ids = np.array(e.ids, np.uint32)
            parts.append(ids)
            reach, ends = np.cumsum(self.lengths[ids]), np.cumsum([len(u) for u in run])
            stops = np.searchsorted(reach, ends) + 1
            if not np.array_equal(reach[stops - 1], ends):
                raise ValueError("a token spans two units")
            counts.append(np.diff(stops, prepend=0))
        single = [e.ids for e in found[len(runs) :]]
        parts.append(np.fromiter(chain.from_iterable(single), np.uint32))
        counts.append(np.fromiter(map(len, single), np.int64, len(single)))
        held = len(self.number)
        self.number.update(zip(chain(*runs, apart), range(held, held + len(new))))
        self.ids = np.concatenate((self.ids, *parts))
        self.first = np.append(self.first, self.first[-1] + np.cumsum(np.concatenate(counts)))
        self.uses = np.append(self.uses, np.zeros(len(new), np.int32))

    def decode(self, ids: bytes) -> str:
        """The text of the ids: the bytes of their pieces, joined; like the library's
        ``decode(ids, skip_special_tokens=False)``."""
        codes = np.frombuffer(ids, np.uint32).astype(np.int64)
        return self.decode_array(np.array([0, len(codes)]), codes)[0].as_py()

    def decode_array(self, first: np.ndarray, ids: np.ndarray) -> pa.Array:
        """The texts of ids that begin at ``first``, as ``encode_array`` gives them."""
        ids = ids.astype(np.int64)
        sizes = self.lengths[ids]
        data = self.piece_bytes[ranges(self.piece_at[ids], sizes)]
        ends = np.concatenate(([0], np.cumsum(sizes)))[first]
        found = pa.Array.from_buffers(
            pa.large_binary(), len(first) - 1, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)]
        )
        try:
            return found.cast(pa.large_string())
        except pa.ArrowInvalid:  # ids that are no text's
            return pa.array([x.decode("utf-8", "replace") for x in found.to_pylist()], pa.large_string())


@lru_cache(2)
def unit_table(path: str) -> UnitTable:
    """One table per worker process; its tokenizer is kept between tasks."""
    return UnitTable(path)


def packed_ids(first: np.ndarray, ids: np.ndarray) -> pa.Array:
    """The ids of each text in a binary."""
    return pa.Array.from_buffers(
        pa.binary(), len(first) - 1, [None, pa.py_buffer((4 * first).astype(np.int32)), pa.py_buffer(ids.astype("<u4"))]
    )


def encode_documents(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, ids): the ids of each whole text as little-endian uint32 in a binary.

    ``tokenizer`` is the path of a byte-level BPE file that every executor has. A null
    or empty text has no ids, also where ``doc_id`` is null; repeated rows give repeated
    results; other columns are left out. No shuffle: a task needs only its own rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = unit_table(tokenizer)
        for part in text_slices(batches):
            first, ids = table.encode_array(filled(part.column("text")))
            yield pa.record_batch([part.column("doc_id"), packed_ids(first, ids)], ["doc_id", "ids"])
        table.release()

    return keyed_texts(docs, key, text).mapInArrow(run, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids, text) of a table (doc_id, ids) made by ``encode_documents``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = unit_table(tokenizer)
        for part in text_slices(batches, "ids", 4 * SLICE_BYTES):
            packed = part.column("ids").fill_null(b"")
            ends = offsets_of(packed)
            data = packed.buffers()[2]
            codes = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data else np.zeros(0, np.uint8)
            texts = table.decode_array((ends - ends[0]) // 4, codes.copy().view("<u4"))
            yield pa.record_batch(
                [part.column("doc_id"), part.column("ids"), texts.cast(pa.string())],
                ["doc_id", "ids", "text"],
            )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")


def coded_and_decoded(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", keep_table: bool = True
) -> DataFrame:
    """(doc_id, ids, text) as ``decode_documents`` gives for ``encode_documents``, in one
    pass: a second Python worker per task would hold a second table. Without ``keep_table``
    a task drops the tokenizer too at its end, which leaves memory to other work on the executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = unit_table(tokenizer)
        for part in text_slices(batches):
            first, ids = table.encode_array(filled(part.column("text")))
            texts = table.decode_array(first, ids).cast(pa.string())
            yield pa.record_batch([part.column("doc_id"), packed_ids(first, ids), texts], ["doc_id", "ids", "text"])
        table.release()
        if not keep_table:
            del table
            unit_table.cache_clear()
            give_back()

    return keyed_texts(docs, key, text).mapInArrow(run, "doc_id long, ids binary, text string")


def round_trip(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoding and decoding again."""
    both = coded_and_decoded(docs, tokenizer, key, text)
    return both.select(
        "doc_id",
        F.expr("CAST(octet_length(ids) div 4 AS BIGINT)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
