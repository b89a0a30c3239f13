"""Alignment of two tokenizers' tokens, counted through inverted pair bitmaps.

Byte offsets where tokens of both end cut a text into groups; all pairs of a token of A and a
token of B in the same group are links. Both tokenizers end a token at every cut of ``units``,
so each distinct unit is aligned once per worker and a text is the sum of its units.

Documents are numbered in blocks of at most 65,536. For each block and pair a compressed
bitmap, a sorted list of 16-bit numbers or the bits themselves, whichever is shorter, says
which documents hold the pair; planes of the same form hold the binary digits of how often,
less one. Slices of a block are OR-merged in the worker, blocks have no document in common, so
a pair's document count is the sum of the popcounts of its bitmaps. The postings then take the
pair's count and whether it is the highest of its A id back to their documents, each plane
weighted by its digit.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rowmill.functions import stored
from rowmill.llm.bpe import byte_alphabet
from rowmill.llm.common import filled, give_back, keyed_texts, offsets_of, small_batches, text_slices
from rowmill.llm.units import LETTER, MARK, ranges, unit_codes

#: Documents of a block and entries (pair, document) after which one is closed.
BLOCK_DOCS, BLOCK_ENTRIES = 1 << 16, 4 << 20
#: Distinct units that a worker keeps aligned, when a slice begins.
MAX_UNITS = 400_000


class Aligner:
    """Aligned units of two tokenizers: a byte-level BPE file of the tokenizers library (A)
    and a SentencePiece BPE model with byte fallback that adds a leading space (B)."""

    def __init__(self, path_a: str, path_b: str, max_units: int = MAX_UNITS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        alphabet = byte_alphabet()
        self.bytes_a = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for piece, i in self.a.get_vocab(with_added_tokens=True).items():
            known = all(c in alphabet for c in piece)
            self.bytes_a[i] = bytes(alphabet[c] for c in piece) if known else piece.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        plain = [p for i, p in enumerate(pieces) if not self.b.is_byte(i) and not self.b.is_control(i)]
        # what lets units be encoded by themselves, behind a newline
        self.head = self.b.encode("\n")
        if [self.bytes_b[i] for i in self.head] != [b" ", b"\n"] or self.b.encode("\n ") != [*self.head, self.head[0]]:
            raise ValueError(f"{path_b} doesn't keep white space as it is behind one added space")
        if any("\n" in p or "▁" in p.lstrip("▁") for p in plain):
            raise ValueError(f"{path_b} has pieces that reach over the start of a word or a line")
        self.joined = np.zeros((256, 256), bool)
        for p in plain:
            data = np.frombuffer(p.encode(), np.uint8)
            both = LETTER[data[:-1]] & MARK[data[1:]]
            self.joined[data[:-1][both], data[1:][both]] = True
        self.n_b = len(pieces)
        self.length_a, self.length_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        numbers = [str(i).encode() for i in range(max(len(self.bytes_a), self.n_b))]
        self.digits = np.frombuffer(b"".join(numbers), np.uint8)
        self.n_digits = np.array([len(x) for x in numbers], np.int64)
        self.first_digit = np.cumsum(self.n_digits) - self.n_digits
        self.max_units = max_units
        self.number: dict[bytes, int] = {}
        self.clear()

    def clear(self) -> None:
        self.number.clear()
        self.texts: list[bytes] = []  # the groups of a unit as text, each with a ; behind it
        self.sizes = np.zeros((0, 4), np.int64)  # tokens of A, of B, groups, links
        self.good = np.zeros(0, bool)
        self.pairs = np.zeros(0, np.int64)
        self.first = np.zeros(1, np.int64)  # the first link of a unit

    def numbers(self, units: list[bytes]) -> np.ndarray:
        """The number of each of these distinct units, new ones aligned first. Of more than
        max_units in all, only those asked for stay."""
        new = [u for u in units if u not in self.number]
        if len(self.number) + len(new) > self.max_units and self.number:
            self.clear()
            new = units
        if new:
            self._add(new)
        return np.fromiter(map(self.number.__getitem__, units), np.int64, len(units))

    def _add(self, new: list[bytes]) -> None:
        texts = [u.decode() for u in new]
        ids_a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        skip = len(self.head)
        ids_b = [b[skip:] for b in self.b.encode(["\n" + t for t in texts], num_threads=1)]
        size = np.array([len(u) for u in new])
        good = self._fitting(new, size, ids_a, ids_b)
        size = np.where(good, size, 0)
        n_a, n_b = (np.where(good, [len(x) for x in ids], 0) for ids in (ids_a, ids_b))
        a, b = (
            np.fromiter(chain.from_iterable(compress(ids, good)), np.int64, int(n.sum()))
            for ids, n in ((ids_a, n_a), (ids_b, n_b))
        )
        # all units one behind the other: their ends are ends of tokens of both
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        beside = np.searchsorted(ends_b, ends_a)
        both = ends_b[np.minimum(beside, len(b) - 1)] == ends_a if len(b) else np.zeros(len(a), bool)
        stop_a, stop_b = np.flatnonzero(both) + 1, beside[both] + 1
        of_a, of_b = np.diff(stop_a, prepend=0), np.diff(stop_b, prepend=0)
        until = np.searchsorted(ends_a[both], np.cumsum(size), "right")  # groups up to the end of each unit
        links = of_a * of_b
        upto = np.concatenate(([0], np.cumsum(links)))[until]
        start_a, start_b = stop_a - of_a, stop_b - of_b
        k, wide = ranges(np.zeros(len(links), np.int64), links), np.repeat(of_b, links)
        pairs = a[np.repeat(start_a, links) + k // wide] * self.n_b + b[np.repeat(start_b, links) + k % wide]
        text = self._written(a, b, of_a, of_b, stop_a, stop_b)
        tokens = np.cumsum(n_a + n_b)
        cuts = [0, *text[1][tokens].tolist()]
        self.number.update(zip(new, range(len(self.texts), len(self.texts) + len(new))))
        self.texts += [text[0][x:y] for x, y in zip(cuts, cuts[1:])]
        self.good = np.append(self.good, good)
        sizes = np.stack((n_a, n_b, np.diff(until, prepend=0), np.diff(upto, prepend=0)), axis=1)
        self.sizes = np.concatenate((self.sizes, sizes))
        self.pairs = np.append(self.pairs, pairs)
        self.first = np.append(self.first, self.first[-1] + upto)

    def _fitting(self, new: list[bytes], size: np.ndarray, ids_a: list, ids_b: list) -> np.ndarray:
        """Which units are what their tokens of A and those of B join to."""
        whole, fits = b"".join(new), True
        for ids, table, lengths in ((ids_a, self.bytes_a, self.length_a), (ids_b, self.bytes_b, self.length_b)):
            flat = np.fromiter(chain.from_iterable(ids), np.int64)
            until = np.concatenate(([0], np.cumsum(lengths[flat])))[np.cumsum([len(x) for x in ids])]
            fits = fits and np.array_equal(until, np.cumsum(size)) and b"".join(map(table.__getitem__, flat.tolist())) == whole
        if fits:
            return np.ones(len(new), bool)
        return np.array([
            b"".join(map(self.bytes_a.__getitem__, a)) == u and b"".join(map(self.bytes_b.__getitem__, b)) == u
            for u, a, b in zip(new, ids_a, ids_b)
        ])

    def _written(
        self, a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, stop_a: np.ndarray, stop_b: np.ndarray
    ) -> tuple[bytes, np.ndarray]:
        """The groups as text, ids of A before those of B, and where each token's text begins."""
        ids, behind = np.zeros(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        ids[np.arange(len(a)) + np.repeat(stop_b - of_b, of_a)] = a
        ids[np.arange(len(b)) + np.repeat(stop_a, of_b)] = b
        behind[stop_a + stop_b - of_b - 1] = ord("|")
        behind[stop_a + stop_b - 1] = ord(";")
        width = self.n_digits[ids]
        ends = np.concatenate(([0], np.cumsum(width + 1)))
        out = np.empty(int(ends[-1]), np.uint8)
        out[ranges(ends[:-1], width)] = self.digits[ranges(self.first_digit[ids], width)]
        out[ends[1:] - 1] = behind
        return out.tobytes(), ends


@lru_cache(1)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One per worker process, kept between tasks."""
    return Aligner(path_a, path_b)


def bitmaps(docs: np.ndarray, first: np.ndarray, n_docs: int) -> pa.Array:
    """A compressed bitmap for each stretch of ascending document numbers from first[i] to
    first[i + 1]: a 0 byte and the numbers as uint16, or a 1 byte and the bits."""
    sizes, width = np.diff(first), -(-n_docs // 8)
    dense = np.flatnonzero(2 * sizes > width)
    lengths = 1 + np.where(2 * sizes > width, width, 2 * sizes)
    ends = np.concatenate(([0], np.cumsum(lengths)))
    out = np.zeros(int(ends[-1]), np.uint8)
    sparse = 2 * sizes <= width
    own = np.repeat(sparse, sizes)
    numbers = docs[own].astype("<u2").view(np.uint8)
    out[ranges(ends[:-1][sparse] + 1, 2 * sizes[sparse])] = numbers
    for i in dense.tolist():
        bits = np.zeros(8 * width, bool)
        bits[docs[first[i] : first[i + 1]]] = True
        out[ends[i]] = 1
        out[ends[i] + 1 : ends[i + 1]] = np.packbits(bits, bitorder="little")
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(out)])


def unfold(maps: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, document number) of all documents in compressed bitmaps."""
    ends = offsets_of(maps)
    data = np.frombuffer(maps.buffers()[2], np.uint8) if len(maps) else np.zeros(0, np.uint8)
    dense = data[ends[:-1]] == 1
    sizes = np.where(dense, 0, (np.diff(ends) - 1) // 2)
    docs = [data[ranges(ends[:-1] + 1, 2 * sizes)].copy().view("<u2").astype(np.int64)]
    rows = [np.repeat(np.arange(len(maps)), sizes)]
    for i in np.flatnonzero(dense).tolist():
        found = np.flatnonzero(np.unpackbits(data[ends[i] + 1 : ends[i + 1]], bitorder="little"))
        docs.append(found)
        rows.append(np.full(len(found), i))
    return np.concatenate(rows), np.concatenate(docs)


DOCUMENT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
ENTRY = f"block long, at int, {DOCUMENT}, pair long, plane int, n int, bits binary"
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


class BlockWriter:
    """Numbers the documents of a block and merges their pairs."""

    def __init__(self) -> None:
        self.block, self.n_docs, self.entries = uuid.uuid4().int >> 65, 0, 0
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray, times: np.ndarray, n_docs: int) -> None:
        """Links of the next documents: pair << 16 | number in the block, and how often."""
        self.parts.append((keys, times))
        self.n_docs += n_docs
        self.entries += len(keys)

    def postings(self) -> Iterator[pa.RecordBatch]:
        keys, times = (np.concatenate(x) for x in zip(*self.parts))
        order = np.argsort(keys, kind="stable")
        keys, rest = keys[order], times[order] - 1
        held = np.ones(len(keys), bool)
        plane = 0
        while held.any():
            pairs, docs = keys[held] >> 16, keys[held] & 0xFFFF
            first = np.append(np.flatnonzero(np.diff(pairs, prepend=-1)), len(pairs))
            n = len(first) - 1
            yield entries(n, {
                "block": pa.array(np.full(n, self.block)), "pair": pa.array(pairs[first[:-1]]),
                "plane": pa.array(np.full(n, plane, np.int32)), "n": pa.array(np.diff(first).astype(np.int32)),
                "bits": bitmaps(docs, first, self.n_docs),
            })
            held = (rest >> plane & 1).astype(bool)
            while plane < 62 and not held.any() and (rest >> plane).any():
                plane += 1
                held = (rest >> plane & 1).astype(bool)
            plane += 1


def entries(n: int, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    kinds = {"block": pa.int64(), "at": pa.int32(), "doc_id": pa.int64(), **{c: pa.int64() for c in COUNTS},
             "groups_sha256": pa.string(), "pair": pa.int64(), "plane": pa.int32(), "n": pa.int32(), "bits": pa.binary()}
    return pa.record_batch([columns.get(c, pa.nulls(n, k)) for c, k in kinds.items()], list(kinds))


def summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in ascending order, and the sum of their times."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(times[order], first) if len(first) else times[:0]


def entry_table(docs: DataFrame, path_a: str, path_b: str, key: str, text: str, block_entries: int) -> DataFrame:
    """Stored entries: a row per document with its own figures (pair null), and a row per
    block, pair and plane with a bitmap (pair not null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units_of = aligner(path_a, path_b)
        writer = BlockWriter()
        for part in text_slices(batches):
            texts = filled(part.column("text"))
            size = np.diff(offsets_of(texts))
            spaced = pa.array([" " + t if t else "" for t in texts.to_pylist()], pa.large_string())
            ends, codes, units = unit_codes(spaced, units_of.joined)
            number = units_of.numbers(units)[codes] if len(codes) else codes
            owner = np.repeat(np.arange(len(size)), np.diff(ends))
            bad = np.zeros(len(size), bool)
            bad[owner[~units_of.good[number]]] = True
            totals = np.concatenate((np.zeros((1, 4), np.int64), np.cumsum(units_of.sizes[number], axis=0)))
            counts = np.where(bad[:, None], 0, totals[ends[1:]] - totals[ends[:-1]])
            named = [
                hashlib.sha256(b"".join(map(units_of.texts.__getitem__, number[a:b].tolist()))[:-1]).hexdigest()
                if b > a and not wrong else ""
                for a, b, wrong in zip(ends[:-1].tolist(), ends[1:].tolist(), bad.tolist())
            ]
            at = 0
            while at < len(size):
                stop = min(len(size), at + BLOCK_DOCS - writer.n_docs)
                own = slice(ends[at], ends[stop])
                fine = ~bad[owner[own]]
                held, times = summed(owner[own][fine] * (len(units_of.good) + 1) + number[own][fine], np.ones(int(fine.sum()), np.int64))
                doc, unit = held // (len(units_of.good) + 1), held % (len(units_of.good) + 1)
                sizes = units_of.sizes[unit, 3]
                links = units_of.pairs[ranges(units_of.first[unit], sizes)]
                keys, times = summed(links << 16 | np.repeat(doc - at + writer.n_docs, sizes), np.repeat(times, sizes))
                n = stop - at
                yield entries(n, {
                    "block": pa.array(np.full(n, writer.block)),
                    "at": pa.array(np.arange(writer.n_docs, writer.n_docs + n, dtype=np.int32)),
                    "doc_id": part.column("doc_id").slice(at, n), "groups_sha256": pa.array(named[at:stop], pa.string()),
                    **{c: pa.array(counts[at:stop, i]) for i, c in enumerate(COUNTS)},
                })
                writer.add(keys, times, n)
                at = stop
                if writer.n_docs == BLOCK_DOCS or writer.entries >= block_entries:
                    yield from writer.postings()
                    writer = BlockWriter()
        if writer.parts:
            yield from writer.postings()
        give_back()

    return stored(keyed_texts(docs, key, text).mapInArrow(run, ENTRY))


def pair_counts(postings: DataFrame, n_b: int) -> DataFrame:
    """Stored (pair, id_a, id_b, n_docs, n_links, best): documents that hold a pair, links
    over all documents, and whether no pair of its A id has more documents."""
    weight = F.when(F.col("plane") == 0, F.lit(1)).otherwise(F.expr("shiftleft(1L, plane - 1)"))
    counts = stored(
        postings.groupBy("pair").agg(
            F.sum(F.when(F.col("plane") == 0, F.col("n").cast("long")).otherwise(F.lit(0))).alias("n_docs"),
            F.sum(F.col("n") * weight).alias("n_links"),
        )
        .withColumn("id_a", F.expr(f"CAST(pair div {n_b} AS INT)"))
        .withColumn("id_b", F.expr(f"CAST(pair % {n_b} AS INT)"))
    )
    most = counts.groupBy("id_a").agg(F.max("n_docs").alias("most"))
    best = (F.col("n_docs") == F.col("most")).alias("best")
    return stored(counts.join(most, "id_a").select("pair", "id_a", "id_b", "n_docs", "n_links", best))


def _weighted(docs: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """Sums per document in whole numbers; double precision is exact for either half."""
    low, high = weights & 0xFFFFF, weights >> 20
    return (np.bincount(docs, high, n).astype(np.int64) << 20) + np.bincount(docs, low, n).astype(np.int64)


def _returned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block, best, total = None, None, None
    for batch in batches:
        number = batch.column("block").to_numpy()
        for a, b in zip(*(x.tolist() for x in bounds(number))):
            own = batch.slice(a, b - a)
            if number[a] != block:
                block, best, total = number[a], np.zeros(BLOCK_DOCS, np.int64), np.zeros(BLOCK_DOCS, np.int64)
            paired = own.column("pair").is_valid().to_numpy(zero_copy_only=False)
            scored = own.filter(pa.array(paired))
            if scored.num_rows:
                row, doc = unfold(scored.column("bits"))
                plane = scored.column("plane").to_numpy()
                times = np.where(plane == 0, 1, 1 << np.maximum(plane.astype(np.int64) - 1, 0))
                highest = scored.column("best").to_numpy(zero_copy_only=False).astype(np.int64)
                total += _weighted(doc, (times * scored.column("n_docs").to_numpy())[row], BLOCK_DOCS)
                best += _weighted(doc, (times * highest)[row], BLOCK_DOCS)
            docs = own.filter(pa.array(~paired))
            if docs.num_rows:
                at = docs.column("at").to_numpy()
                yield pa.record_batch(
                    [docs.column("doc_id"), *(docs.column(c) for c in COUNTS), pa.array(best[at]), pa.array(total[at]),
                     docs.column("groups_sha256")],
                    ["doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256"],
                )


def bounds(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and end of each stretch of equal values."""
    cuts = np.flatnonzero(np.diff(values)) + 1
    inner = np.concatenate(([0], cuts, [len(values)])) if len(values) else np.zeros(1, np.int64)
    return inner[:-1], inner[1:]


def align(
    docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text",
    block_entries: int = BLOCK_ENTRIES,
) -> tuple[DataFrame, DataFrame]:
    """Per document (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256),
    and per pair (pair, id_a, id_b, n_docs, n_links, best).

    Whole texts are encoded behind a space, special tokens' strings as plain text. A text
    that is null or empty, or whose tokens of A or of B don't join to its bytes, has no tokens:
    zeros and an empty ``groups_sha256``. ``n_best`` counts links whose pair is in as many
    documents as any pair of its A id, ``count_sum`` adds the documents of the pairs of all
    links. Every row is a document, also where ids are repeated or null; other columns are
    left out. Texts don't travel; bitmaps do, once by pair and once back by block.
    """
    import sentencepiece

    n_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    found = entry_table(docs, path_a, path_b, key, text, block_entries)
    postings = found.where("pair IS NOT NULL").select("block", "pair", "plane", "n", "bits")
    counts = pair_counts(postings.select("pair", "plane", "n"), n_b)
    scored = postings.drop("n").join(counts.select("pair", "n_docs", "best"), "pair")
    own = found.where("pair IS NULL").drop("pair", "plane", "n", "bits")
    together = scored.unionByName(own, allowMissingColumns=True)
    ordered = small_batches(together).repartition("block").sortWithinPartitions("block", F.desc_nulls_last("pair"))
    result = ordered.mapInArrow(
        _returned,
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string",
    )
    return result, counts
