"""Benchmark decontamination: word windows of benchmark items found in whole texts.

The items' windows are small beside the corpus and go to every task as hash tables, in
blocks of at most ``BLOCK_BYTES`` of item text; a larger benchmark is several blocks that
the texts pass one after the other, so no table outgrows a task. Only stretches of words
that all occur in the items are hashed, and every hash hit is compared word by word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from rowmill.llm.common import filled, keyed_texts, mix, offsets_of, small_batches, split_words, text_slices

#: Words of a window; an item of fewer words is one window.
WINDOW = 10
#: Bytes of item text in a block of windows.
BLOCK_BYTES = 4 << 20
#: Word characters, once A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Bytes of words lower-cased, any other byte a space.
NORMAL = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isdigit() or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)
HITS = "benchmark_hits"
FOUND = StructType()
FOUND.add("n_words", "long")
FOUND.add("spans", ArrayType(StructType().add("start", "integer").add("stop", "integer")))
FOUND.add("item_ids", ArrayType(LongType()))


def normal_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(offsets per text, flat words) under ``WORD``."""
    texts = filled(texts)
    ends = offsets_of(texts)
    data = memoryview(texts.buffers()[2] or b"")[int(ends[0]) : int(ends[-1])].tobytes().translate(NORMAL)
    clean = pa.StringArray.from_buffers(
        len(texts), pa.py_buffer((ends - ends[0]).astype(np.int32)), pa.py_buffer(data)
    )
    return split_words(clean)


class Windows:
    """The windows of some items: by length, hashes in order with their words and items."""

    def __init__(self, items: list[tuple[int | None, str | None]], window: int):
        ends, flat = normal_words(pa.array([text for _, text in items], pa.string()))
        coded = flat.dictionary_encode()
        self.words, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
        lengths = np.diff(ends)
        rows: dict[int, list[tuple[int, int]]] = {}
        for i, n in enumerate(lengths.tolist()):
            size = min(n, window)
            if n:
                rows.setdefault(size, []).extend((int(ends[i]) + k, i) for k in range(n - size + 1))
        self.tables = {}
        for size, found in rows.items():
            starts, owner = np.array(found, np.int64).T
            windows = codes[starts[:, None] + np.arange(size)]
            order = np.argsort(hashes := self.hashes(windows), kind="stable")
            ids = np.array([-1 if items[i][0] is None else items[i][0] for i in owner[order]], np.int64)
            has_id = np.array([items[i][0] is not None for i in owner[order]], bool)
            self.tables[size] = (hashes[order], windows[order], ids, has_id)

    @staticmethod
    def hashes(windows: np.ndarray) -> np.ndarray:
        """A hash of each row of word codes."""
        values = mix(windows.astype(np.uint64) + np.uint64(1))
        return np.array([], np.uint64) if not len(windows) else mix(
            (values * (mix(np.arange(1, windows.shape[1] + 1, dtype=np.uint64)) | np.uint64(1))).sum(axis=1, dtype=np.uint64)
        )

    def find(self, texts: pa.Array) -> tuple[np.ndarray, list[tuple[int, int, int]], list[tuple[int, int]]]:
        """(words per text, hit stretches (text, first word, end), (text, item) found)."""
        ends, flat = normal_words(texts)
        codes = pc.fill_null(pc.index_in(flat, value_set=self.words), -1).to_numpy(zero_copy_only=False)
        known = np.flatnonzero(codes >= 0)
        if not len(known) or not self.tables:
            return np.diff(ends), [], []
        owner = np.searchsorted(ends, known, "right") - 1
        # known words that follow each other in one text form a stretch
        breaks = np.flatnonzero((np.diff(known) != 1) | (np.diff(owner) != 0)) + 1
        stops = np.repeat(known[np.append(breaks, len(known)) - 1] + 1, np.diff(np.concatenate(([0], breaks, [len(known)]))))
        room = stops - known
        marked = np.zeros(len(codes) + 1, np.int32)
        items: set[tuple[int, int]] = set()
        for size, (hashes, windows, ids, has_id) in self.tables.items():
            fits = np.flatnonzero(room >= size)
            if not len(fits):
                continue
            starts = known[fits]
            seen = codes[starts[:, None] + np.arange(size)]
            wanted = self.hashes(seen)
            low, high = np.searchsorted(hashes, wanted, "left"), np.searchsorted(hashes, wanted, "right")
            for i in np.flatnonzero(high > low).tolist():
                same = low[i] + np.flatnonzero((windows[low[i] : high[i]] == seen[i]).all(axis=1))
                if len(same):
                    marked[starts[i]] += 1
                    marked[starts[i] + size] -= 1
                    items.update((int(owner[fits[i]]), int(x)) for x, ok in zip(ids[same], has_id[same]) if ok)
        hit = np.cumsum(marked[:-1]) > 0
        if not hit.any():
            return np.diff(ends), [], []
        spans = []
        edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
        for a, b in edges.reshape(-1, 2).tolist():
            while a < b:  # a stretch may run on into the next text
                text = int(np.searchsorted(ends, a, "right")) - 1
                stop = min(b, int(ends[text + 1]))
                spans.append((text, a - int(ends[text]), stop - int(ends[text])))
                a = stop
        return np.diff(ends), spans, sorted(items)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _listed(values: list[list]) -> pa.Array:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
    return pa.array([[{"start": a, "stop": b} for a, b in v] for v in values], kind)


def blocks_of(items: DataFrame, block_bytes: int) -> list[DataFrame]:
    """The items (item_id, text) in blocks of about ``block_bytes`` of text."""
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // block_bytes))
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    return [items.where(place == number) if count > 1 else items for number in range(count)]


def find_benchmark(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text", window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(doc_id, n_words, spans, item_ids): hit words of each whole text, as stretches from
    the first hit word (counted from 0) to the word after the last, and the items found.

    A null or empty text has no words and no hits; an item without words has no window; an
    item without id marks words but isn't listed; repeated rows, of either table, change
    nothing for others. Columns of other names are left out. No shuffle.
    """
    rows = _scanned(keyed_texts(docs, key, text), "text", benchmark, item_key, item_text, window, block_bytes, False)
    return rows.select("doc_id", f"{HITS}.*")


def remove_benchmark(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id",
    item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
    mode: str = "spans",
) -> DataFrame:
    """The table without benchmark text: mode ``spans`` cuts the hit words, with what stands
    between them, out of the texts and keeps every row; mode ``documents`` drops rows with
    a hit. Columns stay as they are; a null text stays null; other rows are untouched.
    """
    if mode not in ("spans", "documents"):
        raise ValueError(f"mode {mode!r} is neither spans nor documents")
    cut = mode == "spans"
    rows = _scanned(docs, text, benchmark, item_key, item_text, window, block_bytes, True, cut)
    return rows if cut else rows.where(F.size(f"{HITS}.spans") == 0).select(*docs.columns)


def _cut(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    if not spans:
        return text
    lowered = text.translate({c: c + 32 for c in range(65, 91)})
    words = [m.span() for m in re.finditer(WORD, lowered)]
    out, at = [], 0
    for start, stop in spans:
        out.append(text[at : words[start][0]])
        at = words[stop - 1][1]
    return "".join([*out, text[at:]])


def _scanned(
    rows: DataFrame, text: str, benchmark: DataFrame, item_key: str, item_text: str,
    window: int, block_bytes: int, keep: bool, cut: bool = False,
) -> DataFrame:
    """The rows with a column ``HITS``; without ``keep`` just doc_id and that column. With
    ``cut`` the last pass cuts the hits out of the texts instead of naming them."""
    if HITS in {c.lower() for c in rows.columns}:
        raise ValueError(f"the table already has a column {HITS}")
    items = benchmark.select(
        F.col(item_key).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text")
    )
    blocks = blocks_of(items, block_bytes)
    for number, block in enumerate(blocks):
        # bounded by block_bytes of text
        windows = Windows([tuple(r) for r in block.toLocalIterator()], window)
        held = rows.sparkSession.sparkContext.broadcast(windows)
        first, last = number == 0, number == len(blocks) - 1
        names = [c for c in rows.columns if c != HITS]
        names = names if keep or not last else ["doc_id"]
        told = [] if cut and last else [StructField(HITS, FOUND)]
        schema = StructType([*(rows.schema[c] for c in names), *told])

        def run(batches, held=held, first=first, names=names, told=bool(told)) -> Iterator[pa.RecordBatch]:
            for part in text_slices(batches, text):
                counts, hits, listed = held.value.find(part.column(text))
                spans: list[list] = [[] for _ in range(part.num_rows)]
                ids: list[list] = [[] for _ in range(part.num_rows)]
                for i, a, b in hits:
                    spans[i].append((a, b))
                for i, item in listed:
                    ids[i].append(item)
                if not first:
                    for i, old in enumerate(part.column(HITS).to_pylist()):
                        spans[i] = _merged(spans[i] + [(s["start"], s["stop"]) for s in old["spans"]])
                        ids[i] = sorted({*ids[i], *old["item_ids"]})
                if not told:
                    texts = part.column(text)
                    if any(spans):
                        pairs = zip(texts.to_pylist(), map(_merged, spans))
                        texts = pa.array([_cut(t, s) for t, s in pairs], pa.string())
                    yield pa.record_batch([texts if c == text else part.column(c) for c in names], names)
                    continue
                found = pa.StructArray.from_arrays(
                    [pa.array(counts, pa.int64()), _listed(spans), pa.array(ids, pa.list_(pa.int64()))],
                    ["n_words", "spans", "item_ids"],
                )
                yield pa.record_batch([*(part.column(c) for c in names), found], [*names, HITS])

        rows = small_batches(rows).mapInArrow(run, schema)
    return rows


def contamination(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find_benchmark(docs, benchmark, block_bytes=block_bytes)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.stop - s.start)
    names = F.array_join(F.array_sort(F.transform("item_ids", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )
