"""Substring dedup by content-defined chunks.

A gear rolling hash over the last ``GEAR_BYTES`` bytes decides at each word start whether
a cut falls there, so cuts follow the content and text inserted elsewhere doesn't move
them. Where ``FORCED_WORDS`` words have none, as in a passage that repeats few words, one falls at
a word start whose hash is the smallest of them: that too depends on these words alone. A chunk reaches from a cut to the first cut at least ``MIN_WORDS`` words on, and one
more from the last cut that leaves as many words to the end of the text: chunks overlap, and
each is long enough not to repeat by chance. Chunks are told apart by a 64-bit
digest of their bytes. A digest belongs to the row with the smallest id that holds it (null
last; rows that share an id or have none are numbered, and the first by number counts), and in a
row to its first chunk; other chunks are copies, and what copies cover is cut out of the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from rowmill.functions import stored
from rowmill.llm.common import filled, mix, offsets_of, small_batches, text_slices

#: Bytes that the rolling hash covers: each doubling in ``gear`` adds as many again.
GEAR_BYTES = 16
#: A cut falls at a word start with a probability of 1 in 2 ** CUT_BITS.
CUT_BITS = 2
#: Word starts without a cut, the last included, after which the smallest hash cuts.
FORCED_WORDS = 8
#: Words of a chunk, at least.
MIN_WORDS = 25

GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
#: A value for each byte, and the factor between neighbours in a digest.
VALUES = mix(np.arange(1001, 1257, dtype=np.uint64))
FACTOR = 0x9E3779B97F4A7C15
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
COPIES = "copied_chunks"
#: The number of a row among those with its id (0 if the id is its own), and the id and the
#: number of the row that copied digests are for.
ROW, COPY_OF, COPY_ROW = "_row", "_copy_of", "_copy_row"


def gear(data: np.ndarray) -> np.ndarray:
    """At each byte the gear hash of the last GEAR_BYTES bytes, that byte included."""
    out, reach = GEAR[data], 1
    while reach < GEAR_BYTES:
        shifted = out.copy()
        shifted[reach:] += out[:-reach] << np.uint32(reach)
        out, reach = shifted, 2 * reach
    return out


def cut_places(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Which word starts are cuts, from their hashes and texts in order."""
    cut = hashes >> np.uint32(32 - CUT_BITS) == 0
    at = np.arange(len(hashes))
    last = np.maximum.accumulate(np.where(cut, at, -1))
    late = at[(at - last >= FORCED_WORDS) & (at >= FORCED_WORDS - 1)]
    late = late[text[late] == text[late - FORCED_WORDS + 1]]
    for back in range(1, FORCED_WORDS):
        late = late[hashes[late] <= hashes[late - back]]
    cut[late] = True
    return cut


def powers(factor: int, n: int) -> np.ndarray:
    """factor ** 0 .. factor ** (n - 1) modulo 2 ** 64."""
    out = np.ones(max(1, n), np.uint64)
    done = 1
    while done < n:
        step = np.uint64(pow(factor, done, 1 << 64))
        out[done : 2 * done] = out[: min(done, n - done)] * step
        done *= 2
    return out[:n]


def digests(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit digest of each stretch of bytes, wherever it stands."""
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(VALUES[data] * powers(FACTOR, n), out=total[1:])
    back = powers(pow(FACTOR, -1, 1 << 64), n + 1)[starts]
    return mix((total[stops] - total[starts]) * back + mix((stops - starts).astype(np.uint64)))


class Chunks:
    """Chunks of a slice of texts: first byte, end, text and digest of each."""

    def __init__(self, texts: pa.Array, min_words: int = MIN_WORDS):
        texts = filled(texts)
        ends = offsets_of(texts)
        buffer = texts.buffers()[2]
        self.data = memoryview(buffer)[int(ends[0]) : int(ends[-1])] if buffer else memoryview(b"")
        self.ends = ends - ends[0]
        data = np.frombuffer(self.data, np.uint8)
        blank = BLANK[data]
        first = ~blank
        first[1:] &= blank[:-1]
        full = np.diff(self.ends) > 0
        heads, tails = self.ends[:-1][full], self.ends[1:][full]
        first[heads] = ~blank[heads]
        words = np.flatnonzero(first)
        # a cut near the start of a text would depend on the text before it
        far = words - self.ends[np.searchsorted(self.ends, words, "right") - 1] >= GEAR_BYTES
        cuts = words[far]
        if len(cuts):
            inside = np.searchsorted(self.ends, cuts, "right") - 1
            cuts = cuts[cut_places(gear(data)[cuts - 1], inside)]
        # the bounds of each text in order: its start, its cuts, its end
        place = np.concatenate((heads, cuts, tails))
        text = np.concatenate((np.flatnonzero(full), np.searchsorted(self.ends, cuts, "right") - 1, np.flatnonzero(full)))
        order = np.lexsort((place, text))
        place, text = place[order], text[order]
        number = np.searchsorted(words, place)  # words before the bound
        reach = np.searchsorted(number, number + min_words)
        whole = reach < len(place)
        whole[whole] = text[reach[whole]] == text[whole]
        begin, end = np.flatnonzero(whole), reach[whole]
        # the last words of a text may lie beyond the last such cut: a chunk up to its end
        last = np.flatnonzero(np.append(text[1:] != text[:-1], len(text) > 0)) if len(text) else text
        back = np.searchsorted(number, number[last] - min_words, "right") - 1
        own = (back >= 0) & (text[back] == text[last])
        own[own] = reach[back[own]] != last[own]
        begin, end = np.append(begin, back[own]), np.append(end, last[own])
        order = np.lexsort((end, begin))
        begin, end = begin[order], end[order]
        self.starts, self.stops, self.owner = place[begin], place[end], text[begin]
        self.digests = digests(data, self.starts, self.stops).view(np.int64)

    def first_in_text(self) -> np.ndarray:
        """Of each chunk: no earlier chunk of its text has its digest."""
        key = mix(self.digests.view(np.uint64)) ^ mix(self.owner.astype(np.uint64) + np.uint64(1))
        out = np.zeros(len(key), bool)
        out[np.unique(key, return_index=True)[1]] = True
        return out


def chunk_table(
    numbered: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """(digest, row, doc_id): the distinct chunks of each row of a numbered table."""
    rows = numbered.select(
        ROW, F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            chunks = Chunks(part.column("text"), min_words)
            once = chunks.first_in_text()
            owner = pa.array(chunks.owner[once])
            yield pa.record_batch(
                [pa.array(chunks.digests[once]), part.column(ROW).take(owner), part.column("doc_id").take(owner)],
                ["digest", "row", "doc_id"],
            )

    return small_batches(rows).mapInArrow(run, "digest long, row long, doc_id long")


def numbered_rows(docs: DataFrame, key: str) -> DataFrame:
    """The table with a number ROW: 0 where the id is held by one row, else from 1 on. Only rows
    that share an id or have none are stored, since their numbers have to stay the same."""
    own = F.col(key).cast("long")
    counts = docs.groupBy(own.alias(COPY_OF)).agg(F.count(F.lit(1)).alias("n"))
    shared = stored(counts.where(F.col(COPY_OF).isNull() | (F.col("n") > 1)).select(COPY_OF))
    if shared.isEmpty():
        return docs.withColumn(ROW, F.lit(0).cast("long"))
    same = own.eqNullSafe(F.col(COPY_OF))
    several = stored(docs.join(shared, same, "left_semi").withColumn(ROW, F.monotonically_increasing_id() + 1))
    return docs.join(shared, same, "left_anti").withColumn(ROW, F.lit(0).cast("long")).union(several)


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
    report: bool = False,
) -> DataFrame:
    """The table with repeated passages cut out of its texts: all rows and columns stay, a
    null text stays null, and a text that consists of copies becomes empty. Texts of fewer
    than ``min_words`` words have no chunk and stay.

    With ``report`` instead (doc_id, n_chunks, n_copied, n_removed, text): chunks, copied
    chunks, and characters cut out. Rows that share an id or have none count one by one, in the
    order in which the table is read; those without an id come after all others.
    """
    if {c.lower() for c in docs.columns} & {COPIES, ROW, COPY_OF, COPY_ROW}:
        raise ValueError(f"the table already has a column {COPIES}, {ROW}, {COPY_OF} or {COPY_ROW}")
    kept = docs.columns
    schema: StructType | str = docs.schema
    if report:
        docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
        key, text, kept = "doc_id", "text", ["doc_id"]
    numbered = numbered_rows(docs, key)
    chunks = chunk_table(numbered, key, text, min_words)
    # a row gives a digest once
    repeated = stored(chunks.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest"))
    # both sides meet by digest alone, so the joins can split a digest that many hold
    shared = stored(chunks.join(repeated, "digest"))
    first = shared.groupBy("digest").agg(
        F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("id"), F.col("row").alias("number"))).alias("first")
    )
    copies = stored(
        shared.join(first, "digest").where("NOT (doc_id <=> first.id AND row = first.number)")
        .groupBy(F.col("doc_id").alias(COPY_OF), F.col("row").alias(COPY_ROW))
        .agg(F.collect_set("digest").alias(COPIES))
    )
    of_row = F.col(key).cast("long").eqNullSafe(F.col(COPY_OF)) & (F.col(ROW) == F.col(COPY_ROW))
    joined = numbered.join(copies, of_row, "left").drop(ROW, COPY_OF, COPY_ROW)
    counts = ["n_chunks", "n_copied", "n_removed"]
    if report:
        schema = "doc_id long, n_chunks long, n_copied long, n_removed long, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, text):
            texts, found = _without_copies(part.column(text), part.column(COPIES), min_words)
            if report:
                yield pa.record_batch(
                    [part.column("doc_id"), *(pa.array(found[c], pa.int64()) for c in counts), texts],
                    ["doc_id", *counts, "text"],
                )
            else:
                yield pa.record_batch([texts if c == text else part.column(c) for c in kept], kept)

    return small_batches(joined).mapInArrow(run, schema)


def _without_copies(texts: pa.Array, copies: pa.Array, min_words: int) -> tuple[pa.Array, dict]:
    """The texts without what copies cover, and counts of each."""
    chunks, n = Chunks(texts, min_words), len(texts)
    copied = ~chunks.first_in_text()
    bounds = np.searchsorted(chunks.owner, np.arange(n + 1))
    for i, own in enumerate(copies.to_pylist()):
        if own:
            a, b = bounds[i], bounds[i + 1]
            copied[a:b] |= np.isin(chunks.digests[a:b], np.array(own, np.int64))
    counts = {
        "n_chunks": np.diff(bounds),
        "n_copied": np.diff(np.concatenate(([0], np.cumsum(copied)))[bounds]),
        "n_removed": np.zeros(n, np.int64),
    }
    out = texts.to_pylist()
    for i in np.unique(chunks.owner[copied]).tolist():
        own = slice(bounds[i], bounds[i + 1])
        at, parts = int(chunks.ends[i]), []
        # starts and stops both ascend within a text
        for start, stop in zip(chunks.starts[own][copied[own]].tolist(), chunks.stops[own][copied[own]].tolist()):
            parts.append(bytes(chunks.data[at : max(at, start)]))
            at = max(at, stop)
        parts.append(bytes(chunks.data[at : int(chunks.ends[i + 1])]))
        cut = b"".join(parts).decode()
        counts["n_removed"][i] = len(out[i]) - len(cut)
        out[i] = cut
    return pa.array(out, pa.string()), counts
