"""Language-model scores by context-tree weighting.

Texts are read as their lower-cased words joined by a space, with an end byte. Each byte
is eight binary decisions; every decision has a tree over the bytes before it, nearest
first, down to ``DEPTH``. A node mixes its own Krichevsky-Trofimov estimate with those of
its children, half and half before any data, so all depths share in every prediction.

The corpus is cut into chunks as tasks read it. A chunk writes its texts and, per bucket
of keys, which byte windows and words it holds and how often they occur in training texts.
Buckets add these up over all chunks. The distinct windows, no longer one copy per chunk, go
on to the trees, which keep the windows after the same two bytes together and return a value
for each. Buckets answer each chunk from these, and each chunk scores its own texts. So texts
are shuffled once, in compressed chunks, keys twice per chunk, and nothing that grows with
the corpus passes through the driver: it gets two counts of words and the nodes of depth 0
and 1, at most 256 * 255.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from rowmill.functions import stored
from rowmill.llm.common import (
    binary_rows, give_back, hash_words, mix, offsets_of, small_batches, split_words, text_slices,
)

#: Bytes of context. Windows of DEPTH + 1 bytes have to fit into 64 bits.
DEPTH = 5
#: Bytes of text in a chunk.
CHUNK_BYTES = 16 << 20
#: Keys of several chunks that are added up at a time, unless the sum is larger.
MERGE_KEYS = 1 << 20
#: Buckets per group of trees.
BUCKETS_PER_TREE = 4
END = "\n"
END_KEY = np.uint64(xxhash.xxh3_64_intdigest(END.encode()))
TEXTS, GRAMS, WORDS = 0, 1, 2
LOG2 = math.log(2.0)

#: Context bytes, nearest first, whose windows share a bucket, and a group of trees.
BUCKET_DEPTH, TREE_DEPTH = 3, 2

CHUNKS = "kind int, chunk string, bucket int, total long, keys binary, counts binary, blob binary"
ANSWERS = "chunk string, kind int, bucket int, answers binary"
MERGED = "tree int, bucket int, keys binary, counts binary"
VALUES = "bucket int, keys binary, found binary"


def log_gamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function for x >= 0.5, by Stirling's series from 8 on."""
    x = np.asarray(x, np.float64)
    shift = np.zeros_like(x)
    y = x.copy()
    while (small := y < 8).any():
        shift[small] -= np.log(y[small])
        y[small] += 1
    z = 1 / (y * y)
    series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z * (1 / 1680 - z / 1188)))) / y
    return shift + (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """log probability that the KT estimator gives n0 zeros and n1 ones, in any order."""
    return log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - log_gamma(n0 + n1 + 1.0) - math.log(math.pi)


def mixed(n0: np.ndarray, n1: np.ndarray, children: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of nodes: log of the weighted probability, and the share of the node's own estimate."""
    own = log_kt(n0, n1)
    weighted = np.logaddexp(own, children) - LOG2
    return weighted, np.exp(own - LOG2 - weighted)


def ones(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return (n1 + 0.5) / (n0 + n1 + 1.0)


# --- bytes of texts ---------------------------------------------------------------


def normal_texts(texts: pa.Array) -> pa.Array:
    """Lower-cased words of each text, joined by a space."""
    ends, flat = split_words(pc.ascii_lower(pc.fill_null(texts, "")))
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
    return pc.binary_join(lists, " ")


def windows(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets per text, a key for each byte and the text's end): the bytes before it,
    nearest first, then the byte itself. Before a text stand end bytes."""
    padded = pc.binary_join_element_wise(pa.scalar(END * DEPTH), texts, pa.scalar(END), "")
    ends = offsets_of(padded)
    data = np.frombuffer(padded.buffers()[2], np.uint8)[ends[0] : ends[-1]].astype(np.uint64)
    ends -= ends[0]
    n = len(data) - DEPTH
    keys = np.zeros(max(0, n), np.uint64)
    for back in [*range(1, DEPTH + 1), 0]:
        keys <<= np.uint64(8)
        keys |= data[DEPTH - back : DEPTH - back + n]
    # windows that begin in the last DEPTH bytes of a text run into the next one
    inside = np.ones(len(data), bool)
    for i in range(1, DEPTH + 1):
        inside[ends[1:] - i] = False
    return ends - DEPTH * np.arange(len(ends)), keys[inside[:n]]


class Slice:
    """Byte windows and words of some normal texts, as codes of distinct keys."""

    def __init__(self, texts: pa.Array, held: np.ndarray):
        self.held = held
        self.gram_ends, keys = windows(texts)
        codes, distinct = pd.factorize(keys.view(np.int64))
        self.grams, self.gram_codes = distinct.view(np.uint64), codes.astype(np.int32)
        self.word_ends, flat = split_words(texts)
        coded = flat.dictionary_encode()
        self.words = hash_words(coded.dictionary) if len(flat) else np.zeros(0, np.uint64)
        self.word_codes = coded.indices.to_numpy(zero_copy_only=False)

    def gram_counts(self) -> np.ndarray:
        """How often each distinct window occurs in training texts."""
        train = np.repeat(~self.held, np.diff(self.gram_ends))
        return np.bincount(self.gram_codes[train], minlength=len(self.grams))

    def word_counts(self) -> tuple[np.ndarray, np.ndarray]:
        train = np.repeat(~self.held, np.diff(self.word_ends))
        counts = np.bincount(self.word_codes[train], minlength=len(self.words))
        return np.append(self.words, END_KEY), np.append(counts, np.count_nonzero(~self.held))


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and their added counts."""
    order = np.argsort(keys, kind="stable")  # fast where sorted keys follow sorted keys
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[first], np.add.reduceat(counts[order], first, dtype=np.int64)


def buckets_of(kind: int, keys: np.ndarray, buckets: int, depth: int = BUCKET_DEPTH) -> np.ndarray:
    """The bucket of each key. Windows with the same ``depth`` bytes before the last one share
    a bucket, so it holds every node of that depth and below whole."""
    if kind == GRAMS:
        keys = mix((keys >> np.uint64(8 * (DEPTH - depth + 1))) + np.uint64(1))
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def dealt(
    kind: int, keys: np.ndarray, buckets: int, depth: int = BUCKET_DEPTH
) -> Iterator[tuple[int, np.ndarray]]:
    """Of each bucket that some of the sorted keys fall into: its number, and which do."""
    place = buckets_of(kind, keys, buckets, depth)
    order = np.argsort(place, kind="stable")
    cuts = np.searchsorted(place[order], np.arange(buckets + 1))
    for number in np.flatnonzero(np.diff(cuts)).tolist():
        yield number, order[cuts[number] : cuts[number + 1]]


def packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def unpacked(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys, as the steps between them."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, np.uint64), dtype=np.uint64)


# --- chunks -----------------------------------------------------------------------


def chunk_rows(docs: DataFrame, buckets: int, chunk_bytes: int) -> DataFrame:
    """The stored chunks of a table (doc_id, text, held_out): a row with the texts, and rows
    with the keys and training counts of each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held_bytes, parts = TaskContext.get().partitionId(), 0, 0, []

        def rows() -> Iterator[pa.RecordBatch]:
            chunk = f"{part}-{number}"
            whole = pa.Table.from_batches([t for t, _, _ in parts])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, whole.schema) as writer:
                writer.write_table(whole)
            blob = zstandard.ZstdCompressor(level=3).compress(sink.getvalue().to_pybytes())
            yield _chunk_batch([(TEXTS, chunk, 0, 0, None, None, blob)])
            for kind, found in ((GRAMS, [g for _, g, _ in parts]), (WORDS, [w for _, _, w in parts])):
                keys, counts = summed(*(np.concatenate(x) for x in zip(*found)))
                yield _chunk_batch([
                    (kind, chunk, b, int(counts[at].sum()), packed_keys(keys[at]), packed(counts[at]), None)
                    for b, at in dealt(kind, keys, buckets)
                ])

        for piece in text_slices(batches):
            texts = normal_texts(piece.column("text"))
            found = Slice(texts, piece.column("held_out").to_numpy(zero_copy_only=False).astype(bool))
            kept = pa.record_batch(
                [piece.column("doc_id"), piece.column("held_out"), texts], ["doc_id", "held_out", "text"]
            )
            parts.append((kept, (found.grams, found.gram_counts()), found.word_counts()))
            held_bytes += int(offsets_of(texts)[-1] - offsets_of(texts)[0])
            if held_bytes >= chunk_bytes:
                yield from rows()
                number, held_bytes, parts = number + 1, 0, []
        if parts:
            yield from rows()

    return stored(small_batches(docs).mapInArrow(run, CHUNKS))


def _chunk_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    names = ["kind", "chunk", "bucket", "total", "keys", "counts", "blob"]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and their added counts. Rows are unpacked and added up a few at a time,
    so what is held follows the distinct keys and not the number of rows."""
    keys, counts, held, most = [], [], 0, MERGE_KEYS
    for k, c in zip(table.column("keys"), table.column("counts")):
        keys.append(unpacked_keys(k.as_py()))
        counts.append(unpacked(c.as_py(), np.int64))
        held += len(keys[-1])
        if held >= most:
            added = summed(np.concatenate(keys), np.concatenate(counts))
            keys, counts, held = [added[0]], [added[1]], len(added[0])
            most = max(MERGE_KEYS, 2 * held)
    return summed(np.concatenate(keys), np.concatenate(counts))


def _answers(table: pa.Table, kind: int, keys: np.ndarray, values: np.ndarray) -> pa.Table:
    found = [packed(values[np.searchsorted(keys, unpacked_keys(k.as_py()))]) for k in table.column("keys")]
    n = table.num_rows
    return pa.table({
        "chunk": table.column("chunk"), "kind": pa.array([kind] * n, pa.int32()),
        "bucket": table.column("bucket"), "answers": binary_rows(found),
    })


def bucket_count(chunks: float) -> int:
    """Buckets for so many chunks. Both a bucket, which holds keys of all chunks, and the
    number of rows, one per chunk and bucket, grow slower than with a fixed share."""
    return max(128, 1 << math.ceil(math.log2(max(1.0, 16 * math.sqrt(chunks)))))


# --- words ------------------------------------------------------------------------


def _word_answers(table: pa.Table) -> pa.Table:
    """The counts in all chunks; the bucket's distinct training words stand in one row."""
    keys, total = _merged(table)
    distinct = [int((total > 0).sum())] + [0] * (table.num_rows - 1)
    out = _answers(table, WORDS, keys, total).append_column("distinct", pa.array(distinct, pa.int64()))
    del keys, total
    give_back()
    return out


# --- the tree ---------------------------------------------------------------------


class Tree:
    """The nodes from depth 2 to DEPTH for sorted distinct windows whose first two context
    bytes are whole in one place. The levels are made for one bit at a time."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.contexts, self.counts = keys >> np.uint64(8), counts
        self.symbols = (keys & np.uint64(255)).astype(np.int64)
        self.first = (keys >> np.uint64(8 * DEPTH)).astype(np.int64)

    def levels(self, bit: int) -> Iterator[tuple]:
        """From DEPTH up to 2: nodes, the node of each one of the level below (of each window
        at DEPTH), counts, weighted log probability and the share of the node's own estimate."""
        prefix = ((1 << bit) | (self.symbols >> (8 - bit))).astype(np.uint64)
        value = (self.symbols >> (7 - bit)) & 1
        nodes = (self.contexts << np.uint64(8)) | prefix  # in order, as the windows are
        fresh = np.append(True, nodes[1:] != nodes[:-1])[: len(nodes)]
        nodes, place = nodes[fresh], np.cumsum(fresh) - 1
        n1 = np.bincount(place, self.counts * value, len(nodes))
        n0 = np.bincount(place, self.counts * (1 - value), len(nodes))
        weighted = log_kt(n0, n1)
        yield nodes, place, n0, n1, weighted, np.ones(len(nodes))
        for _ in range(DEPTH - 1, 1, -1):
            above = ((nodes >> np.uint64(16)) << np.uint64(8)) | (nodes & np.uint64(255))
            nodes, place = np.unique(above, return_inverse=True)
            n0, n1, added = (np.bincount(place, x, len(nodes)) for x in (n0, n1, weighted))
            weighted, share = mixed(n0, n1, added)
            yield nodes, place, n0, n1, weighted, share

    def upper_sums(self) -> pa.Table:
        """What depth 1 needs: per first byte and prefix the counts and the children's sum."""
        out = np.zeros((3, 256 * 256))
        for bit in range(8):
            for nodes, _, n0, n1, weighted, _ in self.levels(bit):
                pass  # only the last, of depth 2, is used
            at = ((nodes >> np.uint64(16)) << np.uint64(8) | (nodes & np.uint64(255))).astype(np.int64)
            for row, values in zip(out, (n0, n1, weighted)):
                row += np.bincount(at, values, 256 * 256)
        used = np.flatnonzero(out.any(axis=0))
        return pa.table({"node": pa.array(used), **dict(zip(("n0", "n1", "weighted"), map(pa.array, out[:, used])))})

    def log10(self, upper: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """log10 of the probability of each window's last byte after the bytes before it."""
        add, scale = upper
        out = np.zeros(len(self.symbols))
        for bit in range(8):
            chance = where = None
            for _, place, n0, n1, _, share in self.levels(bit):
                where = place if where is None else place[where]
                own = ones(n0, n1)[where]
                chance = own if chance is None else share[where] * own + (1 - share[where]) * chance
            at = self.first * 256 + ((1 << bit) | (self.symbols >> (8 - bit)))
            chance = add[at] + scale[at] * chance
            value = (self.symbols >> (7 - bit)) & 1
            out += np.log10(np.where(value == 1, chance, 1 - chance))
        return out


def upper_nodes(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From the sums (n0, n1, weighted) per first byte and prefix, the numbers a, b such that
    a + b * p is the chance of a one if depth 2 gives it the chance p."""
    n0, n1, children = sums
    weighted, share1 = mixed(n0, n1, children)
    grid = lambda x: x.reshape(256, 256).sum(axis=0)
    _, share0 = mixed(grid(n0), grid(n1), grid(weighted))
    root, share0 = np.tile(ones(grid(n0), grid(n1)), 256), np.tile(share0, 256)
    add = share0 * root + (1 - share0) * share1 * ones(n0, n1)
    return add, (1 - share0) * (1 - share1)


# --- the operator -----------------------------------------------------------------


def score_texts(
    docs: DataFrame, held_out, key: str = "doc_id", text: str = "text",
    buckets: int | None = None, chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes.

    ``held_out`` is a Column over the table: rows for which it is true teach nothing, and
    null counts as false. Tokens are the words and one end. score is log10 of the model's
    probability of the text, so -score / log10(2) / n_bytes is its code length per byte.
    base_score is a unigram word model's. A null or empty text is just its end; null ids
    stay null; repeated rows count each time; columns of other names are left out.
    Results don't depend on ``buckets``, the parts that keys are added up in; by default
    their number follows from the bytes of text.
    """
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
    )
    if buckets is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        buckets = bucket_count(size / chunk_bytes)
    chunks = chunk_rows(rows, buckets, chunk_bytes)
    keys = chunks.select("kind", "chunk", "bucket", "keys", "counts")
    words, grams = keys.where(F.col("kind") == WORDS), keys.where(F.col("kind") == GRAMS)
    tokens = chunks.where(F.col("kind") == WORDS).agg(F.sum("total")).first()[0] or 0
    word_answers = stored(words.groupBy("bucket").applyInArrow(_word_answers, f"{ANSWERS}, distinct long"))
    distinct = word_answers.agg(F.sum("distinct")).first()[0] or 0

    trees = max(1, buckets // BUCKETS_PER_TREE)

    def merge(table: pa.Table) -> pa.Table:
        found, counts = _merged(table)
        own = table.column("bucket")[0].as_py()
        rows = [
            (tree, own, packed_keys(found[at]), packed(counts[at]))
            for tree, at in dealt(GRAMS, found, trees, TREE_DEPTH)
        ]
        del found, counts
        give_back()
        kinds = {"tree": pa.int32(), "bucket": pa.int32(), "keys": pa.binary(), "counts": pa.binary()}
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds.values())], list(kinds))

    merged = stored(grams.groupBy("bucket").applyInArrow(merge, MERGED))

    def upper_sums(table: pa.Table) -> pa.Table:
        out = Tree(*_merged(table)).upper_sums()
        give_back()
        return out

    # depth 1: at most 256 * 255 rows
    sums = np.zeros((3, 256 * 256))
    found = (
        merged.groupBy("tree").applyInArrow(upper_sums, "node long, n0 double, n1 double, weighted double")
        .groupBy("node").agg(*(F.sum(c).alias(c) for c in ("n0", "n1", "weighted"))).toArrow()
    )
    for row, c in zip(sums, ("n0", "n1", "weighted")):
        row[found.column("node").to_numpy()] = found.column(c).to_numpy()
    upper = upper_nodes(sums)

    def values(table: pa.Table) -> pa.Table:
        """Of each row the values of its keys."""
        found, counts = _merged(table)
        scores = Tree(found, counts).log10(upper).astype(np.float32)
        own = [packed(scores[np.searchsorted(found, unpacked_keys(k.as_py()))]) for k in table.column("keys")]
        del found, counts, scores
        give_back()
        return table.select(["bucket", "keys"]).append_column("found", binary_rows(own))

    def gram_answers(left: pa.Table, right: pa.Table) -> pa.Table:
        found = np.concatenate([unpacked_keys(k.as_py()) for k in right.column("keys")])
        scores = np.concatenate([unpacked(v.as_py(), np.float32) for v in right.column("found")])
        order = np.argsort(found, kind="stable")
        out = _answers(left, GRAMS, found[order], scores[order])
        del found, scores, order
        give_back()
        return out

    scored = merged.groupBy("tree").applyInArrow(values, VALUES)
    answers = word_answers.drop("distinct").union(
        grams.groupBy("bucket").cogroup(scored.groupBy("bucket")).applyInArrow(gram_answers, ANSWERS)
    )
    total, denominator = int(tokens), tokens + 0.5 * (distinct + 1)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = _scored(left, right, buckets, total, denominator)
        give_back()
        return out

    texts = chunks.where(F.col("kind") == TEXTS).select("chunk", "blob")
    return texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        run,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double, n_bytes long",
    )


def _scored(left: pa.Table, right: pa.Table, buckets: int, total: int, denominator: float) -> pa.Table:
    out = []
    answers = {
        (kind, bucket): data
        for kind, bucket, data in zip(*(right.column(c).to_pylist() for c in ("kind", "bucket", "answers")))
    }
    for blob in left.column("blob").to_pylist():
        with pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(blob)) as reader:
            batches = list(text_slices(reader))
        slices = [
            Slice(b.column("text"), b.column("held_out").to_numpy(zero_copy_only=False).astype(bool)) for b in batches
        ]
        tables = {}
        for kind, found in ((GRAMS, [s.grams for s in slices]), (WORDS, [s.words for s in slices])):
            keys = np.unique(np.concatenate(found if kind == GRAMS else [*found, [END_KEY]]))
            values = np.zeros(len(keys))
            for bucket, at in dealt(kind, keys, buckets):
                values[at] = unpacked(answers[kind, bucket], np.float32 if kind == GRAMS else np.int64)
            tables[kind] = (keys, values)
        for batch, s in zip(batches, slices):
            keys, values = tables[GRAMS]
            chances = values[np.searchsorted(keys, s.grams)][s.gram_codes]
            score = np.add.reduceat(chances, s.gram_ends[:-1])  # the end byte: no text is empty
            keys, values = tables[WORDS]
            counts = values[np.searchsorted(keys, s.words)]
            end = values[np.searchsorted(keys, END_KEY)]
            base = np.log10((counts + 0.5) / denominator)
            n = np.diff(s.word_ends)
            words = np.add.reduceat(np.append(base[s.word_codes], 0.0), s.word_ends[:-1]) * (n > 0)
            known = np.concatenate(([0], np.cumsum(counts[s.word_codes] > 0)))
            out.append(pa.table({
                "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                "n_tokens": pa.array(n + 1, pa.int64()),
                "n_known": pa.array(known[s.word_ends[1:]] - known[s.word_ends[:-1]] + int(end > 0), pa.int64()),
                "train_tokens": pa.array(np.full(len(n), total), pa.int64()),
                "base_score": pa.array(words + np.log10((end + 0.5) / denominator)),
                "score": pa.array(score), "n_bytes": pa.array(np.diff(s.gram_ends), pa.int64()),
            }))
    return pa.concat_tables(out)
