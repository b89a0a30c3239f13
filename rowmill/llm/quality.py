"""Quality rules: counts per text, and a logistic regression over hashed n-grams.

Features of a text are the shares of its hashed single words, word pairs and byte
trigrams. The regression and the scaling of its scores to probabilities are fitted with
Spark's ML library on a bounded sample of the labelled rows; every whole text is then
scored in Arrow batches and compared with fixed thresholds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame, functions as F

from rowmill.functions import stored
from rowmill.llm.common import (
    SLICE_BYTES, filled, hash_words, keyed_texts, mix, offsets_of, rolled, small_batches, split_words, sums, text_slices,
)

#: Hash buckets of word features, and as many of byte features.
BUCKETS = 1 << 15
#: Labelled rows that the regression is fitted on at most; a quarter of them calibrates it.
MAX_LABELLED = 6_000
#: Fixed thresholds.
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8
MIN_PROBABILITY = 0.5

#: Stands for every pair of two equal words.
EQUAL_PAIR = mix(np.array([2], np.uint64))[0]

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Model:
    """Weights per bucket; ``slope`` and ``shift`` turn a score into log odds."""

    weights: np.ndarray
    intercept: float
    slope: float
    shift: float

    def probability(self, scores: np.ndarray) -> np.ndarray:
        odds = self.slope * (scores + self.intercept) + self.shift
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


class Texts:
    """The words, bytes and lines of a slice, and what is counted over them."""

    def __init__(self, texts: pa.Array):
        self.texts = filled(texts)
        self.word_ends, self.flat = split_words(self.texts)
        coded = self.flat.dictionary_encode()
        self.codes, self.words = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
        self.hashes = mix(hash_words(self.words))[self.codes] if len(self.words) else np.zeros(0, np.uint64)
        ends = offsets_of(self.texts)
        self.byte_ends = ends - ends[0]
        data = self.texts.buffers()[2]
        self.data = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data else np.zeros(0, np.uint8)

    def counts(self) -> dict[str, np.ndarray]:
        lengths = pc.utf8_length(self.flat).to_numpy(zero_copy_only=False).astype(np.int64)
        return {
            "n_words": np.diff(self.word_ends),
            "word_chars": sums(lengths, self.word_ends),
            "n_symbols": sums(SYMBOLS[self.data], self.byte_ends),
            "n_dup_lines": self._dup_lines(),
            "n_repeat_words": self._repeat_words(),
        }

    def _dup_lines(self) -> np.ndarray:
        lists = pc.split_pattern(self.texts, "\n")
        lines, ends = lists.flatten(), offsets_of(lists)
        owner = np.repeat(np.arange(len(self.texts)), np.diff(ends))
        full = pc.binary_length(pc.ascii_trim_whitespace(lines)).to_numpy(zero_copy_only=False) > 0
        coded = lines.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        distinct = np.unique(owner[full] * max(1, len(coded.dictionary)) + codes[full])
        n = len(self.texts)
        once = np.bincount(distinct // max(1, len(coded.dictionary)), minlength=n)
        return np.bincount(owner[full], minlength=n) - once

    def _repeat_words(self) -> np.ndarray:
        n, width = len(self.hashes), REPEAT_WINDOW
        keys = rolled(self.hashes, width)
        if not len(keys):
            return np.zeros(len(self.texts), np.int64)
        owner = np.repeat(np.arange(len(self.texts)), np.diff(self.word_ends))
        inside = np.flatnonzero(owner[: len(keys)] == owner[width - 1 :])
        keys = keys[inside] ^ mix(owner[inside].astype(np.uint64) + np.uint64(1))
        ordered = np.sort(keys)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        marked = np.zeros(n + 1, np.int64)
        if len(twice):
            at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
            starts = inside[twice[at] == keys]
            np.add.at(marked, starts, 1)
            np.add.at(marked, starts + width, -1)
        return sums(np.cumsum(marked[:-1]) > 0, self.word_ends)

    def features(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each family: bucket of every n-gram, and offsets per text. A text's n-grams
        are those that lie whole inside it."""
        mask, high = np.uint64(BUCKETS - 1), np.uint64(40)
        single = ((self.hashes >> high) & mask).astype(np.int64)
        pairs = rolled(self.hashes, 2)
        pairs[self.hashes[1:] == self.hashes[:-1]] = EQUAL_PAIR
        pairs = ((pairs >> high) & mask).astype(np.int64)
        d = self.data.astype(np.uint64)
        grams = (d[:-2] << np.uint64(16)) | (d[1:-1] << np.uint64(8)) | d[2:] if len(d) > 2 else d[:0]
        chars = (((grams * np.uint64(0x9E3779B97F4A7C15)) >> high) & mask).astype(np.int64) + BUCKETS
        return [(single, self.word_ends, 1), (pairs, self.word_ends, 2), (chars, self.byte_ends, 3)]

    def scores(self, weights: np.ndarray) -> np.ndarray:
        total = np.zeros(len(self.texts))
        for buckets, ends, width in self.features():
            run = np.concatenate(([0.0], np.cumsum(weights[buckets])))
            start = np.minimum(ends[:-1], len(buckets))
            stop = np.minimum(np.maximum(ends[:-1], ends[1:] - width + 1), len(buckets))
            total += (run[stop] - run[start]) / np.maximum(1, stop - start)
        return total

    def vectors(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Of each text: its buckets in order, and their shares."""
        families = self.features()
        for i in range(len(self.texts)):
            found, values = [], []
            for buckets, ends, width in families:
                own = buckets[ends[i] : max(ends[i], ends[i + 1] - width + 1)]
                found.append(own)
                values.append(np.full(len(own), 1 / max(1, len(own))))
            ids, place = np.unique(np.concatenate(found), return_inverse=True)
            yield ids.astype(np.int32), np.bincount(place, np.concatenate(values), len(ids))


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
    label: str = "quality", max_labelled: int = MAX_LABELLED, seed: int = 7,
) -> Model | None:
    """The model of label 1 against 0, or None where the sample lacks one of the two.

    At most ``max_labelled`` labelled ids, the first by a hash, are looked up in the
    table; labels that are null or neither 0 nor 1 don't count, nor do ids without a row.
    Of rows that share an id one is used.
    """
    chosen = (
        labels.select(F.col(key).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where("doc_id IS NOT NULL AND label IN (0, 1)")
        .groupBy("doc_id").agg(F.max("label").alias("label"))
        .withColumn("place", F.xxhash64("doc_id", F.lit(seed)))
        .orderBy("place").limit(max_labelled)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, max_bytes=SLICE_BYTES // 2):
            ids, values = zip(*Texts(part.column("text")).vectors())
            yield pa.record_batch(
                [
                    part.column("doc_id"), part.column("label"), part.column("place"),
                    pa.array(ids, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float64())),
                ],
                ["doc_id", "label", "place", "ids", "shares"],
            )

    # the hint is safe: the sample has at most max_labelled rows of three numbers
    found = keyed_texts(docs, key, text).join(F.broadcast(chosen), "doc_id")
    sample = stored(
        found.mapInArrow(run, "doc_id long, label int, place long, ids array<int>, shares array<double>")
        .dropDuplicates(["doc_id"])
    )
    folds = {
        (r["label"], r["held"]): r["n"]
        for r in sample.groupBy("label", (F.col("place") % 4 == 0).alias("held"))
        .agg(F.count(F.lit(1)).alias("n")).collect()
    }
    if not all(folds.get((k, False)) for k in (0, 1)):
        return None
    size = 2 * BUCKETS
    sparse = F.udf(lambda ids, shares: Vectors.sparse(size, ids, shares), VectorUDT())
    rows = sample.select(
        F.col("label").cast("double").alias("label"), sparse("ids", "shares").alias("features"),
        (F.col("place") % 4 == 0).alias("held"),
    )
    # as many partitions whatever the session's settings, so that sums repeat
    trained = LogisticRegression(regParam=1e-3, maxIter=40).fit(rows.where("NOT held").coalesce(8))
    weights, intercept = trained.coefficients.toArray(), float(trained.intercept)
    if not all(folds.get((k, True)) for k in (0, 1)):
        return Model(weights, intercept, 1.0, 0.0)
    score = F.udf(
        lambda ids, shares: Vectors.dense([float(weights[ids] @ np.array(shares)) + intercept]), VectorUDT()
    )
    held = sample.where(F.col("place") % 4 == 0).select(
        F.col("label").cast("double").alias("label"), score("ids", "shares").alias("features")
    )
    scaled = LogisticRegression(regParam=1e-4, maxIter=40).fit(held.coalesce(4))
    return Model(weights, intercept, float(scaled.coefficients[0]), float(scaled.intercept))


def assess(texts: pa.Array, model: Model | None, min_probability: float) -> dict[str, np.ndarray]:
    """The counts of ``COUNTS``, base_failed, probability and kept of each text."""
    found = Texts(texts)
    out = found.counts()
    n = out["n_words"]
    out["base_failed"] = (n < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * n)
    out["probability"] = model.probability(found.scores(model.weights)) if model else np.ones(len(n))
    out["kept"] = ~out["base_failed"] & (out["probability"] >= min_probability)
    return out


def quality(
    docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text",
    min_probability: float = MIN_PROBABILITY,
) -> DataFrame:
    """Per row: doc_id, the counts, base_failed, kept and the probability of good quality.

    Without a model only the base rules decide. A null or empty text has no words and
    fails; a null id stays null; repeated rows give repeated results; columns of other
    names are left out. No shuffle.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    names = [*COUNTS, "base_failed", "kept", "probability"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, max_bytes=SLICE_BYTES // 2):
            found = assess(part.column("text"), held.value, min_probability)
            yield pa.record_batch(
                [part.column("doc_id"), *(pa.array(found[c]) for c in names)], ["doc_id", *names]
            )

    schema = ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS)])
    return keyed_texts(docs, key, text).mapInArrow(
        run, f"{schema}, base_failed boolean, kept boolean, probability double"
    )


def keep_good(
    docs: DataFrame, model: Model | None, text: str = "text", min_probability: float = MIN_PROBABILITY
) -> DataFrame:
    """The rows, all columns as they are, whose text the rules and the model keep."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, text, SLICE_BYTES // 2):
            yield part.filter(pa.array(assess(part.column(text), held.value, min_probability)["kept"]))

    return small_batches(docs).mapInArrow(run, docs.schema)
