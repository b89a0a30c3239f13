"""Hard negatives by anchor clusters that share one candidate list, with exact results.

Anchors are clustered by direction. In a block of candidates each cluster sorts them once by
an upper bound on their inner product with any member, ``|i| * cos(max(0, a - r))``, where
``a`` is the candidate's angle to the cluster's centre and ``r`` the largest angle of a
member to it. Every member walks that list and stops where the bound certifies that nothing
further on can enter its result: a certificate, so nothing is lost. Blocks hold a bounded
number of rows; anchors are dealt to every block and stream through it, cluster by cluster,
so a cluster that holds a third of all anchors costs time but no memory.

Two walks are made: the best rows of the anchor's own label are its positives, and their
scores set the bands in which the second walk looks for rows of other labels.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rowmill.functions import stored
from rowmill.llm.common import give_back, small_batches

#: Rows of a block of candidates, at most on average.
BLOCK_ROWS = 50_000
#: Blocks that a small table is dealt to have at least so many rows on average.
LEAST_ROWS = 2_000
#: Anchors that the centres are fitted on, at most: those with the smallest hashes.
FIT_ANCHORS = 4_096
#: Anchors of a cluster on average, as far as MAX_CLUSTERS allows.
CLUSTER_ANCHORS = 64
MAX_CLUSTERS = 256
#: Members of a cluster that walk at a time.
CHUNK = 256
#: Candidates of the first step of a walk; each step doubles, to the second number at most.
STEP, LAST_STEP = 1_024, 16_384
#: What rounding may take from a bound, in units of the product of both lengths.
SLACK = 1e-6
#: Integers are exact in double precision below this.
EXACT = float(1 << 53)

ROWS = "row long, vec_id long, label int, v array<long>"


def integer_vectors(
    table: DataFrame, scale: int = 256, key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """(vec_id, label, v) with components floor(scale * x), x as double.

    Rows with a null label, a null vector, or any null or non-finite component are left out;
    an empty vector is one of length 0.
    """
    whole = F.forall(
        F.col(vector),
        lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != F.lit(float("inf"))),
    )
    return table.where(F.col(label).isNotNull() & F.col(vector).isNotNull() & whole).select(
        F.col(key).cast("long").alias("vec_id"),
        F.col(label).cast("int").alias("label"),
        F.transform(F.col(vector), lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")).alias("v"),
    )


def matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of integers; shorter vectors end in zeros."""
    lists = [vectors] if isinstance(vectors, pa.Array) else vectors.chunks
    parts = []
    for part in lists:
        lengths = np.diff(part.offsets.to_numpy())
        flat, width = part.flatten().to_numpy(zero_copy_only=False), int(lengths.max(initial=0))
        if len(lengths) * width == len(flat):
            parts.append(flat.reshape(len(lengths), width))
        else:
            out = np.zeros((len(lengths), width), np.int64)
            out[np.arange(width) < lengths[:, None]] = flat
            parts.append(out)
    return stacked(parts)


def stacked(parts: list[np.ndarray]) -> np.ndarray:
    width = max((p.shape[1] for p in parts), default=0)
    return np.concatenate([widened(p, width) for p in parts]) if parts else np.zeros((0, 0), np.int64)


def widened(rows: np.ndarray, width: int) -> np.ndarray:
    short = width - rows.shape[1]
    return np.pad(rows, ((0, 0), (0, short))) if short > 0 else rows


def lengths_of(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows.astype(np.float64) ** 2).sum(axis=1))


def angles(rows: np.ndarray, lengths: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Angles to a centre of length 1; 0 for rows of length 0."""
    width = max(rows.shape[1], len(centre))
    dots = widened(rows, width).astype(np.float64) @ np.pad(centre, (0, width - len(centre)))
    return np.arccos(np.clip(np.divide(dots, lengths, out=np.ones(len(rows)), where=lengths > 0), -1, 1))


def products(rows: np.ndarray, members: np.ndarray, largest: float) -> np.ndarray:
    """Inner products as 64-bit integers. ``largest`` bounds them; where double precision
    isn't exact, Python's integers are used, and a product beyond 64 bits raises."""
    width = max(rows.shape[1], members.shape[1])
    rows, members = widened(rows, width), widened(members, width)
    if largest < EXACT:
        return (rows.astype(np.float64) @ members.astype(np.float64).T).astype(np.int64)
    exact = rows.astype(object) @ members.astype(object).T if width else np.zeros((len(rows), len(members)), object)
    if exact.size and max(abs(exact.min()), abs(exact.max())) >= 1 << 63:
        raise ValueError("an inner product needs more than 64 bits")
    return exact.astype(np.int64)


def centres_of(anchors: DataFrame, n_anchors: int, turns: int = 8) -> np.ndarray:
    """Centres of length 1 by spherical k-means over at most FIT_ANCHORS anchors. They decide
    how soon a walk ends, not what it finds."""
    sample = anchors.orderBy(F.xxhash64("row"), "row").limit(FIT_ANCHORS).select("v").toArrow()
    rows = matrix(sample.column("v")).astype(np.float64)
    lengths = lengths_of(rows)
    rows = rows[lengths > 0] / lengths[lengths > 0, None]
    wanted = min(MAX_CLUSTERS, max(1, n_anchors // CLUSTER_ANCHORS), max(1, len(rows)))
    centres = np.unique(rows, axis=0)[:wanted] if len(rows) else np.zeros((1, rows.shape[1]))
    for _ in range(turns if len(rows) else 0):
        own = np.argmax(rows @ centres.T, axis=1)
        for k in range(len(centres)):
            total = rows[own == k].sum(axis=0)
            size = np.sqrt((total**2).sum())
            if size > 0:
                centres[k] = total / size
    return centres


def clustered(anchors: DataFrame, centres: np.ndarray) -> DataFrame:
    """Stored (row, vec_id, label, v, cluster, angle): the centre nearest by angle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = matrix(batch.column("v"))
            lengths = lengths_of(rows)
            every = np.stack([angles(rows, lengths, c) for c in centres], axis=1)
            own = every.argmin(axis=1) if len(rows) else np.zeros(0, np.int64)
            yield pa.record_batch(
                [*(batch.column(c) for c in ("row", "vec_id", "label", "v")),
                 pa.array(own.astype(np.int32)), pa.array(every[np.arange(len(rows)), own])],
                ["row", "vec_id", "label", "v", "cluster", "angle"],
            )

    return stored(small_batches(anchors).mapInArrow(run, ROWS + ", cluster int, angle double"))


class Block:
    """Candidates of a block, and the list of the cluster that walks it."""

    def __init__(self, row: np.ndarray, vec_id: np.ndarray, known: np.ndarray, label: np.ndarray, v: np.ndarray):
        order = np.lexsort((row, vec_id, ~known))  # ties go to the smaller id, nulls last
        self.row, self.vec_id, self.known = row[order], vec_id[order], known[order]
        self.label, self.v = label[order], v[order]
        self.lengths = lengths_of(self.v)
        self.longest = float(self.lengths.max(initial=0.0))

    def sort_for(self, centre: np.ndarray, reach: float) -> None:
        """The list of a cluster: candidates by descending bound for members of length 1."""
        apart = np.maximum(0.0, angles(self.v, self.lengths, centre) - reach)
        bound = self.lengths * (np.cos(apart) + SLACK)
        self.order = np.argsort(-bound, kind="stable")
        self.bound = bound[self.order]

    def walk(self, members: np.ndarray, lengths: np.ndarray, take: Callable, done: Callable) -> None:
        """Score the list in steps for members that go on. ``take(j, places, scores)`` gets
        the candidates of a step for member j; ``done(j, bound)`` tells whether scores of
        ``bound`` at most can't change its result."""
        at, step, going = 0, STEP, np.arange(len(members))
        while at < len(self.order) and len(going):
            going = np.array([j for j in going if not done(j, self.bound[at] * lengths[j])], np.int64)
            places = self.order[at : at + step]
            scores = products(self.v[places], members[going], self.longest * float(lengths[going].max(initial=0.0)))
            for column, j in enumerate(going.tolist()):
                take(j, places, scores[:, column])
            at, step = at + step, min(2 * step, LAST_STEP)


class Best:
    """The k best (score, place): higher scores first, then smaller places."""

    def __init__(self, k: int):
        self.k, self.scores, self.places = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, places: np.ndarray) -> None:
        if len(self.scores) == self.k:
            fit = scores >= self.scores[-1]
            scores, places = scores[fit], places[fit]
        if not len(scores):
            return
        if len(scores) > 4 * self.k:
            fit = scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            scores, places = scores[fit], places[fit]
        scores, places = np.append(self.scores, scores), np.append(self.places, places)
        order = np.lexsort((places, -scores))[: self.k]
        self.scores, self.places = scores[order], places[order]

    def closed(self, bound: float) -> bool:
        """Scores of ``bound`` at most can't enter, ties included."""
        return len(self.scores) == self.k and bound < self.scores[-1]


def positive_walk(block: Block, anchors: dict, k: int) -> Iterator[tuple[int, int, Best]]:
    """(member, 0, its best rows of its own label), the anchor itself left out."""
    best = [Best(k) for _ in anchors["row"]]

    def take(j: int, places: np.ndarray, scores: np.ndarray) -> None:
        fit = (block.label[places] == anchors["label"][j]) & (block.row[places] != anchors["row"][j])
        best[j].add(scores[fit], places[fit])

    block.walk(anchors["v"], anchors["lengths"], take, lambda j, bound: best[j].closed(bound))
    return ((j, 0, b) for j, b in enumerate(best))


def negative_walk(block: Block, anchors: dict, k: int, low: int, high: int) -> Iterator[tuple[int, int, Best]]:
    """(member, number of the band, its best rows of other labels in the band): a band per
    distinct score of the member's positives."""
    bands = []
    for scores in anchors["scores"]:
        # low * score <= 100 * negative <= high * score, in whole numbers
        own = [(n, -(-low * s // 100), high * s // 100, Best(k)) for n, s in enumerate(scores)]
        bands.append([b for b in own if b[1] <= b[2]])

    def take(j: int, places: np.ndarray, scores: np.ndarray) -> None:
        if bands[j]:
            fit = (block.label[places] != anchors["label"][j]) & (scores >= min(b[1] for b in bands[j]))
            scores, places = scores[fit], places[fit]
            for _, least, most, best in bands[j]:
                fit = (scores >= least) & (scores <= most)
                best.add(scores[fit], places[fit])

    def done(j: int, bound: float) -> bool:
        return all(bound < least or best.closed(bound) for _, least, _, best in bands[j])

    block.walk(anchors["v"], anchors["lengths"], take, done)
    return ((j, n, best) for j, own in enumerate(bands) for n, _, _, best in own)


def walked(
    rows: DataFrame, anchors: DataFrame, centres: np.ndarray, reach: dict[int, float], blocks: int, search: Callable
) -> DataFrame:
    """(anchor, band, row, vec_id, score): what ``search`` finds for each anchor in each block.
    One shuffle: every candidate to its block, every anchor to all blocks."""
    nothing = F.array().cast("array<long>")
    scores = F.col("scores") if "scores" in anchors.columns else nothing.alias("scores")
    own = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    candidates = rows.select(own.alias("block"), F.lit(-1).alias("cluster"), "row", "vec_id", "label", "v", nothing.alias("scores"))
    dealt = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "cluster", "row", "vec_id", "label", "v", scores
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, block, listed = None, [], None, None
        for batch in batches:
            number, cluster = (batch.column(c).to_numpy() for c in ("block", "cluster"))
            cuts = np.flatnonzero((np.diff(number) != 0) | (np.diff(cluster) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(number)]):
                if b == a:
                    continue
                if number[a] != at:
                    at, held, block, listed = number[a], [], None, None
                if cluster[a] < 0:
                    held.append(columns(batch.slice(a, b - a)))
                    continue
                if block is None:
                    names = ("row", "vec_id", "known", "label")
                    block = Block(*(joined([h[c] for h in held]) for c in names), stacked([h["v"] for h in held]))
                    held = []
                if cluster[a] != listed:
                    listed = cluster[a]
                    block.sort_for(centres[listed], reach[int(listed)])
                for c in range(a, b, CHUNK):
                    part = batch.slice(c, min(CHUNK, b - c))
                    members = columns(part) | {"scores": part.column("scores").to_pylist()}
                    members["lengths"] = lengths_of(members["v"])
                    found = [x for x in search(block, members) if len(x[2].scores)]
                    if found:
                        yield results(block, members["row"], found)
        give_back()

    together = small_batches(candidates.unionByName(dealt)).repartition(blocks, "block")
    return together.sortWithinPartitions("block", "cluster", "row").mapInArrow(
        run, "anchor long, band int, row long, vec_id long, score long"
    )


def columns(batch: pa.RecordBatch) -> dict:
    ids = batch.column("vec_id")
    return {
        "row": batch.column("row").to_numpy(), "vec_id": ids.fill_null(0).to_numpy(),
        "known": ids.is_valid().to_numpy(zero_copy_only=False),
        "label": batch.column("label").to_numpy(), "v": matrix(batch.column("v")),
    }


def joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def results(block: Block, anchors: np.ndarray, found: list[tuple[int, int, Best]]) -> pa.RecordBatch:
    sizes = [len(b.scores) for _, _, b in found]
    places = np.concatenate([b.places for _, _, b in found])
    ids = pa.array(block.vec_id[places], pa.int64(), mask=~block.known[places])
    return pa.record_batch(
        [
            pa.array(np.repeat(anchors[[j for j, _, _ in found]], sizes)),
            pa.array(np.repeat([n for _, n, _ in found], sizes).astype(np.int32)),
            pa.array(block.row[places]), ids, pa.array(np.concatenate([b.scores for _, _, b in found])),
        ],
        ["anchor", "band", "row", "vec_id", "score"],
    )


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The best k of each anchor and band over all blocks; a block gives k rows at most."""
    best = Window.partitionBy("anchor", "band").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column | str, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` has (vec_id, label, v) with integer components, as ``integer_vectors`` makes
    them; other columns are left out. For each anchor the ``n_positives`` other rows of its
    label with the highest inner products are its positives; for each of them the
    ``n_negatives`` best rows of another label whose score is between ``low`` and ``high``
    percent of the positive's. Ties go to the smaller id, null ids last. Every row counts for
    itself, also where rows share an id or have none; where vectors differ in length the
    shorter ones end in zeros. An anchor without positives or negatives has no rows, an empty
    table gives none. An inner product beyond 64 bits fails the query.
    """
    rows = stored(vectors.select("vec_id", "label", "v").withColumn("row", F.monotonically_increasing_id()))
    anchors = rows.where(is_anchor)
    n, n_anchors = rows.count(), anchors.count()
    tasks = vectors.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, -(-n // block_rows), min(2 * tasks, n // LEAST_ROWS))
    centres = centres_of(anchors, n_anchors)
    anchors = clustered(anchors, centres)
    # a row per cluster, of which there are MAX_CLUSTERS at most
    reach = {r["cluster"]: r["reach"] for r in anchors.groupBy("cluster").agg(F.max("angle").alias("reach")).collect()}

    def positives(block: Block, members: dict) -> Iterator:
        return positive_walk(block, members, n_positives)

    def negatives(block: Block, members: dict) -> Iterator:
        return negative_walk(block, members, n_negatives, low, high)

    found = walked(rows, anchors, centres, reach, blocks, positives)
    best = stored(ranked(found, n_positives).select("anchor", "rank", F.col("vec_id").alias("positive_id"), "score"))
    scores = best.groupBy(F.col("anchor").alias("row")).agg(F.sort_array(F.collect_set("score")).alias("scores"))
    banded = anchors.join(scores, "row")
    chosen = ranked(walked(rows, banded, centres, reach, blocks, negatives), n_negatives)
    wanted = best.join(scores.withColumnRenamed("row", "anchor"), "anchor").withColumn(
        "band", (F.array_position("scores", F.col("score")) - 1).cast("int")
    )
    named = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return (
        wanted.select("anchor", "band", "positive_id", F.col("score").alias("positive_score"))
        .join(chosen.select("anchor", "band", "rank", F.col("vec_id").alias("negative_id"),
                            F.col("score").alias("negative_score")), ["anchor", "band"])
        .join(named, "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
