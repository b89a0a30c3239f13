"""Near-duplicate documents by SetSketch.

Each shingle set becomes ``REGISTERS`` registers: the smallest of exponentially spaced
hash values of its members, on a logarithmic scale cut to 16 bits. Registers of a union
are the larger registers, and equal registers are about as frequent as common shingles.
Groups of ``ROWS`` registers are bands; documents that share a band are candidates.
Candidates go on if the joint likelihood of their registers doesn't rule the wanted
similarity out, and are then confirmed on their full shingle sets.

Documents with equal sets are one class from the start. In a band, every class is first
compared with the band's smallest one. Only classes that this leaves in different
components are then compared among themselves, in blocks inside tasks, and only links
that connect something leave a task, so no stage makes all pairs of a group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from rowmill.functions import stored
from rowmill.llm.common import binary_rows, hash_words, keyed_texts, mix, text_slices, word_codes

#: 32 bands of 4: a pair at similarity 0.8 shares none with a probability of 5e-8.
ROWS = 4
BANDS = 32
REGISTERS = ROWS * BANDS
#: Base of the scale, rate of the exponential values, largest register.
BASE = 1.001
RATE = 20.0
TOP = (1 << 16) - 1
#: Bounds of a block of classes that are compared among themselves.
BLOCK_ROWS = 2000
BLOCK_SHINGLES = 1_000_000
#: Candidates stay unless their likeliest similarity beats the wanted one by this log ratio.
MAX_LOG_RATIO = 16.0

SEEDS = mix(np.arange(1, REGISTERS + 1, dtype=np.uint64)) | np.uint64(1)


def shingles(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text: (offsets, hashes, words per text).

    Words are lower-cased in A-Z and stand between ASCII white space. A text with fewer
    words than ``width`` has its whole sequence as one shingle; without words none.
    """
    ends, codes, words = word_codes(texts, lower=True)
    values = mix(hash_words(words))[codes] if len(words) else np.zeros(0, np.uint64)
    counts = np.diff(ends)
    sizes = np.where(counts == 0, 0, np.maximum(1, counts - width + 1))
    owner = np.repeat(np.arange(len(counts)), sizes)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    first = ends[:-1][owner] + np.arange(len(owner)) - starts[owner]
    last = ends[1:][owner]
    out = np.zeros(len(owner), np.uint64)
    for i in range(width):
        at = first + i
        inside = at < last
        value = values[np.minimum(at, max(0, len(values) - 1))] if len(values) else out
        out = np.where(inside, out * np.uint64(0x9E3779B97F4A7C15) + value, out)
    out = mix(out)
    order = np.argsort(out)
    by_text = owner[order].astype(np.uint16 if len(counts) < 1 << 16 else np.int64)
    order = order[np.argsort(by_text, kind="stable")]
    out, owner = out[order], owner[order]
    fresh = np.ones(len(out), bool)
    fresh[1:] = (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])
    out, owner = out[fresh], owner[fresh]
    return np.searchsorted(owner, np.arange(len(counts) + 1)), out, counts


def registers(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The registers of each set, one row per set; an empty set has zeros."""
    full = np.flatnonzero(np.diff(ends))
    out = np.zeros((len(ends) - 1, REGISTERS), np.uint16)
    if not len(full):
        return out
    scale, starts = math.log(BASE), ends[full]
    value = np.empty_like(hashes)
    for i, seed in enumerate(SEEDS):
        np.bitwise_xor(hashes, mix(seed[None])[0], out=value)
        value *= seed
        least = (np.minimum.reduceat(value, starts) >> np.uint64(11)).astype(np.float64)
        minima = -np.log1p(-(least + 0.5) / 2.0**53) / RATE
        out[full, i] = np.clip(np.floor(1 - np.log(minima) / scale), 0, TOP).astype(np.uint16)
    return out


def likelihood_ratio(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, wanted: float) -> np.ndarray:
    """By how much the log likelihood of the likeliest Jaccard similarity below ``wanted``
    exceeds that of ``wanted``; 0 where the registers point to ``wanted`` or more.

    Given the set sizes, a register of one set is above, below or equal to the other's with
    probabilities that depend on the similarity alone.
    """
    above = (a > b).sum(axis=1)
    below = (a < b).sum(axis=1)
    equal = a.shape[1] - above - below
    u, v = na / (na + nb), nb / (na + nb)
    scale = (BASE - 1) / BASE

    def log_likelihood(j: np.ndarray) -> np.ndarray:
        def chance(x: np.ndarray) -> np.ndarray:
            return -np.log1p(-np.clip(x, 1e-12, 1) * scale) / math.log(BASE)

        up, down = chance(u - v * j), chance(v - u * j)
        same = np.maximum(1 - up - down, 1e-12)
        return above * np.log(up) + below * np.log(down) + equal * np.log(same)

    # a similarity can't exceed the ratio of the sizes
    limit = np.minimum(u / v, v / u)
    at_wanted = log_likelihood(np.minimum(wanted, limit))
    best = np.max([log_likelihood(np.minimum(j, limit)) for j in np.linspace(0.0, wanted, 33)], axis=0)
    return np.where(limit < wanted - 1e-9, np.inf, best - at_wanted)


def sketches(docs: DataFrame, width: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, set_id, registers): set_id is a 128-bit digest of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            ends, hashes, _ = shingles(part.column("text"), width)
            found, bounds = registers(hashes, ends), ends.tolist()
            names = [xxhash.xxh3_128_digest(hashes[a:b].tobytes()) for a, b in zip(bounds, bounds[1:])]
            yield pa.record_batch(
                [
                    part.column("doc_id"), pa.array(np.diff(ends), pa.int64()), binary_rows(names),
                    binary_rows([r.tobytes() for r in found]),
                ],
                ["doc_id", "n_shingles", "set_id", "registers"],
            )

    return keyed_texts(docs, key, text).mapInArrow(
        run, "doc_id long, n_shingles long, set_id binary, registers binary"
    )


def bands_of(classes: DataFrame) -> DataFrame:
    """(band, node): a key for each band of each class."""
    size = 2 * ROWS
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda i: F.xxhash64(i, F.substring("registers", i * size + 1, F.lit(size))),
    )
    return classes.select(F.explode(keys).alias("band"), "node")


def estimated(pairs: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose registers don't rule the similarity out."""
    side = classes.select("node", "n_shingles", "registers")

    def of(name: str) -> DataFrame:
        return side.select(*[F.col(c).alias(c if c == "node" else f"{c}_{name}") for c in side.columns])

    both = (
        pairs.join(of("a").withColumnRenamed("node", "a"), "a")
        .join(of("b").withColumnRenamed("node", "b"), "b")
        .where(F.least("n_shingles_a", "n_shingles_b") * 1.0 >= F.greatest("n_shingles_a", "n_shingles_b") * (similarity - 1e-9))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (
                    np.frombuffer(b"".join(batch.column(f"registers_{s}").to_pylist()), np.uint16).reshape(-1, REGISTERS)
                    for s in "ab"
                )
                na, nb = (batch.column(f"n_shingles_{s}").to_numpy().astype(float) for s in "ab")
                good = likelihood_ratio(a, b, na, nb, similarity) <= MAX_LOG_RATIO
                yield batch.select(["a", "b"]).filter(pa.array(good))

    return both.mapInArrow(run, "a long, b long")


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union of the full sets.

    ``texts`` has (node, text). The join leaves pairs sorted by ``a``, so the set of a class
    that many pairs share is made once in a row.
    """
    both = (
        pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        .join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        .select("a", "b", "text_a", "text_b", F.xxhash64("text_a").alias("mark"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, held = None, np.zeros(0, np.uint64)
        for part in text_slices(batches, "text_b"):
            a = list(zip(part.column("a").to_pylist(), part.column("mark").to_pylist()))
            fresh = [i for i in range(len(a)) if a[i] != (a[i - 1] if i else node)]
            ends_a, own, _ = shingles(part.column("text_a").take(pa.array(fresh, pa.int64())), width)
            ends, hashes, _ = shingles(part.column("text_b"), width)
            good, at = [], -1
            for i in range(len(a)):
                if at + 1 < len(fresh) and fresh[at + 1] == i:
                    at += 1
                    node, held = a[i], own[ends_a[at] : ends_a[at + 1]]
                other = hashes[ends[i] : ends[i + 1]]
                place = np.minimum(np.searchsorted(held, other), max(0, len(held) - 1))
                common = int((held[place] == other).sum()) if len(held) else 0
                good.append(100 * common >= percent * (len(held) + len(other) - common) and common > 0)
            yield part.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that the links (a, b) reach.

    Links turn into stars round the smallest nodes by alternating two steps until nothing
    changes; every round is stored, so a lost executor costs a re-read.
    """
    stars = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    mark = None
    while True:
        both = stars.union(stars.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = stored(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v"), F.col("m"))
        stars = stored(
            small.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
            .union(least.select("u", "m")).distinct()
        )
        now = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % F.lit(1 << 31))).first()
        if now == mark:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark = now


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept and class_id.

    Documents are linked if 100 * intersection >= percent * union of their shingle sets,
    confirmed on the whole texts. component_id is the smallest id reachable, itself
    included, and class_id the smallest id with the same set. A text without words is
    linked with nothing. Rows that share an id are judged by their own texts; if an id
    stands for several sets, what it is linked with is one component. A null id takes
    no part: its component is null and it is kept. Other columns are left out.
    """
    found = stored(sketches(docs, width, key, text))
    classes = stored(
        found.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("set_id")
        .agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers"))
    )
    links = _links(classes, keyed_texts(docs, key, text), width, percent)
    reached = components(links)
    named = (
        classes.select("set_id", F.col("node").alias("class_id"))
        .join(reached.withColumnRenamed("node", "class_id"), "class_id", "left")
        .select("set_id", "class_id", F.coalesce("component", "class_id").alias("component"))
    )
    joined = found.select("doc_id", "n_shingles", "set_id").join(stored(named), "set_id", "left")
    alone = "n_shingles = 0 OR doc_id IS NULL"
    return joined.select(
        "doc_id", "n_shingles",
        F.when(F.expr(alone), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
        F.when(F.expr(alone), F.lit(True)).otherwise(F.col("component") == F.col("doc_id")).alias("kept"),
        F.when(F.expr(alone), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
    )


def _links(classes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) between classes that connect all that are similar."""
    bands = bands_of(classes)
    leaders = stored(
        bands.groupBy("band").agg(F.min("node").alias("leader"), F.max("node").alias("last"))
        .where("leader < last").select("band", "leader")
    )
    members = stored(bands.join(leaders, "band"))
    # whole texts of the classes that share a band. The keys grow with the corpus, so the
    # join merges at every size and texts are shuffled this once
    nodes = members.select(F.col("node").alias("doc_id")).distinct()
    chosen = stored(texts.join(nodes.hint("merge"), "doc_id").select(F.col("doc_id").alias("node"), "text"))
    stars = members.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    good = stored(confirmed(estimated(stars, classes, percent / 100), chosen, width, percent))

    # classes of a band that the stars leave apart are compared among themselves
    apart = (
        members.join(components(good), "node", "left")
        .select("band", "node", F.coalesce("component", "node").alias("part"))
        .join(classes.select("node", "n_shingles"), "node")
    )
    mixed = stored(
        apart.groupBy("band")
        .agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count(F.lit(1)).alias("n"),
             F.sum("n_shingles").alias("size"))
        .where("low < high")
        .select("band", F.expr(f"CAST(ceil(greatest(n / {BLOCK_ROWS}, size / {BLOCK_SHINGLES})) AS INT)").alias("blocks"))
    )
    found = cross_links(apart.select("band", "node", "part").join(mixed, "band"), chosen, width, percent)
    return good.union(confirmed(found, chosen, width, percent))


def cross_links(rows: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) between classes of a band in different parts, enough to connect all
    parts that some link connects. ``rows`` has (band, node, part, blocks).

    A band with many members is cut into blocks that meet in pairs, so a task holds two
    blocks at most. Sets are compared inside the task through an index of their shingles;
    only links leave it. Shingles are cut to 32 bits here, and a set's own that become equal count
    as if the other set had them all, so this can only add links; the caller confirms them.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            ends, hashes, _ = shingles(part.column("text"), width)
            short, bounds = (hashes >> np.uint64(32)).astype(np.uint32), ends.tolist()
            packed = [np.unique(short[a:b]).tobytes() for a, b in zip(bounds, bounds[1:])]
            yield pa.record_batch(
                [part.column("node"), pa.array(np.diff(ends), pa.int64()), binary_rows(packed)], ["node", "n", "grams"]
            )

    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    meets = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(F.least("own", other).alias("i"), F.greatest("own", other).alias("j")),
    )
    dealt = (
        rows.withColumn("own", own).withColumn("place", F.explode(meets))
        .select("band", "place.i", "place.j", "own", "node", "part")
        .join(texts.mapInArrow(sets, "node long, n long, grams binary"), "node")
        .repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("band", "i", "j")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            if held and any(held[-1].column(c)[-1] != batch.column(c)[0] for c in ("band", "i", "j")):
                yield _pairs(_between(held, percent))
                held = []
            out, at = [], 0
            for cut in cuts.tolist():
                out += _between([*held, batch.slice(at, cut - at)], percent)
                held, at = [], cut
            held.append(batch.slice(at))
            yield _pairs(out)
        if held:
            yield _pairs(_between(held, percent))

    return dealt.mapInArrow(run, "a long, b long").distinct()


def _pairs(links: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*links) if links else ((), ())
    return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _between(batches: list[pa.RecordBatch], percent: int) -> list[tuple[int, int]]:
    """Links between different parts of one meeting of blocks."""
    column = lambda c: np.concatenate([b.column(c).to_numpy() for b in batches])
    node, part, size, own = (column(c) for c in ("node", "part", "n", "own"))
    two_blocks = bool(batches[0].column("i")[0] != batches[0].column("j")[0])
    names, part = np.unique(part, return_inverse=True)
    if len(names) == 1:
        return []
    grams = [np.frombuffer(g, np.uint32) for b in batches for g in b.column("grams").to_pylist()]
    owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
    _, code = np.unique(np.concatenate(grams), return_inverse=True)
    order = np.argsort(code, kind="stable")
    holders, starts = owner[order], np.concatenate(([0], np.cumsum(np.bincount(code))))
    bounds = np.concatenate(([0], np.cumsum([len(g) for g in grams])))
    lost = size - np.diff(bounds)  # shingles that 32 bits don't tell apart
    root = list(range(len(names)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    # the largest part has to be met by all others, but needn't ask itself
    asking = np.flatnonzero(part != np.argmax(np.bincount(part)))
    links = []
    for q in asking.tolist():
        codes = code[bounds[q] : bounds[q + 1]]
        met = np.concatenate([holders[a:b] for a, b in zip(starts[codes].tolist(), starts[codes + 1].tolist())])
        common = np.bincount(met, minlength=len(node))
        other = part != part[q]
        if two_blocks:
            other &= own != own[q]
        most = common + np.minimum(lost[q], lost)
        near = np.flatnonzero(other & (100 * most >= percent * (size[q] + size - most)) & (common > 0))
        for t in near.tolist():
            x, y = find(int(part[q])), find(int(part[t]))
            if x != y:
                links.append((int(min(node[q], node[t])), int(max(node[q], node[t]))))
                # a link that a few chance matches could have made connects nothing yet
                if 100 * (common[t] - 2) >= percent * (size[q] + size[t] - common[t] + 2):
                    root[x] = y
    return links
