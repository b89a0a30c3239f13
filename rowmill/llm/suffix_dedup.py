"""Exact substring dedup by a distributed merge sort of suffixes that knows common prefixes.

A window of ``window`` bytes that occurs twice is removed wherever it stands. Not every suffix
is sorted: in each window one position among its first ``gap + 1`` is its anchor, the one with
the smallest hash of the bytes that follow, so equal windows have their anchors at equal
places. Windows ``l`` bytes before an anchor are equal if the forward strings share
``window - l`` bytes and the ``l`` bytes to the left agree, so a suffix is sorted as its
``window`` bytes forward, then up to ``gap`` bytes backward.

1. Texts are stored in compressed slices with their anchors. Anchors whose first
   ``window - gap`` bytes occur nowhere else (by digest) drop out: only prefixes that can tell
   suffixes apart or together travel.
2. Each task sorts the remaining suffixes of its slices into a run, folds equal ones, and cuts
   the run at splitters into pieces, front-coded: the length of the prefix shared with the one
   before, and the rest. Pieces are stored with the places of their suffixes beside them.
3. The pieces of a part, without places, meet in one task. A loser tree merges them; a node
   holds the common prefix of its loser with the last winner, so bytes known to be equal are
   never compared again. The merge also gives the common prefix of all neighbours.
4. Neighbours with ``window - gap`` common bytes form a cluster. For each ``l`` the forward
   common prefixes cut it into groups, those of the sorted left sides into others; suffixes
   alike in both have the same window. What a suffix learns is the least and greatest such
   ``l``; all windows of one anchor overlap, so these two bound what is removed.
5. The answers go back to the pieces' places, and the bytes are cut out of the slices.

A string that a third of all rows hold is one entry per run, and its places never meet.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from rowmill.functions import stored
from rowmill.llm.common import binary_rows, filled, give_back, keyed_texts, mix, offsets_of, small_batches, text_slices
from rowmill.llm.substring_dedup import digests, gear

#: Bytes of a window, unless the caller names another number, and the least number.
WINDOW, LEAST_WINDOW = 400, 40
#: Bytes whose hash decides which position of a window is its anchor.
GRAM = 16
#: Suffixes of a run, at most.
RUN_SUFFIXES = 1 << 16
#: Repeated prefixes of a part on average, parts at most, and sampled prefixes per part.
PART_PREFIXES, MAX_PARTS, PER_PART = 1 << 15, 4096, 16
#: Neighbours that are resolved together, on average; a cluster is never cut.
BATCH = 1 << 14
NONE = 255


def gap_of(window: int) -> int:
    """How far an anchor may lie behind the start of its window."""
    if window < LEAST_WINDOW:
        raise ValueError(f"a window needs {LEAST_WINDOW} bytes at least, got {window}")
    return min(window // 2, 250)


def anchors_of(data: np.ndarray, ends: np.ndarray, window: int) -> np.ndarray:
    """Ascending anchors of all windows inside the texts that ``ends`` bounds."""
    gap, size = gap_of(window), np.diff(ends)
    whole = size >= window
    if not whole.any():
        return np.zeros(0, np.int64)
    steps = np.zeros(len(data) + 1, np.int32)
    np.add.at(steps, ends[:-1][whole], 1)
    np.add.at(steps, ends[1:][whole] - window + 1, -1)
    hashes = gear(data)[GRAM - 1 :] * np.uint32(0x9E3779B1)
    hashes ^= hashes >> np.uint32(15)
    # the smallest hash, of equal ones the leftmost
    least = hashes.astype(np.uint64) << np.uint64(32) | np.arange(len(hashes), dtype=np.uint64)
    reach = 1
    while 2 * reach <= gap + 1:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if rest := gap + 1 - reach:
        least = np.minimum(least[:-rest], least[rest:])
    starts = np.cumsum(steps[:-1])[: len(least)] > 0
    found = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return found[np.flatnonzero(np.diff(found, prepend=-1))]


def packed(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(1).compress(b"".join(a.tobytes() for a in arrays))


def unpacked(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


SLICE = "doc_ids array<long>, sizes array<int>, body binary, digests binary, places binary, sampled array<binary>"


def slice_table(rows: DataFrame, window: int) -> DataFrame:
    """Stored (slice, doc_ids, sizes, body, digests, places, sampled): texts of about 2 MB
    together, with their anchors and a few of the prefixes for splitters."""
    prefix = window - gap_of(window)
    share = np.uint64(PART_PREFIXES // PER_PART - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            texts = filled(part.column("text"))
            ends = offsets_of(texts)
            body = texts.buffers()[2]
            body = body.to_pybytes()[int(ends[0]) : int(ends[-1])] if body else b""
            ends = ends - ends[0]
            data = np.frombuffer(body, np.uint8)
            at = anchors_of(data, ends, window)
            found = digests(data, at, at + prefix) if len(at) else np.zeros(0, np.uint64)
            few = at[mix(found) & share == 0]
            yield pa.record_batch(
                [
                    pa.array([part.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    pa.array([np.diff(ends).astype(np.int32)], pa.list_(pa.int32())),
                    binary_rows([zstandard.ZstdCompressor(3).compress(body)]),
                    binary_rows([found.tobytes()]), binary_rows([at.astype(np.int32).tobytes()]),
                    pa.array([[body[a : a + prefix] for a in few.tolist()]], pa.list_(pa.binary())),
                ],
                ["doc_ids", "sizes", "body", "digests", "places", "sampled"],
            )

    found = rows.mapInArrow(run, SLICE)
    return stored(found.withColumn("slice", F.monotonically_increasing_id()))


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            found = np.frombuffer(row["digests"], np.int64)
            yield pa.record_batch(
                [pa.array(found), pa.array(np.full(len(found), row["slice"])),
                 pa.array(np.frombuffer(row["places"], np.int32))],
                ["digest", "slice", "at"],
            )


def prefix_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, prefix) of the sampled prefixes."""
    for batch in batches:
        keys = [k for keys in batch.column("sampled").to_pylist() for k in keys]
        data, n = np.frombuffer(b"".join(keys), np.uint8), np.cumsum([0, *map(len, keys)])
        found = digests(data, n[:-1], n[1:]) if keys else np.zeros(0, np.uint64)
        yield pa.record_batch([pa.array(found.view(np.int64)), binary_rows(keys)], ["digest", "prefix"])


def splitters(slices: DataFrame, repeated: DataFrame) -> list[bytes]:
    """Prefixes that cut the repeated ones into parts of about PART_PREFIXES, MAX_PARTS at
    most; PER_PART sampled prefixes for each part come to the driver."""
    n = repeated.count()
    parts = min(MAX_PARTS, n // PART_PREFIXES)
    if parts < 2:
        return []
    thin = max(1, n // (PART_PREFIXES * MAX_PARTS))
    sample = slices.select("sampled").mapInArrow(prefix_digests, "digest long, prefix binary")
    few = sample.where(F.pmod(F.xxhash64("digest"), F.lit(thin)) == 0).join(repeated, "digest", "left_semi")
    keys = sorted(r["prefix"] for r in few.dropDuplicates(["digest"]).select("prefix").collect())
    return sorted({keys[len(keys) * i // parts] for i in range(1, parts)}) if keys else []


def common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes are known to agree."""
    n = min(len(a), len(b))
    apart = int.from_bytes(a[known:n]) ^ int.from_bytes(b[known:n])
    return n - (apart.bit_length() + 7) // 8


def front_coded(keys: list[bytes], forward: list[int], many: list[bool]) -> bytes:
    """Sorted keys, each as the length of the prefix it shares with the one before, and the rest."""
    shared = [0, *(common(a, b, 0) for a, b in zip(keys, keys[1:]))]
    head = [np.array(x, np.uint16) for x in (shared, [len(k) for k in keys], forward)]
    rest = np.frombuffer(b"".join(k[h:] for k, h in zip(keys, shared)), np.uint8)
    return packed(np.array([len(keys)], np.uint32), *head, np.array(many, np.uint8), rest)


class Stream:
    """A front-coded piece, read entry by entry."""

    def __init__(self, blob: bytes):
        data = unpacked(blob)
        self.n = n = int.from_bytes(data[:4], "little")
        self.shared, self.sizes, self.forward = (
            np.frombuffer(data, np.uint16, n, 4 + 2 * n * i).tolist() for i in range(3)
        )
        self.many = data[4 + 6 * n : 4 + 7 * n]
        self.rest, self.at, self.next, self.key = data, 4 + 7 * n, 0, b""

    def advance(self) -> int:
        """Read the next key; the prefix it shares with the one before, -1 at the end."""
        i = self.next
        if i == self.n:
            return -1
        shared = self.shared[i]
        stop = self.at + self.sizes[i] - shared
        self.key = self.key[:shared] + self.rest[self.at : stop]
        self.at, self.next = stop, i + 1
        return shared


def merged(streams: list[Stream]) -> Iterator[tuple[int, int]]:
    """(number of the stream, prefix shared with the key before) in the order of all keys,
    equal ones by the length of their forward string. After each, the stream still holds it.

    A loser tree: a node keeps the stream that lost there and the prefix its key shares with
    the winner. Of two that are compared with the same last winner the one that shares more
    with it is smaller; only at equal lengths are bytes compared, from there on.
    """
    k = len(streams)
    losers, shares = [0] * k, [0] * k

    def beats(a: int, b: int, known: int) -> tuple[bool, int]:
        x, y = streams[a].key, streams[b].key
        same = common(x, y, known)
        if same == len(x) == len(y):
            return streams[a].forward[streams[a].next - 1] <= streams[b].forward[streams[b].next - 1], same
        return same == len(x) or same < len(y) and x[same] < y[same], same

    contenders = [(0, 0)] * k + [(i, s.advance()) for i, s in enumerate(streams)]
    for node in range(k - 1, 0, -1):
        (a, ha), (b, hb) = contenders[2 * node], contenders[2 * node + 1]
        if ha < 0 or hb < 0:
            first, same = ha >= 0, -1
        else:
            first, same = beats(a, b, 0)
        contenders[node] = (a, ha) if first else (b, hb)
        losers[node], shares[node] = (b, same if hb >= 0 else -1) if first else (a, same if ha >= 0 else -1)
    winner, share = contenders[1]
    while share >= 0:
        yield winner, share
        share = streams[winner].advance()
        node = (winner + k) >> 1
        while node:
            other = shares[node]
            if share < other:
                losers[node], winner = winner, losers[node]
                shares[node], share = share, other
            elif share == other >= 0:
                first, same = beats(winner, losers[node], share)
                if not first:
                    losers[node], winner = winner, losers[node]
                shares[node] = same
            node >>= 1


def resolve(shared: np.ndarray, forward: np.ndarray, lefts: list[bytes], many: np.ndarray, window: int) -> np.ndarray:
    """Least and greatest l of each of the sorted distinct suffixes, NONE if there is none.

    ``shared`` are the common prefixes with the one before, ``forward`` the lengths of the
    forward strings, ``lefts`` the bytes to the left, nearest first; ``many`` occur repeatedly.
    """
    gap = gap_of(window)
    n, left = len(shared), np.array([len(x) for x in lefts], np.int64)
    out = np.full((n, 2), NONE, np.int64)
    least = window - forward
    alone = many & (least <= left)
    out[alone] = np.stack((least, left), axis=1)[alone]
    near = shared >= window - gap
    joined = near.copy()
    joined[:-1] |= near[1:]
    own = np.flatnonzero(joined)
    if not len(own):
        return out
    # only clusters of several suffixes are left; cuts between them stay where they were
    cluster = np.cumsum(~near)[own]
    cut = np.append(True, cluster[1:] != cluster[:-1])
    share = np.where(cut, 0, shared[own])
    own_left = [lefts[i] for i in own.tolist()]
    rank = sorted(range(len(own)), key=own_left.__getitem__)
    place = np.empty(len(own), np.int64)
    place[rank] = np.arange(len(own))
    ordered = [own_left[i] for i in rank]
    alike = np.array([0, *(common(a, b, 0) for a, b in zip(ordered, ordered[1:]))], np.int64)
    low, high = np.full(len(own), NONE), np.full(len(own), NONE)
    for l in range(gap + 1):
        fit = np.flatnonzero((forward[own] >= window - l) & (left[own] >= l))
        if len(fit) < 2:
            continue
        ahead = np.cumsum(share < window - l)[fit]
        behind = np.cumsum(alike < l)[place[fit]]
        both = ahead * (len(own) + 1) + behind
        order = np.argsort(both, kind="stable")
        equal = both[order[1:]] == both[order[:-1]]
        hit = np.zeros(len(fit), bool)
        hit[order[1:][equal]] = hit[order[:-1][equal]] = True
        found = fit[hit]
        high[found] = l
        found = found[low[found] == NONE]
        low[found] = l
    found = (low != NONE) & ~alone[own]
    out[own[found], 0], out[own[found], 1] = low[found], high[found]
    return out


def merge_part(blobs: list[bytes], window: int) -> list[np.ndarray]:
    """For each piece the answers of its entries, in order."""
    gap = gap_of(window)
    streams = [Stream(b) for b in blobs]
    source, shared, forward, lefts, many = [], [], [], [], []
    number: list[int] = []  # of the distinct suffix that an entry is
    answers = [[] for _ in blobs]

    def flush() -> None:
        if not source:
            return
        found = resolve(np.array(shared), np.array(forward), lefts, np.array(many), window)
        found = found.astype(np.uint8)[np.array(number)]
        stream = np.array(source)
        order = np.argsort(stream, kind="stable")
        bounds = np.searchsorted(stream[order], np.arange(len(blobs) + 1))
        for i in np.unique(stream).tolist():
            answers[i].append(found[order[bounds[i] : bounds[i + 1]]])
        for held in (source, shared, forward, lefts, many, number):
            held.clear()

    last, last_forward = b"", -1
    for i, share in merged(streams):
        stream = streams[i]
        key, ahead = stream.key, stream.forward[stream.next - 1]
        if share < window - gap and len(shared) >= BATCH:
            flush()
        if source and share == len(key) == len(last) and ahead == last_forward:
            many[-1] = True
        else:
            shared.append(share if source else 0)
            forward.append(ahead)
            lefts.append(key[ahead:])
            many.append(bool(stream.many[stream.next - 1]))
        source.append(i)
        number.append(len(shared) - 1)
        last, last_forward = key, ahead
    flush()
    return [np.concatenate(a) if a else np.zeros((0, 2), np.uint8) for a in answers]


PIECE = "part int, keys binary, members binary"


def piece_table(slices: DataFrame, chosen: DataFrame, cuts: list[bytes], window: int) -> DataFrame:
    """Stored (piece, part, keys, members): the runs of all tasks, cut at the splitters."""
    gap = gap_of(window)

    def pieces(entries: list[tuple[bytes, int, int, int]]) -> Iterator[pa.RecordBatch]:
        entries.sort()
        keys, forward, first = [], [], []
        for i, (key, ahead, _, _) in enumerate(entries):
            if not keys or key != keys[-1] or ahead != forward[-1]:
                keys.append(key)
                forward.append(ahead)
                first.append(i)
        first.append(len(entries))
        bounds = sorted({0, len(keys), *(bisect_left(keys, c) for c in cuts)})
        parts = [bisect_left(cuts, keys[a][: window - gap] + b"\0") for a in bounds[:-1]]
        rows = []
        for a, b in zip(bounds, bounds[1:]):
            own = entries[first[a] : first[b]]
            sizes = np.diff(first[a : b + 1])
            members = packed(
                np.array([b - a, len(own)], np.uint32), sizes.astype(np.uint32),
                np.array([e[2] for e in own], np.int64), np.array([e[3] for e in own], np.uint32),
            )
            rows.append((front_coded(keys[a:b], forward[a:b], (sizes > 1).tolist()), members))
        yield pa.record_batch(
            [pa.array(parts, pa.int32()), binary_rows([r[0] for r in rows]), binary_rows([r[1] for r in rows])],
            ["part", "keys", "members"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = []
        for batch in batches:
            for row in batch.to_pylist():
                body = unpacked(row["body"])
                back, n = body[::-1], len(body)
                ends = np.cumsum([0, *row["sizes"]])
                at = np.sort(np.array(row["places"], np.int64))
                inside = np.searchsorted(ends, at, "right") - 1
                stops = np.minimum(at + window, ends[inside + 1]).tolist()
                begins = np.maximum(at - gap, ends[inside]).tolist()
                for a, stop, begin in zip(at.tolist(), stops, begins):
                    entries.append((body[a:stop] + back[n - a : n - begin], stop - a, row["slice"], a))
                    if len(entries) >= RUN_SUFFIXES:
                        yield from pieces(entries)
                        entries = []
        if entries:
            yield from pieces(entries)
        give_back()

    source = slices.select("slice", "sizes", "body").join(chosen, "slice")
    found = small_batches(source).mapInArrow(run, PIECE)
    return stored(found.withColumn("piece", F.monotonically_increasing_id()))


def answer_table(pieces: DataFrame, window: int) -> DataFrame:
    """(piece, answers) of the pieces in which something is to be removed."""

    def merge(group: pa.Table) -> pa.Table:
        found = merge_part(group.column("keys").to_pylist(), window)
        kept = [i for i, a in enumerate(found) if (a[:, 0] != NONE).any()]
        out = pa.table({
            "piece": group.column("piece").take(pa.array(kept, pa.int64())),
            "answers": binary_rows([found[i].tobytes() for i in kept]),
        })
        del found
        give_back()
        return out

    return pieces.select("part", "piece", "keys").groupBy("part").applyInArrow(merge, "piece long, answers binary")


def span_table(pieces: DataFrame, answers: DataFrame, window: int) -> DataFrame:
    """(slice, spans): bounds within the slice of what is to be removed, as pairs of uint32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data = unpacked(row["members"])
                n, m = np.frombuffer(data, np.uint32, 2).tolist()
                entry = np.repeat(np.arange(n), np.frombuffer(data, np.uint32, n, 8))
                number = np.frombuffer(data, np.int64, m, 8 + 4 * n)
                at = np.frombuffer(data, np.uint32, m, 8 + 4 * n + 8 * m).astype(np.int64)
                low, high = np.frombuffer(row["answers"], np.uint8).reshape(n, 2)[entry].astype(np.int64).T
                hit = low != NONE
                spans = np.stack((at - high, at - low + window), axis=1)[hit].astype(np.uint32)
                number = number[hit]
                order = np.argsort(number, kind="stable")
                names, first = np.unique(number[order], return_index=True)
                parts = np.split(spans[order], first[1:])
                yield pa.record_batch(
                    [pa.array(names), binary_rows([p.tobytes() for p in parts[: len(names)]])], ["slice", "spans"]
                )

    source = pieces.select("piece", "members").join(answers, "piece")
    found = small_batches(source).mapInArrow(run, "slice long, spans binary")
    return found.groupBy("slice").agg(F.collect_list("spans").alias("spans"))


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            data = np.frombuffer(unpacked(row["body"]), np.uint8)
            ends = np.cumsum([0, *row["sizes"]])
            steps = np.zeros(len(data) + 1, np.int64)
            for spans in row["spans"] or ():
                spans = np.frombuffer(spans, np.uint32).reshape(-1, 2)
                np.add.at(steps, spans[:, 0], 1)
                np.add.at(steps, spans[:, 1], -1)
            gone = np.cumsum(steps)[:-1] > 0
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            heads = ends[:-1][np.diff(ends) > 0]
            begins[heads] = gone[heads]
            removed, spans = (np.concatenate(([0], np.cumsum(x)))[ends] for x in (gone, begins))
            left = data[~gone].tobytes()
            bounds = (ends - removed).tolist()
            yield pa.record_batch(
                [
                    pa.array(row["doc_ids"], pa.int64()), *(pa.array(np.diff(x).astype(np.int64)) for x in (ends, removed, spans)),
                    binary_rows([left[a:b] for a, b in zip(bounds, bounds[1:])]),
                ],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )
    give_back()


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): each whole text as UTF-8 without the bytes
    that lie in a string of ``window`` bytes which also starts anywhere else, in this row or
    another. All occurrences go, overlapping ones too, judged on the texts as given.

    ``kept`` is binary, since a cut may fall inside a character. A null or empty text has 0
    bytes and stays; rows that share an id or have none count one by one, so the texts of
    repeated rows of ``window`` bytes and more go altogether; other columns are left out.
    Texts travel compressed, twice; of suffixes only those whose prefix is repeated.
    """
    slices = slice_table(keyed_texts(docs, key, text), window)
    found = slices.select("slice", "digests", "places").mapInArrow(_exploded, "digest long, slice long, at int")
    repeated = stored(found.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest"))
    # both sides meet by digest alone, so the join can split a digest that many hold
    chosen = found.join(repeated, "digest").groupBy("slice").agg(F.collect_list("at").alias("places"))
    pieces = piece_table(slices, chosen, splitters(slices, repeated), window)
    spans = span_table(pieces, answer_table(pieces, window), window)
    whole = slices.select("slice", "doc_ids", "sizes", "body").join(spans, "slice", "left")
    return small_batches(whole).mapInArrow(_cut, RESULT)
