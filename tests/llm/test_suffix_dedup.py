"""Suffix dedup against all windows, and its merge against a plain sort."""

import os
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from llm_helpers import AWKWARD, documents
from pyspark.sql import functions as F

from rowmill.llm import suffix_dedup as sd


def brute(rows, window):
    texts = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[s : s + window] for _, b in texts for s in range(len(b) - window + 1))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for s in range(len(b) - window + 1):
            if count[b[s : s + window]] > 1:
                gone[s : s + window] = b"\1" * window
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, kept))
    return sorted(out, key=str)


def found(spark, rows, window):
    return sorted((tuple(map(lambda x: bytes(x) if isinstance(x, bytearray) else x, r))
                   for r in sd.remove_repeats(documents(spark, rows, ["kept", "slice"]), window).collect()), key=str)


def mosaic(rng, n, words=60):
    """Texts made of a few shared passages of any length, edited here and there."""
    vocabulary = ["".join(rng.choices("abcdé", k=rng.randint(1, 6))) for _ in range(words)]
    passages = [" ".join(rng.choices(vocabulary, k=rng.randint(5, 60))) for _ in range(6)]
    out = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(1, 5)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 2)
            p = p[a : a + rng.randint(1, len(p))]
            if rng.random() < 0.5:
                k = rng.randint(0, len(p) - 1)
                p = p[:k] + rng.choice("xyz") + p[k + 1 :]
            parts.append(p + "".join(rng.choices("abcdefgh ", k=rng.randint(0, 30))))
        out.append((i, "".join(parts)))
    return out


@pytest.mark.parametrize("seed,window", [(1, 40), (2, 64), (3, 41)])
def test_equal_to_all_windows(spark, seed, window):
    rows = mosaic(random.Random(seed), 60) + [(100, "ab" * 300), (101, "b" + "ab" * 90), (102, "q" * 500)]
    assert found(spark, rows, window) == brute(rows, window)


def test_many_runs_and_parts(spark):
    """Small runs, parts and batches: pieces, splitters and flushes all take part."""
    rows = mosaic(random.Random(5), 80)
    texts = [(t or "").encode() for _, t in rows]
    wanted = brute(rows, 48)
    slices = sd.slice_table(sd.keyed_texts(documents(spark, rows)), 48)
    every = slices.select("slice", "digests", "places").mapInArrow(sd._exploded, "digest long, slice long, at int")
    prefixes = sorted({t[s : s + 24] for t in texts for s in range(len(t) - 24)})
    cuts = prefixes[100 :: len(prefixes) // 7]
    chosen = every.groupBy("slice").agg(F.collect_list("at").alias("places"))
    pieces = sd.piece_table(slices.repartition(5), chosen, cuts, 48)
    assert pieces.select("part").distinct().count() > 3
    spans = sd.span_table(pieces, sd.answer_table(pieces, 48), 48)
    whole = slices.select("slice", "doc_ids", "sizes", "body").join(spans, "slice", "left")
    got = sorted((tuple(bytes(x) if isinstance(x, bytearray) else x for x in r)
                  for r in whole.mapInArrow(sd._cut, sd.RESULT).collect()), key=str)
    assert got == wanted


def test_awkward_rows(spark):
    rows = [r for r in AWKWARD if r[0] != 5] + [(5, "lorem ipsum dolor sit amet " * 60)]
    assert found(spark, rows, 100) == brute(rows, 100)
    assert found(spark, [], 100) == []


def test_the_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = sd.remove_repeats(docs).collect()
    wanted = {r[0]: r for r in brute(rows, sd.WINDOW)}
    assert len(got) == len(rows)
    assert {r["doc_id"]: tuple(r)[:4] + (bytes(r["kept"]),) for r in got} == wanted
    assert sum(r["n_removed"] for r in got) > 0


KEYS = st.lists(st.lists(st.tuples(st.binary(max_size=6).map(lambda b: bytes(x % 3 for x in b)), st.integers(0, 3)),
                         min_size=1, max_size=12), min_size=1, max_size=7)


@settings(max_examples=200, deadline=None)
@given(KEYS)
def test_merge_equals_sorting(runs):
    runs = [sorted({(k, min(f, len(k))) for k, f in run}) for run in runs]
    streams = [sd.Stream(sd.front_coded([k for k, _ in r], [f for _, f in r], [False] * len(r))) for r in runs]
    out, last = [], b""
    for i, share in sd.merged(streams):
        key = streams[i].key
        assert share == len(os.path.commonprefix([key, last]))
        out.append((key, streams[i].forward[streams[i].next - 1]))
        last = key
    assert out == sorted(x for r in runs for x in r)


def test_known_prefixes_are_not_compared_again(monkeypatch):
    """All keys share 200 bytes; the merge compares beyond them once it knows them."""
    rng = random.Random(1)
    runs = [sorted(b"p" * 200 + bytes(rng.choices(range(97, 100), k=20)) for _ in range(50)) for _ in range(8)]
    streams = [sd.Stream(sd.front_coded(r, [220] * 50, [False] * 50)) for r in runs]
    starts, whole = [], sd.common
    monkeypatch.setattr(sd, "common", lambda a, b, known: starts.append(known) or whole(a, b, known))
    assert len(list(sd.merged(streams))) == 400
    assert sum(s < 200 for s in starts) <= 8 and len(starts) < 400 * 3


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(1)
    passage = rng.integers(97, 100, 90).astype(np.uint8)
    places = []
    for head in (0, 13, 50):
        data = np.concatenate((rng.integers(97, 100, head).astype(np.uint8), passage, rng.integers(97, 100, 30).astype(np.uint8)))
        found_ = sd.anchors_of(data, np.array([0, len(data)]), 60)
        places.append(set((found_[(found_ >= head) & (found_ <= head + 60)] - head).tolist()))
    shared = set.intersection(*places)
    assert shared and all(any(s <= a <= s + 30 for a in shared) for s in range(0, 31))
    with pytest.raises(ValueError):
        sd.gap_of(10)
