"""Hard negatives against every inner product."""

import math

import numpy as np
import pytest
from pyspark.sql import types as T

from rowmill.llm import hard_negatives as hn

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("label", T.IntegerType()), T.StructField("score", T.StringType()),
])
ANCHOR = "vec_id % 10 = 0"


def brute(rows, n_pos=5, n_neg=10, low=30, high=90):
    good = [
        (k, i, label, [math.floor(256 * float(np.float32(x))) for x in v])
        for k, (i, v, label) in enumerate(rows)
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for k, i, label, v in good:
        if i is None or i % 10:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, m, q) for q, j, m, w in good if q != k]
        scored.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0, s[3]))
        for p in [s for s in scored if s[2] == label][:n_pos]:
            found = [s for s in scored if s[2] != label and low * p[0] <= 100 * s[0] <= high * p[0]][:n_neg]
            out += [(i, p[1], r + 1, s[1], p[0], s[0]) for r, s in enumerate(found)]
    return sorted(out, key=str)


def found(spark, rows, anchor=ANCHOR, **options):
    table = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    return sorted((tuple(r) for r in hn.hard_negatives(hn.integer_vectors(table), anchor, **options).collect()), key=str)


def made(n, dims, seed, spread=0.4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, dims))
    label = rng.integers(0, 4, n)
    v = (centres[label] + spread * rng.normal(size=(n, dims))).astype(np.float32)
    return [(i, v[i].tolist(), int(label[i] if rng.random() < 0.7 else rng.integers(0, 4))) for i in range(n)]


@pytest.mark.parametrize("block_rows", [50, 100_000])
def test_equal_to_all_products(spark, block_rows, monkeypatch):
    monkeypatch.setattr(hn, "STEP", 16)
    monkeypatch.setattr(hn, "CHUNK", 3)
    rows = made(300, 6, 1)
    assert found(spark, rows, block_rows=block_rows) == brute(rows)


def test_ties_copies_and_awkward_rows(spark):
    rows = made(60, 3, 2)
    common = [0.5, -0.25, 1.0]
    rows += [(100 + i, common, i % 3) for i in range(80)]  # a hot vector: ties everywhere
    rows += [(100, common, 1), (None, common, 0), (None, common, 2), (200, None, 1), (210, [1.0, None, 2.0], 1)]
    rows += [(220, [1.0, float("nan"), 0.0], 1), (230, [float("inf"), 0.0, 0.0], 1), (240, common, None)]
    rows += [(250, [], 1), (260, [0.0, 0.0, 0.0], 2), (270, [1.0, 1.0, 1.0, 1.0, 1.0], 1), (280, [1.0], 0)]
    assert found(spark, rows, block_rows=40) == brute(rows)


def test_large_components_are_exact_or_fail(spark):
    rows = [(i, [float(2**22 + i), float(i % 7)], i % 2) for i in range(40)]
    assert found(spark, rows) == brute(rows)
    with pytest.raises(Exception, match="more than 64 bits"):
        found(spark, [(0, [1e18], 0), (1, [1e18], 0)])


def test_empty_tables_and_single_labels(spark):
    assert found(spark, []) == []
    assert found(spark, [(0, [1.0], 1), (10, [2.0], 1)]) == []
    assert found(spark, [(1, [1.0], 1), (2, [2.0], 0)]) == []


def test_walks_end_early(monkeypatch):
    """Where directions differ, the certificate spares most of the list."""
    monkeypatch.setattr(hn, "STEP", 64)
    rng = np.random.default_rng(3)
    v = np.repeat(np.eye(8, dtype=np.int64) * 1000, 500, axis=0) + rng.integers(-20, 21, (4000, 8))
    n = np.arange(4000)
    block = hn.Block(n, n, np.ones(4000, bool), n % 2, v)
    centre = np.eye(8)[0]
    members = v[:20]
    lengths = hn.lengths_of(members)
    block.sort_for(centre, float(hn.angles(members, lengths, centre).max()))
    seen = []
    whole = hn.products
    monkeypatch.setattr(hn, "products", lambda a, b, m: seen.append(len(a)) or whole(a, b, m))
    best = list(hn.positive_walk(block, {"row": n[:20], "label": n[:20] % 2, "v": members, "lengths": lengths}, 5))
    assert sum(seen) < 1000
    scores = v @ members.T
    for j, _, found_ in best:
        own = [(-scores[i, j], i) for i in n if i % 2 == j % 2 and i != j]
        assert [i for _, i in sorted(own)[:5]] == block.row[found_.places].tolist()
