import random
import re

import numpy as np
import pyarrow as pa
import pytest

from rowmill.llm import setsketch
from llm_helpers import AWKWARD, LONG, collected, documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, width):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def brute(rows, width, percent):
    """component of every id by comparing all pairs."""
    sets = [(i, shingle_set(t, width)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i, _ in rows}


def corpus(seed=5):
    """Copies, near copies around the threshold, chains, and texts with a common passage."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    shared = [rng.choice(words) for _ in range(25)]
    rows, n = [], 0
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.randrange(1, 60))]
        if rng.random() < 0.5:
            base = shared + base
        for copy in range(rng.randrange(1, 7)):
            text = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 8)):
                text[rng.randrange(len(text))] = rng.choice(words)
            if copy == 3:
                base = text  # a chain
            rows.append((n, " ".join(text).upper() if n % 3 else "  ".join(text)))
            n += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("width", [2, 5])
def test_components_equal_brute_force(spark, width):
    rows = corpus()
    found = setsketch.near_duplicates(documents(spark, rows), width=width)
    got = {r["doc_id"]: r for r in collected(found)}
    assert {i: r["component_id"] for i, r in got.items()} == brute(rows, width, 80)
    for i, text in rows:
        assert got[i]["n_shingles"] == len(shingle_set(text, width))
        assert got[i]["kept"] == (got[i]["component_id"] == i)


def test_one_large_group_of_near_copies_costs_no_pairs(spark):
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(base[:i] + [f"x{i}"] + base[i + 1 :])) for i in range(100)]
    got = collected(setsketch.near_duplicates(documents(spark, rows), width=2))
    assert {r["component_id"] for r in got} == {0}
    assert sum(r["kept"] for r in got) == 1


def test_awkward_rows(spark):
    got = collected(setsketch.near_duplicates(documents(spark, AWKWARD, ["kept", "component_id", "node"]), width=2))
    assert len(got) == len(AWKWARD)
    one = [r for r in got if r["doc_id"] in (1, 10)]
    assert {r["component_id"] for r in one} == {1} and sorted(r["kept"] for r in one) == [False, True, True]
    for r in got:
        if r["doc_id"] in (2, 3, 4):
            assert (r["n_shingles"], r["component_id"], r["kept"]) == (0, r["doc_id"], True)
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
    assert next(r for r in got if r["doc_id"] == 5)["n_shingles"] == len(shingle_set(LONG, 2))


def test_no_rows(spark):
    assert collected(setsketch.near_duplicates(documents(spark, []))) == []


def test_registers_of_a_union_are_the_larger_ones():
    a, b = pa.array(["a b c d e f"]), pa.array(["e f g h i"])
    sets = [setsketch.shingles(x, 1)[1] for x in (a, b)]
    union = np.unique(np.concatenate(sets))
    one, two, both = (setsketch.registers(s, np.array([0, len(s)]))[0] for s in (*sets, union))
    assert (np.maximum(one, two) == both).all()


def test_likelihood_keeps_similar_pairs_and_drops_others():
    rng = np.random.default_rng(1)
    for common, keep in ((900, True), (880, True), (300, False)):
        pool = np.unique(rng.integers(0, 2**63, 3000).astype(np.uint64))
        a, b = pool[:1000], np.concatenate((pool[:common], pool[1000 : 2000 - common]))
        x, y = (setsketch.registers(np.sort(s), np.array([0, len(s)])) for s in (a, b))
        ratio = setsketch.likelihood_ratio(x, y, np.array([1000.0]), np.array([1000.0]), 0.8)[0]
        assert (ratio <= setsketch.MAX_LOG_RATIO) == keep


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["component"] for r in collected(setsketch.components(links))}
    assert got == {i: 0 for i in range(1, 41)} | {101: 100}


def test_shingles_that_32_bits_merge_do_not_lose_a_link():
    # of 10 and 8 shingles 8 are common, exactly 0.8; two of those are equal in 32 bits
    sets = [np.arange(9, dtype=np.uint32), np.arange(7, dtype=np.uint32)]
    columns = {"i": [0, 0], "j": [0, 0], "own": [0, 0], "node": [4, 6], "part": [4, 6], "n": [10, 8]}
    arrays = [pa.array(v, pa.int64()) for v in columns.values()]
    batch = pa.record_batch([*arrays, pa.array([g.tobytes() for g in sets])], [*columns, "grams"])
    assert setsketch._between([batch], 80) == [(4, 6)]
    assert setsketch._between([batch], 90) == []
