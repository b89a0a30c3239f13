import math
import re
import tracemalloc
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rowmill.llm import ctw
from llm_helpers import AWKWARD, collected, documents

CORPUS = [(i, t) for i, t in enumerate(
    ["the cat sat", "The cat  ran\n", "a dog sat", "the dog ran off", "", "cat", "the the the", "été et hiver", "a b c a b c"] * 3
)] + [r for r in AWKWARD if r[0] is not None and len(r[1] or "") < 100] + [(None, "the end")]


def normal(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]


def held(i):
    return i is not None and crc32(str(i).encode()) % 5 == 1


class Brute:
    """The same tree by direct recursion over dictionaries of counts."""

    def __init__(self, texts):
        self.n = Counter()
        for text in texts:
            data = b"\n" * ctw.DEPTH + text
            for t in range(ctw.DEPTH, len(data)):
                for depth in range(ctw.DEPTH + 1):
                    context = data[t - depth : t]
                    for bit in range(8):
                        prefix = (1 << bit) | (data[t] >> (8 - bit))
                        self.n[context, prefix, (data[t] >> (7 - bit)) & 1] += 1
        self.children = {}
        for context, prefix, _ in self.n:
            if context:
                self.children.setdefault((context[1:], prefix), set()).add(context)
        self.known = {}

    def weighted(self, context, prefix):
        key = (context, prefix)
        if key not in self.known:
            a, b = self.n[(*key, 0)], self.n[(*key, 1)]
            kt = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
            if len(context) == ctw.DEPTH:
                self.known[key] = (kt, 1.0)
            else:
                below = sum(self.weighted(c, prefix)[0] for c in self.children.get(key, ()))
                total = np.logaddexp(kt, below) - math.log(2)
                self.known[key] = (total, math.exp(kt - math.log(2) - total))
        return self.known[key]

    def one(self, before, prefix, depth=0):
        """The chance that the next bit is 1."""
        context = before[len(before) - depth :]
        a, b = self.n[context, prefix, 0], self.n[context, prefix, 1]
        own = (b + 0.5) / (a + b + 1)
        if depth == ctw.DEPTH:
            return own
        share = self.weighted(context, prefix)[1]
        return share * own + (1 - share) * self.one(before, prefix, depth + 1)

    def log10(self, text):
        data, out = b"\n" * ctw.DEPTH + text, 0.0
        for t in range(ctw.DEPTH, len(data)):
            for bit in range(8):
                p = self.one(data[t - ctw.DEPTH : t], (1 << bit) | (data[t] >> (8 - bit)))
                out += math.log10(p if (data[t] >> (7 - bit)) & 1 else 1 - p)
        return out


def stream(text):
    return " ".join(normal(text)).encode() + b"\n"


@pytest.mark.parametrize("chunk_bytes, buckets", [(40, 5), (1 << 20, 64)])
def test_scores_equal_direct_recursion(spark, chunk_bytes, buckets):
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    docs = documents(spark, CORPUS, ["score", "chunk"]).repartition(3)
    found = ctw.score_texts(docs, fold, chunk_bytes=chunk_bytes, buckets=buckets)
    got = {}
    for r in collected(found):
        got.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, got.values())) == len(CORPUS)
    train = [t for i, t in CORPUS if not held(i)]
    tree = Brute([stream(t) for t in train])
    counts = Counter(w for t in train for w in [*normal(t), "\n"])
    total, distinct = sum(counts.values()), len(counts)
    for i, text in CORPUS:
        tokens = [*normal(text), "\n"]
        rows = [r for r in got[i] if math.isclose(r["score"], tree.log10(stream(text)), rel_tol=1e-5, abs_tol=1e-5)]
        assert rows, (i, text, tree.log10(stream(text)), got[i])
        r = rows[0]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in tokens)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9, abs_tol=1e-9)
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held(i), len(tokens), total)
        assert r["n_known"] == sum(counts[w] > 0 for w in tokens) and r["n_bytes"] == len(stream(text))


def test_chances_of_all_next_bytes_add_up_to_one():
    texts = [stream(t) for _, t in CORPUS]
    contexts = [b"\n\n\nth", b"zzzzz", b"e cat"]
    keys, counts = [], []
    for text in texts:
        data = b"\n" * ctw.DEPTH + text
        for t in range(ctw.DEPTH, len(data)):
            keys.append(int.from_bytes(data[t - ctw.DEPTH : t][::-1] + data[t : t + 1], "big"))
            counts.append(1)
    for context in contexts:
        for byte in range(256):
            keys.append(int.from_bytes(context[::-1] + bytes([byte]), "big"))
            counts.append(0)
    distinct, total = ctw.summed(np.array(keys, np.uint64), np.array(counts))
    tree = ctw.Tree(distinct, total)
    sums, upper = np.zeros((3, 256 * 256)), tree.upper_sums()
    for row, c in zip(sums, ("n0", "n1", "weighted")):
        row[upper.column("node").to_numpy()] = upper.column(c).to_numpy()
    chances = 10.0 ** tree.log10(ctw.upper_nodes(sums))
    for context in contexts:
        first = int.from_bytes(context[::-1] + b"\x00", "big")
        assert math.isclose(chances[(distinct >= first) & (distinct < first + 256)].sum(), 1, rel_tol=1e-9)


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 2.5, 7.9, 8, 30, 1e6, 1e12])
    assert np.allclose(ctw.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-11)


def test_nothing_to_learn_from(spark):
    docs = documents(spark, [(1, "a b"), (2, None)])
    got = collected(ctw.score_texts(docs, F.lit(True)))
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == 0 for r in got)
    assert {r["doc_id"]: r["score"] for r in got} == pytest.approx({1: -8 * 4 * math.log10(2), 2: -8 * math.log10(2)})
    assert collected(ctw.score_texts(documents(spark, []), F.lit(False))) == []


def test_held_out_texts_cost_less_than_their_letters(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = ctw.score_texts(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1)
    bits = got.where("held_out").agg((-F.sum("score") / math.log10(2) / F.sum("n_bytes")).alias("x")).first()["x"]
    assert bits < 2.6


def test_counts_of_many_chunks_are_added_up_in_little_memory():
    """A bucket's keys of 64 chunks, mostly the same ones: never held all at once."""
    rng = np.random.default_rng(1)
    rows, wanted = [], Counter()
    for _ in range(64):
        keys = np.unique(rng.integers(0, 1 << 17, 1 << 17).astype(np.uint64))
        counts = rng.integers(0, 5, len(keys))
        rows.append((ctw.packed_keys(keys), ctw.packed(counts)))
        wanted.update(dict(zip(keys.tolist(), counts.tolist())))
    table = pa.table({"keys": [k for k, _ in rows], "counts": [c for _, c in rows]})
    tracemalloc.start()
    keys, counts = ctw._merged(table)[:2]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert dict(zip(keys.tolist(), counts.tolist())) == wanted and (np.diff(keys) > 0).all()
    assert peak < 100 << 20


def test_tree_keeps_one_bit_at_a_time():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 1 << 48, 1 << 17).astype(np.uint64))
    tracemalloc.start()
    ctw.Tree(keys, np.ones(len(keys), np.int64)).upper_sums()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400 * len(keys)


def test_windows_after_a_frequent_pair_are_in_several_buckets():
    """Windows after the same two bytes: only the trees keep them together."""
    windows = np.array([int.from_bytes(b"e " + bytes([c]) + b"xyz", "big") for c in range(97, 123)], np.uint64)
    assert len(set(ctw.buckets_of(ctw.GRAMS, windows, 64).tolist())) > 8
    assert len(set(ctw.buckets_of(ctw.GRAMS, windows, 64, ctw.TREE_DEPTH).tolist())) == 1
