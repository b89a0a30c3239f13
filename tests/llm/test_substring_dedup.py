import random

import numpy as np
import pyarrow as pa

from rowmill.llm import substring_dedup as sd
from llm_helpers import AWKWARD, collected, documents


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def corpus(seed=8):
    """Unique texts; some share passages of 60 words in other surroundings."""
    rng = random.Random(seed)
    passages = [words(rng, 60) for _ in range(5)]
    rows, holders = [], {}
    for i in range(80):
        parts = [words(rng, rng.randrange(5, 80)) for _ in range(3)]
        if i % 4 == 0:
            p = (i // 4) % 5
            parts.insert(1 + i % 2, passages[p])
            holders.setdefault(p, []).append(i)
        rows.append((i, rng.choice([" ", "\n"]).join(parts)))
    return rows, passages, holders


def test_chunks_follow_the_content():
    rng = random.Random(1)
    body = words(rng, 300)
    a, b = sd.Chunks(pa.array([body])), sd.Chunks(pa.array(["some words put in front " + body]))
    common = set(a.digests.tolist()) & set(b.digests.tolist())
    assert len(common) >= len(a.digests) - 8
    one, two = "first text " + body, "another " + body
    together, alone = sd.Chunks(pa.array([one, two])), sd.Chunks(pa.array([two]))
    assert together.digests[together.owner == 1].tolist() == alone.digests.tolist()
    assert all(len(bytes(a.data[s:e]).split()) >= sd.MIN_WORDS for s, e in zip(a.starts, a.stops))
    covered = {p for s, e in zip(a.starts.tolist(), a.stops.tolist()) for p in range(s, e)}
    assert covered == set(range(len(body)))


def test_digests_do_not_depend_on_the_place():
    data = np.frombuffer(b"some bytes, some bytes, other bytes", np.uint8)
    got = sd.digests(data, np.array([0, 12, 24, 0]), np.array([10, 22, 35, 11]))
    assert got[0] == got[1] and len({*got.tolist()}) == 3


def test_passages_stay_once_and_clean_texts_are_left_alone(spark):
    rows, passages, holders = corpus()
    got = {r["doc_id"]: r for r in collected(sd.remove_repeats(documents(spark, rows), report=True))}
    texts = dict(rows)
    for p, ids in holders.items():
        for i in ids[1:]:
            left = set(passages[p].split()) & set(got[i]["text"].split())
            assert len(left) <= 20, (i, len(left))
            assert got[i]["n_removed"] == len(texts[i]) - len(got[i]["text"]) > 100
    firsts = {ids[0] for ids in holders.values()}
    for i, text in rows:
        if i % 4 or i in firsts:
            assert got[i]["text"] == text and got[i]["n_removed"] == 0


def brute(rows):
    """Chunk decisions by one dictionary over all texts in order of their ids."""
    seen, out = {}, {}
    for i, text in sorted(rows):
        chunks = sd.Chunks(pa.array([text], pa.string()))
        flags, own = [], set()
        for d in chunks.digests.tolist():
            flags.append(d in own or seen.get(d, i) != i)
            own.add(d)
            seen.setdefault(d, i)
        out[i] = (len(flags), sum(flags))
    return out


def test_copied_chunks_equal_brute_force(spark):
    rows, _, _ = corpus(9)
    rows += [(200, rows[3][1]), (201, "x y z " * 60), (202, "x y z " * 60), (203, None)]
    got = {r["doc_id"]: (r["n_chunks"], r["n_copied"]) for r in collected(sd.remove_repeats(documents(spark, rows), report=True))}
    assert got == brute(rows)


def test_awkward_rows(spark):
    docs = documents(spark, AWKWARD, ["digest", "first"])
    got = sd.remove_repeats(docs)
    assert got.columns == docs.columns
    rows = collected(got)
    assert len(rows) == len(AWKWARD)
    texts = {(r["doc_id"], r["text"]) for r in rows}
    assert {(2, None), (3, ""), (4, " \t\n "), (None, None), (7, "naïve café 日本語 😀"), (9, "x" * 20000)} <= texts
    assert len(next(r["text"] for r in rows if r["doc_id"] == 5)) < 2000
    assert collected(sd.remove_repeats(documents(spark, []))) == []


def test_copies_of_whole_texts_become_empty(spark):
    text = words(random.Random(3), 100)
    got = {r["doc_id"]: r["text"] for r in collected(sd.remove_repeats(documents(spark, [(1, text), (2, text), (None, text)])))}
    assert got == {1: text, 2: "", None: ""}


def shared_windows(text, earlier, n):
    """Windows of n words of a text that an earlier text has too, word by word."""
    windows = lambda t: {tuple(t.split()[i : i + n]) for i in range(len(t.split()) - n + 1)}
    return windows(text) & set().union(*map(windows, earlier))


def test_passages_of_a_repeated_unit_are_found(spark):
    rng = random.Random(12)
    rows, around = [], {}
    for p in (1, 1, 1, 1, 1, 1, 1, 1, 2, 2, 2, 2, 3, 3, 3, 3, 12, 30):
        passage = " ".join([words(rng, p)] * (150 // p))
        for _ in range(3):
            before, after = words(rng, rng.randrange(30, 60)), words(rng, rng.randrange(30, 60))
            around[len(rows)] = before.split() + after.split()
            rows.append((len(rows), f"{before} {passage} {after}"))
    got = {r["doc_id"]: r["text"] for r in collected(sd.remove_repeats(documents(spark, rows)))}
    for i, text in rows:
        group = [rows[j][1] for j in range(i - i % 3, i)]
        assert not shared_windows(got[i], group, 50), text
        assert not {*around[i]} - {*got[i].split()}
    assert all(shared_windows(text, [rows[i - 1][1]], 50) for i, text in rows if i % 3)


def test_rows_without_or_with_the_same_id_count_one_by_one(spark):
    rng = random.Random(4)
    a, b, c, d = (words(rng, 100) for _ in range(4))
    rows = [(None, a), (None, a), (None, a), (5, b), (5, b), (None, c), (3, c), (7, d), (None, f"{d} {a}")]
    docs = documents(spark, rows).repartition(3)
    got = collected(sd.remove_repeats(docs))
    left = lambda i: sorted(r["text"] for r in got if r["doc_id"] == i)
    assert left(5) == ["", b] and left(3) == [c] and left(7) == [d]
    everything = " ".join(r["text"] for r in got if r["doc_id"] is None)
    assert len(everything.split()) <= 100 + 30 and set(a.split()) <= set(everything.split())
    assert not set(c.split()) & set(everything.split()) - set(a.split())
    assert len(got) == len(rows)
    report = collected(sd.remove_repeats(docs, report=True))
    assert sum(r["n_removed"] for r in report) == sum(len(t) for _, t in rows) - sum(len(r["text"]) for r in got)


def test_a_digest_of_the_largest_id_belongs_to_it(spark):
    text, largest = words(random.Random(5), 100), (1 << 63) - 1
    got = collected(sd.remove_repeats(documents(spark, [(None, text), (largest, text)])))
    assert {r["doc_id"]: r["text"] for r in got} == {largest: text, None: ""}


def test_what_goes_is_repeated_and_long_repeats_go(spark):
    """Word by word, without chunks: each word cut lies in 25 words that stand earlier too, and
    of 50 words that stand earlier none stay whole."""
    rng = random.Random(21)
    rows, _, _ = corpus(22)
    whole = [text for _, text in rows]
    rows += [(300 + i, f"{words(rng, 30)} {whole[i]} {words(rng, 30)}") for i in range(0, 20, 3)]
    rows += [(400, f"{whole[1]} {words(rng, 10)} {whole[1]}"), (401, whole[2]), (402, whole[2])]
    got = {r["doc_id"]: r["text"] for r in collected(sd.remove_repeats(documents(spark, rows)))}
    seen = {}
    for i, text in sorted(rows):
        own = text.split()
        repeated = [False] * len(own)
        for s in range(len(own) - sd.MIN_WORDS + 1):
            window = tuple(own[s : s + sd.MIN_WORDS])
            if seen.setdefault(window, (i, s)) != (i, s):
                repeated[s : s + sd.MIN_WORDS] = [True] * sd.MIN_WORDS
        left, at = got[i].split(), 0
        for word, again in zip(own, repeated):
            if at < len(left) and left[at] == word:
                at += 1
            else:
                assert again, (i, word)
        assert at == len(left)
        earlier = [t for j, t in rows if j < i]
        assert not shared_windows(got[i], earlier, 50), i
