"""Alignment of tokens against the two libraries on whole texts."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from llm_helpers import AWKWARD, documents

from rowmill.llm import alignment as al
from rowmill.llm.common import tokenizer_path
from rowmill.llm.units import unit_codes

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tables():
    return al.Aligner(A, B)


def encoded(tables, text):
    """Groups of a whole text, by the libraries; None without tokens."""
    if not text:
        return None
    a = tables.a.encode(" " + text, add_special_tokens=False).ids
    b = tables.b.encode(text)
    wanted = (" " + text).encode()
    if b"".join(tables.bytes_a[i] for i in a) != wanted or b"".join(tables.bytes_b[i] for i in b) != wanted:
        return None
    ends_a = np.cumsum([len(tables.bytes_a[i]) for i in a]).tolist()
    ends_b = np.cumsum([len(tables.bytes_b[i]) for i in b]).tolist()
    groups, lo = [], 0
    for end in sorted(set(ends_a) & set(ends_b)):
        groups.append(([i for i, e in zip(a, ends_a) if lo < e <= end], [i for i, e in zip(b, ends_b) if lo < e <= end]))
        lo = end
    return groups


def brute(tables, rows):
    every = [(i, encoded(tables, t)) for i, t in rows]
    links = [Counter((x, y) for p, q in g or () for x in p for y in q) for _, g in every]
    n_docs = Counter(pair for own in links for pair in own)
    most = Counter()
    for (x, _), n in n_docs.items():
        most[x] = max(most[x], n)
    out = []
    for (i, g), own in zip(every, links):
        text = ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in g or ())
        out.append((
            i, sum(len(p) for p, _ in g or ()), sum(len(q) for _, q in g or ()), len(g or ()), sum(own.values()),
            sum(m for (x, y), m in own.items() if n_docs[x, y] == most[x]), sum(m * n_docs[p] for p, m in own.items()),
            hashlib.sha256(text.encode()).hexdigest() if g else "",
        ))
    pairs = {(x, y): (n, sum(own[x, y] for own in links), n == most[x]) for (x, y), n in n_docs.items()}
    return sorted(out, key=str), pairs


def found(spark, rows, **options):
    result, counts = al.align(documents(spark, rows, ["n_a", "block"]), A, B, **options)
    pairs = {(r["id_a"], r["id_b"]): (r["n_docs"], r["n_links"], r["best"]) for r in counts.collect()}
    return sorted((tuple(r) for r in result.collect()), key=str), pairs


SPECIAL = [
    (20, "<|endoftext|> and <s> </s>\n\n<unk>"), (21, "a\n\n\nb  c \n d\n e\t\tf  g　h"), (22, "▁hello"), (23, "naïve, e.g. Mr. x. (y); z!"),
    (24, " leading"), (25, "\nnewline first"), (26, "trailing \n\n"), (27, " "), (28, "\u0085x y z"), (29, "it's, I'll. don't!"),
    (30, "word " * 300), (31, "\r\nx\x0by\x1cz"), (32, "日本語 のテキスト、です。 emoji 😀😀 ok"),
]


@pytest.mark.parametrize("block_entries", [20, al.BLOCK_ENTRIES])
def test_equal_to_the_libraries(spark, tables, block_entries):
    rows = [(i, t if i != 5 else "lorem ipsum dolor sit amet " * 50) for i, t in AWKWARD] + SPECIAL
    wanted = brute(tables, rows)
    got = found(spark, rows, block_entries=block_entries)
    assert got[0] == wanted[0]
    assert got[1] == wanted[1]


def test_whole_documents(spark, sf_dir, tables):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert found(spark, rows)[0] == brute(tables, rows)[0]


def test_empty_table(spark):
    assert found(spark, []) == ([], {})


def test_bounded_units(tables, monkeypatch):
    few = al.Aligner(A, B, max_units=3)
    first = few.numbers([b" a", b" b"])
    assert few.numbers([b" b", b" c", b" d"]).tolist() == [0, 1, 2] and first.tolist() == [0, 1]
    assert few.texts == [tables.texts[i] for i in tables.numbers([b" b", b" c", b" d"])]


PIECES = st.sampled_from([" ", "  ", "\n", "\n\n", "\t", "a", "Be", "é", ".", ",", ")", "'s", "1", " ", "　", "\r", "日", "<s>", "!"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, min_size=1, max_size=14).map("".join))
def test_units_by_themselves_equal_the_whole(tables, text):
    import pyarrow as pa

    ends, codes, units = unit_codes(pa.array([" " + text], pa.large_string()), tables.joined)
    assert b"".join(units[c] for c in codes) == (" " + text).encode()
    a = [i for c in codes for i in tables.a.encode(units[c].decode(), add_special_tokens=False).ids]
    b = [i for c in codes for i in tables.b.encode("\n" + units[c].decode())[2:]]
    assert a == tables.a.encode(" " + text, add_special_tokens=False).ids
    assert b == tables.b.encode(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sets(st.integers(0, 99), min_size=1), min_size=1, max_size=6))
def test_bitmaps_hold_what_went_in(sets):
    docs = np.array([d for s in sets for d in sorted(s)])
    first = np.cumsum([0, *map(len, sets)])
    row, doc = al.unfold(al.bitmaps(docs, first, 100))
    assert [set(doc[row == i].tolist()) for i in range(len(sets))] == sets
