"""Operators that look at each text by itself: 2, 3, 6, 7, 10."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from rowmill.llm import bpe, decontaminate, html_text, quality, unigram
from rowmill.llm.common import table, tokenizer_path
from rowmill.llm.queries import ORACLES, QUERIES
from llm_helpers import AWKWARD, LONG, collected, documents

BYTE_BPE = tokenizer_path("byte_bpe_50k.json")
ATOMS = ["a", "b", " ", "  ", "\n", "\t", "'s", "!", "1", "é", " ", "\x1c", "<|endoftext|>", "\x85",
         "日本", "‍", "😀", "²", "_", "᠎", "\x00", " '", "\r\n", "ﬁ", "Ω"]


# --- 10: BPE ----------------------------------------------------------------------


def library_ids(texts):
    found = Tokenizer.from_file(BYTE_BPE).encode_batch_fast(texts, add_special_tokens=False)
    return [np.array(e.ids, np.uint32).tobytes() for e in found]


def test_units_give_the_librarys_ids():
    rng = random.Random(1)
    texts = ["".join(rng.choice(ATOMS) for _ in range(rng.randrange(14))) for _ in range(20000)]
    coder = bpe.UnitTable(BYTE_BPE, max_units=500)
    got = [x for i in range(0, len(texts), 700) for x in coder.encode(texts[i : i + 700])]
    assert got == library_ids(texts)
    lib = Tokenizer.from_file(BYTE_BPE)
    decoded = lib.decode_batch([np.frombuffer(x, np.uint32).tolist() for x in got], skip_special_tokens=False)
    assert [coder.decode(x) for x in got] == decoded == texts


def test_decoding_damaged_ids():
    coder = bpe.UnitTable(BYTE_BPE)
    lib = Tokenizer.from_file(BYTE_BPE)
    rng = random.Random(2)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(rng.randrange(6))]
        assert coder.decode(np.array(ids, np.uint32).tobytes()) == lib.decode(ids, skip_special_tokens=False)


def test_round_trip_of_awkward_rows(spark):
    got = collected(bpe.round_trip(documents(spark, AWKWARD, ["ids", "n_tokens"]), BYTE_BPE))
    want = Counter()
    for (i, text), ids in zip(AWKWARD, library_ids([t or "" for _, t in AWKWARD])):
        want[i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert Counter(tuple(r.values()) for r in got) == want
    assert collected(bpe.round_trip(documents(spark, []), BYTE_BPE)) == []
    docs = documents(spark, AWKWARD)
    apart = bpe.decode_documents(bpe.encode_documents(docs, BYTE_BPE), BYTE_BPE)
    assert collected(apart) == collected(bpe.coded_and_decoded(docs, BYTE_BPE))


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        bpe.UnitTable(tokenizer_path("word_bpe_49k.json"))


# --- 3: token counts ---------------------------------------------------------------


@pytest.mark.parametrize("fallback", [False, True])
def test_counts_follow_the_librarys_ties(fallback):
    pieces = [(x, -float(len(x))) for x in ["a", "b", "ab", "ba", "aba", "bab", "abab", "c", "é"]]
    data = [(f"<0x{i:02X}>", -4.0) for i in range(256)] if fallback else []
    lib = models.Unigram([("<unk>", 0.0), *pieces, *data], 0, fallback)
    counter = unigram.PieceCounter(pieces, fallback)
    rng = random.Random(3)
    for _ in range(3000):
        word = "".join(rng.choice("abcdé日") for _ in range(rng.randrange(1, 12)))
        assert counter.count(word)[0] == len(lib.tokenize(word)), word


def test_counts_of_the_public_vocabulary():
    vocabulary = unigram.read_vocabulary(tokenizer_path("piece_bpe_32k.model"))
    lib = models.Unigram([("<unk>", 0.0), *vocabulary], 0, False)
    counter = unigram.PieceCounter(vocabulary)
    for text in AWKWARD:
        for word in set((text[1] or "").split(" ")) - {""}:
            if len(word) < 1000:
                marked = unigram.WORD_MARK + word
                assert counter.count(marked)[0] == len(lib.tokenize(marked)), word


BYTES = [(f"<0x{i:02X}>", 0.0) for i in range(256)]


def library_totals(lib, scores, text):
    """(tokens, score) of a whole text by the library; a character in bytes is unknown."""
    tokens = [t.value for t in lib.tokenize("▁" + text.replace(" ", "▁"))] if text else []
    unknown = bytes(int(t[3:5], 16) for t in tokens if t not in scores).decode()
    lowest = min(scores.values()) - unigram.UNKNOWN_PENALTY
    return len(tokens), sum(scores[t] for t in tokens if t in scores) + lowest * len(unknown)


def test_whole_texts_have_the_librarys_counts(spark, sf_dir):
    path = tokenizer_path("piece_bpe_32k.model")
    scores = dict(unigram.read_vocabulary(path))
    assert "▁" * 16 in scores
    lib = models.Unigram([("<unk>", 0.0), *scores.items(), *BYTES], 0, True)
    rng = random.Random(5)
    made = ["".join(rng.choice(ATOMS + ["▁", "\n\n", "   ", "the"]) for _ in range(rng.randrange(14))) for _ in range(3000)]
    made += ["hello\nworld", "hello  world", " ", "\n", " \t\n ", "a" + " " * 40 + "b\r\n", LONG[:5000]]
    docs = documents(spark, [*enumerate(made), (-1, None)])
    docs = docs.unionByName(table(spark, sf_dir, "documents").withColumn("doc_id", F.col("doc_id") + 10000), True)
    want = {r.doc_id: library_totals(lib, scores, r.text or "") for r in docs.collect()}
    got = collected(unigram.token_counts(docs, path, byte_fallback=True, whole_text=True))
    assert {r["doc_id"]: (r["n_tokens"], r["score"]) for r in got} == want
    assert len(got) == docs.count()


@pytest.mark.parametrize("fallback", [False, True])
@pytest.mark.parametrize("pieces", [["a", "▁a", "▁▁"], ["a", "▁", "▁▁", "b\n"], ["a", "▁", "a▁b", "b"]])
def test_units_are_cut_where_nothing_spans(pieces, fallback):
    counter = unigram.PieceCounter([(p, -float(len(p))) for p in pieces], fallback)
    rng = random.Random(6)
    for _ in range(1000):
        text = "".join(rng.choice("ab  \né") for _ in range(rng.randrange(1, 12)))
        n_tokens, scores = counter.totals(*counter.units(pa.array([text, None, ""])))
        whole = counter.count("▁" + text.replace(" ", "▁"))
        assert [*zip(n_tokens, scores)] == [whole, (0, 0.0), (0, 0.0)], text


def test_the_query_counts_white_space(spark, tmp_path):
    texts = ["hello\nworld", "hello  world", "hello world"]
    documents(spark, [*enumerate(texts)]).write.parquet(f"{tmp_path}/documents.parquet")
    vocabulary = unigram.read_vocabulary(tokenizer_path("piece_bpe_32k.model"))
    lib = models.Unigram([("<unk>", 0.0), *vocabulary, *BYTES], 0, True)
    want = {i: library_totals(lib, dict(vocabulary), t) for i, t in enumerate(texts)}
    got = collected(QUERIES["op3_token_counts"](spark, str(tmp_path)))
    assert {r["doc_id"]: (r["n_tokens"], r["score"]) for r in got} == want
    assert len({*want.values()}) == 3


def test_token_counts_of_awkward_rows(spark):
    got = collected(unigram.token_counts(documents(spark, AWKWARD, ["n_words"]), tokenizer_path("piece_bpe_32k.model")))
    assert len(got) == len(AWKWARD)
    found = {r["doc_id"]: r for r in got}
    assert [found[i]["n_tokens"] for i in (2, 3, 4)] == [0, 0, 0] and found[3]["score"] == 0
    assert found[5]["n_words"] == 5 * 8000 and found[5]["n_tokens"] % 8000 == 0
    assert sum(r["doc_id"] == 1 for r in got) == 2
    assert collected(unigram.token_counts(documents(spark, []), tokenizer_path("piece_bpe_32k.model"))) == []


# --- 6: decontamination ------------------------------------------------------------


def brute_hits(text, items):
    def words(t):
        return re.findall(decontaminate.WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))

    own, hit, found = words(text), set(), set()
    for item, t in items:
        w = words(t)
        size = min(len(w), 10)
        for s in range(len(w) - size + 1 if w else 0):
            for p in range(len(own) - size + 1):
                if own[p : p + size] == w[s : s + size]:
                    hit.update(range(p, p + size))
                    if item is not None:
                        found.add(str(item))
    return len(own), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def planted(spark):
    rng = random.Random(4)
    vocabulary = ["alpha", "Beta", "gamma", "été", "x1", "日本"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 2, 3, 9, 10, 14])))) for i in range(12)]
    items += [(None, "alpha x1 x1"), (3, "gamma gamma"), (77, None), (78, "?!"), (10, "beta beta Beta beta")]
    docs = []
    for i in range(120):
        parts = [rng.choice(vocabulary + ["other", "é-é"]) for _ in range(rng.randrange(30))]
        if rng.random() < 0.4:
            parts.insert(rng.randrange(len(parts) + 1), (rng.choice(items)[1] or "").replace(" ", rng.choice(["  ", "-", ", "])))
        docs.append((i, " ".join(parts)))
    docs += AWKWARD
    frame = spark.createDataFrame(items, "item_id long, text string")
    return docs, items, documents(spark, docs, ["n_words", "spans", "item_ids"]), frame


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 60])
def test_hits_equal_brute_force(spark, block_bytes):
    docs, items, frame, benchmark = planted(spark)
    found = decontaminate.contamination(frame, benchmark, block_bytes)
    got = Counter(tuple(r.values()) for r in collected(found))
    want = Counter((i, *brute_hits(t, items)) for i, t in docs)
    assert got == want


def test_removed_spans_leave_no_hits_and_clean_texts_alone(spark):
    docs, items, frame, benchmark = planted(spark)
    clean = decontaminate.remove_benchmark(frame, benchmark)
    assert clean.columns == frame.columns and clean.count() == len(docs)
    untouched = Counter((i, t) for i, t in docs if not brute_hits(t, items)[1])
    assert not untouched - Counter((r["doc_id"], r["text"]) for r in collected(clean))
    dropped = decontaminate.remove_benchmark(frame, benchmark, mode="documents")
    assert Counter((r["doc_id"], r["text"]) for r in collected(dropped)) == untouched
    with pytest.raises(ValueError, match="mode"):
        decontaminate.remove_benchmark(frame, benchmark, mode="rows")


def test_an_empty_benchmark_hits_nothing(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    got = collected(decontaminate.contamination(documents(spark, AWKWARD), none))
    assert len(got) == len(AWKWARD) and not any(r["contaminated"] for r in got)
    assert collected(decontaminate.contamination(documents(spark, []), none)) == []


# --- 7: quality rules --------------------------------------------------------------


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    repeated = {i + k for i, w in enumerate(windows) if w in twice for k in range(8)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated),
    }


def test_counts_equal_brute_force(spark):
    rng = random.Random(6)
    rows = list(AWKWARD)
    for i in range(200):
        lines = [" ".join(rng.choice(["a", "b", "c#", "日本", "&|"]) for _ in range(rng.randrange(12))) for _ in range(rng.randrange(9))]
        rows.append((100 + i, rng.choice(["\n", "\r\n", "\n\t"]).join(lines)))
    got = collected(quality.quality(documents(spark, rows, ["kept", "n_words"]), None))
    want = Counter((i, *brute_counts(t).values()) for i, t in rows)
    assert Counter((r["doc_id"], *(r[c] for c in quality.COUNTS)) for r in got) == want
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert r["kept"] == (not r["base_failed"])
    assert collected(quality.quality(documents(spark, []), None)) == []


def test_model_tells_held_out_labels_apart(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    labels = table(spark, "/root/testdata/sf0.01", "labels")
    model = quality.fit(docs, labels.where("doc_id % 2 = 0"))
    held = quality.quality(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id")
    rows = [r for r in collected(held) if not r["base_failed"]]
    assert len(rows) > 100
    assert sum((r["probability"] >= 0.5) == bool(r["quality"]) for r in rows) >= 0.97 * len(rows)


def test_labels_that_teach_nothing(spark):
    docs = documents(spark, AWKWARD)
    for rows in ([], [(1, 1), (5, 1)], [(1, None), (None, 0)], [(999, 0), (998, 1)]):
        assert quality.fit(docs, spark.createDataFrame(rows, "doc_id long, quality int")) is None


def test_good_rows_keep_their_columns(spark):
    docs = documents(spark, AWKWARD, ["kept", "probability"])
    kept = quality.keep_good(docs, None)
    assert kept.columns == docs.columns
    want = [(i, t) for i, t in AWKWARD if brute_counts(t)["n_words"] >= 20 and t != LONG]
    assert [(r["doc_id"], r["text"]) for r in collected(kept)] == want


# --- 2: main text ------------------------------------------------------------------


@pytest.fixture(scope="module")
def model(spark):
    return html_text.fit(table(spark, "/root/testdata/sf0.001", "pages"))


FILL = "lorem ipsum dolor " * 20

PAGES = {
    "plain": ("<p>Hello &amp; welcome</p><p>to\n  this&nbsp;page</p>", "Hello & welcome\n\nto this page"),
    "roles": (
        f"<html><head><title>t</title><style>p{{}}</style></head><body><header><h1>Site</h1></header><nav><a href=x>m</a></nav>"
        f"<div id=wrap><div class='content'><h1>Title</h1><p>{FILL}</p><p>Short &lt;one&gt;.</p><div class=ad>Buy {FILL}</div>"
        f"<p>{FILL}<br>end</div><div class='sidebar'><p>{FILL}</p></div></div><div id='comments'><article class='comment'>"
        f"<p>{FILL}</p></article></div><div class='cookie-notice'><p>{FILL}</p></div><form><p>x</p></form><footer>f</footer>",
        f"Title\n\n{FILL.strip()}\n\nShort <one>.\n\n{FILL}end",
    ),
    "unclosed": (
        f"<body><article><h1>T</h1><p><b>one<br><p>two <script>var a='</p>';</script>three<ul><li>four<li>five</article><footer>x",
        "T\n\none\n\ntwo three\n\nfour\n\nfive",
    ),
    "empty": ("", ""),
    "nothing": (None, ""),
    "no tags": ("just text", "just text"),
    "no text": ("<html><body><nav>menu</nav></body></html>", ""),
    "cut off": ("<article><p>some words</p><a href='x", "some words"),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text(model, name):
    source, want = PAGES[name]
    assert model.main_text(source) == want


def test_marginals_equal_sums_over_all_states(model):
    page = html_text.parse("<body><div class=ad><p>a b</p></div><article><h1>t</h1><p>word word word word word word</p></article>")
    nodes, n = page.nodes, len(page.nodes)
    own = []
    for i, node in enumerate(nodes):
        odds = sum(model.odds.get(f, 0.0) for f in html_text.features(page, i))
        chance = 1 / (1 + np.exp(-odds))
        own.append((0.5, 0.5) if node.parent < 0 else (1 - chance, chance))
    total, on = 0.0, np.zeros(n)
    for state in range(1 << n):
        s = [(state >> i) & 1 for i in range(n)]
        p = np.prod([own[i][s[i]] * (model.after[s[nodes[i].parent]][s[i]] if i else 1) for i in range(n)])
        total += p
        on += p * np.array(s)
    assert np.allclose(model.marginals(page), on / total)


def test_generated_pages_are_exact(spark, model):
    """Pages of the table have one article with headline and paragraphs."""
    import html as entities

    for r in table(spark, "/root/testdata/sf0.01", "pages").collect():
        inside = re.search(r"(?s)<article>(.*)</article>", r["html"])[1]
        parts = [re.sub(r"</?b>", "", p.replace("<br>", " ")) for p in re.split(r"</?(?:p|h1)>", inside)]
        want = "\n\n".join(t for p in parts if (t := " ".join(entities.unescape(p).split())))
        assert model.main_text(r["html"]) == want


def test_extract_takes_awkward_rows(spark, model):
    rows = [(1, "u", "<p>a b c</p>"), (1, "u", "<p>a b c</p>"), (None, None, None), (2, None, ""), (3, "v", "<div>" * 3000 + LONG), (4, "w", "<")]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, text string, n_chars string")
    got = collected(html_text.extract(pages, model))
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    found = {r["page_id"]: r["text"] for r in got}
    assert found[1] == "a b c" and found[None] == found[2] == "" and found[3] == LONG.strip()
    empty = pages.where("false")
    assert collected(html_text.extract(empty, html_text.fit(empty))) == []


# --- SQL ---------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    from check import compare, connect

    folder = "/root/testdata/sf0.01"
    assert compare(spark, connect(folder), folder, name) == ""


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert sorted({int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES if n.startswith("op")}) == list(range(1, 14))
