import random
import re

import pyarrow as pa
import pytest

import corpus_pipeline
from rowmill.llm import substring_dedup as sd
from rowmill.llm.common import table
from llm_helpers import AWKWARD, SCHEMA, collected, documents
from test_setsketch import brute as brute_components
from test_text_scans import brute_counts, brute_hits

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """The rows after each stage, each written and read again."""
    docs, out = table(spark, sf_dir, "documents"), {"documents": None}
    out["documents"] = collected(docs)
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        out[name] = collected(docs)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == SCHEMA.names
    return out


def test_bad_rows_go_and_good_ones_stay(stages, spark, sf_dir):
    kept = {r["doc_id"] for r in stages["quality_rules"]}
    quality = {r["doc_id"]: r["quality"] for r in table(spark, sf_dir, "labels").collect()}
    for r in stages["documents"]:
        counts = brute_counts(r["text"])
        failed = counts["n_words"] < 20 or 100 * counts["n_repeat_words"] > 30 * counts["n_words"]
        if failed:
            assert r["doc_id"] not in kept
        elif r["doc_id"] in quality:
            assert (r["doc_id"] in kept) == bool(quality[r["doc_id"]])


def test_one_of_each_group_stays(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages["quality_rules"]]
    found = brute_components(rows, 5, 80)
    assert {r["doc_id"] for r in stages["near_dedup"]} == {i for i, c in found.items() if i == c}


def test_cuts_equal_brute_force(stages):
    rows = sorted((r["doc_id"], r["text"]) for r in stages["near_dedup"])
    seen, want = {}, {}
    for i, text in rows:
        chunks = sd.Chunks(pa.array([text]))
        own, gone = set(), set()
        for d, a, b in zip(chunks.digests.tolist(), chunks.starts.tolist(), chunks.stops.tolist()):
            if d in own or seen.get(d, i) != i:
                gone.update(range(a, b))
            own.add(d)
            seen.setdefault(d, i)
        want[i] = bytes(x for p, x in enumerate(text.encode()) if p not in gone).decode()
    got = {r["doc_id"]: r["text"] for r in stages["substring_dedup"]}
    assert got == want
    assert all(r["n_chars"] == len(r["text"]) for r in stages["substring_dedup"])


def test_benchmark_words_are_cut(stages, spark, sf_dir):
    items = [tuple(r) for r in table(spark, sf_dir, "benchmark").collect()]
    after = {r["doc_id"]: r["text"] for r in stages["benchmark_decontamination"]}
    for r in stages["substring_dedup"]:
        hit = brute_hits(r["text"], items)[1]
        words = lambda t: len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower()))
        if hit:
            assert words(r["text"]) - words(after[r["doc_id"]]) >= hit - 2
        else:
            assert after[r["doc_id"]] == r["text"]


def test_ids_decode_to_the_texts(stages):
    import hashlib

    want = {r["doc_id"]: hashlib.sha256(r["text"].encode()).hexdigest() for r in stages["benchmark_decontamination"]}
    assert {r["doc_id"]: r["decoded_sha256"] for r in stages["bpe_encoding"]} == want
    assert all(r["n_tokens"] * 4 == len(r["ids"]) for r in stages["bpe_encoding"])


@pytest.mark.parametrize("name", [n for n in STAGES if n != "bpe_encoding"])
def test_stages_take_awkward_and_no_rows(spark, sf_dir, name):
    docs = documents(spark, AWKWARD)
    got = STAGES[name](spark, docs, sf_dir)
    assert got.columns == docs.columns
    rows = collected(got)
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in rows)
    assert collected(STAGES[name](spark, documents(spark, []), sf_dir)) == []


def test_near_dedup_keeps_one_row_of_an_id(spark, sf_dir):
    got = collected(STAGES["near_dedup"](spark, documents(spark, AWKWARD), sf_dir))
    ids = [r["doc_id"] for r in got]
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 5, 6, 7, 8, 9] and ids.count(None) == 2


def test_near_dedup_judges_rows_by_their_own_texts(spark, sf_dir):
    """Ids that are shared, also by unrelated texts, and rows without one."""
    rng = random.Random(31)
    text = lambda n: " ".join(f"w{rng.randrange(400)}" for _ in range(n))
    a, b, c, d, e = (text(80) for _ in range(5))
    near = lambda t: t.replace(t.split()[40], "other", 1)
    rows = [(7, a), (7, b), (7, a), (3, near(a)), (None, a), (None, c), (None, near(c)), (9, d), (9, e), (None, e), (5, near(b)), (6, "")]
    docs = documents(spark, rows, ["_row"]).repartition(4)
    got = collected(STAGES["near_dedup"](spark, docs, sf_dir))
    # numbered in the order of ids, null ids last, every row is a document of its own
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    groups = brute_components([(n, rows[k][1]) for n, k in enumerate(order)], 5, 80)
    wanted = {n for n, g in groups.items() if n == g}
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted(
        (rows[order[n]][0] is None, rows[order[n]][0] or 0) for n in wanted
    )
    left = [r["text"] for r in got]
    assert sum(t in (a, near(a)) for t in left) == sum(t in (c, near(c)) for t in left) == 1
    assert d in left and left.count(e) == 1 and sum(t in (b, near(b)) for t in left) == 1
