"""Queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowmill.llm import alignment, bpe, ctw, decontaminate, hard_negatives, html_text, quality, setsketch, substring_dedup, suffix_dedup
from rowmill.llm import token_files, unigram, warc
from rowmill.llm.common import scratch, table, tokenizer_path

TOKENIZER = tokenizer_path("byte_bpe_50k.json")
PIECES = tokenizer_path("piece_bpe_32k.model")
#: The id that ends each document in token files.
END_ID = 2


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80).drop("class_id")


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.fit(pages))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.token_counts(table(spark, sf_dir, "documents"), PIECES, byte_fallback=True, whole_text=True)


def op4_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"), scratch(spark))


def op5_context_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    return ctw.score_texts(table(spark, sf_dir, "documents"), fold == 1)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.quality(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), report=True)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_token_files(
        table(spark, sf_dir, "documents"), TOKENIZER, END_ID, scratch(spark)
    )
    return token_files.read_token_files(manifest).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), TOKENIZER)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = hard_negatives.integer_vectors(table(spark, sf_dir, "embeddings").withColumn("label", moved))
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), TOKENIZER, PIECES)[0]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_main_text": op2_main_text,
    "op3_token_counts": op3_token_counts,
    "op4_warc_archive": op4_warc_archive,
    "op5_context_tree_scores": op5_context_tree_scores,
    "op6_decontaminate": op6_decontaminate,
    "op7_quality_rules": op7_quality_rules,
    "op9_substring_dedup": op9_substring_dedup,
    "op8_token_files": op8_token_files,
    "op10_bpe_round_trip": op10_bpe_round_trip,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_token_alignment": op13_token_alignment,
}

BENCHMARK_WORDS = r"""regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLES: dict[str, str] = {
    "op1_near_duplicates": r"""WITH RECURSIVE t AS (
        SELECT doc_id, row_number() OVER () AS r, list_filter(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
      sets AS (SELECT doc_id, r, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
          ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
        FROM t),
      members AS (SELECT doc_id, unnest(s) AS x FROM sets),
      pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
        FROM members a JOIN members b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
      links AS (SELECT a, b FROM pairs JOIN sets p ON p.doc_id = a JOIN sets q ON q.doc_id = b
        WHERE 100 * common >= 80 * (len(p.s) + len(q.s) - common)),
      sym AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
      reach AS (SELECT doc_id AS a, doc_id AS b FROM sets
        UNION SELECT reach.a, sym.b FROM reach JOIN sym ON reach.b = sym.a),
      found AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
      SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id,
        doc_id = component_id AS kept FROM sets JOIN found USING (doc_id)""",
    "op4_warc_archive": """WITH p AS (
        SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
      d AS (SELECT page_id, octet_length(payload) AS n, sha1(payload) AS h FROM p),
      g AS (SELECT *, min(page_id) OVER (PARTITION BY h, n) AS first FROM d)
      SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
        array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
          CAST(((CAST('0x' || substr(h, CAST(5 * (i // 4) + 1 AS INTEGER), 5) AS BIGINT)
            >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) + 1 AS INTEGER), 1)), '') AS payload_digest,
        CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
      FROM g""",
    "op6_decontaminate": rf"""WITH d AS (
        SELECT doc_id, row_number() OVER () AS r, {BENCHMARK_WORDS} AS w FROM documents),
      b AS (SELECT item_id, {BENCHMARK_WORDS} AS w FROM benchmark),
      starts AS (SELECT item_id, w, least(10, len(w)) AS size,
          unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM b WHERE len(w) > 0),
      windows AS (SELECT DISTINCT item_id, size, array_to_string(w[s:s + size - 1], ' ') AS k FROM starts),
      sizes AS (SELECT DISTINCT size FROM windows),
      places AS (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d, sizes
          WHERE len(w) >= size),
      hits AS (SELECT r, p.size, s, item_id FROM
          (SELECT r, size, s, array_to_string(w[s:s + size - 1], ' ') AS k FROM places) p
          JOIN windows v ON p.size = v.size AND p.k = v.k),
      marked AS (SELECT r, count(DISTINCT word) AS n_hit FROM
          (SELECT r, unnest(range(s, s + size)) AS word FROM hits) GROUP BY r),
      listed AS (SELECT r, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS name FROM hits
                WHERE item_id IS NOT NULL) GROUP BY r)
      SELECT doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words,
        CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
        sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
      FROM d LEFT JOIN marked USING (r) LEFT JOIN listed USING (r)""",
    "op11_hard_negatives": """WITH r AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
          list_transform(embedding, lambda x: floor(256e0 * CAST(x AS DOUBLE))) AS v,
          row_number() OVER () AS r FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      scored AS (SELECT a.r AS anchor, a.vec_id AS anchor_id, a.label = c.label AS same, c.r, c.vec_id,
          CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
        FROM r a JOIN r c ON a.vec_id % 100 = 0 AND a.r <> c.r),
      positives AS (SELECT anchor, anchor_id, r, vec_id AS positive_id, score AS positive_score FROM scored
        WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST, r) <= 5),
      pairs AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, CAST(row_number() OVER (
          PARTITION BY anchor, p.r ORDER BY s.score DESC, s.vec_id NULLS LAST, s.r) AS INTEGER) AS rank
        FROM positives p JOIN scored s USING (anchor)
        WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
      SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
      FROM pairs WHERE rank <= 10""",
    # bytes as pairs of hexadecimal digits; a repeated window covers 400 of them
    "op12_suffix_dedup": """WITH t AS (
        SELECT doc_id, row_number() OVER () AS r, hex(encode(coalesce(text, ''))) AS h FROM documents),
      windows AS (SELECT r, s, hash(substr(h, 2 * s + 1, 800)) AS k
        FROM (SELECT r, h, unnest(range(length(h) // 2 - 399)) AS s FROM t WHERE length(h) >= 800)),
      repeated AS (SELECT k FROM windows GROUP BY k HAVING count(*) > 1),
      hits AS (SELECT r, s, lag(s) OVER (PARTITION BY r ORDER BY s) AS before
        FROM windows SEMI JOIN repeated USING (k)),
      numbered AS (SELECT r, s, sum(CASE WHEN before IS NULL OR s > before + 400 THEN 1 ELSE 0 END)
          OVER (PARTITION BY r ORDER BY s) AS span FROM hits),
      spans AS (SELECT r, span, min(s) AS a, max(s) + 400 AS b FROM numbered GROUP BY r, span),
      edges AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM spans),
      parts AS (SELECT r, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
          string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
        FROM edges JOIN t USING (r) GROUP BY r)
      SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes,
        CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
        sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
      FROM t LEFT JOIN parts USING (r)""",
}
