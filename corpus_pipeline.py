"""A training corpus from the table ``documents``, in stages.

Each stage is (name, function of (spark, docs, sf_dir)) and works on all rows that the one
before it kept; results are written as Parquet between stages. All but the last return
the columns of the documents; n_chars follows the text where a stage cuts it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowmill.functions import stored
from rowmill.llm import bpe, decontaminate, quality, setsketch, substring_dedup
from rowmill.llm.common import table, tokenizer_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the base rules and the model of the labelled rows among them keep."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, at five-word shingles and a similarity of 0.8: the
    one with the smallest id, null ids last, of equal ids the first in the table as read. Each
    row is judged by its own text, also where rows share an id or have none; rows without words
    all stay."""
    number = "_row"
    while number in docs.columns:
        number += "_"
    # the numbers have to be the same in all that follows
    numbered = stored(docs.withColumn(number, F.monotonically_increasing_id()))
    found = setsketch.near_duplicates(numbered.select(number, "text"), key=number)
    ids = numbered.select(F.col(number).alias("node"), F.col("doc_id").alias("id"))
    place = F.struct(F.col("id").isNull().alias("last"), "id", "node")
    groups = found.select(F.col("doc_id").alias("node"), "component_id").join(ids, "node")
    first = groups.groupBy("component_id").agg(F.min(place).alias("first")).select(F.col("first.node").alias("kept"))
    kept = numbered.join(stored(first), F.col(number) == F.col("kept"), "left_semi")
    return kept.select(*docs.columns)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows; passages that an earlier document or an earlier place has are cut out."""
    return _recounted(substring_dedup.remove_repeats(docs))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows; words inside benchmark windows are cut out."""
    return _recounted(decontaminate.remove_benchmark(docs, table(spark, sf_dir, "benchmark")))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256): ids as little-endian uint32, and the digest
    of what they decode to."""
    path = tokenizer_path("byte_bpe_50k.json")
    return bpe.coded_and_decoded(docs, path, keep_table=False).select(
        "doc_id",
        F.expr("CAST(octet_length(ids) div 4 AS BIGINT)").alias("n_tokens"),
        "ids",
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def _recounted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


STAGES = [
    ("quality_rules", good_quality),
    ("near_dedup", one_of_each),
    ("substring_dedup", without_repeats),
    ("benchmark_decontamination", without_benchmark),
    ("bpe_encoding", tokens),
]

#: No stage but the cuts has a form in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
