"""The operators applied to the whole tables, one query each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import ann, chunks, decontam, hardneg, htmltext, licenses, mixing, neardup, quality, ranked, suffix, tokens, toxicity
from tessera.llm.common import read
from tessera.llm.oracle import ORACLE  # noqa: F401


def op1_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree: source / ten thousands / hundreds / id."""
    docs = read(spark, sf_dir, "documents")
    path = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.floor(F.col("doc_id") / 10000).cast("string"),
                       F.floor(F.col("doc_id") / 100).cast("string"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    files = docs.select(F.col("doc_id").alias("key"), F.when(F.col("doc_id").isNotNull(), path).alias("path"), "text")
    return licenses.scan(files).withColumnRenamed("key", "doc_id")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return tokens.token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op7_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.repeated_passages(read(spark, sf_dir, "documents")).drop("key")


def op9_one_bit_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 50 = 0"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.repeated_strings(read(spark, sf_dir, "documents"))


def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.main_text(read(spark, sf_dir, "pages"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.rank(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return hardneg.hard_negatives(vectors, vectors.where("vec_id % 50 = 0"))


QUERIES = {f.__name__: f for f in (
    op1_toxicity_fm, op2_license_scan, op3_decontamination, op4_token_counts, op5_minhash_neardup, op6_mixing, op7_quality_pu,
    op8_substring_dedup, op9_one_bit_neighbours, op10_suffix_dedup, op11_html_text, op12_ranked_search, op13_hard_negatives)}
