"""Corpus pipeline: the documents table through five operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next stage's documents.  All but the last
return the columns of the documents.

Defined cases, besides those of the operators: rows equal in doc_id and text
are one document once duplicates are removed; rows with a null doc_id pass
every stage unless their own text is toxic or contaminated; a document whose
whole text was repeated stays with an empty text.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tessera.llm import chunks, decontam, mixing, neardup, toxicity  # noqa: E402
from tessera.llm.common import cut, read  # noqa: E402


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine rejects go."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    gone = neardup.near_duplicates(docs).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").dropDuplicates(["doc_id", "text"]).select(docs.columns)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand in an earlier document are cut out."""
    found = chunks.repeated_passages(docs).where("n_removed > 0").select(
        F.col("doc_id").alias("_cut_id"), F.col("key").alias("_cut_key"), F.col("kept").alias("_cut_text")) \
        .dropDuplicates(["_cut_id", "_cut_key"])
    out = docs.join(found, docs["doc_id"].eqNullSafe(F.col("_cut_id")) & (F.xxhash64(docs["text"]) == F.col("_cut_key")), "left")
    new = {"text": F.coalesce("_cut_text", docs["text"]),
           "n_chars": F.coalesce(F.length("_cut_text").cast("long"), docs["n_chars"])}
    return out.select(*[new[c].alias(c) if c in new else docs[c] for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, but for a few words, go."""
    return decontam.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each document is taken into the mix."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_neardup", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

# Trained models, similarity joins and chunking have no SQL form; the tests
# compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, f"stage-{name}")
    return docs
