"""Corpus pipeline: quality rules, exact dedup, near-duplicate join, mixing, SentencePiece.

Each stage works on all its predecessor kept: it is handed the documents that the stage before it
returned, and ``run`` writes every stage's result as Parquet in the shared scratch folder and reads
it again as the next one's input. What a stage wrote on its way is deleted when its result is
written, and a result when the next one is. All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.llm import exact_dedup, jaccard_join, mixing, quality_rules, sentencepiece_scan
from tabulon.llm.common import table
from tabulon.llm.queries import sentencepiece_model
from tabulon.session import delete_scratch, scratch_path, scratch_scope


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the adaptive ones."""
    return quality_rules.keep_good(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest doc_id."""
    return exact_dedup.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by near-duplicate links the one with the smallest doc_id."""
    return jaccard_join.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mixture of sources takes it."""
    return mixing.mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document taken: doc_id, n_tokens and its piece ids."""
    encoded = sentencepiece_scan.encode(docs, sentencepiece_model())
    return encoded.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("quality_rules", quality), ("exact_dedup", dedup), ("ngram_jaccard", near_dedup),
          ("mixing", mix), ("sentencepiece", tokenize)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline_{name}")
        with scratch_scope(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        if before:
            delete_scratch(spark, before)
        docs, before = spark.read.schema(kept.schema).parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL cannot express the last stage; tests/llm/test_pipeline.py holds every stage against SQL or
#: a brute-force version.
ORACLE_SQL = None
