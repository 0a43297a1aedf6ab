"""Corpus pipeline: each stage works on what the one before it kept.

The stages remove documents that the quality rules reject, lines that an earlier document has,
near-duplicates, and documents with a passage of the benchmark; the last one encodes what remains.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.llm import bpe, decontamination, line_dedup as lines, minhash, quality
from clickloom.llm.common import table
from clickloom.llm.queries import vocabulary_path
from clickloom.storage import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    judged = quality.apply(docs, quality.fit(docs))
    return judged.filter("kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines aligned with an earlier document go, and documents that are left without a word."""
    found = lines.line_dedup(docs)
    shorter = F.col("n_deleted") > 0
    left = found.filter(~shorter | F.col("text").rlike("[^\\x20\\x09-\\x0D]"))
    length = F.when(shorter, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", length).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return minhash.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    marked = decontamination.mark(docs, table(spark, sf_dir, "benchmark"))
    return marked.filter(F.size("hits") == 0).drop("hits")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts of whole texts, and digests of their ids and of the decoded text."""
    return bpe.round_trip(docs, vocabulary_path()).drop("text")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("bpe", encode),
]

# Patience alignment, MinHash, CGK search and BPE merges are beyond SQL; brute force tests them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
