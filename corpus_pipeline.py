"""The training-data pipeline: documents -> token ids, in five stages.

Each stage is written as Parquet and read again; the next one works on all rows it
kept.  The first four return rows of ``documents`` with all its columns, the last one
the token ids of what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskmart.llm import decontaminate, exact_dedup, quality_resampling, signature_tree, viterbi_pieces
from riskmart.llm.common import new_path, table
from riskmart.llm.queries import PIECES


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality sample rejects go."""
    return quality_resampling.kept(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document of the largest doc_id stays."""
    return exact_dedup.deduplicated(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at a similarity of 0.8 stays."""
    return signature_tree.one_of_each(docs, signature_tree.Settings(words=5, percent=80))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    return decontaminate.clean(spark, docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every document left."""
    return viterbi_pieces.encoded(docs, PIECES)


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("decontamination", benchmark),
          ("sentencepiece", tokens)]

# Scores, seeds and pieces are no matter of SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
