"""A training-corpus pipeline: quality rules, exact dedup, near dedup, secret redaction, packing.

Each stage reads all that its predecessor kept, and its decisions take effect. All but the last
return the columns of ``documents``.  A stage's result is written as Parquet to the shared folder
and read again, so a lost executor costs at most the stage that runs.

Nulls, empty tables, repeated rows and extra columns have the results that each operator defines.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strandloom.llm import best_fit, exact_dedup, jaccard_join, quality_rules, secret_scan
from strandloom.llm.common import materialize


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the threshold table rejects."""
    return quality_rules.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the row with the largest doc_id of each text."""
    return exact_dedup.keep_one(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the row with the least doc_id of each group of near copies."""
    return jaccard_join.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every reported secret in the texts; no document goes."""
    return secret_scan.redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the tokenised documents into sequences."""
    added = best_fit.added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    return best_fit.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, added=added)


STAGES = [("quality_rules", rules), ("exact_dedup", exact), ("jaccard_join", near), ("secret_scan", secrets), ("best_fit", packing)]

#: Token ids cannot be had in SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
