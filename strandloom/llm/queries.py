"""One thin query for each training-data operator, over whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import best_fit, cover_dedup, exact_dedup, hilbert_shards, jaccard_join, lexical_search, mil_quality, prefix_bpe, quality_rules, secret_scan, spelling_groups, suffix_dedup, token_scan

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
END_OF_DOCUMENT = 50256


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards.hilbert_shards(_documents(spark, sf_dir))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_scan(_documents(spark, sf_dir)).drop("parts")


def op3_mil_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mil_quality.classify(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(_documents(spark, sf_dir)).drop("kept")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_documents(spark, sf_dir))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality_rules.quality_rules(_documents(spark, sf_dir)).select(*cols)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(_documents(spark, sf_dir))


def op8_token_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_scan.token_counts(_documents(spark, sf_dir), RANKS, public_tokenizers.PATTERN, END_OF_DOCUMENT)
    return counted.select("doc_id", "n_tokens")  # files and places differ from run to run


def op9_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_bpe.tokenize(_documents(spark, sf_dir), RANKS, public_tokenizers.PATTERN)


def op10_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(_documents(spark, sf_dir), RANKS, public_tokenizers.PATTERN, added=best_fit.added_tokens(VOCABULARY))


def op11_cover_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_dedup.cover_dedup(_documents(spark, sf_dir)).drop("kept")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups.spelling_groups(_documents(spark, sf_dir))


_ALL = (
    op1_hilbert_shards, op2_secret_scan, op3_mil_quality, op4_suffix_dedup, op5_exact_dedup, op6_quality_rules, op7_jaccard_join, op8_token_scan, op9_prefix_bpe, op10_best_fit,
    op11_cover_dedup, op12_lexical_search, op13_spelling_groups,
)
QUERIES = {f.__name__: f for f in _ALL}
ORACLES = {"op5_exact_dedup": exact_dedup.ORACLE, "op6_quality_rules": quality_rules.ORACLE, "op11_cover_dedup": cover_dedup.ORACLE, "op12_lexical_search": lexical_search.ORACLE}
