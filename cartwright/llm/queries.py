"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cartwright.llm import (bpe, decontaminate, divergence, licenses, minhash, pii, quality,
                            sharding, token_counts, token_files, toxicity, unit_dedup,
                            vector_codes)
from cartwright.llm.common import read_table


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(read_table(spark, sf_dir, "documents"),
                                public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                                public_tokenizers.PATTERN)


def op2_pii_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_documents(read_table(spark, sf_dir, "documents"))


def op3_toxicity_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(read_table(spark, sf_dir, "documents"),
                                    read_table(spark, sf_dir, "labels"))


def op4_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_documents(read_table(spark, sf_dir, "documents"),
                                        public_tokenizers.path("byte_bpe_50k.json"),
                                        public_tokenizers.PATTERN)


def op5_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_documents(read_table(spark, sf_dir, "documents"))


def op6_unit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unit_dedup.removed_from_documents(read_table(spark, sf_dir, "documents"))


def op6_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unit_dedup.removed_passages(read_table(spark, sf_dir, "documents"))


def op7_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op8_benchmark_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated_documents(read_table(spark, sf_dir, "documents"),
                                                read_table(spark, sf_dir, "benchmark"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_documents(read_table(spark, sf_dir, "documents"))


def op10_jump_hash_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"))


def op11_orc_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.write_documents(read_table(spark, sf_dir, "documents"),
                                       public_tokenizers.path("byte_bpe_50k.json"))


def op12_walsh_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(read_table(spark, sf_dir, "embeddings"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_bpe_round_trip, op2_pii_votes, op3_toxicity_neighbours, op4_prefix_token_counts,
        op5_quality_votes, op6_passage_dedup, op6_unit_dedup, op7_minhash_near_duplicates,
        op8_benchmark_tiling, op9_license_scan, op10_jump_hash_shards,
        op11_orc_token_files, op12_walsh_vector_codes, op13_source_divergence)}
