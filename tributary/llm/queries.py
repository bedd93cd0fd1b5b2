"""Registered queries of the operators: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tributary.llm import (
    bpe,
    conversations,
    language_model,
    licenses,
    mixing,
    near_duplicates,
    neighbours,
    quality,
    resampling,
    sharding,
    suffixes,
    toxicity,
    warc,
)
from tributary.llm.common import read_table


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(read_table(spark, sf_dir, "documents"), vocabulary())


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(read_table(spark, sf_dir, "embeddings"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read_table(spark, sf_dir, "documents"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.join_documents(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "n_links"
    )


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"))


def op6_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.find_repeats(read_table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive_records(read_table(spark, sf_dir, "pages"), digests_only=True)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(read_table(spark, sf_dir, "documents"))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_damaged(read_table(spark, sf_dir, "conversations"))


def op13_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(read_table(spark, sf_dir, "documents"), vocabulary())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_bpe": op1_bpe,
        "op2_neighbours": op2_neighbours,
        "op3_quality": op3_quality,
        "op4_near_duplicates": op4_near_duplicates,
        "op5_licenses": op5_licenses,
        "op6_suffixes": op6_suffixes,
        "op7_warc": op7_warc,
        "op8_mixing": op8_mixing,
        "op9_toxicity": op9_toxicity,
        "op10_sharding": op10_sharding,
        "op11_resampling": op11_resampling,
        "op12_conversations": op12_conversations,
        "op13_attention": op13_attention,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL where it can express a query; the others are tested against
    brute-force versions in ``tests/llm``."""
    return {
        "op8_mixing": mixing.oracle_sql(),
        "op10_sharding": sharding.oracle_sql(),
        "op11_resampling": resampling.oracle_sql(),
        "op12_conversations": conversations.oracle_sql(),
    }
