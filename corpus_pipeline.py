"""The corpus pipeline: quality rules, near duplicates, repeated passages,
mixing, tokens. Each stage takes (spark, docs, sf_dir) and returns a frame;
all but the last return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tributary.llm import bpe, mixing, near_duplicates, quality, suffixes
from tributary.llm.common import read_table, stage_table
from tributary.llm.queries import vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.kept_documents(docs)


def near_duplicate_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_duplicates.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of passages that also start earlier in the corpus go."""
    return suffixes.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the mixed documents."""
    return bpe.encode_documents(docs, vocabulary())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicate_join),
    ("repeated_passages", repeated_passages),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

#: DuckDB has no suffix arrays, shingle joins or BPE; tests/llm compares with a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
