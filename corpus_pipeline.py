"""Corpus pipeline: quality rules, line dedup, SimHash near-dedup, suffix-array
dedup, packing. Each stage reads what its predecessor kept, from Parquet."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from hourglass.llm import line_dedup, packing, quality, simhash, suffix_dedup
from hourglass.llm.queries import PACKING_TOKENIZER, tokenizer_path
from hourglass.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of each source go; ``n_chars`` follows the text."""
    return line_dedup.strip_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest id."""
    return simhash.keep_one(docs)


def suffixes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go; ``n_chars`` follows the text."""
    return suffix_dedup.strip_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left, in full sequences."""
    return packing.packed_digest(docs, tokenizer_path(PACKING_TOKENIZER))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("suffix_dedup", suffixes),
    ("packing", packed),
]

#: Neither covering hashes over 64-bit counts nor tokenization is SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, "pipeline", f"{name}-{uuid.uuid4().hex}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
