"""Corpus pipeline: quality rules, near-duplicates, repeated passages, benchmark
passages, packing. Every stage works on all that its predecessor kept, and the
stages up to the last return the columns of ``documents``.

Packing needs a tokenizer and the cut of repeated bytes leaves text that SQL
cannot state, so there is no SQL for the whole; the stages are tested one by
one against their operators' brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from nbsieve.llm import decontaminate, near_dedup, packing, quality, suffix_dedup
from nbsieve.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of smallest id."""
    return near_dedup.keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes of 200-byte strings that occur twice."""
    return suffix_dedup.without_repeats(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences of at most 2048 ids."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_passages", benchmark_passages),
    ("packing", pack_sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage-{name}")
    return docs
