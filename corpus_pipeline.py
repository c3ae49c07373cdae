"""A training corpus from ``documents``: five stages, each a DataFrame → DataFrame job.

Every stage works on all rows its predecessor kept. All but the last return
the columns of ``documents``; each result is written as Parquet and read again
as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import line_dedup, mixing, quality, sentencepiece_viterbi, simhash
from tessera.llm.common import materialise, table
from tessera.session import configure


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs, table(configure(spark), sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines go; every document stays. n_chars is not counted anew."""
    configure(spark)
    return line_dedup.line_dedup(docs)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    configure(spark)
    return simhash.keep_one(docs, shingle=3, max_distance=2)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    configure(spark)
    return mixing.mix(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and round_trip of every row."""
    configure(spark)
    return sentencepiece_viterbi.encode(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("simhash near-dedup", near_copy_stage),
    ("mixing to target weights", mixing_stage),
    ("sentencepiece encoding", encoding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Fingerprints, byte-level hashes and piece segmentation have no SQL form; tests/llm checks the stages by brute force.
ORACLE_SQL = None
