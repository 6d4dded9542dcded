"""From raw documents to token files: quality rules, deduplication, decontamination, mixing, output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chunkloom.llm import odd_sketch, quality_rules, raking, suffix_arrays, token_planes
from chunkloom.llm.common import table
from chunkloom.llm.queries import tokenizer_path
from chunkloom.operators.storage import scratch_path, staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line rules keep, without their failed lines."""
    return quality_rules.kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8)."""
    return odd_sketch.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return suffix_arrays.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample in which sources, languages and topics have their target shares of the tokens."""
    return raking.sampled_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents, and from these files the place of each document."""
    path = scratch_path(spark, "tokens")
    token_planes.write_token_files(docs, path, tokenizer_path())
    return token_planes.document_digests(token_planes.token_files(spark, path))


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_output", token_output),
]

# Tokenising has no SQL form; tests compare the run with plain versions of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on what the one before wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
