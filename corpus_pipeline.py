"""A training corpus in five stages: quality rules, near-dedup, secret scans, source mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orelake.llm.common import stored, table
from orelake.llm.mixing import mixed_documents
from orelake.llm.near_dedup import one_of_each
from orelake.llm.packing import pack_in_order
from orelake.llm.quality_rules import keep_good
from orelake.llm.secret_scan import without_secrets


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands."""
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return one_of_each(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark."""
    return without_secrets(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix; any first part of the files follows the target weights,
    and so do the sequences that packing makes of it."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in the training sequences, which follow the order of the mix."""
    return pack_in_order(docs)


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("secret_scans", secret_scans),
          ("source_mixing", source_mixing), ("packing", packing)]

# Compression ratios, Markov scores and token ids are beyond SQL; tests/llm compares each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result but the last is written and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
