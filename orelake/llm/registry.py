"""Registered queries of the subpackage and their DuckDB SQL; each operator over its whole table."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelake.llm import sql
from orelake.llm.common import table
from orelake.llm.grammar_ids import read_documents, write_shards
from orelake.llm.importance import importance_resample
from orelake.llm.lm_scoring import lm_score
from orelake.llm.mixing import mix_sources
from orelake.llm.near_dedup import near_duplicates
from orelake.llm.packing import pack_documents
from orelake.llm.quality_rules import quality_rules
from orelake.llm.ranked_resample import target_resample
from orelake.llm.secret_scan import secret_scan
from orelake.llm.substring_dedup import kept_digest, remove_repeats
from orelake.llm.threshold_clusters import cluster
from orelake.llm.token_counts import token_counts
from orelake.llm.voronoi_knn import knn_join
from orelake.session import scratch_path


def op1_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn_join(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op2_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op3_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


def op4_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def op5_large_item_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score(table(spark, sf_dir, "documents"))


def op8_pretoken_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op9_superkmer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept_digest(remove_repeats(table(spark, sf_dir, "documents")))


def op10_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_repair_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token_ids")
    write_shards(table(spark, sf_dir, "documents"), path)
    return read_documents(spark, path)


def op12_threshold_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings")).drop("compared")


def op13_ranked_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _shipped(query):
    """The query, with the package sent to the Python workers where their search path lacks it."""
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        package = Path(__file__).resolve().parents[1]
        root = package.parent
        sc = spark.sparkContext
        if (str(root) not in os.environ.get("PYTHONPATH", "").split(os.pathsep) and Path.cwd() != root
                and not any(f.endswith(f"/{package.name}.zip") for f in sc.listFiles)):
            path = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
            with zipfile.ZipFile(path, "w") as out:
                for f in sorted(package.rglob("*.py")):
                    out.write(f, f.relative_to(root))
            sc.addPyFile(str(path))
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_voronoi_knn, op2_compression_bands, op3_markov_secrets, op4_pfair_mix, op5_large_item_packing,
           op6_order_minhash, op7_deleted_interpolation, op8_pretoken_counts,
           op9_superkmer_dedup, op10_importance_resampling, op11_repair_ids, op12_threshold_clusters,
           op13_ranked_resample)
    return {f.__name__: _shipped(f) for f in own} | {"pipeline": _shipped(corpus_pipeline.run)}


def oracle_sql() -> dict[str, str]:
    return dict(sql.ORACLE)
