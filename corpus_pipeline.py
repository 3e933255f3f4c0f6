"""The corpus pipeline: STAGES run in order, each on what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import stages
from tidemark.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", stages.language_id),
    ("near_dedup", stages.near_dedup),
    ("decontamination", stages.decontamination),
    ("secret_scans", stages.secret_scans),
    ("packing", stages.packing_stage),
]

#: Alignment, entropy windows and the tokenizer are beyond SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to `documents`; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
