"""The pipeline's stages. Each takes documents and returns those it keeps.

All but the last return the columns of what they are given. A null text is rejected
by the first stage; empty tables pass through all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, langid, neardup, packing, secrets
from tidemark.llm.queries import vocabulary_file


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents whose language is rejected; `lang` becomes what was recognised."""
    found = langid.predict(docs, langid.fit(docs.where(~langid.held_out())))
    kept = found.where(~F.col("rejected"))
    return kept.select(*[(F.col("lang_pred") if c == "lang" else F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return neardup.representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a benchmark item."""
    found = decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where(F.size("hits") == 0).select("doc.*")


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by a mark; `n_chars` follows the text."""
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(clean.schema["n_chars"].dataType))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of several lengths."""
    return packing.pack_documents(docs, vocabulary_file())
