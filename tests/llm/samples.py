"""Small tables for the training-data operators, odd cases included."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

#: Extra columns that the operators use as names of their own.
CLASHES = ["doc", "spans", "score", "label", "rank", "shard", "node", "key", "uid", "hits", "grp", "words", "kept", "rejected"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng: random.Random, n: int, letters: str = "abcdefghijklmno") -> list[str]:
    """Words of a skewed vocabulary."""
    return ["".join(rng.choice(letters) for _ in range(1 + min(int(rng.expovariate(0.35)), 9))) for _ in range(n)]


def prose(seed: int, n: int, letters: str = "abcdefghijklmno") -> str:
    rng = random.Random(seed)
    return " ".join(words(rng, n, letters))


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty, blank, one-word and very long texts, and repeated rows."""
    long = prose(1, 30_000)
    return [
        (None, None, None, None, None), (1, None, "en", "s", None), (2, "", "en", "s", 0), (3, " \n\t ", None, "s", 4),
        (4, "one", "en", None, 3), (5, "… ÄÖ   漢字 🙂", "de", "s", 9), (6, long, "en", "s", len(long)),
        (7, "same text of a few words", "en", "s", 24), (7, "same text of a few words", "en", "s", 24),
        (8, "same text of a few words", "fr", "s", 24), (None, "an id is missing here", "en", "s", 21),
    ]


def table(spark: SparkSession, rows: list[tuple], clashes: bool = False) -> DataFrame:
    docs = spark.createDataFrame(rows, SCHEMA)
    if clashes:
        docs = docs.selectExpr("*", *[f"'extra' AS `{name}`" for name in CLASHES])
    return docs


def saved(docs: DataFrame, folder) -> str:
    docs.write.parquet(f"{folder}/documents.parquet")
    return str(folder)
