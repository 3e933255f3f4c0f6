"""The registered queries of the training-data operators, one per operator."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    decontaminate, langid, licenses, lmscore, merkle, neardup, packing, rulequality, secrets, sharding, substrings,
    tokenalign, topk,
)


def vocabulary_file(name: str = "word_bpe_49k.json") -> str:
    """An installed vocabulary; the one that packing uses unless another is given."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its words in windows that stand elsewhere, too."""
    found = substrings.repeated_words(_read(spark, sf_dir, "documents"))
    removed = F.aggregate("repeated", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence signatures of every document."""
    found = licenses.scan(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        F.col("doc.doc_id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from those not held out."""
    docs = _read(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~langid.held_out()).select("text", "lang"))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select(
        F.col("doc.doc_id").alias("doc_id"), langid.held_out("doc.doc_id").alias("held_out"), "lang_pred", "score", "rejected"
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards of equal counts, equal texts together as far as that allows."""
    placed = sharding.shard_documents(_read(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document, named by the id of one of its documents."""
    found = neardup.classes(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    named = found.where("uid = root").select("root", F.col("doc_id").alias("class_id"))
    return found.join(named, "root").select("doc_id", "class_id", (F.col("uid") == F.col("root")).alias("kept"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of windows of at most 2048 tokens."""
    return packing.pack_documents(_read(spark, sf_dir, "documents"), vocabulary_file())


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 largest inner products of every 50th embedding with all others."""
    vectors = topk.quantised(_read(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, whole or edited, one row for each such pair."""
    found = decontaminate.contamination(
        _read(spark, sf_dir, "documents").select("doc_id", "text"), _read(spark, sf_dir, "benchmark")
    )
    return found.select(F.col("doc.doc_id").alias("doc_id"), F.explode("hits").alias("hit")).select("doc_id", "hit.*")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word and byte-context scores of every document, learnt from those not held out."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    found = lmscore.score(_read(spark, sf_dir, "documents").select("doc_id", "text"), ~held_out)
    return found.select(
        "doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    found = secrets.find_secrets(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE_KINDS))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        F.col("doc.doc_id").alias("doc_id"),
        *[count(kind).alias(f"n_{kind}") for kind in secrets.BASE_KINDS],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chance of label 1 of every document, learnt from labelled ones not held out."""
    labels = _read(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    held_out = lambda key: F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))
    found = rulequality.scores(_read(spark, sf_dir, "documents"), labels, ~held_out("id"))
    return found.select(
        F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens that two vocabularies make of every document."""
    found = tokenalign.scored(
        _read(spark, sf_dir, "documents"), vocabulary_file("byte_bpe_50k.json"), vocabulary_file("piece_bpe_32k.model")
    )
    return found.select(F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and what a changed text gives."""
    docs = _read(spark, sf_dir, "documents")
    small = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    found = merkle.manifest(docs, altered={"text": F.when(touched, small).otherwise(F.col("text"))})
    folded = merkle.fold(F.col("altered"), F.col("path"))
    return found.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_license_scans": op2_license_scans,
    "op3_language_id": op3_language_id,
    "op4_sharding": op4_sharding,
    "op5_near_dedup": op5_near_dedup,
    "op6_packing": op6_packing,
    "op7_exact_topk": op7_exact_topk,
    "op8_decontamination": op8_decontamination,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_secret_scans": op10_secret_scans,
    "op11_quality_classifier": op11_quality_classifier,
    "op12_token_alignment": op12_token_alignment,
    "op13_merkle_manifest": op13_merkle_manifest,
}
ORACLES: dict[str, str] = {
    "op1_substring_dedup": r"""
        WITH texts AS (
          SELECT row_number() OVER () AS r, doc_id,
                 list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
          FROM documents
        ), windows AS (
          SELECT r, i, array_to_string(w[i : i + 34], ' ') AS s
          FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM texts)
        ), again AS (
          SELECT s FROM windows GROUP BY s HAVING count(*) > 1
        ), gone AS (
          SELECT DISTINCT r, unnest(range(i, i + 35)) AS k FROM windows SEMI JOIN again USING (s)
        ), words AS (
          SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM texts
        ), kept AS (
          SELECT r, string_agg(word, ' ' ORDER BY k) AS s, count(*) AS n FROM words ANTI JOIN gone USING (r, k) GROUP BY r
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(s, '')) AS kept_sha256
        FROM texts LEFT JOIN kept USING (r)
    """,
    "op7_exact_topk": """
        WITH sound AS (
          SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
          FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
          SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                 CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
          FROM sound q JOIN sound c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
        ), ranked AS (
          SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op13_merkle_manifest": """
        WITH RECURSIVE rows AS (
          SELECT row_number() OVER () AS r, coalesce('+' || lang, '') AS t, doc_id, source, lang, n_chars, text,
                 CASE WHEN doc_id IS NOT NULL AND xor(list_reduce(
                   list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
                   lambda crc, b: list_reduce(
                     list_prepend(xor(crc, b), list_transform(range(8), lambda i: CAST(0 AS BIGINT))),
                     lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 3 = 0
                 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS other
          FROM documents
        ), hashed AS (
          SELECT r, t, doc_id, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                 sha256(head || coalesce(strlen(other) || ':' || other, '-')) AS altered
          FROM (SELECT *, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                          || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head FROM rows)
        ), leaves AS (
          SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos, count(*) OVER (PARTITION BY t) AS n FROM hashed
        ), levels AS (
          SELECT t, 0 AS h, pos AS i, leaf AS node, n FROM leaves
          UNION ALL
          SELECT t, h + 1, i // 8, sha256(string_agg(node, '' ORDER BY i)), (max(n) + 7) // 8 FROM levels WHERE n > 1 GROUP BY t, h, i // 8
        ), subroots AS (
          SELECT t, node AS subroot, h, row_number() OVER (ORDER BY t) - 1 AS pos, count(*) OVER () AS n FROM levels WHERE n = 1
        ), tops AS (
          SELECT 0 AS h, pos AS i, subroot AS node, n FROM subroots
          UNION ALL
          SELECT h + 1, i // 8, sha256(string_agg(node, '' ORDER BY i)), (max(n) + 7) // 8 FROM tops WHERE n > 1 GROUP BY h, i // 8
        ), beside AS (
          SELECT l.r, v.h, v.node, v.i < l.pos // CAST(pow(8, v.h) AS BIGINT) AS before, v.i
          FROM leaves l JOIN levels v ON v.t = l.t AND v.n > 1 AND v.i // 8 = l.pos // CAST(pow(8, v.h + 1) AS BIGINT)
                                     AND v.i <> l.pos // CAST(pow(8, v.h) AS BIGINT)
          UNION ALL
          SELECT l.r, 1000 + v.h, v.node, v.i < s.pos // CAST(pow(8, v.h) AS BIGINT), v.i
          FROM leaves l JOIN subroots s ON s.t = l.t JOIN tops v ON v.n > 1 AND v.i // 8 = s.pos // CAST(pow(8, v.h + 1) AS BIGINT)
                                     AND v.i <> s.pos // CAST(pow(8, v.h) AS BIGINT)
        ), steps AS (
          SELECT l.r, v.h, v.n FROM leaves l JOIN (SELECT DISTINCT t, h, n FROM levels WHERE n > 1) v USING (t)
          UNION ALL
          SELECT l.r, 1000 + v.h, v.n FROM leaves l CROSS JOIN (SELECT DISTINCT h, n FROM tops WHERE n > 1) v
        ), sides AS (
          SELECT r, h, coalesce(string_agg(node, '' ORDER BY i) FILTER (before), '') AS x,
                 coalesce(string_agg(node, '' ORDER BY i) FILTER (NOT before), '') AS y
          FROM steps LEFT JOIN beside USING (r, h) GROUP BY r, h
        ), paths AS (
          SELECT r, list({'x': x, 'y': y} ORDER BY h) AS path, string_agg(x || y, '' ORDER BY h) AS s FROM sides GROUP BY r
        )
        SELECT doc_id, leaf, subroot, root, sha256(coalesce(s, '')) AS proof_sha256, folded_root, folded_root = root AS verified
        FROM (
          SELECT l.doc_id, l.leaf, b.subroot, (SELECT node FROM tops WHERE n = 1) AS root, p.s,
                 list_reduce(list_prepend({'x': l.altered, 'y': ''}, coalesce(p.path, [])),
                             lambda a, b: {'x': sha256(b.x || a.x || b.y), 'y': ''}).x AS folded_root
          FROM leaves l JOIN subroots b USING (t) LEFT JOIN paths p USING (r)
        )
    """,
}
