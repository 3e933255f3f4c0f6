"""Language-model scores of whole texts: word frequencies and a byte-context model.

Training rows are counted in one pass: words and byte grams are added up inside each
task before they are shuffled. Words frequent enough for a table of `HEAD_WORDS` are
looked up there; all other words of a text are joined with the full counts and
summed, so no word is left out. Frequent words never reach that join, so it has no
hot key. Likewise the trie that is looked up holds the most frequent contexts; what a text
has in other contexts is joined with probabilities worked out from all counts, in groups
of contexts that end alike.

A word is known by a 64-bit hash of its lower-cased bytes. Defined results: a null
text is empty and has its end alone; repeated rows are counted and scored as often
as they stand; without training rows every word is unknown and every byte alike; very long
texts are counted and scored whole; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import ppm
from tidemark.llm.textarrays import Words, chunks, signed, text_bytes
from tidemark.session import stage

HEAD_WORDS = 1 << 19
GROUP_GRAMS = 250_000  # about so many counted and wanted grams are worked on together
_FLUSH = 1_500_000
WORD, GRAM, TEXTS = 0, 1, 2


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(inverse, weights=np.concatenate([n for _, n in parts])).astype(np.int64)


def count(train: DataFrame) -> DataFrame:
    """kind, key, n: training counts of words and of byte grams, and the number of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {WORD: [], GRAM: []}

        def out(kind: int) -> Iterator[pa.RecordBatch]:
            if held[kind]:
                keys, n = _merge(held[kind])
                held[kind] = []
                for a in range(0, len(keys), 100_000):
                    k = keys[a : a + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(k), kind, np.int32)), pa.array(signed(k)), pa.array(n[a : a + 100_000])],
                        names=["kind", "key", "n"],
                    )

        texts = 0
        for batch in batches:
            for part in chunks(batch, "text"):
                texts += part.num_rows
                words = Words(part.column("text"), lower=True)
                held[WORD].append(np.unique(words.hash, return_counts=True))
                held[GRAM].append(ppm.grams(*text_bytes(part.column("text"))))
                for kind in (WORD, GRAM):
                    if sum(len(k) for k, _ in held[kind]) > _FLUSH:
                        held[kind] = [_merge(held[kind])]
                        if len(held[kind][0][0]) > _FLUSH // 2:
                            yield from out(kind)
        yield from out(WORD)
        yield from out(GRAM)
        yield pa.RecordBatch.from_arrays(
            [pa.array([TEXTS], pa.int32()), pa.array([0], pa.int64()), pa.array([texts], pa.int64())], names=["kind", "key", "n"]
        )

    rows = train.select("text").mapInArrow(run, "kind int, key long, n long")
    return rows.groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _most_frequent(counts: DataFrame, limit: int) -> DataFrame:
    """The rows of highest `n`, at most `limit` of them: all at or above some count."""
    bins = counts.groupBy(F.floor(F.log2("n") * 8).alias("bin")).count().orderBy(F.desc("bin")).collect()  # under 520 rows
    total, least = 0, None
    for r in bins:
        total += r["count"]
        if total > limit:
            break
        least = r.bin
    if least is None:
        return counts.where(F.lit(False))
    return counts.where(F.floor(F.log2("n") * 8) >= least)


@dataclass
class Model:
    """The trie of the most frequent contexts, all grams, their number, and those of contexts shorter than SUFFIX."""

    trie: ppm.Trie
    grams: DataFrame
    n: int
    low: list[tuple[np.ndarray, np.ndarray]]


def _sorted(found: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys, n = np.asarray(found.column("key"), np.int64), np.asarray(found.column("n"), np.int64)
    order = np.argsort(keys)
    return keys[order], n[order]


def _model(counts: DataFrame) -> Model:
    grams = counts.where(F.col("kind") == GRAM).select("key", "n")
    at = []
    for d in range(ppm.DEPTH):
        key = F.col("key").bitwiseAND(F.lit((1 << 8 * (d + 1)) - 1))
        at.append(grams.groupBy(key.alias("key")).agg(F.sum("n").alias("n")))
    at.append(grams)
    context = F.shiftright("key", 8)
    contexts = reduce(DataFrame.unionByName, [
        g.groupBy(context.alias("context")).agg(F.sum("n").alias("total"), F.count("*").alias("grams")).withColumn("depth", F.lit(d))
        for d, g in enumerate(at)
    ])
    # A context is never more frequent than one that it ends in, so the contexts from some level on hold all shorter ones.
    contexts = stage(contexts.withColumn("level", F.floor(F.log2("total") * 8)), "lm-contexts")
    bins = contexts.groupBy("level", "depth").agg(F.count("*").alias("contexts"), F.sum("grams").alias("grams")).collect()  # under 2,600 rows
    low = [_sorted(at[d].toArrow()) for d in range(ppm.SUFFIX)]  # at most 256 and 65,536 rows
    cells = ppm.MAX_CELLS // (len(low[0][0]) + 1)
    levels = sorted({r.level for r in bins}, reverse=True)
    least = None
    for level in levels:
        held = [r for r in bins if r.level >= level]
        most = max(sum(r.grams for r in held if r.depth == d) for d in range(ppm.DEPTH + 1))
        if least is not None and (most > ppm.MAX_GRAMS or sum(r.contexts for r in held) > cells):
            break
        least = level
    depths = []
    for d, g in enumerate(at):
        if least is not None and least > levels[-1]:
            kept = contexts.where((F.col("depth") == d) & (F.col("level") >= least)).select("context")
            g = g.withColumn("context", context).join(kept, "context", "left_semi")
        depths.append(_sorted(g.toArrow()))  # at most MAX_GRAMS rows
    trie = ppm.build(depths)
    trie.whole = len(trie.log10p) >= sum(r.contexts for r in bins)
    return Model(trie, grams, sum(r.grams for r in bins if r.depth == ppm.DEPTH), low)


def _rest(model: Model, wanted: DataFrame) -> DataFrame:
    """key, log10p of some (context, symbol) keys, from all counts."""
    wanted = stage(wanted.distinct(), "lm-wanted")
    parts = 1 + (wanted.count() + model.n) // GROUP_GRAMS
    part = F.pmod(F.xxhash64(F.shiftright("key", 8).bitwiseAND(F.lit((1 << 8 * ppm.SUFFIX) - 1))), F.lit(parts))
    shared = wanted.sparkSession.sparkContext.broadcast(model.low)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        keys = np.asarray(left.column("key"), np.int64)
        logs = ppm.exact(keys, np.asarray(right.column("of_key"), np.int64), np.asarray(right.column("n"), np.int64), shared.value)
        return pa.table({"key": keys, "log10p": logs})

    counted = model.grams.select(part.alias("of_part"), F.col("key").alias("of_key"), "n").groupBy("of_part")
    found = wanted.select(part.alias("part"), "key").groupBy("part").cogroup(counted).applyInArrow(run, "key long, log10p double")
    return stage(found, "lm-rest")


def _lists(text: np.ndarray, keys: np.ndarray, rows: int) -> tuple[pa.Array, pa.Array]:
    """For each of `rows` texts its distinct keys, and how often each stands there."""
    sort = np.lexsort((keys, text))
    text, keys = text[sort], keys[sort]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (keys[1:] != keys[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(keys))).astype(np.int32)
    edges = pa.array(np.searchsorted(text[at], np.arange(rows + 1)).astype(np.int32))
    return pa.ListArray.from_arrays(edges, pa.array(keys[at])), pa.ListArray.from_arrays(edges, pa.array(times))


def score(docs: DataFrame, training: Column, text: str = "text", keep: str = "doc_id") -> DataFrame:
    """Word counts, base score and model score of every row; the model learns from rows where `training` holds."""
    rows = docs.select(
        F.col(f"`{keep}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.coalesce(training, F.lit(True)).alias("training")
    )
    counts = stage(count(rows.where("training")), "lm-counts")
    words = counts.where(F.col("kind") == WORD)
    total = words.agg(F.sum("n").alias("n"), F.count("n").alias("v")).first()
    texts = counts.where(F.col("kind") == TEXTS).agg(F.sum("n").alias("n")).first().n or 0
    tokens = (total.n or 0) + texts
    distinct = total.v + (1 if texts else 0)
    head = _most_frequent(words, HEAD_WORDS).toArrow()  # at most HEAD_WORDS rows
    key, n = np.asarray(head.column("key"), np.int64), np.asarray(head.column("n"), np.int64)
    order = np.argsort(key)
    model = _model(counts)
    whole = model.trie.whole
    shared = docs.sparkSession.sparkContext.broadcast((key[order], np.log10(n[order] + 1.0), model.trie))
    model.trie = None  # the executors have it

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, logs, trie = shared.value
        bits = np.zeros(1 << 24, dtype=bool)
        bits[keys & ((1 << 24) - 1)] = True
        for batch in batches:
            for part in chunks(batch, "text"):
                column = part.column("text")
                words = Words(column, lower=True)
                hashes = signed(words.hash)
                where = np.flatnonzero(bits[hashes & ((1 << 24) - 1)])
                slot = np.searchsorted(keys, hashes[where])
                slot[slot == len(keys)] = 0
                hit = keys[slot] == hashes[where] if len(keys) else np.zeros(0, bool)
                found = np.zeros(len(hashes), dtype=bool)
                found[where[hit]] = True
                weight = np.zeros(len(hashes) + 1)
                weight[where[hit]] = logs[slot[hit]]
                n_words = words.counts()
                full = n_words > 0
                known, base = np.zeros(len(n_words), np.int64), np.zeros(len(n_words))
                known[full] = np.add.reduceat(np.append(found, False).astype(np.int64), words.first[:-1][full])
                base[full] = np.add.reduceat(weight, words.first[:-1][full])
                # The rest: each distinct word, or gram, of a text once, with how often it stands there.
                rest = np.flatnonzero(~found)
                left = _lists(np.searchsorted(words.first, rest, side="right") - 1, hashes[rest], len(n_words))
                scores, grams, text = ppm.walk(trie, *text_bytes(column))
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("training"), pa.array(n_words + 1), pa.array(known), pa.array(base),
                    pa.array(scores), *left, *_lists(text, grams, len(n_words)),
                ], names=["doc_id", "training", "n_tokens", "known", "logs", "score", "words", "times", "grams", "gram_times"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    first = rows.mapInArrow(run, (
        f"doc_id {kind}, training boolean, n_tokens long, known long, logs double, score double, words array<long>, times array<int>, "
        "grams array<long>, gram_times array<int>"
    ))
    first = stage(first.withColumn("row", F.monotonically_increasing_id()), "lm-rows")
    each = first.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select(
        "row", F.col("w.words").alias("key"), F.col("w.times").alias("times")
    )
    more = each.join(words.select("key", "n"), "key").groupBy("row").agg(
        F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more_logs")
    )
    end_known = 1 if texts else 0
    out = first.drop("words", "times", "grams", "gram_times").join(more, "row", "left")
    if not whole:
        pending = first.select("row", F.explode(F.arrays_zip("grams", "gram_times")).alias("g")).select(
            "row", F.col("g.grams").alias("key"), F.col("g.gram_times").alias("times")
        )
        tail = pending.join(_rest(model, pending.select("key")), "key").groupBy("row").agg(
            F.sum(F.col("times") * F.col("log10p")).alias("more_score"))
        out = out.join(tail, "row", "left").withColumn("score", F.col("score") + F.coalesce("more_score", F.lit(0.0)))
    logs = F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) + F.lit(float(np.log10(texts + 1.0)))
    return out.select(
        "doc_id", "training", "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0)) + end_known).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(float(np.log10(tokens + distinct + 1.0)))).alias("base_score"),
        "score",
    )
