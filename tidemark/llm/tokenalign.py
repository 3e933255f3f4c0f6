"""Alignment of two tokenizers' tokens over the same bytes, by pointer jumping.

Tokenizer A takes a space and the text, B the text and adds the space itself, so both
cover the same bytes. Every token points to the token of the other side that reaches
farthest right among those that overlap it: the one that covers its last byte. Where an A
and a B token end together, A's is the terminal and points to itself, B's points to it.
All pointers of a batch are then doubled (each becomes the pointer of what it points to)
until none changes, a number of rounds logarithmic in the longest chain; what a token
points to then is its group's terminal. Links are all pairs of overlapping tokens.

A text is encoded once. Its distinct linked id pairs and their number are written; from them
come the corpus counts of all pairs. Pairs frequent enough for a table of `HEAD_PAIRS`
are looked up there, all others of a text are joined with the full counts, so no
pair is left out and frequent ones never reach the join.

Defined results: a null or empty text, and one whose tokens do not give back its
bytes (B replaces some characters), has no tokens and links: zeros. Repeated rows count as
often as they stand. Work is done on `CHUNK_BYTES` of text at a time, or one longer text.
The other columns are never read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.textarrays import chunks, ranges, text_bytes
from tidemark.session import stage

HEAD_PAIRS = 1 << 20
#: Text encoded at a time, or one longer text; distinct pairs looked up at a time, or those of one text.
CHUNK_BYTES = 200_000
CHUNK_PAIRS = 500_000

# How the byte-level vocabulary splits a text before its merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_of_char() -> dict[str, int]:
    """Byte-level entries write a byte as its own character if that is printable, else as one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Vocabulary:
    """The bytes of every id of one side, and its decimal digits with room for a separator."""

    def __init__(self, entries: list[bytes]):
        self.size = np.array([len(e) for e in entries], dtype=np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.size)])[:-1]
        self.pool = np.frombuffer(b"".join(entries), dtype=np.uint8)
        width = len(str(len(entries)))
        self.digits = np.zeros((len(entries), width + 1), dtype=np.uint8)
        self.places = np.array([len(str(i)) for i in range(len(entries))])
        for i in range(len(entries)):
            self.digits[i, : self.places[i]] = np.frombuffer(str(i).encode(), dtype=np.uint8)

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return self.pool[ranges(self.begin[ids], self.size[ids])[0]]


class ByteLevel:
    """Tokenizer A: a byte-level BPE file, its merges in the order of its ids."""

    def __init__(self, path: str):
        import tiktoken

        byte_of = _byte_of_char()
        with open(path, encoding="utf-8") as f:
            content = json.load(f)
        vocabulary, special = content["model"]["vocab"], {t["content"] for t in content["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in e): i for e, i in vocabulary.items() if e not in special}
        entries = [b""] * (max(vocabulary.values()) + 1)
        for e, i in ranks.items():
            entries[i] = e
        self.vocabulary = Vocabulary(entries)
        self._encoding = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self._encoding.encode_ordinary(" " + text) for text in texts]


class Pieces:
    """Tokenizer B: a sentencepiece model."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        entries = []
        for i in range(self._model.get_piece_size()):
            piece = self._model.id_to_piece(i)
            byte = re.fullmatch(r"<0x([0-9A-F]{2})>", piece) if self._model.is_byte(i) else None
            entries.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
        self.vocabulary = Vocabulary(entries)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1) if texts else []


@dataclass
class Side:
    """Tokens of some texts after each other: ids, byte ends, and where each text's tokens begin."""

    ids: np.ndarray
    end: np.ndarray
    first: np.ndarray


def _side(ids: list[list[int]], vocabulary: Vocabulary) -> Side:
    first = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
    flat = np.fromiter((i for x in ids for i in x), dtype=np.int64, count=int(first[-1]))
    return Side(flat, np.cumsum(vocabulary.size[flat]), first)


def _kept(side: Side, vocabulary: Vocabulary, good: np.ndarray) -> Side:
    """The same texts, those that are not good without tokens."""
    sizes = np.diff(side.first)
    ids = side.ids[np.repeat(good, sizes)]
    return Side(ids, np.cumsum(vocabulary.size[ids]), np.concatenate([[0], np.cumsum(np.where(good, sizes, 0))]))


def _gives_back(side: Side, vocabulary: Vocabulary, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts have tokens whose bytes are theirs."""
    upto = np.concatenate([[0], side.end])[side.first]
    good = np.diff(upto) == np.diff(offsets)
    if good.any():
        made = vocabulary.bytes_of(side.ids[np.repeat(good, np.diff(side.first))])
        begin, size = offsets[:-1][good], np.diff(offsets)[good]
        at, owner = ranges(begin, size)
        wrong = np.bincount(owner, weights=made != data[at], minlength=len(size)) > 0
        good[np.flatnonzero(good)[wrong]] = False
    return good


def terminals(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each A and each B token, the A token that ends its group; both sides end together."""
    reach = np.searchsorted(b_end, a_end)  # the B token over an A token's last byte
    back = np.searchsorted(a_end, b_end)
    a = np.where(b_end[reach] == a_end, np.arange(len(a_end)), len(a_end) + reach) if len(a_end) else reach
    to = np.concatenate([a, back])
    while True:
        further = to[to]
        if (further == to).all():
            return to[: len(a_end)], to[len(a_end) :]
        to = further


def overlaps(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of an A and a B token that share a byte."""
    a_start = np.concatenate([[0], a_end[:-1]]) if len(a_end) else a_end
    first = np.searchsorted(b_end, a_start, side="right")
    last = np.searchsorted(b_end, a_end)
    b, a = ranges(first, last - first + 1)
    return a, b


def _written(a: Side, b: Side, group_a: np.ndarray, group_b: np.ndarray, va: Vocabulary, vb: Vocabulary) -> list[str]:
    """Each text's groups as `a1,a2|b1;a3|b2,b3`, as bytes."""
    n = len(a.ids) + len(b.ids)
    # Groups stand in order on both sides, so a token's place follows from counts.
    spot_a = np.arange(len(a.ids)) + np.searchsorted(group_b, group_a)
    spot_b = np.arange(len(b.ids)) + np.searchsorted(group_a, group_b, side="right")
    width = max(va.digits.shape[1], vb.digits.shape[1])
    cells, places = np.zeros((n, width), dtype=np.uint8), np.zeros(n, dtype=np.int64)
    for side, spot, v in ((a, spot_a, va), (b, spot_b, vb)):
        cells[spot, : v.digits.shape[1]] = v.digits[side.ids]
        places[spot] = v.places[side.ids]
    mark = np.full(n, ord(","), dtype=np.uint8)
    if n:
        mark[spot_a[np.append(np.diff(group_a) != 0, True)]] = ord("|")
        mark[spot_b[np.append(np.diff(group_b) != 0, True)]] = ord(";")
    cells[np.arange(n), places] = mark
    out = cells[cells != 0].tobytes()
    upto = np.concatenate([[0], np.cumsum(places + 1)])[a.first + b.first]
    return [out[x : max(x, y - 1)] for x, y in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]


_loaded: dict[tuple[str, str], tuple[ByteLevel, Pieces]] = {}


def _tokenizers(a_path: str, b_path: str) -> tuple[ByteLevel, Pieces]:
    """One pair per process."""
    if (a_path, b_path) not in _loaded:
        _loaded[a_path, b_path] = ByteLevel(a_path), Pieces(b_path)
    return _loaded[a_path, b_path]


def aligned(
    docs: DataFrame, a_path: str, b_path: str, text: str = "text", keep: str = "doc_id", detail: bool = False
) -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, groups_sha256, and the distinct linked pairs with their number, of every row.

    A pair is A's id times B's number of ids, plus B's id. `detail` adds both sides' ids
    and, for each, the number of its group in the text.
    """
    extra = ("a_ids", "b_ids", "a_group", "b_group")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_tokens, b_tokens = _tokenizers(a_path, b_path)
        va, vb = a_tokens.vocabulary, b_tokens.vocabulary
        for batch in batches:
            for part in chunks(batch, "text", CHUNK_BYTES):
                column = part.column("text")
                texts = [t or "" for t in column.to_pylist()]
                a, b = _side(a_tokens.encode(texts), va), _side(b_tokens.encode(texts), vb)
                data, offsets = text_bytes(pa.array([" " + t for t in texts], pa.large_string()))
                good = np.array([t != "" for t in texts], dtype=bool)
                good &= _gives_back(a, va, data, offsets) & _gives_back(b, vb, data, offsets)
                a, b = _kept(a, va, good), _kept(b, vb, good)
                end_a, end_b = terminals(a.end, b.end)
                of, with_ = overlaps(a.end, b.end)
                row = np.searchsorted(a.first, of, side="right") - 1
                pair = a.ids[of] * len(vb.size) + b.ids[with_]
                order = np.lexsort((pair, row))
                pair, row = pair[order], row[order]
                new = np.ones(len(pair), dtype=bool)
                new[1:] = (pair[1:] != pair[:-1]) | (row[1:] != row[:-1])
                at = np.flatnonzero(new)
                times = np.diff(np.append(at, len(pair))).astype(np.int32)
                rows = np.arange(part.num_rows + 1)
                edges = pa.array(np.searchsorted(row[at], rows).astype(np.int32))
                written = _written(a, b, end_a, end_b, va, vb)
                last = np.append(np.diff(end_a) != 0, True) if len(end_a) else np.zeros(0, bool)
                groups = np.concatenate([[0], np.cumsum(last)])
                out = [
                    part.column("id"), pa.array(np.diff(a.first)), pa.array(np.diff(b.first)), pa.array(np.diff(groups[a.first])),
                    pa.array(np.diff(np.searchsorted(row, rows))),
                    pa.array([hashlib.sha256(w).hexdigest() if w else "" for w in written], pa.string()),
                    pa.ListArray.from_arrays(edges, pa.array(pair[at])), pa.ListArray.from_arrays(edges, pa.array(times)),
                ]
                if detail:
                    number = groups[:-1] if len(groups) > 1 else np.zeros(0, np.int64)
                    for side, group in ((a, number), (b, number[end_b] if len(end_b) else number)):
                        begin = number[end_a[np.minimum(a.first[:-1], len(a.ids) - 1)]] if len(a.ids) else np.zeros(part.num_rows, np.int64)
                        inside = group - np.repeat(begin, np.diff(side.first))
                        where = pa.array(side.first.astype(np.int32))
                        out += [pa.ListArray.from_arrays(where, pa.array(side.ids)), pa.ListArray.from_arrays(where, pa.array(inside))]
                    out[-3], out[-2] = out[-2], out[-3]
                yield pa.RecordBatch.from_arrays(out, names=names)

    names = ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times", *(extra if detail else ())]
    rows = docs.select(F.col(f"`{keep}`").alias("id"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"
    if detail:
        schema += "".join(f", {name} array<long>" for name in extra)
    return rows.mapInArrow(run, schema)


def pair_counts(texts: DataFrame, b_ids: int) -> DataFrame:
    """pair, n, and whether no pair of the same B id has a higher n (`best`), over all rows of `aligned`."""
    counts = texts.select(F.inline(F.arrays_zip("pairs", "times"))).groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("n"))
    counts = stage(counts, "align-counts")
    highest = counts.groupBy((F.col("pair") % b_ids).alias("b")).agg(F.max("n").alias("most"))
    found = counts.join(highest, F.col("pair") % b_ids == F.col("b"))
    return stage(found.select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "align-pairs")


def _head(counts: DataFrame) -> DataFrame:
    """The most frequent pairs, at most HEAD_PAIRS: all at or above some count."""
    bins = counts.groupBy(F.floor(F.log2("n") * 8).alias("bin")).count().orderBy(F.desc("bin")).collect()  # under 520 rows
    total, least = 0, None
    for r in bins:
        total += r["count"]
        if total > HEAD_PAIRS:
            break
        least = r.bin
    return counts.where(F.lit(False) if least is None else F.floor(F.log2("n") * 8) >= least)


def scored(docs: DataFrame, a_path: str, b_path: str, text: str = "text", keep: str = "doc_id") -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, groups_sha256, n_best and count_sum of every row."""
    b_ids = len(Pieces(b_path).vocabulary.size)
    texts = stage(aligned(docs, a_path, b_path, text, keep).withColumn("row", F.monotonically_increasing_id()), "align-texts")
    counts = pair_counts(texts, b_ids)
    head = _head(counts).toArrow()  # at most HEAD_PAIRS rows
    keys = np.asarray(head.column("pair"), np.int64)
    order = np.argsort(keys)
    table = (keys[order], np.asarray(head.column("n"), np.int64)[order], np.array(head.column("best").to_pylist(), dtype=bool)[order])
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            upto = np.asarray(batch.column("pairs").offsets, np.int64)
            cuts = np.flatnonzero(np.diff((upto[1:] - upto[0]) // CHUNK_PAIRS)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                yield looked_up(batch.slice(a, b - a))

    def looked_up(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, n, best = shared.value
        lists, amounts = batch.column("pairs"), batch.column("times")
        first = np.asarray(lists.offsets, np.int64)
        first = first - first[0]
        pair, times = np.asarray(lists.flatten(), np.int64), np.asarray(amounts.flatten(), np.int64)
        slot = np.searchsorted(keys, pair)
        slot[slot == len(keys)] = 0
        hit = keys[slot] == pair if len(keys) else np.zeros(len(pair), bool)
        rest = np.flatnonzero(~hit)
        edges = pa.array(np.searchsorted(rest, first).astype(np.int32))
        times_hit = np.where(hit, times, 0)
        sums = [times_hit * best[slot], times_hit * n[slot]] if len(keys) else [times_hit, times_hit]
        return pa.RecordBatch.from_arrays([
            *[batch.column(c) for c in kept], *[pa.array(np.diff(np.concatenate([[0], np.cumsum(x)])[first])) for x in sums],
            pa.ListArray.from_arrays(edges, pa.array(pair[rest])), pa.ListArray.from_arrays(edges, pa.array(times[rest])),
        ], names=[*kept, "n_best", "count_sum", "pairs", "times"])

    kept = [c for c in texts.columns if c not in ("pairs", "times")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in texts.select(*kept).schema)
    first = stage(texts.mapInArrow(
        run, f"{schema}, n_best long, count_sum long, pairs array<long>, times array<long>"
    ), "align-head")
    each = first.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    more = each.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum")
    )
    out = first.drop("pairs", "times").join(more, "row", "left")
    return out.select(
        "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
    )
