"""Benchmark decontamination: each item's rarest words, then Smith-Waterman alignment.

An alignment that counts has a least number of matches, so an item can have only so
many words without one: of any more of its words than those, some must stand in a
short piece of the text. A first pass counts how often the items' words stand in
the documents; a second looks for pieces that hold enough of each item's rarest words,
then enough of all its words, and aligns the item with those. No text that would
reach the threshold is left out, however many documents hold the item or its words.
Both passes work inside a row, so nothing but counts is shuffled.

What goes to the executors is the words of one block of items, at most about
`BLOCK_WORDS` words, which is checked; more items make more blocks.

Defined results: a null or wordless text holds nothing, and neither does a null or
wordless item; equal items are all reported; repeated documents are judged each on
their own; every input column comes back in `doc`, so names cannot clash; item ids may be
of any type; very long texts are searched whole; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.textarrays import PUNCTUATION, Words, chunks, ranges

BLOCK_WORDS = 400_000
MATCH, MISMATCH, GAP = 2, -1, -1
THRESHOLD = 0.5
LEAST_MATCHES = 8
#: At most about so many (word, item) pairs of a piece of a batch are held at a time.
MAX_PAIRS = 2_000_000
_BITS = 22


def hits_type(item_id: T.DataType) -> T.ArrayType:
    return T.ArrayType(T.StructType([
        T.StructField("item_id", item_id), T.StructField("score", T.DoubleType()),
        T.StructField("start_word", T.LongType()), T.StructField("end_word", T.LongType()),
    ]))


@dataclass
class Items:
    """Items of one block: word hashes, and looked-up words sorted by (hash, item).

    A text can hold an item only if `hits` places within `reach` words have words looked up for it.
    """

    ids: list
    words: list[np.ndarray]
    distinct: np.ndarray  # words looked up
    pair: np.ndarray  # place in `distinct` * number of items + item
    hits: np.ndarray
    least: np.ndarray  # matches
    reach: np.ndarray
    bits: np.ndarray
    vocabulary: np.ndarray  # all words of the items
    held: np.ndarray  # place in `vocabulary` * number of items + item, sorted
    often: np.ndarray  # how often the item of `held` has that word


def _split(column: pa.Array) -> Words:
    return Words(column, lower=True, separators=PUNCTUATION)


def least_matches(size: int) -> int:
    """Matches that an item of `size` words has at least where it is found."""
    return int(np.ceil(max(THRESHOLD * size, min(size, LEAST_MATCHES) * 0.9) - 1e-9))


def reach(size: int) -> int:
    """Words of a text that the alignment of a found item spans at most: `size` matches, and errors that leave the score."""
    return 3 * size - 2 * least_matches(size) + 1


def _indexed(ids: list, words: list[np.ndarray], looked: list[np.ndarray], hits: np.ndarray) -> Items:
    distinct = np.unique(np.concatenate([np.zeros(0, np.uint64), *looked]))
    pair = [np.searchsorted(distinct, np.unique(w)) * len(ids) + i for i, w in enumerate(looked)]
    vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *words]))
    held = [np.searchsorted(vocabulary, w) * len(ids) + i for i, w in enumerate(words)]
    held, often = np.unique(np.concatenate([np.zeros(0, np.int64), *held]), return_counts=True)
    bits = np.zeros(1 << _BITS, dtype=bool)
    bits[(distinct & np.uint64((1 << _BITS) - 1)).astype(np.int64)] = True
    return Items(
        ids, words, distinct, np.sort(np.concatenate([np.zeros(0, np.int64), *pair])), hits,
        np.array([least_matches(len(w)) for w in words], dtype=np.int64),
        np.array([reach(len(w)) for w in words], dtype=np.int64), bits, vocabulary, held, often,
    )


def index(ids: list, texts: list[str]) -> Items:
    """All words of some items."""
    words = _split(pa.array(texts, type=pa.large_string()))
    each = [words.hash[words.first[i] : words.first[i + 1]] for i in range(len(ids))]
    return _indexed(ids, each, each, np.array([least_matches(len(w)) for w in each], dtype=np.int64))


def rarest(index: Items, times: np.ndarray) -> Items:
    """Look up only so many of each item's rarest words that a few must be there; `times` is how often each of `index.distinct` stands."""
    looked, hits = [], []
    for item in index.words:
        need = least_matches(len(item))
        hits.append(-(-need // 3))
        order = np.argsort(times[np.searchsorted(index.distinct, item)], kind="stable")
        looked.append(item[order[: len(item) - need + hits[-1]]])
    return _indexed(index.ids, index.words, looked, np.array(hits, dtype=np.int64))


def _places(words: Words, index: Items) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words that are looked up, and their places in `index.distinct`."""
    maybe = np.flatnonzero(index.bits[(words.hash & np.uint64((1 << _BITS) - 1)).astype(np.int64)])
    hash_ = words.hash[maybe]
    slot = np.searchsorted(index.distinct, hash_)
    slot[slot == len(index.distinct)] = 0
    good = index.distinct[slot] == hash_ if len(index.distinct) else np.zeros(0, bool)
    return maybe[good], slot[good]


def _candidates(words: Words, index: Items) -> Iterator[tuple[int, int, int, int]]:
    """(text, item, first and last word number) where enough looked-up words stand close, by item, then by place."""
    at, slot = _places(words, index)
    number = len(index.ids)
    low = np.searchsorted(index.pair, slot * number)
    total = int((np.searchsorted(index.pair, (slot + 1) * number) - low).sum())
    step = max(1, number // max(1, -(-total // MAX_PAIRS)))
    text = np.searchsorted(words.first, at, side="right") - 1
    for first in range(0, number, step):
        low = np.searchsorted(index.pair, slot * number + first)
        count = np.searchsorted(index.pair, slot * number + min(first + step, number)) - low
        which = np.repeat(np.arange(len(at)), count)
        begin = np.cumsum(count) - count
        item = index.pair[np.arange(len(which)) - begin[which] + low[which]] % number if len(which) else which
        order = np.argsort((item - first).astype(np.uint16 if step < 1 << 16 else np.int64), kind="stable")
        which, item = which[order], item[order]
        other = np.arange(len(which)) + index.hits[item] - 1
        start = np.flatnonzero(other < len(which))
        other = other[start]
        good = (item[start] == item[other]) & (text[which[start]] == text[which[other]])
        good &= at[which[other]] - at[which[start]] < index.reach[item[start]]
        start, other = start[good], other[good]
        yield from zip(
            text[which[start]].tolist(), item[start].tolist(), at[which[start]].tolist(), at[which[other]].tolist(), strict=True
        )


def _rows(item: np.ndarray, text: np.ndarray) -> tuple[float, int, int]:
    """Best local alignment score and where it ends in item and text (exclusive)."""
    steps = np.arange(len(text) + 1) * -GAP
    above = np.zeros(len(text) + 1)
    best, end, row = 0.0, 0, 0
    for i, word in enumerate(item):
        here = np.zeros(len(text) + 1)
        here[1:] = np.maximum(np.maximum(above[:-1] + np.where(text == word, MATCH, MISMATCH), above[1:] + GAP), 0)
        above = np.maximum.accumulate(here + steps) - steps
        j = int(above.argmax())
        if above[j] > best:
            best, end, row = float(above[j]), j, i + 1
    return best, row, end


def align(item: np.ndarray, text: np.ndarray) -> tuple[float, int, int]:
    """Local alignment of an item with a piece of text: share of a perfect score, start and end."""
    best, row, end = _rows(item, text)
    if best <= 0:
        return 0.0, 0, 0
    _, _, back = _rows(item[:row][::-1], text[:end][::-1])
    return best / (MATCH * len(item)), end - back, end


def _enough(words: Words, pieces: np.ndarray, index: Items) -> np.ndarray:
    """Which pieces (item, first and last word number) have, in some stretch as long as an alignment can be, as many of
    the item's words, each at most as often as the item has it, as an alignment that counts has matches.
    """
    number, low, high = pieces.T
    at, piece = ranges(low, high - low)
    hash_ = words.hash[at]
    slot = np.searchsorted(index.vocabulary, hash_)
    slot[slot == len(index.vocabulary)] = 0
    there = np.flatnonzero(index.vocabulary[slot] == hash_)
    key = slot[there] * len(index.ids) + number[piece[there]]
    entry = np.searchsorted(index.held, key)
    entry[entry == len(index.held)] = 0
    good = index.held[entry] == key
    there, entry = there[good], entry[good]
    # A stretch counts a place if it starts after the one that is the item's number of such words before.
    order = np.lexsort((there, entry, piece[there]))
    there, entry = there[order], entry[order]
    group = piece[there] * len(index.held) + entry
    earlier = np.arange(len(there)) - index.often[entry]
    bound = np.where((earlier >= 0) & (group[earlier] == group), there[earlier], -1)
    begin = np.cumsum(high - low) - (high - low)
    start = np.maximum(np.maximum(bound + 1, there - index.reach[number[piece[there]]] + 1), begin[piece[there]])
    size = len(at) + 1
    most = np.cumsum(np.bincount(start, minlength=size) - np.bincount(there + 1, minlength=size))[:-1]
    return np.maximum.reduceat(most, begin) >= index.least[number]


def _judge(words: Words, index: Items) -> dict[int, list[dict]]:
    """Items found in each text."""
    pieces: list[list[int]] = []  # text, item, first and last word number; those that overlap are one
    for i, number, a, b in _candidates(words, index):
        span = int(index.reach[number])
        a, b = max(int(words.first[i]), b - span + 1), min(int(words.first[i + 1]), a + span)
        if pieces and pieces[-1][:2] == [i, number] and a <= pieces[-1][3]:
            pieces[-1][3] = max(b, pieces[-1][3])
        else:
            pieces.append([i, number, a, b])
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    table = np.array(pieces, dtype=np.int64).reshape(-1, 4)
    parts = np.cumsum(table[:, 3] - table[:, 2]) // MAX_PAIRS
    good = [_enough(words, table[parts == part, 1:], index) for part in np.unique(parts)]
    for i, number, a, b in table[np.concatenate([np.zeros(0, bool), *good])].tolist():
        score, x, y = align(index.words[number], words.hash[a:b])
        if score > best.get((i, number), (0.0, 0, 0))[0]:
            base = a - int(words.first[i])
            best[i, number] = (score, base + x, base + y)
    found: dict[int, list[dict]] = {}
    for (i, number), (score, x, y) in sorted(best.items()):
        size = len(index.words[number])
        if score >= THRESHOLD and score * size >= min(size, LEAST_MATCHES) * 0.9:
            found.setdefault(i, []).append({"item_id": index.ids[number], "score": score, "start_word": x, "end_word": y})
    return found


def _times(docs: DataFrame, index: Items) -> np.ndarray:
    """How often each distinct word stands in the texts."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        total = np.zeros(len(items.distinct), dtype=np.int64)
        for batch in batches:
            for part in chunks(batch, "text"):
                total += np.bincount(_places(_split(part.column("text")), items)[1], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["word", "n"])

    total = np.zeros(len(index.distinct), dtype=np.int64)
    sums = docs.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    for r in sums.collect():  # a row a word of the block
        total[r.word] = r.n
    return total


def _mark(rows: DataFrame, index: Items) -> DataFrame:
    """Add to `hits` what is found of one block of items."""
    shared = rows.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for batch in batches:
            for part in chunks(batch, "text"):
                words = _split(part.column("text"))
                hits = part.column("hits").to_pylist()
                for i, found in _judge(words, items).items():
                    hits[i] = hits[i] + found
                columns = [part.column("doc"), part.column("text"), pa.array(hits, type=part.column("hits").type)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc", "text", "hits"])

    return rows.mapInArrow(run, rows.schema)


def contamination(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """`doc` (all input columns) and `hits`, the items (`item_id`, `text`) that a row's text holds.

    A hit's score is its alignment score over that of the whole item unchanged;
    `start_word` and `end_word` bound the aligned words, counted from 0.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(f"`{text}`").alias("text"),
        F.array().cast(hits_type(items.schema["item_id"].dataType)).alias("hits"),
    )
    items = items.select("item_id", "text").where(F.col("text").isNotNull() & F.col("item_id").isNotNull())
    words = items.agg(F.sum(F.size(F.split("text", r"\s+"))).alias("n")).first().n or 0
    blocks = max(1, -(-words // BLOCK_WORDS))
    for block in range(blocks):
        some = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        found = some.orderBy("item_id", "text").collect()  # about BLOCK_WORDS words
        whole = index([r.item_id for r in found], [r.text for r in found])
        if len(whole.distinct):
            rows = _mark(rows, rarest(whole, _times(docs.select(F.col(f"`{text}`").alias("text")), whole)))
    return rows.select("doc", "hits")
