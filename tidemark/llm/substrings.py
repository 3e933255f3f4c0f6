"""Substring dedup: every passage of `WINDOW` words that recurs is found exactly.

1. Anchors. In each window of words the run of `ANCHOR` words with the least hash is
   its anchor; equal windows have equal anchors, so a window can recur only if its
   anchor does. Anchors are counted over all texts.
2. Confirmed passages. The windows of one anchor place make a segment. Segments
   around recurring anchors are counted whole; where one stands alone, its windows
   are counted one by one. What stays single is recorded.
3. Automata. Texts are dealt by hash into shards of about `SHARD_BYTES`. Each shard
   compiles the recurring anchor phrases of its texts into an Aho-Corasick automaton
   and streams its texts through it. Every place found stands for its windows, less
   the single ones; the words they cover are what recurs.

Counting is combined before every shuffle, so a passage in a third of all texts costs
one row a shard. What is sent between steps is 64-bit hashes, always of a window
together with its anchor; phrases are compared as text.

Defined results: a null text has no words; texts shorter than a window lose nothing;
repeated rows are texts of their own, so a row of a window or more given twice loses
all of its words; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.textarrays import Words, chunks, ranges, signed, span_hash
from tidemark.session import stage

WINDOW = 35
ANCHOR = 8
SHARD_BYTES = 2_000_000


class Anchors:
    """Segments of some texts: for each anchor place the windows it is the anchor of.

    `place` is the anchor's first word, `hash` its words' hash, `low` and `high` the
    first and last start of its windows.
    """

    def __init__(self, words: Words, window: int = WINDOW, anchor: int = ANCHOR):
        self.words, self.window, self.anchor = words, window, anchor
        self.prefix = words.prefix()
        span = window - anchor + 1  # anchor places in a window
        starts = np.arange(max(len(words.hash) - anchor + 1, 0))
        gram = span_hash(self.prefix, starts, starts + anchor)
        long_enough = np.maximum(np.diff(words.first) - window + 1, 0)
        at, _ = ranges(words.first[:-1], long_enough)  # starts of all windows
        # The leftmost least of `span` hashes from each start on, by doubling.
        best = np.arange(len(gram))
        width = 1
        while width < span:
            step = min(width, span - width)
            other = best[np.minimum(np.arange(len(best)) + step, max(len(best) - 1, 0))] if len(best) else best
            best = np.where(gram[other] < gram[best], other, best)
            width += step
        chosen = best[at] if len(at) else at
        new = np.ones(len(at), dtype=bool)
        new[1:] = (chosen[1:] != chosen[:-1]) | (at[1:] != at[:-1] + 1)
        first = np.flatnonzero(new)
        self.place = chosen[first]
        self.hash = gram[self.place] if len(first) else np.zeros(0, np.uint64)
        self.low = at[first]
        self.high = at[np.append(first[1:], len(at)) - 1] if len(first) else at

    def segment_hash(self, which: np.ndarray) -> np.ndarray:
        """Hash of all words of a segment; where the anchor stands in it follows from them."""
        return span_hash(self.prefix, self.low[which], self.high[which] + self.window)

    def windows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts of all windows of some segments, their hashes, and the segment of each."""
        start, owner = ranges(self.low[which], self.high[which] - self.low[which] + 1)
        return start, span_hash(self.prefix, start, start + self.window), owner


def _shards(docs: DataFrame, text: str, keep: str) -> DataFrame:
    rows = docs.select(F.col(f"`{keep}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    shards = max(1, -(-size // SHARD_BYTES))
    return rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int"))


def recurring_anchors(rows: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """shard, anchor: the anchors that stand at more than one place, for each shard that has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                found = Anchors(Words(part.column("text")), window, anchor)
                text = np.searchsorted(found.words.first, found.place, side="right") - 1
                shard = np.asarray(part.column("shard"))[text]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(found.hash)), pa.array(shard, pa.int32())], names=["anchor", "shard"]
                )

    places = rows.select("text", "shard").mapInArrow(run, "anchor long, shard int")
    # Places of an anchor in a shard first, so that an anchor in every text is one row a shard after that.
    each = places.groupBy("anchor", "shard").agg(F.count("*").alias("n"))
    total = each.withColumn("total", F.sum("n").over(Window.partitionBy("anchor")))
    return total.where("total > 1").select("shard", "anchor")


def _right(table: pa.Table, kind: int) -> np.ndarray:
    kinds = np.asarray(table.column("kind"))
    return np.sort(np.asarray(table.column("hash"), np.int64)[kinds == kind])


def _member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values are in the sorted `among`."""
    if not len(among):
        return np.zeros(len(values), dtype=bool)
    slot = np.searchsorted(among, values)
    slot[slot == len(among)] = 0
    return among[slot] == values


ANCHORS, SINGLE = 0, 1


def _window_key(anchor: np.ndarray, window: np.ndarray) -> np.ndarray:
    return anchor ^ window


def single_windows(rows: DataFrame, recurring: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """shard, hash: windows with a recurring anchor that all the same stand at one place only."""

    def segments(left: pa.Table, right: pa.Table) -> pa.Table:
        wanted = _right(right, ANCHORS)
        out: list[list] = [[], [], [], []]
        for part in chunks(left, "text"):
            found = Anchors(Words(part.column("text")), window, anchor)
            which = np.flatnonzero(_member(signed(found.hash), wanted))
            _, hashes, owner = found.windows(which)
            edges = np.searchsorted(owner, np.arange(len(which) + 1))
            out[0].append(signed(found.hash[which]))
            out[1].append(signed(found.segment_hash(which)))
            out[2].append(signed(hashes))
            out[3].append(np.diff(edges))
        keys, segs, wins, sizes = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)
        # Within the shard each distinct segment once, with how often it stands there.
        order = np.lexsort((segs, keys))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (segs[order][1:] != segs[order][:-1]) | (keys[order][1:] != keys[order][:-1])
        at = np.flatnonzero(new)
        one = order[at]
        begin = np.concatenate([[0], np.cumsum(sizes)])[:-1] if len(sizes) else sizes
        index, _ = ranges(begin[one], sizes[one])
        shard = left.column("shard")[0].as_py() if left.num_rows else 0
        return pa.table({
            "shard": pa.array(np.full(len(one), shard, np.int32)), "anchor": pa.array(keys[one]), "segment": pa.array(segs[one]),
            "n": pa.array(np.diff(np.append(at, len(order)))),
            "windows": pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(sizes[one])]).astype(np.int32)), pa.array(wins[index])
            ),
        })

    right = recurring.select("shard", F.lit(ANCHORS).alias("kind"), F.col("anchor").alias("hash"))
    found = rows.groupBy("shard").cogroup(right.groupBy("shard")).applyInArrow(
        segments, "shard int, anchor long, segment long, n long, windows array<long>"
    )
    whole = found.groupBy("anchor", "segment").agg(
        F.sum("n").alias("n"), F.first("windows").alias("windows"), F.max("shard").alias("shard")
    )
    # An anchor all of whose segments recur needs no look at windows.
    mixed = whole.withColumn("least", F.min("n").over(Window.partitionBy("anchor"))).where("least = 1")
    each = mixed.select("anchor", "shard", "n", F.explode("windows").alias("window"))
    counted = each.groupBy("anchor", "window").agg(F.sum("n").alias("n"), F.max("shard").alias("shard"))
    return counted.where("n = 1").select("shard", F.col("anchor").bitwiseXOR(F.col("window")).alias("hash"))


def repeated_words(docs: DataFrame, text: str = "text", keep: str = "doc_id", window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """`keep`, n_words, the kept text (words joined by a space) and its word spans that recur, for every row."""
    rows = _shards(docs, text, keep)
    recurring = stage(recurring_anchors(rows, window, anchor), "passage-anchors")
    single = single_windows(rows, recurring, window, anchor)
    right = recurring.select("shard", F.lit(ANCHORS).alias("kind"), F.col("anchor").alias("hash")).unionByName(
        single.select("shard", F.lit(SINGLE).alias("kind"), "hash")
    )

    def locate(left: pa.Table, right: pa.Table) -> pa.Table:
        anchors, alone = _right(right, ANCHORS), _right(right, SINGLE)
        parts = list(chunks(left, "text"))
        found = [Anchors(Words(part.column("text")), window, anchor) for part in parts]
        automaton = _automaton(found, anchors, anchor)
        ids, counts, kept, spans = [], [], [], []
        for part, a in zip(parts, found, strict=True):
            here = _places(automaton, a)
            which = np.flatnonzero(here[a.place]) if len(a.place) else np.zeros(0, np.int64)
            start, hashes, owner = a.windows(which)
            again = start[~_member(signed(_window_key(a.hash[which][owner], hashes)), alone)]
            depth = np.zeros(len(a.words.hash) + 1, dtype=np.int64)
            np.add.at(depth, again, 1)
            np.add.at(depth, again + window, -1)
            gone = np.cumsum(depth)[:-1] > 0
            ids.append(part.column("doc_id").combine_chunks())
            for i in range(part.num_rows):
                lost = gone[a.words.first[i] : a.words.first[i + 1]]
                words = a.words.text_of(i)
                counts.append(len(words))
                edges = np.flatnonzero(np.diff(np.concatenate([[False], lost, [False]]).astype(np.int8)))
                spans.append(edges.reshape(-1, 2).tolist())
                kept.append(b" ".join([w for w, x in zip(words, lost.tolist(), strict=True) if not x] if lost.any() else words))
        flat = [pair for row in spans for pair in row]
        pairs = pa.StructArray.from_arrays(
            [pa.array([x[0] for x in flat], pa.int64()), pa.array([x[1] for x in flat], pa.int64())], names=["start", "end"]
        )
        sizes = np.concatenate([[0], np.cumsum([len(x) for x in spans])]).astype(np.int32)
        return pa.table({
            "doc_id": pa.chunked_array(ids) if ids else pa.array([], left.schema.field("doc_id").type),
            "n_words": pa.array(counts, pa.int64()), "kept": pa.array([k.decode() for k in kept], pa.string()),
            "repeated": pa.ListArray.from_arrays(pa.array(sizes), pairs),
        })

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.groupBy("shard").cogroup(right.groupBy("shard")).applyInArrow(
        locate, f"doc_id {kind}, n_words long, kept string, repeated array<struct<start: long, end: long>>"
    )


def _automaton(found: list[Anchors], anchors: np.ndarray, size: int):
    """An automaton of the shard's recurring phrases: words joined and enclosed by spaces."""
    import ahocorasick

    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    done: set[int] = set()
    for a in found:
        which = np.flatnonzero(_member(signed(a.hash), anchors))
        data, start, end = a.words.data, a.words.start, a.words.end
        for key, place in zip(a.hash[which].tolist(), a.place[which].tolist(), strict=True):
            if key not in done:
                done.add(key)
                words = data[start[place] : end[place + size - 1]].tobytes().split()
                automaton.add_word((b" " + b" ".join(words) + b" ").decode())
    if len(automaton):
        automaton.make_automaton()
    return automaton


def _places(automaton, a: Anchors) -> np.ndarray:
    """For every word, whether a phrase of the automaton starts there."""
    here = np.zeros(len(a.words.hash) + 1, dtype=bool)
    if not len(automaton):
        return here
    for i in range(len(a.words.first) - 1):
        low = int(a.words.first[i])
        if a.words.first[i + 1] - low < a.window:
            continue
        text = " " + " ".join(w.decode() for w in a.words.text_of(i)) + " "
        ends = [(end, size) for end, size in automaton.iter(text)]
        if ends:
            at = np.array(ends, dtype=np.int64)
            codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
            # A phrase starts at the space before its first word: count the spaces before it.
            spaces = np.cumsum(codes == 0x20)
            here[low + spaces[at[:, 0] - at[:, 1] + 1] - 1] = True
    return here


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
