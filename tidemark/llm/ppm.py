"""Prediction by partial matching over bytes: a context trie with escapes and exclusion.

A node is a context of up to `DEPTH` preceding bytes; a symbol is a byte, or the end
of the text (byte 255, which no UTF-8 text holds; it also fills the context before a text). From the deepest
context known, a symbol seen there has its count over the total plus the number of
distinct symbols seen; the rest escapes to the next shorter context, where symbols
already excluded do not count; below the empty context all remaining bytes are alike.

As the model is fixed once trained, the probabilities of every symbol at every node,
escapes and exclusions worked in, are computed once; scoring walks the trie for all
positions of a batch at a time. The trie may hold only the most frequent contexts, each with
all its symbols, and with a context all shorter ones. Where a walk leaves such a trie, the
(context, symbol) key is handed out, and `exact` takes its probability from the counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from tidemark.llm.textarrays import chunks, ranges, text_bytes

DEPTH = 4
END = 255
SUFFIX = 2  # bytes at a context's end by which its grams are put together
#: The trie holds at most so many grams of one depth, and so many cells of probabilities; the rest is left to `exact`.
MAX_GRAMS = 2_000_000
MAX_CELLS = 24_000_000


@dataclass
class Trie:
    symbol: np.ndarray  # of each byte: its column, or the last one for bytes not seen
    child: np.ndarray  # [node, symbol of the byte before the context] -> node, or -1
    log10p: np.ndarray  # [node, symbol]
    whole: bool = True  # every context is a node


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts with DEPTH start bytes and one end byte each; positions to be coded, and the first of each text."""
    rows = len(offsets) - 1
    shift = np.repeat(np.arange(rows), np.diff(offsets)) * (DEPTH + 1) + DEPTH
    out = np.full(len(data) + rows * (DEPTH + 1), END, dtype=np.uint8)
    at = np.arange(len(data)) + shift
    out[at] = data
    ends = offsets[1:] + np.arange(rows) * (DEPTH + 1) + DEPTH
    first = offsets[:-1] + np.arange(rows)
    coded = np.empty(len(data) + rows, dtype=np.int64)
    coded[np.arange(len(data)) + np.repeat(np.arange(rows), np.diff(offsets))] = at
    coded[offsets[1:] + np.arange(rows)] = ends
    return out, coded, first


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (context, symbol) keys of some texts, the symbol in the lowest byte, and their counts."""
    out, coded, _ = padded(data, offsets)
    wide = out.astype(np.uint64)
    key = np.zeros(len(coded), dtype=np.uint64)
    for back in range(DEPTH, -1, -1):
        key = (key << np.uint64(8)) | wide[coded - back]
    return np.unique(key, return_counts=True)


def build(depths: list[tuple[np.ndarray, np.ndarray]]) -> Trie:
    """The trie of counted grams, `depths[d]` being (keys, counts) of contexts of d bytes."""
    seen = np.unique(depths[0][0] & 255) if len(depths[0][0]) else np.zeros(0, np.int64)
    width = len(seen)
    symbol = np.full(256, width, dtype=np.int64)
    symbol[seen] = np.arange(width)
    cells = MAX_CELLS // (width + 1)
    contexts, counts, parents = [np.zeros(1, np.int64)], [np.zeros((1, width))], [np.zeros(1, np.int64)]
    counts[0][0, symbol[depths[0][0] & 255]] = depths[0][1]
    for d in range(1, DEPTH + 1):
        keys, n = depths[d]
        context, inverse = np.unique(keys >> 8, return_inverse=True)
        total = np.bincount(inverse, weights=n, minlength=len(context))
        parent = np.searchsorted(contexts[-1], context & ((1 << 8 * (d - 1)) - 1))
        parent[parent == len(contexts[-1])] = 0
        keep = contexts[-1][parent] == context & ((1 << 8 * (d - 1)) - 1) if len(context) else np.zeros(0, bool)
        room = cells - sum(map(len, contexts))
        if keep.sum() > room:
            keep &= total > np.sort(total[keep])[::-1][room] if room > 0 else False
        number = np.cumsum(keep) - 1
        dense = np.zeros((int(keep.sum()), width), dtype=np.float32)
        good = keep[inverse] & (symbol[keys & 255] < width) if len(keys) else np.zeros(0, bool)
        dense[number[inverse[good]], symbol[keys[good] & 255]] = n[good]
        contexts.append(context[keep])
        counts.append(dense)
        parents.append(parent[keep])
    first = np.concatenate([[0], np.cumsum([len(c) for c in contexts])])
    inner = int(first[DEPTH])
    child = np.full((inner, width + 1), -1, dtype=np.int32)
    log10p = np.empty((int(first[-1]), width + 1), dtype=np.float32)
    for d in range(DEPTH + 1):
        if d:
            child[first[d - 1] + parents[d], symbol[contexts[d] >> 8 * (d - 1)]] = first[d] + np.arange(len(contexts[d]))
        for a in range(0, len(contexts[d]), 4096):
            here = np.arange(a, min(a + 4096, len(contexts[d])))
            log10p[first[d] + here] = _spread(counts, parents, d, here, width)
    return Trie(symbol, child, log10p)


def _spread(counts: list, parents: list, d: int, nodes: np.ndarray, width: int) -> np.ndarray:
    """log10 probabilities of all symbols at nodes of depth d; the last column is any byte never seen."""
    out = np.zeros((len(nodes), width + 1))
    excluded = np.zeros((len(nodes), width), dtype=bool)
    escape = np.zeros(len(nodes))
    with np.errstate(divide="ignore", invalid="ignore"):
        for depth in range(d, -1, -1):
            c = np.where(excluded, 0.0, counts[depth][nodes].astype(np.float64))
            total, distinct = c.sum(axis=1), (c > 0).sum(axis=1)
            p = escape[:, None] + np.log10(c / (total + distinct)[:, None])
            out[:, :width] = np.where(c > 0, p, out[:, :width])
            excluded |= c > 0
            escape = np.where(total > 0, escape + np.log10(distinct / np.maximum(total + distinct, 1)), escape)
            nodes = parents[depth][nodes]
        left = 256 - excluded.sum(axis=1)
        rest = escape - np.log10(np.maximum(left, 1))
    out[:, :width] = np.where(excluded, out[:, :width], rest[:, None])
    out[:, width] = rest
    return out


def walk(trie: Trie, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """log10 probability of each text, its end included, without the (context, symbol) keys that leave a trie that is not whole.

    These keys and the text of each come second and third.
    """
    out, coded, first = padded(data, offsets)
    columns = trie.symbol[out].astype(np.int32)
    node = np.zeros(len(coded), dtype=np.int32)
    width = trie.child.shape[1]
    child = trie.child.reshape(-1)
    walking = np.ones(len(coded), dtype=bool)
    for back in range(1, DEPTH + 1):
        following = child[np.where(walking, node, 0).astype(np.int64) * width + columns[coded - back]]
        walking &= following >= 0
        node = np.where(walking, following, node)
    each = trie.log10p.reshape(-1)[node.astype(np.int64) * trie.log10p.shape[1] + columns[coded]].astype(np.float64)
    left = np.flatnonzero(~walking) if not trie.whole else np.zeros(0, np.int64)
    each[left] = 0.0
    key = np.zeros(len(left), dtype=np.int64)
    for back in range(DEPTH, -1, -1):
        key = (key << 8) | out[coded[left] - back]
    total = np.add.reduceat(each, first) if len(first) else np.zeros(0)
    return total, key, np.searchsorted(first, left, side="right") - 1


def score(trie: Trie, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """log10 probability of each text under a whole trie."""
    return walk(trie, data, offsets)[0]


def exact(wanted: np.ndarray, keys: np.ndarray, counts: np.ndarray, low: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """log10 probability of each of some (context, symbol) keys.

    `keys` and `counts` are all grams whose contexts end in the same SUFFIX bytes as one that is
    wanted; `low[d]` those of contexts of d bytes, for d below SUFFIX.
    """
    depths = list(low)
    for d in range(SUFFIX, DEPTH + 1):
        at, inverse = np.unique(keys & ((1 << 8 * (d + 1)) - 1), return_inverse=True)
        depths.append((at, np.bincount(inverse, weights=counts, minlength=len(at))))
    out = np.empty(len(wanted))
    for a in range(0, len(wanted), 4096):
        todo = np.arange(a, min(a + 4096, len(wanted)))
        excluded, escape = np.zeros((len(todo), 256), dtype=bool), np.zeros(len(todo))
        for d in range(DEPTH, -1, -1):
            at, n = depths[d]
            context = (wanted[todo] >> 8) & ((1 << 8 * d) - 1)
            begin, end = np.searchsorted(at, context << 8), np.searchsorted(at, (context + 1) << 8)
            where, owner = ranges(begin, end - begin)
            c = np.zeros((len(todo), 256))
            c[owner, at[where] & 255] = n[where]
            c[excluded] = 0
            total, distinct = c.sum(axis=1), (c > 0).sum(axis=1)
            mine = c[np.arange(len(todo)), wanted[todo] & 255]
            hit = mine > 0
            out[todo[hit]] = escape[hit] + np.log10(mine[hit] / (total + distinct)[hit])
            more = np.where(total > 0, np.log10(np.maximum(distinct, 1) / np.maximum(total + distinct, 1)), 0.0)
            todo, excluded, escape = todo[~hit], (excluded | (c > 0))[~hit], (escape + more)[~hit]
        out[todo] = escape - np.log10(np.maximum(256 - excluded.sum(axis=1), 1))
    return out


def scores_of(trie: Trie, column: pa.Array, limit: int) -> Iterator[np.ndarray]:
    for part in chunks(pa.table({"text": column}), "text", limit):
        yield score(trie, *text_bytes(part.column("text")))
