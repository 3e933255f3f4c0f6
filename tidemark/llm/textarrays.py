"""Whole Arrow text columns as numpy arrays: words, word hashes and n-gram hashes.

Everything works on the UTF-8 bytes of a batch at once; a batch is cut into
pieces of about `CHUNK_BYTES`, always between rows, so memory stays bounded by
that and by the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1_000_000

_WORD_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_GRAM_BASE = np.uint64(0xD6E8FEB86659FD93)
_LENGTH = np.uint64(0xD1B54A32D192ED03)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: Separators of words made of letters, digits and whatever is not ASCII.
PUNCTUATION = np.ones(256, dtype=bool)
PUNCTUATION[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def _inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


class _Powers:
    """Powers of one base modulo 2**64, grown on demand and reused."""

    def __init__(self, base: np.uint64):
        self.base, self.values = base, np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.values) < n:
            steps = np.full(max(n, 1 << 20), self.base, dtype=np.uint64)
            steps[0] = 1
            self.values = np.multiply.accumulate(steps)
        return self.values[:n]


_word_up, _word_down = _Powers(_WORD_BASE), _Powers(_inverse(_WORD_BASE))
_gram_up, _gram_down = _Powers(_GRAM_BASE), _Powers(_inverse(_GRAM_BASE))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a text column and the offset of each row; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(table: pa.Table | pa.RecordBatch, text: str = "text", limit: int = CHUNK_BYTES) -> Iterator:
    """Slices of whole rows whose texts make up about `limit` bytes each."""
    if not table.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(table.column(text)), 0)
    part = np.cumsum(np.asarray(lengths, dtype=np.int64)) // limit
    cuts = np.flatnonzero(np.diff(part)) + 1
    edges = [0, *cuts.tolist(), table.num_rows]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield table.slice(a, b - a)


class Words:
    """The words of some texts: runs without `separators`, which are ASCII white space if not given.

    `first[i]:first[i + 1]` are the words of text i; `start`, `end` their byte
    positions in `data`; `hash` a 64-bit hash of each word's bytes.
    """

    def __init__(self, column: pa.Array, lower: bool = False, separators: np.ndarray = _SPACE):
        data, self.offsets = text_bytes(column)
        self.data = data = LOWER[data] if lower else data
        n = len(data)
        inside = ~separators[data]
        cut = np.zeros(n + 1, dtype=bool)
        cut[self.offsets] = True
        before = np.zeros(n, dtype=bool)
        before[1:] = inside[:-1] & ~cut[1:n]
        after = np.zeros(n, dtype=bool)
        after[:-1] = inside[1:] & ~cut[1:n]
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, self.offsets)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(data * _word_up.upto(n) if n else data, out=sums[1:], dtype=np.uint64)
        self._sums = sums
        self.hash = self.bytes_hash(self.start, self.end)

    def bytes_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of the bytes start:end."""
        down = _word_down.upto(max(len(self.data), 1))
        # The length tells words apart that differ in bytes of value 0 at their ends.
        return mix((self._sums[end] - self._sums[start]) * down[start] + (end - start).astype(np.uint64) * _LENGTH)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self, i: int) -> list[bytes]:
        """The words of text i."""
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes().split()

    def prefix(self) -> np.ndarray:
        """Running sums from which `span_hash` takes the hash of any run of words."""
        n = len(self.hash)
        sums = np.zeros(n + 1, dtype=np.uint64)
        if n:
            np.cumsum(self.hash * _gram_up.upto(n), out=sums[1:], dtype=np.uint64)
        return sums


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the word runs start:end; equal runs have equal hashes wherever they stand."""
    if not len(start):
        return np.zeros(0, np.uint64)
    down = _gram_down.upto(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def ranges(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All integers first[i] .. first[i] + size[i] - 1, and for each the i it belongs to."""
    owner = np.repeat(np.arange(len(size)), size)
    begin = np.concatenate([[0], np.cumsum(size)[:-1]]) if len(size) else np.zeros(0, np.int64)
    return (first - begin)[owner] + np.arange(len(owner)), owner


def gram_starts(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Start word of every run of k words within one text, and the text's number."""
    return ranges(first[:-1], np.maximum(np.diff(first) - k + 1, 0))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
