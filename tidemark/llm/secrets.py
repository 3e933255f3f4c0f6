"""Secret scans: named patterns plus sliding-window entropy over candidate strings.

Candidate strings are maximal runs of a character class, cut where a word of the allow-list
stands; runs that the allow-list knows as a whole are left out. A window slides over
each candidate; its Shannon entropy follows from counts that change by one character in
and one out per step. A candidate with a window at or above the class's limit is a span
from end to end, so nothing of a secret is left beside it. Spans inside a span found
before add nothing. All work on a text is linear in its length, apart from sorting spans.

Defined results: a null text counts as empty and has no span; repeated rows are
scanned each on their own; every input column comes back unchanged in `doc`, so
extra columns of any name are safe; very long texts are scanned whole; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.textarrays import LOWER, chunks, text_bytes

# The named patterns and the least length of what they must find.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
BASE_KINDS = ("assign", "access", "hex")


@dataclass(frozen=True)
class CharClass:
    """A class of characters, its window length, entropy limit in bits and what a window must mix."""

    kind: str
    runs: re.Pattern
    window: int
    limit: float
    needs: tuple[str, ...]


DIGITS, UPPER, SMALL = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CLASSES = (
    CharClass("entropy_hex", re.compile(r"[0-9A-Fa-f]{20,}"), 20, 3.0, (DIGITS, "ABCDEFabcdef")),
    CharClass("entropy_caps", re.compile(r"[A-Z0-9]{16,}"), 16, 3.2, (DIGITS, UPPER)),
    CharClass("entropy_mixed", re.compile(r"[A-Za-z0-9+/=_-]{20,}"), 20, 3.6, (DIGITS, UPPER, SMALL)),
)
KINDS = (*BASE_KINDS, *(c.kind for c in CLASSES))
LEAST_RUN = min(c.window for c in CLASSES)

# Words of placeholders, and whole strings that look random and are no secrets.
ALLOWED_WORDS = re.compile(r"(?i)example|changeme|placeholder|xxxx|0000000|1234567|deadbeef|abcdefg")
ALLOWED_RUNS = re.compile(
    r"(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
    r"|d41d8cd98f00b204e9800998ecf8427e|da39a3ee5e6b4b0d3255bfef95601890afd80709"
    r"|e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
)

_PLOGP = [0.0, *(c * math.log2(c) for c in range(1, 65))]
_IN_RUN = np.zeros(256, dtype=bool)
_IN_RUN[np.frombuffer((DIGITS + UPPER + SMALL + "+/=_-").encode(), dtype=np.uint8)] = True

SPAN = T.ArrayType(
    T.StructType([
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
    ])
)


def entropy_spans(run: str, kind: CharClass) -> list[tuple[int, int]]:
    """Merged windows of `run` whose entropy reaches the limit and that mix what they must."""
    n, found = kind.window, []
    counts: dict[str, int] = {}
    weight = 0.0  # sum of c * log2(c) over the characters in the window
    mixed = [0] * len(kind.needs)
    for i, char in enumerate(run):
        c = counts.get(char, 0)
        weight += _PLOGP[c + 1] - _PLOGP[c]
        counts[char] = c + 1
        for j, need in enumerate(kind.needs):
            mixed[j] += char in need
        if i >= n:
            gone = run[i - n]
            c = counts[gone]
            weight += _PLOGP[c - 1] - _PLOGP[c]
            counts[gone] = c - 1
            for j, need in enumerate(kind.needs):
                mixed[j] -= gone in need
        if i >= n - 1 and all(m >= 2 for m in mixed) and math.log2(n) - weight / n >= kind.limit - 1e-9:
            start, end = i - n + 1, i + 1
            if found and start <= found[-1][1]:
                found[-1] = (found[-1][0], end)
            else:
                found.append((start, end))
    return found


def pattern_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the named patterns, in code points."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= LEAST_HEX]
    return found


def candidates(text: str, kind: CharClass) -> Iterator[tuple[int, int]]:
    """Runs of the class, without allowed ones and cut at allowed words; long enough for a window."""
    for m in kind.runs.finditer(text):
        if ALLOWED_RUNS.fullmatch(m[0]):
            continue
        at = m.start()
        for word in ALLOWED_WORDS.finditer(m[0]):
            yield at, m.start() + word.start()
            at = m.start() + word.end()
        yield at, m.end()


class _Cover:
    """Whether an interval lies inside one of many others, by look-up."""

    def __init__(self, intervals: list[tuple[int, int]]):
        intervals = sorted(intervals)
        self.starts = [a for a, _ in intervals]
        self.ends = list(accumulate((b for _, b in intervals), max))

    def holds(self, start: int, end: int) -> bool:
        i = bisect_right(self.starts, start)
        return i > 0 and self.ends[i - 1] >= end


def spans_of(text: str) -> list[dict]:
    """All spans of one text, by start and then by the order of KINDS."""
    found = pattern_spans(text)
    for number, kind in enumerate(CLASSES, len(BASE_KINDS)):
        cover = _Cover([(a, b) for a, _, b in found])
        found += [
            (a, number, b) for a, b in candidates(text, kind)
            if b - a >= kind.window and not cover.holds(a, b) and entropy_spans(text[a:b], kind)
        ]
    return [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in sorted(found)]


def _flagged(column: pa.Array) -> np.ndarray:
    """Numbers of the texts that hold a keyword or a run long enough for any kind."""
    data, offsets = text_bytes(column)
    low = LOWER[data].tobytes()
    at = []
    for word in ASSIGN_WORDS:
        i = low.find(word)
        while i >= 0:
            at.append(i)
            i = low.find(word, i + 1)
    inside = np.concatenate([[False], _IN_RUN[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    where = np.concatenate([np.array(at, dtype=np.int64), start[end - start >= LEAST_RUN]])
    rows = np.searchsorted(offsets, where, side="right") - 1
    # A run may go on from one text into the next: take the texts it ends in, too.
    last = np.searchsorted(offsets, end[end - start >= LEAST_RUN] - 1, side="right") - 1
    keep = np.zeros(len(offsets), dtype=bool)
    keep[rows] = True
    for a, b in zip(rows[len(at):], last, strict=True):
        keep[a : b + 1] = True
    return np.flatnonzero(keep[:-1])


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """`doc` (all input columns) and `spans` of every row; offsets are code points, ends exclusive."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for part in chunks(batch, "text"):
                column = part.column("text")
                spans: list[list[dict]] = [[] for _ in range(part.num_rows)]
                for i in _flagged(column).tolist():
                    spans[i] = spans_of(column[i].as_py() or "")
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), pa.array(spans, type=kind)], names=["doc", "spans"]
                )

    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"), F.col(f"`{text}`").alias("text"))
    schema = T.StructType([rows.schema["doc"], T.StructField("spans", SPAN)])
    return rows.mapInArrow(scan, schema)


def masked(text: str, spans: list[dict], mask: str) -> str:
    """The text with every span replaced; overlapping ones, which come by start, count once."""
    parts, at = [], 0
    for span in spans:
        if span["start"] >= at:
            parts += [text[at : span["start"]], mask]
        at = max(at, span["end"])
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, text: str = "text", mask: str = "[secret]") -> DataFrame:
    """The rows of `docs` with every span of their text replaced by `mask`; overlaps count once."""
    place = docs.columns.index(text)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, place):
                column = part.column(place)
                clean = column.to_pylist()
                for i in _flagged(column).tolist():
                    if clean[i] is not None:
                        clean[i] = masked(clean[i], spans_of(clean[i]), mask)
                columns = [*part.columns]
                columns[place] = pa.array(clean, type=column.type)
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return docs.mapInArrow(scan, docs.schema)
