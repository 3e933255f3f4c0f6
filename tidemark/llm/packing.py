"""Hierarchical packing of token sequences into windows of several lengths.

Documents are dealt by hash into groups of about `GROUP_BYTES` of text; a group is
tokenised and packed in one task. Whole windows of the longest tier come off first.
What is left of a document goes to the shortest tier that holds it. Tiers are packed
from the longest down: an open window takes the longest remaining piece that fits,
from shorter tiers when its own has none, and where nothing fits it is closed with a
cut from the shortest. So every window but the group's last few is full. Windows are
dealt, tier by tier, to step groups, which so have the same mix and nearly the same
number of tokens.

Defined results: a null or empty text is its end id alone; repeated rows are packed
as often as they stand; an empty table gives no pieces. Ties go by place in a group,
which follows doc_id and the text's hash.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.textarrays import chunks
from tidemark.llm.wordids import word_ids

TIERS = (256, 512, 1024, 2048)
END_ID = 1
GROUP_BYTES = 4_000_000
ENCODED_BYTES = 2_000_000  # encoded at a time: the more, the fewer distinct words are looked up again
STEP_TOKENS = 16 * TIERS[-1]

PIECES = (
    "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long"
)


def pack(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[list[tuple[int, int, int]]]:
    """Windows as lists of (document, start, length); every token is in exactly one."""
    longest = tiers[-1]
    windows = []
    free: list[tuple[int, int, int]] = []  # (length, document, start), sorted
    for doc, n in enumerate(lengths):
        whole = n // longest
        windows += [[(doc, i * longest, longest)] for i in range(whole)]
        if n > whole * longest:
            free.append((n - whole * longest, doc, whole * longest))
    free.sort()
    for tier, least in zip(tiers[::-1], [*tiers[-2::-1], 0], strict=True):
        while free and free[-1][0] > least:
            n, doc, start = free.pop(bisect_right(free, (tier, len(lengths), 0)) - 1)
            window, gap = [(doc, start, n)], tier - n
            while gap and free:
                at = bisect_left(free, (gap + 1, -1, 0)) - 1
                if at >= 0:
                    n, doc, start = free.pop(at)
                    window.append((doc, start, n))
                    gap -= n
                else:
                    n, doc, start = free.pop(0)
                    window.append((doc, start, gap))
                    insort(free, (n - gap, doc, start + gap))
                    gap = 0
            if gap:
                windows += _powers(window, tiers)
            else:
                windows.append(window)
    return windows


def _powers(window: list[tuple[int, int, int]], tiers: tuple[int, ...]) -> list[list[tuple[int, int, int]]]:
    """An unfilled window cut into full ones of shorter tiers and a rest."""
    total, cut = sum(n for _, _, n in window), []
    for tier in tiers[::-1]:
        while total >= tier:
            cut.append(tier)
            total -= tier
    cut += [total] if total else []
    out, rest = [], list(window)
    for size in cut:
        part = []
        while size:
            doc, start, n = rest.pop(0)
            take = min(n, size)
            part.append((doc, start, take))
            size -= take
            if take < n:
                rest.insert(0, (doc, start + take, n - take))
        out.append(part)
    return out


def step_groups(sizes: list[int], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A step for each window: windows by size, longest first, dealt out in turns."""
    steps = max(1, round(sum(sizes) / step_tokens))
    out = [0] * len(sizes)
    for turn, i in enumerate(sorted(range(len(sizes)), key=lambda i: -sizes[i])):
        lap, at = divmod(turn, steps)
        out[i] = at if lap % 2 == 0 else steps - 1 - at
    return out


def pack_documents(docs: DataFrame, vocabulary: str, text: str = "text", keep: str = "doc_id") -> DataFrame:
    """One row per piece: `keep`, and where the piece is in its document and its window."""
    rows = docs.select(F.col(f"`{keep}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    groups = max(1, -(-size // GROUP_BYTES))
    key = F.xxhash64("doc_id", "text")
    rows = rows.withColumn("grp", F.pmod(key, F.lit(groups)))

    def run(table: pa.Table) -> pa.Table:
        encoder = word_ids(vocabulary)
        table = table.sort_by([("doc_id", "ascending")])
        ids: list[np.ndarray] = []
        for part in chunks(table, "text", ENCODED_BYTES):
            values, edges = encoder.texts(part.column("text"), END_ID)
            ids += [values[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
        windows = pack([len(x) for x in ids])
        steps = step_groups([sum(n for _, _, n in w) for w in windows])
        first = (table.column("grp")[0].as_py() if table.num_rows else 0) << 32
        out: list[list] = [[] for _ in range(9)]
        for number, (window, step) in enumerate(zip(windows, steps, strict=True)):
            total, offset = sum(n for _, _, n in window), 0
            tier = next(t for t in TIERS if t >= total)
            for doc, start, n in window:
                crc = zlib.crc32(ids[doc][start : start + n].astype("<u4").tobytes())
                for values, value in zip(
                    out, (doc, start, n, crc, len(ids[doc]), first + number, offset, tier, first + step), strict=True
                ):
                    values.append(value)
                offset += n
        kinds = [pa.int64()] * 6 + [pa.int32(), pa.int64()]
        return pa.Table.from_arrays(
            [table.column("doc_id").take(pa.array(out[0], pa.int64())).combine_chunks(),
             *[pa.array(v, kind) for v, kind in zip(out[1:], kinds, strict=True)]],
            names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group"],
        )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.groupBy("grp").applyInArrow(run, f"doc_id {kind}, {PIECES}")
