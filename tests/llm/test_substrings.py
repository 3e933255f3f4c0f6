"""Substring dedup against windows compared as text."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest

from samples import odd_rows, prose, saved, table
from tidemark.llm import substrings
from tidemark.llm.queries import op1_substring_dedup

N = substrings.WINDOW


def expected(rows):
    texts = [(r[0], (r[1] or "").encode().split()) for r in rows]
    seen = Counter(tuple(w[i : i + N]) for _, w in texts for i in range(len(w) - N + 1))
    out = []
    for doc_id, w in texts:
        gone = [False] * len(w)
        for i in range(len(w) - N + 1):
            if seen[tuple(w[i : i + N])] > 1:
                gone[i : i + N] = [True] * N
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def cases():
    base, passage = prose(3, 200).split(), prose(4, 60).split()
    rows = odd_rows()
    rows += [(100 + i, " ".join(base[:i] + passage + prose(50 + i, 40).split()), "en", "s", 0) for i in range(12)]
    rows += [(200, " ".join(base), "en", "s", 0), (201, "  ".join(base) + "\n", "en", "s", 0)]  # other white space
    rows += [(202, " ".join(["ha"] * 90), "en", "s", 0), (203, " ".join(["ho"] * 35), "en", "s", 0)]  # overlaps itself
    rows += [(204, " ".join(base[20:54]), "en", "s", 0), (205, " ".join(base[20:55]), "en", "s", 0)]  # one word short
    rows += [(206, " ".join(passage[:35] + ["x"] + passage[35:]), "en", "s", 0)]
    return rows


@pytest.mark.parametrize("shard_bytes", [2_000_000, 500])
def test_agrees_with_text_windows(spark, tmp_path, monkeypatch, shard_bytes):
    monkeypatch.setattr(substrings, "SHARD_BYTES", shard_bytes)
    rows = cases()
    got = op1_substring_dedup(spark, saved(table(spark, rows, clashes=True), tmp_path)).collect()
    assert sorted(map(tuple, got), key=repr) == expected(rows)


def test_empty_table(spark, tmp_path):
    assert op1_substring_dedup(spark, saved(table(spark, []), tmp_path)).collect() == []


def test_spans_and_text(spark):
    passage = prose(5, 40)
    rows = [(1, f"x {passage} y", None, None, None), (2, passage, None, None, None)]
    got = {r.doc_id: r for r in substrings.repeated_words(table(spark, rows)).collect()}
    assert got[1].kept == "x y" and [tuple(s) for s in got[1].repeated] == [(1, 41)]
    assert got[2].kept == "" and [tuple(s) for s in got[2].repeated] == [(0, 40)]
