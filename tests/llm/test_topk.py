"""Exact top-k against all products, and the tree's bounds."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tidemark.llm import topk
from tidemark.llm.mtree import MTree
from tidemark.llm.queries import op7_exact_topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows):
    sound = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, _ in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, (i, v) in enumerate(sound):
        if i % 50 == 0:
            scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), j) for b, (j, w) in enumerate(sound) if b != a and len(w) == len(v))
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:5])]
    return sorted(out)


def vectors(seed, n, size=8):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.3) for _ in range(size)] for _ in range(6)]
    return [(i, [c + rng.gauss(0, 0.1) for c in rng.choice(centres)], 0) for i in range(n)]


def run(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS v", "2 AS cell", "3 AS rep").write.parquet(f"{tmp_path}/embeddings.parquet")
    return sorted(map(tuple, op7_exact_topk(spark, str(tmp_path)).collect()))


@pytest.mark.parametrize("tree_rows,block", [(4096, 4096), (40, 3)])
def test_agrees_with_all_products(spark, tmp_path, monkeypatch, tree_rows, block):
    monkeypatch.setattr(topk, "TREE_ROWS", tree_rows)
    monkeypatch.setattr(topk, "QUERY_BLOCK", block)
    same = [0.25] * 8
    rows = vectors(1, 400) + [(1000 + i, same, 0) for i in range(60)]  # ties, queries among them
    rows += [(2000, [1.0] * 7 + [None], 0), (2050, None, 0), (2100, [1.0] * 7 + [float("nan")], 0), (2150, [float("inf")] * 8, 0), (None, same, 0)]
    rows += [(3000, [0.5, 0.25], 0), (3001, [0.5, -0.25], 0), (4000, [0.1, 0.2, 0.3], 0), (5000, [], 0), (5001, [], 0)]
    rows += [(50, rows[50][1], 0), (50, same, 0), (0, [0.0] * 8, 0)]  # repeated row, repeated id, zero vector
    assert run(spark, tmp_path, rows) == expected(rows)


def test_one_long_vector_does_not_blunt_the_bounds(spark, tmp_path):
    """Lengths over four powers of ten: all products agree, and short bands are not opened for long queries."""
    rng = random.Random(9)
    rows = [(i, [rng.gauss(0, 1) * 10 ** rng.choice([-2, -1, 0, 1]) for _ in range(6)], 0) for i in range(500)]
    rows.append((9999, [4000.0, 0.0, 0.0, 0.0, 0.0, 0.0], 0))
    assert run(spark, tmp_path, rows) == expected(rows)


def test_trees_are_copied_for_the_blocks_of_their_own_queries(spark, monkeypatch):
    """A tree that many queries open is copied once per block of these, one that none opens not at all."""
    monkeypatch.setattr(topk, "QUERY_BLOCK", 10)
    trees = spark.createDataFrame(
        [([1], [t], 7, t, 0) for t in range(5)], "v array<long>, ids array<long>, grp int, cell int, part int")
    opened = [(r, 7, t, 0) for t, n in ((0, 25), (1, 3), (3, 10)) for r in range(n)]
    dealt = spark.createDataFrame(opened, "rep long, grp int, cell int, part int")
    copies, queries = topk._meetings(trees, dealt)
    assert sorted((r.cell, r.block) for r in copies.collect()) == [(0, 0), (0, 1), (0, 2), (1, 0), (3, 0)]
    held = {(r.cell, r.block) for r in queries.collect()}
    assert queries.count() == len(opened)
    assert held <= {(0, 0), (0, 1), (0, 2), (1, 0), (3, 0)}


def test_empty_and_invalid_only(spark, tmp_path):
    assert run(spark, tmp_path, [(0, None, 0), (50, [None], 0)]) == []


def test_tree_finds_all_ties_and_saves_computations():
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 300, (40, 6))
    data = np.unique(np.floor(centres[rng.integers(0, 40, 4000)] + rng.normal(0, 4, (4000, 6))).astype(np.int64), axis=0)
    tree = MTree(data, float((data * data).sum(axis=1).max()))
    for query in data[::400]:
        tree.computed = 0
        found = tree.search(query, 5)
        scores = data @ query
        fifth = np.sort(scores)[-5]
        assert {r for _, r in found} == set(np.flatnonzero(scores >= fifth).tolist()) and all(scores[r] == s for s, r in found)
        assert tree.computed < 0.7 * len(data)
    assert MTree(np.zeros((0, 3), np.int64), 1.0).search(np.zeros(3, np.int64), 5) == []
