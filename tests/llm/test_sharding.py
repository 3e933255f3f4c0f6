"""Balanced label propagation: counts, slots, groups, odd rows."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from samples import odd_rows, prose, saved, table
from tidemark.llm import sharding
from tidemark.llm.queries import op4_sharding


def check(rows, got):
    assert sorted((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in map(key, rows)) == sorted(
        map(key, ((r.doc_id, r.size, r.text_crc32) for r in got)))
    counts = Counter(r.shard for r in got)
    sizes = [counts.get(s, 0) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1 and set(counts) <= set(range(8))
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))


def key(r):
    return (-1 if r[0] is None else r[0], *r[1:])


@pytest.mark.parametrize("copies", [0, 60, 400])
def test_law_and_slots(spark, tmp_path, copies):
    rows = odd_rows() + [(100 + i, prose(i % 150, 5), "en", "s", 0) for i in range(200)]
    rows += [(5000 + i, "one text in a great many copies", "en", "s", 0) for i in range(copies)]
    got = op4_sharding(spark, saved(table(spark, rows, clashes=True), tmp_path)).collect()
    check(rows, got)
    text = {r[0]: r[1] or "" for r in rows}
    where = defaultdict(Counter)
    for r in got:
        if r.doc_id is not None:
            where[text[r.doc_id]][r.shard] += 1
    cap = -(-len(rows) // 8)
    for group in where.values():
        n = sum(group.values())
        assert len(group) <= max(1, -(-n // cap) + (n > 2)), group  # a group may lose its place to the last bit of room
    assert sum(len(g) > 1 for g in where.values()) <= 2


def split_groups(rows, got):
    text = {r[0]: r[1] for r in rows}
    where = defaultdict(set)
    for r in got:
        where[text[r.doc_id]].add(r.shard)
    return [t for t, shards in where.items() if len(shards) > 1]


def groups_of(sizes, singles=0, offset=0):
    rows, at = [], offset
    for g, n in enumerate(sizes):
        rows += [(at + i, f"group {g} of words", "en", "s", 0) for i in range(n)]
        at += n
    return rows + [(at + i, f"single {i}", "en", "s", 0) for i in range(singles)]


@pytest.mark.parametrize(
    ("sizes", "singles"),
    [
        ([20] * 400, 0),  # they fill all shards exactly: the best placement cuts none
        ([20] * 400, 400),
        ([2] * 1200, 0),
        ([300] * 8 + [25] * 16, 0),
        ([random.Random(4).randint(2, 40) for _ in range(300)], 600),
    ],
)
def test_groups_that_fit_stay_whole(spark, sizes, singles):
    rows = groups_of(sizes, singles)
    got = sharding.shard_documents(table(spark, rows)).collect()
    counts = Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1
    assert split_groups(rows, got) == []


@pytest.mark.parametrize("seed", [1, 2])
def test_fewer_groups_than_shards_are_cut_without_single_documents(spark, seed):
    """No filler at all: at most 7 groups that are no larger than a shard may be cut, and larger ones must."""
    rng = random.Random(seed)
    sizes = [rng.randint(2, 60) for _ in range(200)] + [2500]
    rows = groups_of(sizes)
    got = sharding.shard_documents(table(spark, rows)).collect()
    counts = Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1
    cut = split_groups(rows, got)
    assert "group 200 of words" in cut
    assert len(cut) - 1 <= 7


def test_all_rows_equal_and_empty(spark, tmp_path):
    rows = [(i, None, None, None, None) for i in range(50)]
    got = op4_sharding(spark, saved(table(spark, rows), tmp_path)).collect()
    check(rows, got)
    assert sharding.shard_documents(table(spark, [])).collect() == []


def test_repeated_rows_are_all_placed(spark):
    rows = [(7, "twice", None, None, None)] * 33
    got = sharding.shard_documents(table(spark, rows)).collect()
    assert len(got) == 33 and len({(r.shard, r.slot) for r in got}) == 33


def test_no_python_in_the_plan(spark):
    plan = sharding.shard_documents(table(spark, odd_rows()))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)
