"""Near-duplicate classes against all pairs."""

from __future__ import annotations

import random
from collections import defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

from samples import odd_rows, prose, saved, table
from tidemark.llm import neardup
from tidemark.llm.components import components
from tidemark.llm.queries import op5_near_dedup
from tidemark.llm.textarrays import Words


def edited(text, seed, share):
    rng = random.Random(seed)
    out = []
    for word in text.split():
        x = rng.random()
        out += [] if x < share / 3 else [word, "added"] if x < share * 2 / 3 else ["changed"] if x < share else [word]
    return " ".join(out)


def shingles(texts):
    shingle, owner = neardup.labelled_shingles(Words(pa.array(texts), lower=True))
    edges = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [shingle[edges[i] : edges[i + 1]] for i in range(len(texts))]


def common_subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
        row = new
    return row[-1]


def expected(rows):
    """Classes by all pairs, the whole alignment table for each."""
    seqs = shingles([r[1] for r in rows])
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(seqs):
        for j in range(i):
            b = seqs[j]
            text = rows[i][1]
            equal = text is not None and text.split() and text == rows[j][1]
            if not equal and len(a) and len(b) and len(set(a.tolist()) & set(b.tolist())) >= 0.8 * max(len(a), len(b)):
                m = common_subsequence(a.tolist(), b.tolist())
                equal = m / (len(a) + len(b) - m) >= 0.8
            if equal:
                parent[find(i)] = find(j)
    classes = defaultdict(list)
    for i, r in enumerate(rows):
        classes[find(i)].append(r[0] if r[0] is not None else -1)
    return sorted(sorted(c) for c in classes.values())


def got_classes(found):
    by = defaultdict(list)
    for r in found:
        by[r.root].append(r.doc_id if r.doc_id is not None else -1)
    return sorted(sorted(c) for c in by.values())


def corpus():
    rows = odd_rows()
    for g in range(8):
        text = prose(g + 20, 30 + 25 * g)
        rows += [(100 * (g + 1) + i, edited(text, 7 * g + i, share), "en", "s", 0) for i, share in enumerate([0, 0, 0.01, 0.02, 0.04, 0.3])]
    hot = prose(99, 120)
    rows += [(5000 + i, edited(hot, 900 + i, 0.015), "en", "s", 0) for i in range(60)]
    rows += [(9000, "a b c d e f g h", "en", "s", 0), (9001, "A b c  d e f g H", "en", "s", 0), (9002, "a b c d", "en", "s", 0), (9003, "a b c d", "en", "s", 0)]
    return rows


def test_agrees_with_all_pairs(spark):
    rows = corpus()
    assert got_classes(neardup.classes(table(spark, rows, clashes=True)).collect()) == expected(rows)


def templated(pairs, seed=11):
    """Pairs at about 0.82 whose members share a template, so that all others are at about 0.61."""
    rng = random.Random(seed)
    template, rows = prose(seed, 228).split(), []
    for g in range(pairs):
        own = prose(10_000 * seed + g, 72).split()
        other = list(own)
        for at in rng.sample(range(6, 66), 3):
            other[at] = "changed" + other[at]
        rows += [(2 * g, " ".join(template + own), "en", "s", 0), (2 * g + 1, " ".join(template + other), "en", "s", 0)]
    return rows


def test_pairs_in_a_crowd_with_a_common_template_are_all_linked(spark):
    rows = templated(150)
    found = got_classes(neardup.classes(table(spark, rows)).collect())
    parts = shingles([r[1] for r in rows[:4]])
    assert neardup.similarity(parts[0], parts[1]) >= 0.8 > neardup.similarity(parts[0], parts[2], 0.1)
    assert found == [[2 * g, 2 * g + 1] for g in range(150)]


def reordered() -> list[tuple]:
    """Pairs that differ in a word; every pair has the paragraphs of all others in an order of its own."""
    rows, parts = [], [prose(900 + i, 40) for i in range(5)]
    for g, order in enumerate(permutations(parts)):
        own = " ".join(order).split()
        other = list(own)
        other[20 + g % 160] = f"changed{g}"
        rows += [(2 * g, " ".join(own), "en", "s", 0), (2 * g + 1, " ".join(other), "en", "s", 0)]
    return rows


@pytest.mark.parametrize("tile", [100_000, 5_000])
def test_pairs_in_a_crowd_that_shares_nearly_all_shingles_are_all_linked(spark, monkeypatch, tile):
    monkeypatch.setattr(neardup, "TILE_WORDS", tile)
    rows = reordered()
    parts = shingles([r[1] for r in rows[:4]])
    assert neardup.similarity(parts[0], parts[1]) >= 0.8 > neardup.similarity(parts[0], parts[2], 0.1)
    assert len(set(parts[0].tolist()) & set(parts[2].tolist())) > 0.7 * len(parts[0])
    assert got_classes(neardup.classes(table(spark, rows)).collect()) == [[2 * g, 2 * g + 1] for g in range(120)]


def test_a_pair_of_one_component_is_not_aligned_again(spark, monkeypatch):
    """In a large group of near copies every step after the first joins components, and the classes are those of all pairs."""
    hot, asked, linked = prose(99, 100), [], []
    whole = neardup._verified

    def kept(pairs, texts):
        good = whole(pairs, texts)
        asked.append([tuple(r) for r in pairs.select("a", "b").collect()])
        linked.append([tuple(r) for r in good.select("a", "b").collect()])
        return good

    monkeypatch.setattr(neardup, "_verified", kept)
    rows = [(i, edited(hot, 900 + i, 0.012), "en", "s", 0) for i in range(150)] + [(1000 + r[0], *r[1:]) for r in templated(15)]
    assert got_classes(neardup.classes(table(spark, rows)).collect()) == expected(rows)
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    assert len(asked) == 3 and len(linked[0]) > 100
    for step, pairs in enumerate(asked):
        assert step == 0 or all(find(a) != find(b) for a, b in pairs)
        for a, b in linked[step]:
            parent[find(a)] = find(b)


def test_components_are_merged_by_links_between_them(spark):
    roots = spark.createDataFrame([(1, 1), (5, 1), (3, 3), (4, 3), (8, 8), (9, 8)], "node long, root long")
    links = spark.createDataFrame([(4, 5), (5, 4), (1, 5), (7, 9), (2, 6)], "a long, b long")
    got = {r.node: r.root for r in neardup._merged(roots, links).collect()}
    assert got == {1: 1, 5: 1, 3: 1, 4: 1, 7: 7, 8: 7, 9: 7, 2: 2, 6: 2}
    assert neardup._merged(roots, links.limit(0)).count() == 6


def test_common_shingles_are_counted_in_steps(monkeypatch):
    texts = [prose(i % 3, 30 + i) for i in range(8)]
    parts = shingles(texts)
    x, own = np.concatenate(parts[:5]), np.repeat(np.arange(5), [len(p) for p in parts[:5]])
    y, other = np.concatenate(parts[5:]), np.repeat(np.arange(3), [len(p) for p in parts[5:]])
    monkeypatch.setattr(neardup, "COMMON_STEP", 7)
    got = neardup.common_shingles(x, own, 5, y, other, 3)
    assert got.tolist() == [[len(set(a.tolist()) & set(b.tolist())) for b in parts[5:]] for a in parts[:5]]
    assert neardup.common_shingles(x[:0], own[:0], 0, y, other, 3).shape == (0, 3)


def test_crowds_agree_with_all_pairs(spark):
    """Templates of several shares, chains of edits and copies, in buckets far beyond what is aligned at once."""
    rng, rows = random.Random(5), []
    for share in (0.5, 0.7, 0.85, 0.93):
        template = prose(int(share * 100), int(200 * share)).split()
        for g in range(25):
            own = prose(7000 + int(share * 100) * 50 + g, 200 - len(template)).split()
            text = " ".join(template + own)
            for _ in range(rng.randint(1, 3)):
                rows.append((len(rows), text, "en", "s", 0))
                text = edited(text, len(rows), rng.choice([0, 0.01, 0.03, 0.06]))
    found = got_classes(neardup.classes(table(spark, rows)).collect())
    assert found == expected(rows)


def test_prefixes_join_every_similar_pair(spark):
    """No pair of similarity 0.8 or more is without a common shingle in its prefixes."""
    rows = corpus()[11:]
    texts = spark.createDataFrame([(i, r[1]) for i, r in enumerate(rows)], "node long, text string")
    by = defaultdict(list)
    for r in neardup._by_rare_shingle(texts).collect():
        by[r.key].append((r.node, r.index))
    met = {(min(a, b), max(a, b)) for nodes in by.values() for a, index in nodes if index for b, _ in nodes if a != b}
    parts = shingles([r[1] for r in rows])
    for i in range(len(rows)):
        for j in range(i):
            if neardup.similarity(parts[i], parts[j]) >= 0.8:
                assert (j, i) in met


def test_query_names_one_kept_row_a_class(spark, tmp_path):
    rows = [r for r in corpus() if r[0] is not None]
    got = op5_near_dedup(spark, saved(table(spark, rows), tmp_path)).collect()
    assert len(got) == len(rows) and sum(r.kept for r in got) == len(expected(rows))
    for r in got:
        assert not r.kept or r.class_id == r.doc_id
    assert op5_near_dedup(spark, saved(table(spark, []), tmp_path / "none")).collect() == []


def test_one_row_of_each_class_stays_with_its_columns(spark):
    rows = corpus()
    docs = table(spark, rows, clashes=True)
    kept = neardup.representatives(docs)
    assert kept.columns == docs.columns and kept.count() == len(expected(rows))


def test_alignment_needs_order_and_length():
    a, b = shingles([prose(1, 100), prose(2, 100)])
    assert neardup.similarity(a, a) == 1 and neardup.similarity(a, b) == 0
    assert neardup.similarity(np.concatenate([a, b]), np.concatenate([b, a])) < 0.8  # moved halves
    assert neardup.similarity(a, a[:50]) == 0 and neardup.similarity(a, a[:0]) == 0


def test_sketches_keep_text_order_and_occurrences():
    words = Words(pa.array([prose(3, 60), prose(3, 60), "x " * 40, "x " * 41, "a b c d", None]))
    texts, keys = neardup.sketches(words)
    assert texts.tolist() == [0, 1, 2, 3] and (keys[0] == keys[1]).all() and (keys[2] != keys[0]).all()
    assert len(np.unique(neardup.labelled_shingles(Words(pa.array(["x " * 40])))[0])) == 36


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(120)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
