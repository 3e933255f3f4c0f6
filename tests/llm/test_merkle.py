"""Merkle manifest: all hashes recomputed plainly, for trees of many shapes."""

from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

import check
from samples import odd_rows, saved, table
from tidemark.llm import merkle
from tidemark.llm.queries import ORACLES, QUERIES


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(nodes, fanout):
    """All levels of a tree, and each position's siblings (left, right) from below."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + fanout]) for i in range(0, len(levels[-1]), fanout)])
    paths = []
    for at in range(len(nodes)):
        path = []
        for level in levels[:-1]:
            first = at - at % fanout
            run = level[first : first + fanout]
            path.append(("".join(run[: at - first]), "".join(run[at - first + 1 :])))
            at //= fanout
        paths.append(path)
    return levels[-1][0], paths


def expected(rows, fanout):
    """(doc_id, leaf) -> sorted outcomes, for rows (doc_id, text, lang, source, n_chars)."""
    trees = {}
    for doc_id, text, lang, source, n_chars in rows:
        trees.setdefault(lang, []).append((doc_id, leaf_of((doc_id, source, lang, n_chars, text))))
    langs = sorted(trees, key=lambda v: (v is not None, (v or "").encode()))
    ordered = {v: sorted(trees[v], key=lambda x: (x[0] is not None, x[0] or 0, x[1])) for v in langs}
    sub = {v: climb([leaf for _, leaf in ordered[v]], fanout) for v in langs}
    root, above = climb([sub[v][0] for v in langs], fanout)
    out = []
    for v, up in zip(langs, above, strict=True):
        for (doc_id, leaf), path in zip(ordered[v], sub[v][1], strict=True):
            out.append((doc_id, leaf, sub[v][0], root, path + up))
    return out


def got(found):
    return [(r.id, r.leaf, r.subroot, r.root, [(p.left, p.right) for p in r.path]) for r in found.collect()]


def many(n, langs, seed=5):
    rng = random.Random(seed)
    return [(100 + i, f"Text {i % 7} é", rng.choice(langs), "s", i % 3 or None) for i in rng.sample(range(10 * n), n)]


@pytest.mark.parametrize(
    ("rows", "fanout", "height"),
    [
        (many(300, ["a"]), 2, 1),  # one tree, many rounds
        (many(700, ["a", "a", "a", "b", "c", None, "", "é", "z", "Z"]), 3, 1),
        (many(130, [f"l{i}" for i in range(60)]), 2, 2),  # rounds over the subroots, too
        (many(65, ["a", "b"]), 8, 1),
        (many(1, ["a"]), 8, 3),
        (odd_rows(), 8, 3),
    ],
)
def test_agrees_with_a_plain_tree(spark, rows, fanout, height):
    found = got(merkle.manifest(table(spark, rows, clashes=True), fanout=fanout, height=height))
    assert sorted(found, key=repr) == sorted(expected(rows, fanout), key=repr)


def test_every_size_up_to_several_blocks(spark):
    for n in (2, 9, 17, 28):
        rows = many(n, ["a"], seed=n)
        found = got(merkle.manifest(table(spark, rows), fanout=3, height=1))
        assert sorted(found, key=repr) == sorted(expected(rows, 3), key=repr), n


def test_changed_fields_do_not_fold_to_the_root(spark):
    rows = many(80, ["a", "b"])
    changed = {"text": F.when(F.col("doc_id") % 2 == 0, F.upper("text")).otherwise(F.col("text"))}
    found = merkle.manifest(table(spark, rows), altered=changed, fanout=4, height=1)
    found = found.withColumn("folded", merkle.fold(F.col("altered"), F.col("path")))
    for r in found.collect():
        assert (r.folded == r.root) == (r.id % 2 == 1)
        assert (r.altered == r.leaf) == (r.id % 2 == 1)


def test_empty_table(spark):
    assert merkle.manifest(table(spark, [])).collect() == []


def test_query_on_odd_rows(spark, tmp_path):
    """The query agrees with its SQL, and only changed texts fail."""
    folder = saved(table(spark, odd_rows() + many(900, ["a", "b", None]), clashes=True), tmp_path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    name = "op13_merkle_manifest"
    status, detail, _ = check.compare(spark, con, name, QUERIES[name], ORACLES[name], folder)
    assert status == "ok", detail
    texts = {}
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        texts.setdefault(r.doc_id, set()).add(r.text)
    for r in QUERIES[name](spark, folder).collect():
        crc = None if r.doc_id is None else zlib.crc32(str(r.doc_id).encode())
        changes = any(t and any("A" <= c <= "Z" for c in t) for t in texts[r.doc_id])
        assert r.verified == (crc is None or crc % 3 != 0 or not changes)
