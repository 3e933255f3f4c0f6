"""Benchmark decontamination: planted items, edited ones, clean documents."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from samples import odd_rows, prose, saved, table
from tidemark.llm import decontaminate as d
from tidemark.llm.queries import op8_decontamination


def align_plainly(item, text):
    best = 0
    row = [0] * (len(text) + 1)
    for x in item:
        new = [0]
        for j, y in enumerate(text):
            new.append(max(0, row[j] + (d.MATCH if x == y else d.MISMATCH), row[j + 1] + d.GAP, new[j] + d.GAP))
        row = new
        best = max(best, *row)
    return best / (d.MATCH * len(item))


def test_alignment_is_that_of_the_whole_table():
    rng = random.Random(1)
    for _ in range(60):
        item = np.array([rng.randint(0, 5) for _ in range(rng.randint(1, 15))])
        text = np.array([rng.randint(0, 5) for _ in range(rng.randint(1, 40))])
        score, start, end = d.align(item, text)
        assert score == align_plainly(item.tolist(), text.tolist())
        if score:
            assert abs(align_plainly(item.tolist(), text[start:end].tolist()) - score) < 1e-12


def rows_and_items():
    items = [(i, prose(500 + i, 18 + 3 * i).capitalize() + ".") for i in range(12)] + [(50, None), (51, ""), (52, "tiny item here"), (53, prose(500, 18))]
    rows = odd_rows()
    want = set()
    for i in range(12):
        words = items[i][1].split()
        rows.append((100 + i, f"{prose(i, 60)} {items[i][1]} {prose(i + 50, 60)}", "en", "s", 0))
        changed = [("edit" if n % 7 == 3 else w) for n, w in enumerate(words)]
        rows.append((200 + i, f"{prose(i + 100, 30)} {' '.join(changed).upper()}!", "en", "s", 0))
        rows.append((300 + i, f"{prose(i + 150, 60)} {' '.join(words[:5])} {prose(i + 200, 60)}", "en", "s", 0))  # a piece only
        want |= {(100 + i, i), (200 + i, i)}
    want |= {(100, 53), (200, 53)}
    rows += [(400, f"{prose(7, 40)} tiny, item; HERE {prose(8, 40)}", "en", "s", 0), (401, "tiny item there", "en", "s", 0)]
    rows += [(1000 + i, f"{prose(i % 3, 20)} {items[3][1]}", "en", "s", 0) for i in range(120)]  # a very common passage
    want |= {(400, 52)} | {(1000 + i, 3) for i in range(120)}
    return rows, items, want


def test_finds_items_and_leaves_clean_documents(spark, tmp_path, monkeypatch):
    rows, items, want = rows_and_items()
    folder = saved(table(spark, rows, clashes=True), tmp_path)
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    got = op8_decontamination(spark, folder).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    assert all(d.THRESHOLD <= r.score <= 1 for r in got)
    exact = {r.doc_id: r for r in got if 100 <= r.doc_id < 112 and r.item_id < 12}
    assert all(r.score == 1 and r.start_word == 60 for r in exact.values())
    monkeypatch.setattr(d, "BLOCK_WORDS", 80)  # several blocks of items
    assert {(r.doc_id, r.item_id) for r in op8_decontamination(spark, folder).collect()} == want


def test_an_edit_in_many_documents_is_found(spark):
    items = [(1, prose(900, 30)), (2, prose(901, 12))]
    rows, want = [], set()
    for item, text in items:
        edited = " ".join("edit" if n % 5 == 4 else w for n, w in enumerate(text.split()))
        third = " ".join("edit" if n % 3 == 1 else w for n, w in enumerate(text.split()))
        spread = " ".join(f"{w} more" if n % 2 else w for n, w in enumerate(text.split()))
        for n in range(60):
            for kind, body in enumerate((edited, spread, edited if len(text.split()) < 30 else third) if n > 1 else (text, edited)):
                doc = 1000 * item + 10 * n + kind
                rows.append((doc, f"{prose(doc, 15)} {body} {prose(doc + 7, 15)}", "en", "s", 0))
                want.add((doc, item))
    got = d.contamination(table(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc.doc_id, h.item_id) for r in got for h in r.hits} == want


def test_finds_what_alignment_with_whole_texts_finds():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(40)]
    items = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 24))) for _ in range(40)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60))) for _ in range(20)]
    for item in items:
        kept = [w for w in item.split() if rng.random() < 0.85]
        mixed = [x for w in kept for x in ([w, rng.choice(vocabulary)] if rng.random() < 0.3 else [w])]
        texts.append(" ".join([rng.choice(texts[:20]), *mixed, rng.choice(texts[:20])]))
    whole = d.index(list(range(len(items))), items)
    words = d._split(pa.array(texts))
    times = np.array([(words.hash == w).sum() for w in whole.distinct])
    got = {(i, h["item_id"]): h["score"] for i, hits in d._judge(words, d.rarest(whole, times)).items() for h in hits}
    want = {}
    for i in range(len(texts)):
        for number, item in enumerate(whole.words):
            score = d.align(item, words.hash[words.first[i] : words.first[i + 1]])[0]
            if score >= d.THRESHOLD and score * len(item) >= min(len(item), d.LEAST_MATCHES) * 0.9:
                want[i, number] = score
    assert got == want and len(want) > 40


def test_item_ids_of_other_types(spark):
    items = spark.createDataFrame([("first", prose(1, 20)), ("second", prose(2, 20))], "item_id string, text string")
    docs = table(spark, [(5, f"{prose(3, 10)} {prose(2, 20)}", "en", "s", 0), (6, prose(4, 30), "en", "s", 0)])
    got = {r.doc.doc_id: [h.item_id for h in r.hits] for r in d.contamination(docs, items).collect()}
    assert got == {5: ["second"], 6: []}


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, prose(1, 20))], "item_id long, text string")
    assert d.contamination(table(spark, []), items).collect() == []
    got = d.contamination(table(spark, odd_rows()), items.limit(0)).collect()
    assert len(got) == len(odd_rows()) and all(r.hits == [] for r in got)
