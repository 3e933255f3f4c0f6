"""Quality rules: statistics and scores recomputed plainly, and accuracy on rows held out."""

from __future__ import annotations

import math
import re
import zlib

import pytest
from pyspark.sql import functions as F

from samples import odd_rows, prose, saved, table
from tidemark.llm import rulequality as rq
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def plain(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [x for x in text.split("\n") if x]
    share = lambda part, whole: part / whole if whole else 0.0
    again = lambda items: sum(a == b for a, b in zip(items, items[1:]))
    return {
        "chars": math.log1p(len(text)), "words": math.log1p(len(words)),
        "word_length": share(sum(map(len, words)), len(words)), "longest_word": math.log1p(max(map(len, words), default=0)),
        "upper": share(sum(c.isupper() for c in text), len(text)), "digits": share(sum(c in "0123456789" for c in text), len(text)),
        "symbols": share(sum(not (c.isalpha() or c.isnumeric() or c in " \t\n\r\x0b\x0c.,'-") for c in text), len(text)),
        "stops": share(sum(c in ".," for c in text), len(words)),
        "distinct_words": share(len(set(words)), len(words)), "repeated_words": share(again(words), len(words)),
        "distinct_lines": share(len(set(lines)), len(lines)), "line_words": share(len(words), len(lines)),
        "bare_words": share(sum(not any(c.isalpha() for c in w) for w in words), len(words)),
    }


def junk(i):
    return " ".join(w + "&%$!"[i % 4] * 3 for w in prose(i, 80).split()) if i % 2 else " ".join(prose(i, 3).split()[:1] * 90)


def labelled(n=400):
    rows = [(i, junk(i) if i % 5 == 0 else prose(i, 90) + ".", "en", "s", 1) for i in range(n)]
    return rows, [(i, int(i % 5 != 0), 0) for i in range(n)]


def labels_table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def with_labels(spark, docs, labels, folder):
    labels_table(spark, labels).write.parquet(f"{folder}/labels.parquet")
    return saved(docs, folder)


def test_statistics_of_odd_texts(spark):
    rows = [*odd_rows(), (300, "A a\n\nA a\nB 12 -- ÄÖ ñ.\n", "en", "s", 1), (301, "x x x, y", "en", "s", 1)]
    found = rq.statistics(table(spark, rows, clashes=True)).collect()
    texts = sorted((plain(r[1]) for r in rows), key=lambda s: sorted(s.items()))
    got = sorted(({k: r[k] for k in rq.STATISTICS} for r in found), key=lambda s: sorted(s.items()))
    assert [list(x) for x in texts] == [list(rq.STATISTICS)] * len(rows)
    for want, have in zip(texts, got, strict=True):
        assert have == pytest.approx(want, abs=1e-12)


def test_compiled_rules_agree_with_rules_read_one_by_one(spark):
    rows, labels = labelled()
    stats = rq.statistics(table(spark, rows))
    known = labels_table(spark, labels).select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    model = rq.fit(stats.join(known, "id"))
    assert 1 <= len(model.weights) < 100
    scored = stats.select("*", model.score().alias("score")).collect()
    for r in scored:
        z = model.base + sum(w for rule, w in model.weights if rule.holds({k: r[k] for k in rq.STATISTICS}))
        assert r.score == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)
    right = sum((r.score >= 0.3) == (r.id % 5 != 0) for r in scored)
    assert right >= 0.98 * len(scored)


def test_query_on_odd_rows(spark, tmp_path):
    rows, labels = labelled(200)
    labels += [(None, 1, 0), (3, None, None), (5000, 0, 1), (7, 1, 0), (7, 0, 0), (8, 5, 0)]
    folder = with_labels(spark, table(spark, rows + [(1000 + (r[0] or 0), *r[1:]) for r in odd_rows()], clashes=True), labels, tmp_path)
    found = QUERIES["op11_quality_classifier"](spark, folder).collect()
    assert len(found) == len(rows) + len(odd_rows())
    for r in found:
        assert 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


@pytest.mark.parametrize("labels", [[], [(i, 1, 0) for i in range(20)], [(i, 0, 0) for i in range(20)]])
def test_without_two_labels_all_scores_are_the_share(spark, tmp_path, labels):
    folder = with_labels(spark, table(spark, [(i, prose(i, 9), "en", "s", 1) for i in range(20)]), labels, tmp_path)
    found = QUERIES["op11_quality_classifier"](spark, folder).collect()
    learnt = [q for i, q, _ in labels if zlib.crc32(str(i).encode()) % 5]
    assert {round(r.score, 9) for r in found} == {round((sum(learnt) + 1) / (len(learnt) + 2), 9)}


def test_null_id_is_scored_and_empty_table_is_empty(spark, tmp_path):
    known = labels_table(spark, [(1, 1, 0)]).select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    docs = table(spark, [(None, "a b", "en", "s", 1)])
    assert rq.scores(docs, known, F.lit(True)).count() == 1
    assert rq.scores(docs.limit(0), known, F.lit(True)).count() == 0


def test_held_out_documents_of_the_sample_table(spark):
    found = QUERIES["op11_quality_classifier"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = found.where("held_out").join(labels, "doc_id").collect()
    assert len(rows) > 50
    good, bad = [r.score for r in rows if r.quality], [r.score for r in rows if not r.quality]
    pairs = sum((x > y) + 0.5 * (x == y) for x in good for y in bad) / (len(good) * len(bad))
    assert pairs >= 0.97
    assert sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)
