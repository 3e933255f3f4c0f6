"""Language identification: held-out accuracy, undetermined texts, rejection."""

from __future__ import annotations

import random
import zlib

import numpy as np

from samples import odd_rows, saved, table
from tidemark.llm import langid
from tidemark.llm.queries import op3_language_id
from tidemark.llm.textarrays import text_bytes

SYLLABLES = {
    "aa": ["ka", "ri", "mo", "tu", "ne", "so"], "bb": ["sch", "ung", "ver", "keit", "ein", "ü"], "cc": ["ción", "ñe", "os", "ara", "el", "do"],
}


def text(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(n))


def corpus(n=240):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        lang = sorted(SYLLABLES)[i % 3]
        rows.append((i, text(rng, lang, rng.randint(3, 80)), lang, "s", 0))
    return rows


def test_held_out_accuracy_and_odd_texts(spark, tmp_path):
    rows = corpus() + [(1000 + (r[0] or 0), r[1], None, None, None) for r in odd_rows()] + [(2000, "123 !?", "aa", "s", 1)]
    got = op3_language_id(spark, saved(table(spark, rows, clashes=True), tmp_path)).collect()
    assert len(got) == len(rows)
    lang = {r[0]: r[2] for r in rows}
    held = [r for r in got if r.held_out and r.doc_id < 1000]
    assert len(held) > 50 and sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    none = [r for r in got if r.doc_id in (1001, 1002, 1003, 2000)]
    assert all(r.lang_pred == "und" and r.score == 0 and r.rejected for r in none)
    assert {r.lang_pred for r in got} == {"aa", "bb", "cc", "und"}
    assert not any(r.rejected for r in got if r.doc_id < 1000)


def test_other_scripts_are_rejected(spark):
    model = langid.fit(table(spark, corpus()))
    rows = [(1, "漢字仮名交じり文を書くことにする" * 10, None, None, None), (2, "карамурине " * 20, None, None, None), (3, "karimo tune " * 20, None, None, None)]
    got = {r.doc.doc_id: r for r in langid.predict(table(spark, rows), model).collect()}
    assert got[1].rejected and got[2].rejected and not got[3].rejected and got[3].lang_pred == "aa"


DUTCH = "de kat zat op de mat en keek naar de vogels die in de boom hun nest hadden gebouwd terwijl het buiten langzaam begon te regenen"


def test_unlearned_languages_and_random_letters_are_rejected_at_any_length(spark):
    """Learnt from the sample table, whose own documents stay."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = langid.fit(docs.where(~langid.held_out()).select("text", "lang"))
    rng = random.Random(1)
    rows = []
    for n in (200, 575, 2622, 11_058, 40_000):
        rows.append((n, " ".join(rng.choices(DUTCH.split(), k=n // 5)), None, None, None))
        if n > 600:
            rows.append((n + 1, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz    ", k=n)), None, None, None))
    got = langid.predict(table(spark, rows), model).collect()
    assert [r.doc.doc_id for r in got if not r.rejected] == []
    held = langid.predict(docs.where(langid.held_out()), model).selectExpr(
        "avg(CAST(rejected AS INT))", "avg(CAST(lang_pred = doc.lang AS INT))").first()
    assert held[0] < 0.004
    assert held[1] > 0.99


def test_limits_do_not_grow_towards_shorter_texts(spark):
    model = langid.fit(table(spark, corpus()))
    assert (np.diff(model.floor, axis=1) >= -1e-12).all()
    assert (model.floor > 0).all()


def test_nearest_centroid_computed_plainly(spark):
    """Counts, weights, cosine and the choice of the nearest centroid, one text and gram at a time."""
    import math

    model = langid.fit(table(spark, corpus()))
    texts = [r[1] for r in corpus()[:25]] + ["Ka ri, MO!  tune\nso 12 Ü", "keit"]
    got = {r.doc.doc_id: r for r in langid.predict(table(spark, [(i, t, None, None, None) for i, t in enumerate(texts)]), model).collect()}
    for i, t in enumerate(texts):
        data = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in t.encode())
        while b"  " in data:
            data = data.replace(b"  ", b" ")
        counts: dict[int, int] = {}
        for k in (1, 2, 3):
            for a in range(len(data) - k + 1):
                gram = np.array([int.from_bytes(data[a : a + k], "big") + (k << 32)], dtype=np.uint64)
                slot = int(langid.mix(gram)[0] % np.uint64(langid.SIZE))
                counts[slot] = counts.get(slot, 0) + 1
        vector = {s: math.log1p(n) * model.idf[s] for s, n in counts.items()}
        norm = math.sqrt(sum(v * v for v in vector.values()))
        cosine = [sum(v / norm * float(c[s]) for s, v in vector.items()) for c in model.centroids]
        assert abs(max(cosine) - got[i].score) < 1e-4
        assert got[i].lang_pred == model.languages[model.owner[int(np.argmax(cosine))]]


def test_without_training_rows_all_is_undetermined(spark):
    model = langid.fit(table(spark, []))
    got = langid.predict(table(spark, corpus(6)), model).collect()
    assert all(r.lang_pred == "und" and r.rejected and r.score == 0 for r in got)
    assert langid.predict(table(spark, []), model).collect() == []


def test_each_language_has_several_centroids_and_frequencies_cover_all_rows(spark):
    rows = corpus()
    model = langid.fit(table(spark, rows))
    assert model.languages == ["aa", "bb", "cc"] and all((model.owner == i).sum() > 1 for i in range(3))
    import pyarrow as pa

    counts = langid.gram_counts(*text_bytes(pa.array([r[1] for r in rows])))
    assert np.allclose(model.idf, np.log((1 + len(rows)) / (1 + (counts > 0).sum(axis=0))) + 0.2)


def test_copies_do_not_flood_the_sample(spark):
    rows = corpus(90) + [(5000 + i, "karimo tune so " * 8, "aa", "s", 0) for i in range(400)]
    model = langid.fit(table(spark, rows))
    got = langid.predict(table(spark, corpus(90)), model).collect()
    assert sum(r.lang_pred == r.doc.lang for r in got) >= 88


def test_a_language_of_copies_only_has_samples(spark):
    rows = [(i, f"karimo tune so {'abcdefgh'[k] * 3} ", f"l{k}", "s", 0) for k in range(8) for i in range(4000)]
    model = langid.fit(table(spark, rows).repartition(4))
    assert model.languages == [f"l{k}" for k in range(8)] and set(model.owner.tolist()) == set(range(8))
    got = langid.predict(table(spark, rows[::4000]), model).collect()
    assert all(r.lang_pred == r.doc.lang and not r.rejected for r in got)
