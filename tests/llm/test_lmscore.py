"""Language-model scores against dictionaries and a byte-by-byte model."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from samples import odd_rows, prose, saved, table
from tidemark.llm import lmscore, ppm
from tidemark.llm.queries import op9_lm_scoring


class PlainPpm:
    """Counts by context, and one symbol at a time: escapes, exclusions, then all other bytes alike."""

    def __init__(self, texts):
        self.counts = defaultdict(Counter)
        for text in texts:
            padded = b"\xff" * ppm.DEPTH + text + b"\xff"
            for i in range(ppm.DEPTH, len(padded)):
                for d in range(ppm.DEPTH + 1):
                    self.counts[padded[i - d : i]][padded[i]] += 1

    def log10(self, text):
        padded, total = b"\xff" * ppm.DEPTH + text + b"\xff", 0.0
        for i in range(ppm.DEPTH, len(padded)):
            excluded = set()
            for d in range(ppm.DEPTH, -1, -1):
                seen = {s: n for s, n in self.counts.get(padded[i - d : i], {}).items() if s not in excluded}
                if not seen:
                    continue
                if padded[i] in seen:
                    total += math.log10(seen[padded[i]] / (sum(seen.values()) + len(seen)))
                    break
                total += math.log10(len(seen) / (sum(seen.values()) + len(seen)))
                excluded |= set(seen)
            else:
                total -= math.log10(256 - len(excluded))
        return total


def rows():
    out = odd_rows()[:-1] + [(100 + i, prose(i, 5 + 3 * i, "abcdeé"), "en", "s", 0) for i in range(60)]
    return out + [(300, "Unseen Ωords \x01\x02 here", "en", "s", 0), (303, "a\x00b \x00\x00 c\x00", "en", "s", 0), (301, "ABC abc AbC", "en", "s", 0), (302, "abc", "en", "s", 0)]


def held(doc_id):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % 7 == 2


@pytest.mark.parametrize("head", [1 << 19, 8, 0])
def test_agrees_with_plain_counts(spark, tmp_path, monkeypatch, head):
    monkeypatch.setattr(lmscore, "HEAD_WORDS", head)
    docs = [r for r in rows() if r[0] is not None]
    tokens = [[*(r[1] or "").encode().lower().split(), None] for r in docs]
    counts = Counter(t for r, ts in zip(docs, tokens, strict=True) if not held(r[0]) for t in ts)
    n, v = sum(counts.values()), len(counts)
    got = op9_lm_scoring(spark, saved(table(spark, docs, clashes=True), tmp_path)).collect()
    want = [
        (r[0], held(r[0]), len(ts), sum(counts[t] > 0 for t in ts), n, sum(math.log10((counts[t] + 1) / (n + 1 * (v + 1))) for t in ts))
        for r, ts in zip(docs, tokens, strict=True)
    ]
    got = sorted(got, key=lambda r: (r.doc_id, r.base_score))
    for r, w in zip(got, sorted(want, key=lambda w: (w[0], w[5])), strict=True):
        assert tuple(r)[:5] == w[:5] and r.base_score == pytest.approx(w[5], rel=1e-9, abs=1e-9)
    model = PlainPpm([(r[1] or "").encode() for r in docs if not held(r[0])])
    text = {r[0]: (r[1] or "").encode() for r in docs}
    for r in got:
        if len(text[r.doc_id]) < 2000:
            assert r.score == pytest.approx(model.log10(text[r.doc_id]), rel=1e-4, abs=1e-4)


@pytest.mark.parametrize("cells, grams, group", [(4000, 2_000_000, 250_000), (1 << 20, 300, 900), (1, 1, 100)])
def test_contexts_outside_the_trie_are_scored_exactly(spark, tmp_path, monkeypatch, cells, grams, group):
    monkeypatch.setattr(ppm, "MAX_CELLS", cells)
    monkeypatch.setattr(ppm, "MAX_GRAMS", grams)
    monkeypatch.setattr(lmscore, "GROUP_GRAMS", group, raising=False)
    docs = [r for r in rows() if r[0] is not None and len(r[1] or "") < 2000]
    model = PlainPpm([(r[1] or "").encode() for r in docs if not held(r[0])])
    text = {r[0]: (r[1] or "").encode() for r in docs}
    got = op9_lm_scoring(spark, saved(table(spark, docs), tmp_path)).collect()
    assert len(got) == len(docs) and any(r.held_out for r in got)
    for r in got:
        assert r.score == pytest.approx(model.log10(text[r.doc_id]), rel=1e-4, abs=1e-4)


def test_no_training_rows_and_empty_table(spark):
    docs = table(spark, [(1, "ab", "en", "s", 0), (2, None, "en", "s", 0)])
    got = {r.doc_id: r for r in lmscore.score(docs, docs.doc_id < 0).collect()}
    assert got[1].n_tokens == 2 and got[1].n_known == 0 and got[1].train_tokens == 0 and got[1].base_score == 0
    assert got[1].score == pytest.approx(-3 * math.log10(256), rel=1e-5) and got[2].score == pytest.approx(-math.log10(256), rel=1e-5)
    empty = table(spark, [])
    assert lmscore.score(empty, empty.doc_id > 0).collect() == []


def test_probabilities_add_up_and_limits_keep_them_so(monkeypatch):
    texts = [prose(i, 60).encode() for i in range(20)]
    grams = [Counter() for _ in range(ppm.DEPTH + 1)]
    for text in texts:
        padded = b"\xff" * ppm.DEPTH + text + b"\xff"
        for i in range(ppm.DEPTH, len(padded)):
            for d in range(ppm.DEPTH + 1):
                grams[d][int.from_bytes(padded[i - d : i + 1], "big")] += 1
    depths = [(np.array(sorted(g)), np.array([g[k] for k in sorted(g)])) for g in grams]
    for cells in (ppm.MAX_CELLS, 2000):
        monkeypatch.setattr(ppm, "MAX_CELLS", cells)
        trie = ppm.build(depths)
        width = trie.log10p.shape[1] - 1
        total = (10.0 ** trie.log10p[:, :width]).sum(axis=1) + (256 - width) * 10.0 ** trie.log10p[:, width]
        assert np.allclose(total, 1, atol=1e-4) and trie.log10p.size <= max(cells, 1000)
