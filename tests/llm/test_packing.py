"""Packing: round trip of every token, windows, padding and step groups."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from samples import odd_rows, prose, saved, table
from tidemark.llm import packing, wordids
from tidemark.llm.queries import op6_packing, vocabulary_file

tokenizers = pytest.importorskip("tokenizers")
STRANGE = [
    "don't I'LL we've 's", "Ünïcode É À Ŝ İstanbul ΣΑΣ", "á é combining", "x\x1fy\x85z w v", "1234 a1b2 ... ?! (x), [y].",
    "<|endoftext|> a<|startoftext|>b", "漢字 漢字。", "🙂🙂 ok", "word,word word. word; word: WORD! Word?", "ﬁ ½ ª º µ", "a" * 500, "\u0000 nul",
    "ß ẞ SS ǅ", "́leading",
]


@pytest.fixture(scope="module")
def tokenizer():
    return tokenizers.Tokenizer.from_file(vocabulary_file())


def test_word_by_word_ids_are_the_tokenizers(tokenizer, monkeypatch):
    encoder = wordids.WordIds(vocabulary_file())
    monkeypatch.setattr(wordids, "KEPT_WORDS", 50)
    texts = [*STRANGE, prose(1, 400, "abcdeéüñßABC"), "", " ", None]
    for _ in range(2):
        ids, edges = encoder.texts(pa.array(texts), 1)
        for i, text in enumerate(texts):
            want = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
            assert ids[edges[i] : edges[i + 1]].tolist() == want, text


@pytest.mark.parametrize("group_bytes", [4_000_000, 3_000])
def test_round_trip(spark, tmp_path, tokenizer, monkeypatch, group_bytes):
    monkeypatch.setattr(packing, "GROUP_BYTES", group_bytes)
    rows = [r for r in odd_rows() if r[0] not in (7, None)] + [(100 + i, prose(i, 5 + 37 * i), "en", "s", 0) for i in range(40)]
    rows += [(300 + i, t, "en", "s", 0) for i, t in enumerate(STRANGE)]
    got = op6_packing(spark, saved(table(spark, rows, clashes=True), tmp_path)).collect()
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        windows[r.sequence_id].append(r)
    assert set(pieces) == {r[0] for r in rows}
    for r in rows:
        ids = np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1], dtype="<u4")
        at = 0
        for p in sorted(pieces[r[0]], key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for window in windows.values():
        at = 0
        for p in sorted(window, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048 and window[0].tier >= at and len({(p.tier, p.step_group) for p in window}) == 1


def test_repeated_rows_are_packed_as_often(spark, tmp_path):
    rows = [(7, "a few words here", None, None, None)] * 5 + [(None, None, None, None, None)] * 3
    got = op6_packing(spark, saved(table(spark, rows), tmp_path)).collect()
    assert sum(r.length for r in got if r.doc_id == 7) == 5 * next(r.doc_tokens for r in got if r.doc_id == 7)
    assert sum(r.length for r in got if r.doc_id is None) == 3
    assert op6_packing(spark, saved(table(spark, []), tmp_path / "none")).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_windows_are_full_but_the_last(seed):
    rng = random.Random(seed)
    lengths = [max(1, int(rng.lognormvariate(5.5, 1.4))) for _ in range(rng.choice([1, 7, 400]))] + [2048, 4096, 1]
    windows = packing.pack(lengths)
    covered = [set() for _ in lengths]
    for window in windows:
        for doc, start, n in window:
            new = set(range(start, start + n))
            assert n > 0 and not covered[doc] & new
            covered[doc] |= new
    assert [len(c) for c in covered] == lengths
    sizes = [sum(n for _, _, n in w) for w in windows]
    assert sum(n not in packing.TIERS for n in sizes) <= 1 and max(sizes) <= 2048


def test_step_groups_are_even():
    rng = random.Random(3)
    sizes = [rng.choice(packing.TIERS) for _ in range(500)]
    steps = packing.step_groups(sizes)
    load = np.bincount(steps, weights=sizes)
    assert load.max() - load.min() <= 2048 and len(load) == max(1, round(sum(sizes) / packing.STEP_TOKENS))
    assert packing.step_groups([]) == []
