"""Token alignment: every group and link found again by walking both sides byte by byte."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from samples import odd_rows, prose, saved, table
from tidemark.llm import tokenalign
from tidemark.llm.queries import QUERIES, vocabulary_file

A_FILE, B_FILE = vocabulary_file("byte_bpe_50k.json"), vocabulary_file("piece_bpe_32k.model")
ODD = [
    "don't  stop\r\n\tnow ", "   ", "\x00 null \x01", "▁ is not a space", "<s> </s> <|endoftext|> <0x41>", "漢字 🙂 é é ½ Ⅷ",
    "a" * 5000, "I'LL we'll 1234567 __ ###", " ​x y",
]


@pytest.fixture(scope="module")
def plain():
    """The two tokenizers as installed: (ids, token bytes) of a text."""
    t = Tokenizer.from_file(A_FILE)
    t.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown}
    for b in range(256):
        if b not in shown:
            byte_of[chr(256 + len(byte_of) - len(shown))] = b

    def side_a(text):
        ids = t.encode(" " + text, add_special_tokens=False).ids
        return ids, [bytes(byte_of[c] for c in t.id_to_token(i)) for i in ids]

    def side_b(text):
        ids = model.encode(text)
        pieces = [model.id_to_piece(i) for i in ids]
        return ids, [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids, pieces, strict=True)]

    return side_a, side_b


def walked(plain, text):
    """Groups [(a ids, b ids)] and the Counter of linked id pairs of one text."""
    if not text:
        return [], Counter()
    (a, a_bytes), (b, b_bytes) = plain[0](text), plain[1](text)
    if b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
        return [], Counter()
    owner_a = [i for i, x in enumerate(a_bytes) for _ in x]
    owner_b = [i for i, x in enumerate(b_bytes) for _ in x]
    links = Counter((a[i], b[j]) for i, j in set(zip(owner_a, owner_b, strict=True)))
    groups, begin_a, begin_b = [], 0, 0
    for at in range(len(owner_a)):
        last = at + 1 == len(owner_a)
        if last or (owner_a[at] != owner_a[at + 1] and owner_b[at] != owner_b[at + 1]):
            groups.append((a[begin_a : owner_a[at] + 1], b[begin_b : owner_b[at] + 1]))
            begin_a, begin_b = owner_a[at] + 1, owner_b[at] + 1
    return groups, links


def digest(groups):
    if not groups:
        return ""
    return hashlib.sha256(";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups).encode()).hexdigest()


def expected(plain, rows):
    walks = [(doc_id, *walked(plain, text)) for doc_id, text, *_ in rows]
    counts = Counter()
    for _, _, links in walks:
        counts.update(links)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    return sorted([
        (doc_id, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(links.values()),
         sum(n for p, n in links.items() if counts[p] == most[p[1]]), sum(n * counts[p] for p, n in links.items()), digest(groups))
        for doc_id, groups, links in walks
    ], key=repr)


ROWS = [*odd_rows(), *[(100 + i, t, "en", "s", 1) for i, t in enumerate(ODD)], *[(200 + i, prose(i, 60), "en", "s", 1) for i in range(40)]]


def test_query_agrees_with_walking(spark, tmp_path, plain):
    folder = saved(table(spark, ROWS, clashes=True), tmp_path)
    found = sorted([tuple(r) for r in QUERIES["op12_token_alignment"](spark, folder).collect()], key=repr)
    assert found == expected(plain, ROWS)


def test_pairs_beyond_the_table_are_joined(spark, tmp_path, plain, monkeypatch):
    folder = saved(table(spark, ROWS), tmp_path)
    for limit in (0, 50):
        monkeypatch.setattr(tokenalign, "HEAD_PAIRS", limit)
        found = sorted([tuple(r) for r in QUERIES["op12_token_alignment"](spark, folder).collect()], key=repr)
        assert found == expected(plain, ROWS)


def test_detail_gives_ids_and_groups(spark, plain):
    rows = [(i, t, "en", "s", 1) for i, t in enumerate([*ODD, "", None, prose(3, 200)])]
    for r in tokenalign.aligned(table(spark, rows), A_FILE, B_FILE, detail=True).collect():
        groups, _ = walked(plain, rows[r.id][1])
        assert r.a_ids == [i for x, _ in groups for i in x]
        assert r.b_ids == [i for _, y in groups for i in y]
        assert r.a_group == [g for g, (x, _) in enumerate(groups) for _ in x]
        assert r.b_group == [g for g, (_, y) in enumerate(groups) for _ in y]


def test_empty_table(spark, tmp_path):
    assert QUERIES["op12_token_alignment"](spark, saved(table(spark, []), tmp_path)).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=40), st.randoms())
def test_pointer_jumping_finds_all_common_ends(sizes, rng):
    a_end = np.cumsum(sizes)
    cuts = sorted(rng.sample(range(1, int(a_end[-1])), k=rng.randint(0, int(a_end[-1]) - 1))) if a_end[-1] > 1 else []
    b_end = np.array([*cuts, int(a_end[-1])])
    end_a, end_b = tokenalign.terminals(a_end, b_end)
    common = np.intersect1d(a_end, b_end)
    assert (a_end[end_a] == common[np.searchsorted(common, a_end)]).all()
    assert (a_end[end_b] == common[np.searchsorted(common, b_end)]).all()


def test_long_chain_of_overlaps():
    """Boundaries that never meet before the end: one group, found in a few doublings."""
    a_end = np.append(np.arange(2, 200_001, 2), 200_001)
    b_end = np.arange(1, 200_002, 2)
    end_a, end_b = tokenalign.terminals(a_end, b_end)
    assert (end_a == len(a_end) - 1).all()
    assert (end_b == len(a_end) - 1).all()
