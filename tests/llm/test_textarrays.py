"""Words and hashes of whole columns agree with plain Python."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from samples import odd_rows, prose
from tidemark.llm.textarrays import PUNCTUATION, Words, chunks, ranges, span_hash

TEXTS = [r[1] for r in odd_rows()] + [prose(2, 50), "a  b\x0bc\x1fd", "x"]


def test_words_are_those_of_split():
    words = Words(pa.array(TEXTS))
    for i, text in enumerate(TEXTS):
        want = (text or "").encode().split()
        a, b = words.first[i], words.first[i + 1]
        assert [words.data[x:y].tobytes() for x, y in zip(words.start[a:b], words.end[a:b], strict=True)] == want
        assert words.text_of(i) == want


def test_equal_words_and_runs_have_equal_hashes():
    words = Words(pa.array(["ab cd ab", None, "cd ab", "abcd"]))
    assert words.hash[0] == words.hash[2] == words.hash[4]
    assert len(set(words.hash.tolist())) == 3
    sums = words.prefix()
    runs = span_hash(sums, np.array([1, 3, 0]), np.array([3, 5, 2]))
    assert runs[0] == runs[1] != runs[2]


def test_texts_do_not_run_into_each_other():
    words = Words(pa.array(["ab", "cd"]))
    assert words.first.tolist() == [0, 1, 2]


def test_lower_case_and_other_separators():
    words = Words(pa.array(["It's 2-fold ÄB"]), lower=True, separators=PUNCTUATION)
    assert [words.data[a:b].tobytes().decode() for a, b in zip(words.start, words.end, strict=True)] == ["it", "s", "2", "fold", "Äb"]


def test_chunks_keep_rows_whole():
    column = pa.table({"text": ["a" * 10] * 10 + [None]})
    sizes = [part.num_rows for part in chunks(column, "text", 30)]
    assert sum(sizes) == 11 and max(sizes) <= 4
    assert list(chunks(column.slice(0, 0), "text")) == []


def test_ranges():
    at, owner = ranges(np.array([5, 9, 2]), np.array([2, 0, 3]))
    assert at.tolist() == [5, 6, 2, 3, 4] and owner.tolist() == [0, 0, 2, 2, 2]


def test_words_with_zero_bytes_are_told_apart():
    texts = ["c\x00 d", "\x00 \x00\x00 \x01", "a\x00b a\x00\x00b ab", "d c\x00\x00 e"]
    words = Words(pa.array(texts))
    each = [w for t in texts for w in t.split(" ")]
    assert len(set(words.hash.tolist())) == len(set(each))
