"""Token ids of whole texts, each distinct word looked up once.

The tokenizer drops white space and never joins what stands on its two sides, so a
text's ids are those of its white-space separated words in order; nor does it join
letters with a mark after them, apostrophes aside. Tests compare ids with the
tokenizer's own. Most words are letters only; for these the same vocabulary runs
without its normaliser and splitter, on long lists of words at a time.

Words are known by a 64-bit hash of their bytes; a bounded table keeps their ids.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa

from tidemark.llm.textarrays import Words, ranges

#: Words kept, at about 25 bytes each; beyond that the table starts anew.
KEPT_WORDS = 3_000_000
_LIST = 4_000
_INDIVIDUAL = "İ"  # from here on lower case may depend on the library: the tokenizer's own way is taken
_SPECIAL = b"<|"  # texts that may hold a special token are given to the tokenizer whole

#: ASCII marks but the apostrophe, which may begin a contraction.
_IS_MARK = np.zeros(256, dtype=bool)
_IS_MARK[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "'"]] = True
_MAY_BE_LETTER = np.zeros(256, dtype=bool)
_MAY_BE_LETTER[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True


class WordIds:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.whole.get_vocab()
        self.dtype = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        self.last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for token, number in vocabulary.items():
            self.last[number] = token.endswith("</w>")
        self._forget()

    def _forget(self) -> None:
        """Start the table: sorted keys, and for each where its ids are, how many, and if it is letters only."""
        self.keys = np.zeros(0, np.uint64)
        self.begin, self.size, self.letters = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, bool)
        self.pool = np.zeros(0, self.dtype)

    def _encode(self, word: str) -> np.ndarray:
        return np.array(self.whole.encode(word, add_special_tokens=False).ids, dtype=self.dtype)

    def _encode_plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for words of lower-case letters; each ends with one word-ending token."""
        lists = [" ".join(words[a : a + _LIST]) for a in range(0, len(words), _LIST)]
        ids = np.concatenate([np.array(e.ids, np.int64) for e in self.plain.encode_batch_fast(lists, add_special_tokens=False)])
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):
            each = [self._encode(word) for word in words]
            return np.concatenate(each), np.array([len(x) for x in each])
        return ids.astype(self.dtype), np.diff(np.concatenate([[0], ends]))

    def _learn(self, keys: np.ndarray, words: list[bytes]) -> None:
        """Add lower-case words that the table does not have."""
        plain, others = [], []
        for i, word in enumerate(words):
            text = word.decode("utf-8", "replace")
            if text.isalpha() and (word.isascii() or (max(text) < _INDIVIDUAL and unicodedata.is_normalized("NFC", text))):
                plain.append((i, text if word.isascii() else text.lower()))
            else:
                others.append((i, self._encode(text)))
        ids, sizes = self._encode_plain([t for _, t in plain]) if plain else (np.zeros(0, self.dtype), np.zeros(0, np.int64))
        order = np.array([i for i, _ in plain] + [i for i, _ in others], dtype=np.int64)
        sizes = np.concatenate([sizes, [len(x) for _, x in others]]).astype(np.int32)
        begin = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])[:-1] + len(self.pool)
        self.pool = np.concatenate([self.pool, ids, *[x for _, x in others]])
        merged = np.concatenate([self.keys, keys[order]])
        by = np.argsort(merged)
        self.keys, self.begin, self.size, self.letters = (
            x[by] for x in (
                merged, np.concatenate([self.begin, begin]), np.concatenate([self.size, sizes]),
                np.concatenate([self.letters, np.arange(len(order)) < len(plain)]),
            )
        )

    def _slots(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slot = np.searchsorted(self.keys, hashes)
        slot[slot == len(self.keys)] = 0
        return slot, self.keys[slot] == hashes if len(self.keys) else np.zeros(len(hashes), bool)

    def _rows(self, words: Words, blob: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The table's rows for the words at start:end, distinct ones learnt first."""
        which, hashes = pd.factorize(words.bytes_hash(start, end))
        one = np.empty(len(hashes), np.int64)
        one[which[::-1]] = np.arange(len(which))[::-1]
        _, known = self._slots(hashes)
        new = one[~known]
        if len(new):
            self._learn(hashes[~known], [blob[a:b] for a, b in zip(start[new].tolist(), end[new].tolist(), strict=True)])
        return self._slots(hashes)[0][which]

    def texts(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts, each with `end_id` after it, and where each text's ids begin."""
        words = Words(column, lower=True)
        data, first = words.data, words.first
        blob = data.tobytes()
        # Letters and the marks after them are two words.
        body = np.maximum.accumulate(np.where(_IS_MARK[data], -1, np.arange(len(data)))) if len(data) else data
        core_end = np.maximum(body[words.end - 1] + 1, words.start) if len(words.end) else words.end
        cut = (core_end > words.start) & (core_end < words.end)
        cut &= _MAY_BE_LETTER[data[np.maximum(core_end - 1, 0)]] if len(data) else False
        core_end = np.where(cut, core_end, words.end)
        if len(self.keys) > KEPT_WORDS:
            self._forget()
        core = self._rows(words, blob, words.start, core_end)
        # What is not letters only goes with its marks; this may happen after more words are learnt.
        odd = cut & ~self.letters[core] if len(core) else cut
        core_end = np.where(odd, words.end, core_end)
        cut &= ~odd
        start = np.insert(words.start, np.flatnonzero(cut) + 1, core_end[cut])
        end = np.insert(core_end, np.flatnonzero(cut) + 1, words.end[cut])
        first = first + np.concatenate([[0], np.cumsum(cut)])[first]
        rows = self._rows(words, blob, start, end)
        size = self.size[rows].astype(np.int64) if len(rows) else np.zeros(0, np.int64)
        upto = np.concatenate([[0], np.cumsum(size)])
        edges = upto[first] + np.arange(len(first))
        out = np.empty(int(edges[-1]), dtype=self.dtype)
        source, owner = ranges(self.begin[rows], size) if len(rows) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        out[np.arange(len(source)) + text[owner]] = self.pool[source]
        out[edges[1:] - 1] = end_id
        return self._special(column, out, edges, end_id) if _SPECIAL in blob else (out, edges)

    def _special(self, column: pa.Array, out: np.ndarray, edges: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        parts = []
        for i, text in enumerate(column.to_pylist()):
            if text and "<|" in text:
                parts.append(np.append(self._encode(text), self.dtype.type(end_id)))
            else:
                parts.append(out[edges[i] : edges[i + 1]])
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


_loaded: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One per process and vocabulary file, so that the table outlives a task."""
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]
