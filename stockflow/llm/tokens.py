"""Token ids of many texts by a public tokenizer, through its distinct words.

The tokenizer (BPE with word ends) breaks a text at white space, so the ids of a text are those of its words
in a row. Words repeat: each distinct one is encoded once and kept, and a text's ids are gathered from
there. Words are lower-cased (A-Z) first, as the tokenizer does itself; a mark that ends a word after a letter is a unit of its own.
Words that may hold a special token's string, or combining marks, are encoded as they are.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from stockflow.llm.words import Words, text_buffer

#: Kept words; beyond that the store starts anew. Only speed depends on it.
MOST_KEPT = 1_000_000
#: New words encoded at once: the tokenizer takes some hundred bytes for each of their characters.
AT_ONCE = 4096
_SENTENCE_ENDS = np.isin(np.arange(256), np.frombuffer(b".!?", np.uint8))
_CLOSING = np.isin(np.arange(256), np.frombuffer(b".,;:!?", np.uint8))
_RAW_SALT = np.uint64(0xD6E8FEB86659FD93)


class Encoder:
    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.closes[i] = token.endswith("</w>")
        self.clear()

    def clear(self) -> None:
        self.keys, self.starts, self.lengths = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def _encode(self, units: list[bytes], plain: np.ndarray) -> list[np.ndarray]:
        """Ids of each unit; `plain` units are letters only, so each ends with the one id that closes a word."""
        found: list[np.ndarray] = [np.zeros(0, np.int32)] * len(units)
        letters = np.flatnonzero(plain)
        if len(letters):
            ids = np.array(self.tokenizer.encode(" ".join(units[i].decode() for i in letters), add_special_tokens=False).ids, np.int32)
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) == len(letters):
                for i, part in zip(letters, np.split(ids, ends[:-1]), strict=True):
                    found[i] = part
            else:
                plain = np.zeros(len(units), bool)
        others = np.flatnonzero(~plain)
        texts = [units[i].decode() for i in others]
        for i, e in zip(others, self.tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
            found[i] = np.array(e.ids, np.int32)
        return found

    def _learn(self, keys: np.ndarray, units: list[bytes], plain: np.ndarray) -> None:
        found = []
        for i in range(0, len(units), AT_ONCE):
            found += self._encode(units[i : i + AT_ONCE], plain[i : i + AT_ONCE])
        lengths = np.array([len(x) for x in found], np.int64)
        starts = len(self.ids) + np.cumsum(lengths) - lengths
        self.ids = np.concatenate([self.ids, *found])
        keys, starts, lengths = np.concatenate([self.keys, keys]), np.concatenate([self.starts, starts]), np.concatenate([self.lengths, lengths])
        order = np.argsort(keys, kind="stable")
        self.keys, self.starts, self.lengths = keys[order], starts[order], lengths[order]

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts, each with `end_id` after it; n + 1 offsets; places where a sentence or a text ends)."""
        words = Words(texts)
        low, begin, end = words.bytes, words.begin, words.end
        n = len(low)
        raw, _ = text_buffer(texts)
        # Words that are encoded as they are: "<|" begins a special token, 0xCC and 0xCD begin combining marks.
        odd = (raw == 0xCC) | (raw == 0xCD)
        odd[:-1] |= (raw[:-1] == 0x3C) & (raw[1:] == 0x7C)
        sums = np.zeros(n + 1, np.int32)
        np.cumsum(odd, out=sums[1:])
        is_odd = sums[end] > sums[begin]
        # A closing mark after a letter: a-z, or one of U+00C0 to U+00FF.
        before, before2 = low[np.maximum(end - 2, 0)], low[np.maximum(end - 3, 0)]
        letter = ((before >= 97) & (before <= 122)) | ((before2 == 0xC3) & (end - begin >= 3) & (before >= 0x80) & (before != 0x97) & (before != 0xB7))
        split = np.flatnonzero(_CLOSING[low[np.maximum(end - 1, 0)]] & (end - begin >= 2) & letter & ~is_odd) if n else np.zeros(0, np.int64)
        # Units in order: each word, its closing mark, and after each text its end.
        marks = end[split] - 1
        unit_end = end.copy()
        unit_end[split] -= 1
        ends = words.first[1:]
        b = np.insert(begin, np.concatenate([split + 1, ends]), np.concatenate([marks, np.full(len(ends), -1)]))
        e = np.insert(unit_end, np.concatenate([split + 1, ends]), np.concatenate([end[split], np.full(len(ends), -1)]))
        o = np.insert(is_odd, np.concatenate([split + 1, ends]), False)
        real = b >= 0
        rb, re, ro = b[real], e[real], o[real]
        keys = words.hash_of(rb, re)
        if ro.any():
            raw_words = Words(texts, lower=False)
            keys[ro] = raw_words.hash_of(rb[ro], re[ro]) ^ _RAW_SALT
        distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.keys) > MOST_KEPT:
            self.clear()
        at = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == distinct[inside]
        missing = np.flatnonzero(~known)
        if len(missing):
            i = first[missing]
            units = [(raw if odd_ else low)[x:y].tobytes() for x, y, odd_ in zip(rb[i], re[i], ro[i], strict=True)]
            plain = np.array([u.isalpha() for u in units], bool)  # bytes: a-z only
            self._learn(distinct[missing], units, plain)
            at = np.searchsorted(self.keys, distinct)
        lengths, starts = np.ones(len(b), np.int64), np.zeros(len(b), np.int64)
        lengths[real], starts[real] = self.lengths[at][inverse], self.starts[at][inverse]
        upto = np.concatenate([[0], np.cumsum(lengths)])
        ids = np.empty(upto[-1], np.int32)
        ids[:] = np.concatenate([self.ids, [end_id]])[self._places(starts, lengths, upto, real)]
        text_ends = np.flatnonzero(~real)
        last = np.zeros(len(b), bool)
        last[real] = _SENTENCE_ENDS[low[re - 1]] if n else False
        last[real] |= (np.append(low, 0)[re] == 10) if n else False
        last[text_ends] = True
        return ids, np.concatenate([[0], upto[text_ends + 1]]), upto[1:][last]

    def _places(self, starts, lengths, upto, real) -> np.ndarray:
        """Where each id lies in the store; the place after its end for a text's end."""
        starts = np.where(real, starts, len(self.ids))
        return np.repeat(starts - upto[:-1], lengths) + np.arange(upto[-1])


_encoders: dict[str, Encoder] = {}


def encoder(file: str) -> Encoder:
    """One encoder per file and Python worker, so that words stay known from task to task."""
    if file not in _encoders:
        _encoders[file] = Encoder(file)
    return _encoders[file]
