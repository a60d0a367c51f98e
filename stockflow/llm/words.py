"""Words of many texts at once: boundaries and 64-bit hashes from Arrow buffers, without a Python loop per word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: A-Z to a-z, every other byte unchanged (UTF-8 continuation bytes are never in A-Z).
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: The white space of a word boundary: space and 0x09 to 0x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: An odd multiplier of the polynomial hash of a word's bytes, and its inverse modulo 2^64.
PRIME = 0x9E3779B97F4A7C15
INVERSE = pow(PRIME, -1, 1 << 64)

#: ASCII marks that may surround a word.
MARK = np.zeros(256, dtype=bool)
MARK[33:127] = True
MARK[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False

_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values so that every bit depends on all bits (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _grow(n: int) -> None:
    global _powers, _inverses
    if len(_powers) < n:
        size = -(-n // (1 << 18)) << 18
        _powers, _inverses = np.full(size, PRIME, np.uint64), np.full(size, INVERSE, np.uint64)
        _powers[0] = _inverses[0] = 1
        np.multiply.accumulate(_powers, out=_powers)
        np.multiply.accumulate(_inverses, out=_inverses)


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the n + 1 offsets into them; a null text is empty."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    starts = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[starts[0] : starts[-1]] if len(starts) else raw[:0], starts - starts[0]


class Words:
    """The words `[^\\x20\\x09-\\x0D]+` of a batch of texts.

    `begin`, `end`: byte positions; `doc`: index of the text; `first`: index of each text's first
    word, n + 1 values; `hash`: of the word's lower-cased (A-Z) bytes.
    """

    def __init__(self, texts: pa.Array, lower: bool = True):
        raw, offsets = text_buffer(texts)
        self.offsets = offsets
        self.bytes = LOWER[raw] if lower else raw
        n = len(raw)
        inside = ~SPACE[raw]
        # A word also ends where its text ends.
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < n)]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        opens[cuts] = inside[cuts]
        closes[cuts - 1] = inside[cuts - 1]
        self.begin = np.flatnonzero(opens)
        self.end = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.begin, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        _grow(n + 1)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum((self.bytes.astype(np.uint64) + np.uint64(1)) * _powers[:n], out=self._sums[1:])
        self.hash = self.hash_of(self.begin, self.end)

    def hash_of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of byte ranges; equal bytes have equal hashes wherever they lie."""
        h = (self._sums[end] - self._sums[begin]) * _inverses[begin]
        return mix(h ^ ((end - begin).astype(np.uint64) << np.uint64(48)))

    def trimmed(self) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of each word without the ASCII marks around it; a word of marks alone keeps one."""
        begin, end = self.begin.copy(), self.end.copy()
        while len(more := np.flatnonzero(MARK[self.bytes[end - 1]] & (end - begin > 1))):
            end[more] -= 1
        while len(more := np.flatnonzero(MARK[self.bytes[begin]] & (end - begin > 1))):
            begin[more] += 1
        return begin, end

    def __len__(self) -> int:
        return len(self.begin)
