"""Elias-Fano sequences and a two-level n-gram trie on them, in memory-mapped arrays.

A sorted sequence of n numbers below u keeps the low log2(u / n) bits of each number packed, and the high parts in unary: n + u / 2^low
bits. All look-ups take arrays of places or numbers.
"""

from __future__ import annotations

import numpy as np

ONE = np.uint64(1)
SIX = np.uint64(6)
LAST = np.uint64(63)


def _select_in_word(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th (from 0) set bit of each 64-bit word, by halving."""
    place = np.zeros(len(words), np.uint64)
    k = k.astype(np.int64)
    for width in (32, 16, 8, 4, 2, 1):
        part = (words >> place) & np.uint64((1 << width) - 1)
        ones = np.bitwise_count(part).astype(np.int64)
        up = k >= ones
        k = np.where(up, k - ones, k)
        place = np.where(up, place + np.uint64(width), place)
    return place.astype(np.int64)


class EliasFano:
    """`arrays`: high (unary, 64-bit words), ones (set bits before each word), low (packed); `n`, `bits`: numbers, low bits of each."""

    def __init__(self, n: int, bits: int, high: np.ndarray, ones: np.ndarray, low: np.ndarray):
        self.n, self.bits, self.high, self.ones, self.low = n, bits, high, ones, low

    @classmethod
    def of(cls, numbers: np.ndarray) -> EliasFano:
        """From sorted 64-bit numbers."""
        numbers = numbers.astype(np.uint64)
        n = len(numbers)
        top = int(numbers[-1]) + 1 if n else 1
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        places = (numbers >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        size = int(places[-1]) + 2 if n else 1
        unary = np.zeros(-(-size // 64) * 64, np.uint8)
        unary[places] = 1
        high = np.packbits(unary, bitorder="little").view(np.uint64)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)]).astype(np.int64)
        low = np.zeros(-(-n * bits // 64) + 1, np.uint64)
        if bits:
            part = numbers & np.uint64((1 << bits) - 1)
            at = np.arange(n, dtype=np.int64) * bits
            word, shift = at >> 6, (at & 63).astype(np.uint64)
            # Several numbers share a word, so they are joined one after the other, not at once.
            np.bitwise_or.at(low, word, part << shift)
            over = np.flatnonzero(shift.astype(np.int64) + bits > 64)
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
        return cls(n, bits, high, ones, low)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.uint64)
        at = i * self.bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        first = self.low[word] >> shift
        rest = np.where(shift > 0, self.low[np.minimum(word + 1, len(self.low) - 1)] << ((np.uint64(64) - shift) & LAST), np.uint64(0))
        return (first | rest) & np.uint64((1 << self.bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The numbers at places i."""
        word = np.searchsorted(self.ones, i, side="right") - 1
        place = (word << 6) + _select_in_word(self.high[word], i - self.ones[word])
        return ((place - i).astype(np.uint64) << np.uint64(self.bits)) | self._low(i)

    def _before(self, high: np.ndarray) -> np.ndarray:
        """How many numbers have a high part below `high`: the set bits before the unary code's `high`-th zero."""
        k = high - 1
        zeros = (np.arange(len(self.ones)) << 6) - self.ones
        word = np.minimum(np.searchsorted(zeros, k, side="right") - 1, len(self.high) - 1)
        place = (word << 6) + _select_in_word(~self.high[word], k - zeros[word])
        return np.where(high <= 0, 0, np.minimum(place - k, self.n))

    def successor(self, x: np.ndarray, begin: np.ndarray | int = 0, end: np.ndarray | None = None) -> np.ndarray:
        """The first place in [begin, end) whose number is at least x; `end` if there is none."""
        end = np.full(len(x), self.n) if end is None else end
        high = (x >> np.uint64(self.bits)).astype(np.int64)
        # No number has a higher part than the unary code has zeros.
        most = len(self.high) * 64 - self.n
        left = np.where(high < most, self._before(np.minimum(high, most - 1)), self.n)
        right = np.where(high + 1 < most, self._before(np.minimum(high + 1, most - 1)), self.n)
        left, right = np.clip(left, begin, end), np.clip(right, begin, end)
        wanted = x & np.uint64((1 << self.bits) - 1)
        while len(going := np.flatnonzero(left < right)):
            middle = (left[going] + right[going]) >> 1
            less = self._low(middle) < wanted[going]
            left[going] = np.where(less, middle + 1, left[going])
            right[going] = np.where(less, right[going], middle)
        return left

    def find(self, x: np.ndarray, begin: np.ndarray | int = 0, end: np.ndarray | None = None) -> np.ndarray:
        """The place of x in [begin, end), or -1."""
        if not self.n:
            return np.full(len(x), -1)
        end = np.full(len(x), self.n) if end is None else end
        at = self.successor(x, begin, end)
        inside = np.flatnonzero(at < end)
        found = np.full(len(x), -1)
        same = self.get(at[inside]) == x[inside]
        found[inside[same]] = at[inside[same]]
        return found


class Trie:
    """Words, their contexts, and a value for each: `value(word, context)`, contexts being searched relative to the word.

    The contexts of a word are a range of the second level, where its pointer (a monotone sequence) says. To keep that level sorted
    across words, each word's contexts are raised by the word's place times 2^32.
    """

    def __init__(self, file: str, keys: np.ndarray, values: np.ndarray):
        """`keys`: sorted distinct word << 32 | context, 32 bits each; the levels are written to `file` and mapped from there."""
        words = keys >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]])) if len(keys) else np.zeros(0, np.int64)
        place = np.repeat(np.arange(len(first), dtype=np.uint64), np.diff(np.append(first, len(keys))))
        levels = [words[first], np.append(first, len(keys)), (place << np.uint64(32)) | (keys & np.uint64(0xFFFFFFFF))]
        coded = [EliasFano.of(x) for x in levels]
        arrays = [a for c in coded for a in (c.high, c.ones, c.low)] + [values]
        with open(file, "wb") as out:
            for a in arrays:
                out.write(a.tobytes() + bytes(-a.nbytes % 8))
        data, at, mapped = np.memmap(file, np.uint8, "r"), 0, []
        for a in arrays:
            mapped.append(data[at : at + a.nbytes].view(a.dtype))
            at += a.nbytes + -a.nbytes % 8
        self.words, self.pointers, self.contexts = (EliasFano(c.n, c.bits, *mapped[3 * i : 3 * i + 3]) for i, c in enumerate(coded))
        self.values = mapped[-1]

    def value(self, keys: np.ndarray, missing: int = 0) -> np.ndarray:
        """The value of each word << 32 | context."""
        found = np.full(len(keys), missing, self.values.dtype)
        word = self.words.find(keys >> np.uint64(32))
        known = np.flatnonzero(word >= 0)
        if len(known):
            w = word[known]
            begin, end = self.pointers.get(w).astype(np.int64), self.pointers.get(w + 1).astype(np.int64)
            at = self.contexts.find((w.astype(np.uint64) << np.uint64(32)) | (keys[known] & np.uint64(0xFFFFFFFF)), begin, end)
            found[known[at >= 0]] = self.values[at[at >= 0]]
        return found
