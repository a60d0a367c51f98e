"""Periodic runs of words, by branching tandem repeats over an enhanced suffix array.

A run is a stretch of words with smallest period q (words q apart are identical) that no neighbouring word extends; those of at least
`least` words and `times` periods are found. The texts of a slice are one sequence of numbers, a number for each (text, word), so that nothing
repeats across texts:

1. Suffix array by doubling, of the suffixes that still tie only, with its inverse (ISA). The LCP array comes with it: neighbours that part in
   a round share the round's length plus what the suffixes behind it share, a range minimum over what is known by then.
2. LCP intervals as pairs of ranges of ranks: for each LCP value d, the ranks before it and behind it that share d words at least (nearest smaller
   values, by a pyramid of minima); no tree is made. Of the two ranges, every suffix i of the smaller one is tested: if ISA[i + d] or
   ISA[i - d] is in the other range, i and i + d (i - d and i) share exactly d words, which is a tandem repeat of period d that
   cannot be shifted to the right. Each run of period d ends with one of these.
3. Rotation to the left: a square stays one as long as the words before it agree. How far that goes is found by bisection, since the suffixes at s and
   s + d must share all words up to the run's end (LCP of two ranks: a range minimum).
4. Squares of one run meet in the same start and end, whatever multiple of its period they have; the smallest is the run's.

All steps are over arrays; numbers stand for exact words (an Arrow dictionary), no hashes. Time grows as n log n with a slice's words, memory with
the words of a slice or of one longer text.

Defined results: null and empty texts and those of white space alone have no words and no run; equal texts have equal runs; repeated rows, rows without doc_id and ties
stay rows of their own; an empty table gives an empty result; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stockflow.llm.common import ship, text_slices
from stockflow.llm.words import SPACE, text_buffer

#: Pairs of a range's suffix and its LCP value that are tested at once.
STEP = 1 << 20

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


class Minima:
    """Minima of the ranges of an array, in a pyramid over it."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while len(values) > 1:
            if len(values) % 2:
                values = np.append(values, values[-1])
            values = np.minimum(values[::2], values[1::2])
            self.levels.append(values)

    def least(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The least value of each range [begin, end), none of them empty."""
        found = np.full(len(begin), np.iinfo(self.levels[0].dtype).max, self.levels[0].dtype)
        begin, end = begin.copy(), end.copy()
        for values in self.levels:
            odd = np.flatnonzero((begin & 1 == 1) & (begin < end))
            found[odd] = np.minimum(found[odd], values[begin[odd]])
            begin[odd] += 1
            odd = np.flatnonzero((end & 1 == 1) & (begin < end))
            end[odd] -= 1
            found[odd] = np.minimum(found[odd], values[end[odd]])
            begin >>= 1
            end >>= 1
        return found

    def next_below(self, at: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """The first place behind `at` whose value is below `limit`; there must be one."""
        place, height = at + 1, np.full(len(at), -1)
        open_ = np.arange(len(at))
        for level, values in enumerate(self.levels):
            # An even place is asked through its parent, which begins there too; at the top there is none.
            ask = open_[(place[open_] & 1 == 1) | (level == len(self.levels) - 1)]
            inside = ask[place[ask] < len(values)]
            hit = inside[values[place[inside]] < limit[inside]]
            height[hit] = level
            place[np.setdiff1d(ask, hit, assume_unique=True)] += 1
            open_ = open_[height[open_] < 0]
            place[open_] >>= 1
        for level in range(len(self.levels) - 1, 0, -1):
            down = np.flatnonzero(height == level)
            values = self.levels[level - 1]
            left = 2 * place[down]
            place[down] = left + (values[left] >= limit[down])
            height[down] = level - 1
        return place


def word_numbers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Numbers of all texts' words `[^\\x20\\x09-\\x0D]+`, each text's first place (n + 1 values), and the words that the numbers stand for."""
    raw, offsets = text_buffer(texts)
    inside = ~SPACE[raw]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(raw))]
    opens[cuts], closes[cuts - 1] = inside[cuts], inside[cuts - 1]
    begin, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    places = np.concatenate([[0], np.cumsum(end - begin)])
    words = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(places), pa.py_buffer(raw[inside]))
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(), np.searchsorted(begin, offsets), coded.dictionary


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array, its inverse, and LCP: lcp[k] of the suffixes at ranks k - 1 and k; lcp[0] and the last one, lcp[n], are 0."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    first = np.concatenate([[True], np.diff(symbols[order]) != 0])
    unknown = np.iinfo(np.int32).max
    lcp = np.where(first, 0, unknown).astype(np.int32)
    head = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    isa = np.empty(n + 1, np.int64)
    isa[order], isa[n] = head, -1
    tied = np.flatnonzero(~first | np.append(~first[1:], False))
    width = 1
    while len(tied):
        at = order[tied]
        group, behind = isa[at], isa[np.minimum(at + width, n)]
        by = np.lexsort((behind, group))
        at, group, behind = at[by], group[by], behind[by]
        order[tied] = at
        new = np.concatenate([[True], (np.diff(group) != 0) | (np.diff(behind) != 0)])
        parted = np.flatnonzero(new[1:] & (np.diff(group) == 0)) + 1
        if len(parted):
            a, b = behind[parted - 1], behind[parted]  # a < b; -1: nothing is behind
            shared = np.zeros(len(parted), np.int32)
            some = np.flatnonzero(a >= 0)
            shared[some] = Minima(lcp).least(a[some] + 1, b[some] + 1)
            lcp[tied[parted]] = width + shared
        head = tied[np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))]
        isa[at] = head
        tied = tied[~new | np.append(~new[1:], False)]
        width *= 2
    isa[order] = np.arange(n)
    return order, isa[:n], np.append(lcp, 0).astype(np.int32)


def squares(order: np.ndarray, isa: np.ndarray, lcp: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, d): words [i, i + d) come again at i + d, and no further word does. `most`: for each suffix, the longest period of interest."""
    n = len(order)
    at = np.flatnonzero((lcp[:n] > 0) & (lcp[:n] <= most[order]))
    if not len(at):
        return at, at
    d = lcp[at].astype(np.int64)
    # Ranks [low, at) and [at, high) share d words: a value like d ends the range on the left, not on the right, so each pair is in one place.
    low = len(lcp) - 1 - Minima(lcp[::-1].copy()).next_below(len(lcp) - 1 - at, d + 1)
    high = Minima(lcp).next_below(at, d)
    left = at - low <= high - at
    begin, size = np.where(left, low, at), np.where(left, at - low, high - at)
    other, other_end = np.where(left, at, low), np.where(left, high, at)
    found_at, found_d = [], []
    ends = np.cumsum(size)
    start = 0
    while start < len(at):
        # Ranges together of about STEP suffixes, one range at least.
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + STEP, side="right")))
        k = np.repeat(np.arange(start, stop), size[start:stop])
        rank = begin[k] + np.arange(len(k)) - np.repeat(ends[start:stop] - size[start:stop] - (ends[start - 1] if start else 0), size[start:stop])
        i = order[rank]
        for there, square in ((i + d[k], i), (i - d[k], i - d[k])):
            ok = (there >= 0) & (there < n)
            r = isa[np.where(ok, there, 0)]
            ok &= (r >= other[k]) & (r < other_end[k])
            found_at.append(square[ok])
            found_d.append(d[k][ok])
        start = stop
    return np.concatenate(found_at), np.concatenate(found_d)


def find_runs(symbols: np.ndarray, first: np.ndarray, least: int = 6, times: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of the runs of at least `least` words and `times` (2 or more) periods in texts that begin at `first`, ordered by start and period."""
    n = len(symbols)
    none = np.zeros(0, np.int64)
    if not n:
        return none, none, none
    sizes = np.diff(first)
    text = np.repeat(np.arange(len(sizes)), sizes)
    order, isa, lcp = suffix_array(text << 32 | symbols)
    at, period = squares(order, isa, lcp, (sizes // times)[text])
    end = at + 2 * period
    shared = Minima(lcp)

    def reaches(s: np.ndarray, d: np.ndarray, e: np.ndarray) -> np.ndarray:
        """Whether the words from s on have period d up to e."""
        a, b = isa[s], isa[s + d]
        return shared.least(np.minimum(a, b) + 1, np.maximum(a, b) + 1) >= e - d - s

    # A run that is long enough reaches back so far; then further, by bisection.
    low, high = first[text[at]], end - np.maximum(times * period, least)
    ok = high >= low
    at, period, end, low, high = at[ok], period[ok], end[ok], low[ok], high[ok]
    ok = reaches(high, period, end)
    at, period, end, low, high = at[ok], period[ok], end[ok], low[ok], high[ok]
    while len(going := np.flatnonzero(low < high)):
        middle = (low[going] + high[going]) // 2
        ok = reaches(middle, period[going], end[going])
        high[going[ok]] = middle[ok]
        low[going[~ok]] = middle[~ok] + 1
    by = np.lexsort((period, end, high))
    start, end, period = high[by], end[by], period[by]
    same = np.concatenate([[False], (np.diff(start) == 0) & (np.diff(end) == 0)])[: len(start)]
    start, end, period = start[~same], end[~same], period[~same]
    by = np.lexsort((period, start))
    return start[by], end[by], period[by]


def collapsed(texts_of_words: np.ndarray, keep: np.ndarray, first: np.ndarray, words: pa.Array) -> pa.Array:
    """Each text's kept words, joined by one space."""
    kept = texts_of_words[keep]
    places = np.searchsorted(np.flatnonzero(keep), first).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(places), words.take(pa.array(kept)).cast(pa.string()))
    return pa.compute.binary_join(lists, " ")


def find(docs: DataFrame, least: int = 6, times: int = 4) -> DataFrame:
    """(doc_id, runs, collapsed) of every row: the runs by start, then period, in word numbers; the words that are left when every run
    keeps its first period, joined by one space."""
    ship(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            symbols, first, words = word_numbers(part.column("text"))
            start, end, period = find_runs(symbols, first, least, times)
            text = np.searchsorted(first, start, side="right") - 1
            places = np.searchsorted(text, np.arange(part.num_rows + 1)).astype(np.int32)
            columns = [pa.array(c.astype(np.int64)) for c in (start - first[text], end - start, period)]
            lists = pa.ListArray.from_arrays(pa.array(places), pa.StructArray.from_arrays(columns, ["start", "length", "period"]))
            marks = np.zeros(len(symbols) + 1, np.int64)
            np.add.at(marks, start + period, 1)
            np.add.at(marks, end, -1)
            left = collapsed(symbols, np.cumsum(marks[:-1]) == 0, first, words)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists, left], ["doc_id", "runs", "collapsed"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(rows, f"doc_id long, runs {RUNS}, collapsed string")
