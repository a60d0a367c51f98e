"""Packing token ids into sequences by an order-preserving dynamic programme.

Texts are laid end to end in the order of the table's partitions; windows of at most `size` ids are cut from that
line. A cut is free where a sentence or a text ends and costs `cut` elsewhere; a window costs what it is padded, from its
length to `size`, nothing if its length is a power of two (`short` for one that is not full). The cheapest cuts follow from
    cost(j) = min over i of cost(i) + m * size - (p_j - p_i) + (m - 1) * cut,   (m - 1) * size < p_j - p_i <= m * size
over the places p where sentences end, m windows at a time (the inner ones full, cut wherever that falls). For each m the
minimum of cost(i) + p_i slides along the line: a monotone queue holds it.

Each partition is packed on its own, in runs of `run` ids: no shuffle, memory bounded by a run and a text. The last window
of a run is carried into the next; what remains of a partition in the end is cut into powers of two if that is cheaper than padding.

Defined results: null and empty texts are the end id alone; repeated rows are packed as often as they occur, a null doc_id is
carried through; an empty table gives an empty result; further columns are not looked at. Sequence ids hold the
partition's number, so that they are unique; the same files in the same splits give the same sequences.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from stockflow.llm import tokens
from stockflow.llm.common import SMALL_SLICE_BYTES, ship, text_slices

SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def places(ends: np.ndarray, total: int, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the line may be cut (0 and `total` among them), and whether the place is inside a sentence: a longer one is opened every `gap` ids."""
    free = np.unique(np.concatenate([[0], ends, [total]]))
    wide = np.flatnonzero(np.diff(free) > 2 * gap)
    inner = [np.arange(free[i] + gap, free[i + 1], gap) for i in wide]
    every = np.concatenate([free, *inner])
    order = np.argsort(every, kind="stable")
    return every[order], np.concatenate([np.zeros(len(free), bool), *[np.ones(len(x), bool) for x in inner]])[order]


def cheapest(spots: np.ndarray, inner: np.ndarray, size: int, cut: int, short: int, runs: int = 2) -> tuple[list[int], list[int], list[int]]:
    """For each place: the least cost, the place before it and how many windows lie between (0: one of a power of two)."""
    p, n = spots.tolist(), len(spots)
    powers = []
    for k in range(size.bit_length() - 1):
        at = np.searchsorted(spots, spots - (1 << k))
        at[spots[np.minimum(at, n - 1)] != spots - (1 << k)] = -1
        powers.append(at)
    power = np.stack(powers)
    has_power = (power >= 0).any(axis=0).tolist()
    extra = (inner * cut).tolist()
    cost, before, windows = [0] * n, [0] * n, [0] * n
    queues = [deque() for _ in range(runs)]
    entered, value = [0] * runs, [0] * n
    best_possible = float("inf")
    for j in range(1, n):
        here, best, source, kind = p[j], best_possible, 0, 1
        for m in range(runs):
            queue, i = queues[m], entered[m]
            newest, oldest = here - size * m, here - size * (m + 1)
            while i < j and p[i] < newest:
                v = value[i]
                while queue and value[queue[-1]] >= v:
                    queue.pop()
                queue.append(i)
                i += 1
            entered[m] = i
            while queue and p[queue[0]] < oldest:
                queue.popleft()
            if queue:
                c = value[queue[0]] + size * (m + 1) - here + m * cut
                if c < best:
                    best, source, kind = c, queue[0], m + 1
        if has_power[j]:
            for i in power[:, j].tolist():
                if i >= 0 and cost[i] + short < best:
                    best, source, kind = cost[i] + short, i, 0
        cost[j], before[j], windows[j] = best + extra[j], source, kind
        value[j] = cost[j] + here
    return cost, before, windows


def windows(ends: np.ndarray, total: int, size: int, cut: int, short: int, last: bool) -> list[tuple[int, int]]:
    """The windows of a line of `total` ids; of one that goes on, those before its last cut."""
    spots, inner = places(ends, total, size // 8)
    cost, before, kinds = cheapest(spots, inner, size, cut, short)
    j = len(spots) - 1
    if not last:
        # Any place in the last window's reach may end the run: the one that costs least per id so far.
        near = np.flatnonzero(spots >= total - size)
        near = near[near > 0]
        j = int(near[np.argmin(np.array(cost)[near] - spots[near] * 1e-6)])
    found = []
    while j > 0:
        i, kind = before[j], kinds[j]
        edges = [int(spots[i]) + size * m for m in range(max(kind, 1))] + [int(spots[j])]
        found += list(zip(edges[:-1], edges[1:], strict=True))[::-1]
        j = i
    found.reverse()
    if last and found:
        a, b = found[-1]
        bits = [1 << k for k in range((b - a).bit_length()) if (b - a) >> k & 1][::-1]
        if len(bits) > 1 and (len(bits) - 1) * (cut + short) < size - (b - a):
            found[-1:] = [(a + sum(bits[:k]), a + sum(bits[: k + 1])) for k in range(len(bits))]
    return found


class Line:
    """The ids of a partition that are not packed yet, and the texts that they are of."""

    def __init__(self, size: int, cut: int, short: int):
        self.size, self.cut, self.short = size, cut, short
        self.ids, self.ends = np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.docs: list[tuple] = []  # (doc_id, ids of the text, where it begins on the line; below 0 if a part is packed)
        self.sequence = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32

    def add(self, doc_ids: list, ids: np.ndarray, offsets: np.ndarray, ends: np.ndarray) -> None:
        at = len(self.ids)
        self.docs += [(d, int(y - x), int(at + x)) for d, x, y in zip(doc_ids, offsets[:-1], offsets[1:], strict=True)]
        self.ids, self.ends = np.concatenate([self.ids, ids]), np.concatenate([self.ends, ends + at])

    def pack(self, last: bool) -> Iterator[pa.RecordBatch]:
        if not len(self.ids):
            return
        rows, held, d = [], 0, 0
        done = 0
        for a, b in windows(self.ends, len(self.ids), self.size, self.cut, self.short, last):
            done, x = b, a
            while x < b:
                doc, n, begin = self.docs[d]
                y = min(b, begin + n)
                rows.append((doc, x - begin, y - x, n, self.sequence, x - a, self.ids[x:y].astype("<u4").tobytes()))
                held += y - x
                x = y
                d += y == begin + n
            self.sequence += 1
            if held > 1 << 20:
                yield self._batch(rows)
                rows, held = [], 0
        if rows:
            yield self._batch(rows)
        self.ids, self.ends = self.ids[done:], self.ends[self.ends > done] - done
        self.docs = [(doc, n, begin - done) for doc, n, begin in self.docs[d:]]

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset"]
        columns = list(zip(*rows, strict=True))
        arrays = [pa.array(c, pa.int64()) for c in columns[:6]] + [pa.array(columns[6], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, [*names, "ids"])


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 1, cut: int = 16, short: int = 8, run: int = 2 << 20) -> DataFrame:
    """A row per piece: doc_id, start (the text's ids before it), length, doc_tokens, sequence_id, offset there, ids (little-endian, 4 bytes each).

    `tokenizer`: a tokenizer file that every executor has.
    """
    ship(docs.sparkSession)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, line = tokens.encoder(tokenizer), Line(size, cut, short)
        for part in text_slices(batches, most=SMALL_SLICE_BYTES):
            line.add(part.column("doc_id").to_pylist(), *encoder.encode(part.column("text"), end_id))
            if len(line.ids) >= run:
                yield from line.pack(last=False)
        yield from line.pack(last=True)

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(packed, SCHEMA)
