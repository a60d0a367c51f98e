"""Hard negatives by an inverted multi-index, exact.

An anchor's positives are its best rows of the same label; its hard negatives for a positive are the best rows of other labels whose score lies
within given percents of the positive's. The score is the inner product of integer vectors.

1. Index. Two codebooks of `words` centres, one for each half of the vector, are learned from a bounded sample; every row lies in the cell of its two
   nearest half-centres. Rows are ranged by cell, so that a cell with most rows is split over tasks, and written in packs of at most `pack` rows
   (a matrix each). Each codeword has a radius: the greatest distance of a half that belongs to it.
2. Bounds. For an anchor, inner product with a half-centre plus and minus the half's length times the radius bound the half-score of all
   rows of that codeword; sums of two half-bounds bound the scores in a cell.
3. Visits. A heap over the two lists of codewords, each sorted by its upper half-bound, gives cells in the order of their summed bounds (the
   multi-sequence algorithm); empty cells are passed over, as are cells whose lower bound lies above all windows. In each round the open
   anchors take their next cells until those hold `quota` rows, and the quota grows `GROWTH`-fold; the cells' packs meet the anchors that ask for
   them, in blocks of anchors, and a block keeps the best few of each window.
4. Certificates. A window is done when its last wanted score is above the bound of the next cell, or that bound is below the window, or no cell is left.
   An anchor stops when all its windows are done. So nothing is missed, whatever the codebooks are; they only decide how much is looked at.

What is sent to tasks with the code are the codebooks and the number of rows of each cell: bounded by `words`. Packs and anchors are joined by shuffles.

Defined results: rows whose label, vec_id or vector is null, or whose vector is empty or holds null or non-finite components, take no part; vectors of another
length than the most frequent one neither. A repeated row is a row of its own (it can stand in a result twice), but an anchor's
vec_id counts once (the least label and vector); rows with the anchor's vec_id are not its positives. Ties go by vec_id. Fewer rows than wanted
are given as they are; an empty table gives an empty result; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.llm.common import ship
from stockflow.session import release, settle

#: Anchors that meet a pack at once, scores of them that are held at once, and how much further each round goes.
BLOCK, HELD, GROWTH = 512, 1 << 21, 16
#: The whole of the scores, as a window.
ALL = 1 << 62
#: Bounds are worked out in doubles and widened by so much.
SLACK = 1e-9

WINDOW = "array<struct<tag: bigint, low: bigint, high: bigint>>"
FOUND = "anchor long, tag long, vec_id long, score long"


def whole_vectors(rows: DataFrame, embedding: Column, label: Column) -> DataFrame:
    """(vec_id, label, v): the rows that take part; `embedding` gives an array of whole numbers."""
    v = embedding.cast("array<bigint>")
    kept = rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), v.alias("v"))
    return kept.where("vec_id is not null and label is not null and size(v) > 0 and not exists(v, x -> x is null)")


@dataclass(frozen=True)
class Index:
    """`packs`: pack, cells, vec_ids, labels (lists) and the matrix (int64) of its rows; `places`: cell, pack; `radii`, `counts`: of codewords and cells."""

    packs: DataFrame
    places: DataFrame
    books: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    counts: np.ndarray


def centres(sample: np.ndarray, words: int, seed: int, steps: int = 8) -> np.ndarray:
    """k-means over a sample; at most as many centres as it has different rows."""
    different = np.unique(sample, axis=0)
    start = np.random.default_rng(seed).permutation(len(different))[:words]
    book = different[start].astype(np.float64)
    for _ in range(steps):
        near = nearest(sample, book)[0]
        count = np.bincount(near, minlength=len(book))
        sums = np.zeros_like(book)
        np.add.at(sums, near, sample)
        book = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], book)
    return book


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each row, and the distance to it."""
    near = ((book**2).sum(axis=1) - 2 * (x @ book.T)).argmin(axis=1)
    return near, np.linalg.norm(x - book[near], axis=1)


def matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column as a matrix; all have the same length."""
    column = pa.concat_arrays([column]) if isinstance(column, pa.Array) else column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def build(rows: DataFrame, words: int = 64, sample: int = 16_384, pack: int = 8192, seed: int = 13) -> Index | None:
    """Indexes every row; codebooks from the `sample` rows whose vec_id's hash is least. None: there are no rows."""
    ship(rows.sparkSession)
    spark = rows.sparkSession
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if size is None:
        return None
    size = size.n
    rows = rows.where(F.size("v") == size)
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "label", "v").select("v").limit(sample).toArrow().column("v")
    drawn, half = matrix(drawn).astype(np.float64), size // 2
    books = (centres(drawn[:, :half], words, seed), centres(drawn[:, half:], words, seed + 1))
    width = len(books[1])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                x = matrix(part.column("v")).astype(np.float64)
                (i, r), (j, s) = (nearest(x[:, at], book) for at, book in zip((slice(half), slice(half, None)), books, strict=True))
                columns = [pa.array(c) for c in (i * width + j, r, s)]
                yield pa.RecordBatch.from_arrays([*columns, *(part.column(c) for c in ("vec_id", "label", "v"))], ["cell", "r", "s", "vec_id", "label", "v"])

    kind = "cell long, r double, s double, vec_id long, label long, v array<long>"
    cells = settle(rows.mapInArrow(placed, kind), "negatives-cells")
    summed = cells.groupBy("cell").agg(F.count("*").alias("n"), F.max("r").alias("r"), F.max("s").alias("s")).toPandas()  # a row per cell at most
    counts = np.zeros(len(books[0]) * width, np.int64)
    counts[summed.cell] = summed.n
    radii = np.zeros(len(books[0])), np.zeros(width)
    np.maximum.at(radii[0], summed.cell // width, summed.r)
    np.maximum.at(radii[1], summed.cell % width, summed.s)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        most = max(1, min(pack, (4 << 20) // (8 * size)))
        for batch in batches:
            for start in range(0, batch.num_rows, most):
                part = batch.slice(start, most)
                lists = [pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(c)) for c in ("cell", "vec_id", "label")]
                data = np.ascontiguousarray(matrix(part.column("v")), "<i8").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([name]), *lists, pa.array([data], pa.binary())], ["pack", "cells", "vec_ids", "labels", "data"])
                name += 1

    ranged = cells.select("cell", "vec_id", "label", "v").repartitionByRange(F.col("cell"), F.col("vec_id")).sortWithinPartitions("cell")
    kind = "pack long, cells array<long>, vec_ids array<long>, labels array<long>, data binary"
    packs = settle(ranged.mapInArrow(packed, kind), "negatives-packs")
    places = settle(packs.select("pack", F.explode(F.array_distinct("cells")).alias("cell")), "negatives-places")
    return Index(packs, places, books, radii, counts)


def visits(upper: tuple[np.ndarray, np.ndarray], lower: tuple[np.ndarray, np.ndarray], counts: np.ndarray, highest: float) -> Iterator[tuple[float, int]]:
    """(bound, cell) of the cells with rows, by falling bound; cells that lie above `highest` as a whole are passed over."""
    first, second = (np.argsort(-u, kind="stable") for u in upper)
    u, v = upper[0][first].tolist(), upper[1][second].tolist()
    lowest = lower[0][first], lower[1][second]
    wanted = (counts.reshape(len(u), len(v))[np.ix_(first, second)] > 0) & (lowest[0][:, None] + lowest[1] <= highest)
    heap = [(-(u[0] + v[0]), 0, 0)]
    while heap:
        bound, i, j = heappop(heap)
        if wanted[i, j]:
            yield -bound, int(first[i] * len(v) + second[j])
        # (i, j) is entered once: along its row, or from the row before at the row's begin.
        if j + 1 < len(v):
            heappush(heap, (-(u[i] + v[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(u):
            heappush(heap, (-(u[i + 1] + v[0]), i + 1, 0))


def _asks(index: Index, quota: int):
    """For each open anchor: the next cells, as many as hold `quota` rows, how many it has seen then, and the bound of the one after (null: none)."""
    books, radii, counts = index.books, index.radii, index.counts
    half = books[0].shape[1]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, seen, bounds = [], [], []
            x = matrix(batch.column("v")).astype(np.float64) if batch.num_rows else []
            for a, done, top in zip(x, batch.column("seen").to_pylist(), batch.column("top").to_pylist(), strict=True):
                upper, lower = [], []
                for h, book, radius in zip((a[:half], a[half:]), books, radii, strict=True):
                    near, reach = book @ h, np.linalg.norm(h) * radius
                    slack = SLACK * (1 + np.abs(near) + reach)
                    upper.append(near + reach + slack)
                    lower.append(near - reach - slack)
                some, held, bound, k = [], 0, None, 0
                for k, (u, cell) in enumerate(visits(upper, lower, counts, top)):
                    if k < done:
                        continue
                    if held >= quota:
                        bound = u
                        break
                    some.append(cell)
                    held += int(counts[cell])
                cells.append(some)
                seen.append(done + len(some))
                bounds.append(bound)
            columns = [batch.column(c) for c in ("anchor", "label", "v", "windows", "top")]
            columns += [pa.array(seen, pa.int64()), pa.array(bounds, pa.float64()), pa.array(cells, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["anchor", "label", "v", "windows", "top", "seen", "bound", "asked"])

    return rows


def _best(same: bool, wanted: int):
    """Of a pack and the anchors that ask for cells of it: the best rows of each window."""

    def rows(key: tuple, packs: pa.Table, asking: pa.Table) -> pa.Table:
        out = {c: [] for c in ("anchor", "tag", "vec_id", "score")}
        if packs.num_rows and asking.num_rows:
            cell, ids, labels = (packs.column(c).combine_chunks().flatten().to_numpy() for c in ("cells", "vec_ids", "labels"))
            data = np.frombuffer(packs.column("data")[0].as_buffer(), "<i8").reshape(len(ids), -1).astype(np.float64)
            by = np.argsort(ids, kind="stable")  # of equal scores the first place is then the least vec_id
            cell, ids, labels, data = cell[by], ids[by], labels[by], data[by]
            step = max(1, HELD // len(ids))
            for start in range(0, asking.num_rows, step):
                part = asking.slice(start, step)
                scores = (matrix(part.column("v")).astype(np.float64) @ data.T).astype(np.int64)
                told = zip(part.column("anchor").to_pylist(), part.column("label").to_pylist(), part.column("windows").to_pylist(), part.column("cells").to_pylist(), scores, strict=True)
                for anchor, label, windows, cells, row in told:
                    ok = np.isin(cell, cells) & ((labels == label) == same) & (ids != anchor)
                    for w in windows:
                        at = np.flatnonzero(ok & (row >= w["low"]) & (row <= w["high"]))
                        at = at[np.argsort(-row[at], kind="stable")[:wanted]]
                        out["anchor"] += [anchor] * len(at)
                        out["tag"] += [w["tag"]] * len(at)
                        out["vec_id"] += ids[at].tolist()
                        out["score"] += row[at].tolist()
        return pa.table({c: pa.array(x, pa.int64()) for c, x in out.items()})

    return rows


def search(index: Index, anchors: DataFrame, same: bool, wanted: int, quota: int = 4096) -> DataFrame:
    """(anchor, tag, vec_id, score): the first `wanted` rows of each window of each anchor, of the anchor's label (`same`) or of others.

    `anchors`: anchor, label, v, windows (tag, and the least and greatest score).
    """
    top = F.array_max(F.col("windows.high")).alias("top")  # the same in all rounds, so that the order of visits is
    state = settle(anchors.select("anchor", "label", "v", "windows", top, F.lit(0).cast("long").alias("seen")), "negatives-anchors")
    kind = f"anchor long, label long, v array<long>, windows {WINDOW}, top long, seen long, bound double, asked array<long>"
    found, left = None, state.count()
    while left:
        asks = settle(state.mapInArrow(_asks(index, quota), kind), "negatives-asks")
        # Anchors that are asked together lie anywhere; a block has about BLOCK of them.
        block = F.pmod(F.xxhash64("anchor"), F.lit(-(-left // BLOCK)))
        cells = asks.select("anchor", F.explode("asked").alias("cell")).join(index.places, "cell")
        asked = cells.groupBy("anchor", "pack").agg(F.collect_list("cell").alias("cells"))
        asked = settle(asked.join(asks.select("anchor", "label", "v", "windows"), "anchor").withColumn("block", block), "negatives-asked")
        packs = asked.selectExpr("pack of", "block of_block").distinct().join(index.packs, F.col("of") == F.col("pack"))
        new = packs.groupBy("of", "of_block").cogroup(asked.groupBy("pack", "block")).applyInArrow(_best(same, wanted), FOUND)
        new = new if found is None else new.unionByName(found)
        # row_number with a limit: each task drops what is behind the limit before the shuffle.
        ranked = new.selectExpr("*", "row_number() over (partition by anchor, tag order by score desc, vec_id) rank")
        before, found = found, settle(ranked.where(F.col("rank") <= wanted).drop("rank"), "negatives-found")
        last = found.groupBy("anchor", "tag").agg(F.count("*").alias("n"), F.min("score").alias("last"))
        open_ = asks.where("bound is not null").select("anchor", "bound", F.explode("windows").alias("w")).select("anchor", "bound", "w.*")
        # What is behind the last wanted score of a full window is not asked for again.
        full = F.coalesce("n", F.lit(0)) >= wanted
        open_ = open_.join(last, ["anchor", "tag"], "left").withColumn("low", F.when(full, F.greatest("low", "last")).otherwise(F.col("low")))
        open_ = open_.where(F.col("bound") >= F.col("low")).groupBy("anchor").agg(F.collect_list(F.struct("tag", "low", "high")).alias("windows"))
        state = settle(asks.select("anchor", "label", "v", "top", "seen").join(open_, "anchor"), "negatives-state")
        release(asks, asked, before)
        left, quota = state.count(), quota * GROWTH
    if found is None:
        return index.packs.sparkSession.createDataFrame([], FOUND)
    return found


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, **index) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of `rows` (vec_id, label, v as `whole_vectors` gives them):
    for each anchor and each of its `positives`, the best `negatives` whose score is `low` to `high` % of the positive's.

    `index`: the parameters of `build`.
    """
    rows = settle(rows, "negatives-rows")
    built = build(rows, **index)
    result = T._parse_datatype_string("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    if built is None:
        return rows.sparkSession.createDataFrame([], result)
    size = built.books[0].shape[1] + built.books[1].shape[1]
    anchors = rows.where(is_anchor & (F.size("v") == size)).groupBy(F.col("vec_id").alias("anchor")).agg(F.min(F.struct("label", "v")).alias("of"))
    anchors = settle(anchors.select("anchor", "of.label", "of.v"), "negatives-anchor-rows")
    every = F.expr(f"array(struct(0L AS tag, {-ALL}L AS low, {ALL}L AS high))")
    best = search(built, anchors.withColumn("windows", every), True, positives)
    best = settle(best.select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "negatives-positives")
    # Whole scores s with low * p <= 100 * s <= high * p; a positive below 0 leaves none.
    window = F.expr(
        f"struct(positive_score AS tag, -((-{low} * positive_score - pmod(-{low} * positive_score, 100L)) div 100) AS low,"
        f" ({high} * positive_score - pmod({high} * positive_score, 100L)) div 100 AS high)"
    )
    windows = best.where("positive_score >= 0").groupBy("anchor").agg(F.array_sort(F.collect_set(window)).alias("windows"))
    hard = search(built, anchors.join(windows, "anchor"), False, negatives)
    hard = hard.select(F.col("anchor").alias("of"), "tag", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    pairs = best.join(hard, (F.col("anchor") == F.col("of")) & (F.col("positive_score") == F.col("tag")))
    rank = F.expr("row_number() over (partition by anchor, positive_id order by negative_score desc, negative_id)")
    return pairs.select(F.col("anchor").alias("anchor_id"), "positive_id", rank.alias("rank"), "negative_id", "positive_score", "negative_score")
