"""Exact n-gram Jaccard join: size-banded tiles, hashed bitmaps, sorted-array intersection.

1. A text's set: its distinct `gram`-word shingles as 51-bit hashes, sorted. Texts with the same set (a 64-bit name) are one node.
2. Tiles. Sizes fall into bands; sets that can link are in one band or in two that touch, and a set near its band's upper
   border also enters the next band's tiles. Two sets that link differ in at most `d` elements, d from the band's greatest size; a
   band's tiles divide the hash range into d + 1 + m parts, so two sets that link agree on m + 1 parts at least. A tile
   holds the sets with the same content of one part: no link is missed, and a phrase in many texts makes no large tile. A set with
   at most m empty parts agrees on a part that is not empty, so its empty parts make no tiles.
3. Most tiles hold one set. Tiles go over the network once, packed: 12 bytes for each tile and set, sorted, in one message per range of tile
   names and so many tiles; a task of a range hands on what it finds more than once. The number of ranges grows with the shingles, and a
   tile of very many sets sends each range one entry per message, its other sets directly, spread over all ranges.
4. Candidates. Each tile has a centre, its set with the least hash. Every set is compared first with the centre that it shares most tiles with;
   that links most of what is alike. Then, within each tile that still holds more than one component, all sets are compared with its centre, which
   then leaves the tile, for some rounds. Tiles that are still open are compared in blocks, pairs of different components only: for some rounds each set
   gives its best candidate of a block, and last, with wider bitmaps, all that are left. Tiles with the same members count once. Bit counts of hashed bitmaps bound the overlap from above, and only pairs within the bound go on to the
   intersection. No pairs are made within what is already linked.
5. Components of the links, named by the smallest doc_id.

Each step is written; what it was made from is deleted as soon as nothing reads it any more.

Defined results: words are lower-cased (A-Z); a text with fewer words than a shingle has one shingle, the whole sequence; null and empty
texts have the empty set and link with nothing; repeated rows are one node; a row without doc_id links with nothing and
its component is null; an empty table gives an empty result; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm import bloom
from stockflow.llm.common import ship, text_slices
from stockflow.llm.components import components
from stockflow.llm.words import Words, mix
from stockflow.session import release, settings, settle

#: Bits of a shingle's hash; the other bits of a 64-bit value hold the text's place in a slice.
BITS = 51
LOW = np.uint64((1 << BITS) - 1)
#: Texts of a slice at most: a place, the place after the last one and the end of that one's hash range must fit in the other bits.
PLACES = 1 << (63 - BITS)
#: Each band's sizes go up to the border of the next, this much larger.
BAND = 1.35
#: Rows of a tile that are compared with each other at once.
BLOCK = 256
#: Tiles that a task packs together, and about how many of them a range of tile names holds; there are `RANGES` at least.
PACKED, RANGE_TILES, RANGES = 1 << 20, 1 << 20, 64
#: Bits of a bitmap for each element of the largest set of a band, at least: those that are compared first, and those that settle what is left.
NARROW, WIDE = 2, 4
#: Rows that Spark and a Python worker hand each other at once, and bytes of text worked on at once: rows hold whole texts or sets, and both sides
#: keep several copies of what they hand over.
ARROW_ROWS, SLICE_BYTES = 512, 512 << 10
#: Rows of a file of what is written between steps: few rows make few tasks, whatever the shuffles' number of partitions.
ROWS_PER_FILE = 400_000


class Bands:
    """The sizes of bands, and each band's number of parts, for links of at least `percent` %."""

    def __init__(self, percent: int):
        self.percent = percent
        edges = [1]
        while edges[-1] < 1 << 40:
            edges.append(max(edges[-1] + 1, int(edges[-1] * max(BAND, 110 / percent))))
        self.edges = np.array(edges, np.int64)
        # |A xor B| <= (1 - s) * |A or B|, and |A or B| <= 2 * greatest / (1 + s).
        apart = [floor(2 * (e - 1) * (100 - percent) / (100 + percent) + 1e-9) for e in edges[1:]]
        #: The parts that may be empty without making tiles: a little more than those that chance leaves empty.
        self.empty = [ceil(0.08 * d) + 3 if d else 0 for d in apart]
        self.parts = [d + 1 + m for d, m in zip(apart, self.empty, strict=True)]

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.edges, sizes, side="right") - 1


def sets(texts: pa.Array, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts, sorted and distinct within each text, and the n + 1 offsets."""
    assert len(texts) <= PLACES, len(texts)
    words = Words(texts)
    count = np.diff(words.first)
    h, n = words.hash, len(words)
    run = np.zeros(max(n - gram + 1, 0), np.uint64)
    for k in range(gram):
        run = mix(run * np.uint64(0x9E3779B97F4A7C15) + h[k : k + len(run)])
    doc = words.doc[: len(run)]
    whole = doc == words.doc[gram - 1 : gram - 1 + len(run)]
    keys = [(doc[whole].astype(np.uint64) << np.uint64(BITS)) | (run[whole] >> np.uint64(64 - BITS))]
    for d in np.flatnonzero((count > 0) & (count < gram)):
        part = np.uint64(count[d])
        for x in h[words.first[d] : words.first[d + 1]]:
            part = mix((np.array([part]) ^ x) * np.uint64(0xD6E8FEB86659FD93))[0]
        keys.append(np.array([(np.uint64(d) << np.uint64(BITS)) | (part >> np.uint64(64 - BITS))], np.uint64))
    every = np.sort(np.concatenate(keys))
    if len(every):
        every = every[np.concatenate([[True], every[1:] != every[:-1]])]
    offsets = np.searchsorted(every, np.arange(len(texts) + 1, dtype=np.uint64) << np.uint64(BITS))
    return every & LOW, offsets


def _sums(elements: np.ndarray, salt: int) -> np.ndarray:
    total = np.zeros(len(elements) + 1, np.uint64)
    np.cumsum(mix(elements + np.uint64(salt)), out=total[1:])
    return total


def names(elements: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set: equal sets have equal names."""
    total = _sums(elements, 2)
    return mix(total[offsets[1:]] - total[offsets[:-1]] + np.diff(offsets).astype(np.uint64)).view(np.int64)


def tiles(elements: np.ndarray, offsets: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """(text, tile) of all texts: for each band that a text enters, one tile per part of its hash range."""
    sizes = np.diff(offsets)
    total = _sums(elements, 1)
    placed = (np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes) << np.uint64(BITS)) | elements
    texts, keys = [], []
    own = bands.of(sizes)
    crossing = sizes * 100 // bands.percent >= bands.edges[own + 1]
    for up in (0, 1):
        for band in np.unique(own[(sizes > 0) & (crossing if up else True)]):
            at = np.flatnonzero((own == band) & (sizes > 0) & (crossing if up else True))
            tile = int(band) + up
            parts = bands.parts[tile]
            edges = np.array([(i << BITS) // parts for i in range(parts + 1)], np.uint64)
            step = max(1, (1 << 20) // parts)
            for i in range(0, len(at), step):
                some = at[i : i + step]
                grid = (some.astype(np.uint64) << np.uint64(BITS))[:, None] + edges
                cuts = np.searchsorted(placed, grid.ravel()).reshape(grid.shape)
                content = total[cuts[:, 1:]] - total[cuts[:, :-1]]
                salt = mix(np.arange(parts, dtype=np.uint64) + np.uint64(tile << 44))
                bare = cuts[:, 1:] == cuts[:, :-1]
                wanted = ~bare | (bare.sum(axis=1) > bands.empty[tile])[:, None]
                texts.append(np.broadcast_to(some[:, None], wanted.shape)[wanted])
                keys.append(mix(content ^ salt)[wanted])
    return np.concatenate(texts or [np.zeros(0, np.int64)]), np.concatenate(keys or [np.zeros(0, np.uint64)])


def bitmaps(elements: np.ndarray, offsets: np.ndarray, bands: Bands, each: int = NARROW) -> list[bytes]:
    """Each text's bitmap: as many bits as the power of two over `each` times the largest size of its band."""
    sizes = np.diff(offsets)
    own = bands.of(np.maximum(sizes, 1))
    found = []
    for d, n in enumerate(sizes):
        width = 1 << max(6, int(each * bands.edges[own[d] + 1]).bit_length()) if n else 64
        bits = np.zeros(width, np.uint8)
        bits[elements[offsets[d] : offsets[d + 1]] & np.uint64(width - 1)] = 1
        found.append(np.packbits(bits).tobytes())
    return found


def _folded(bits: np.ndarray, size: int) -> np.ndarray:
    """A wider bitmap as one of `size` bytes: bits that fall together are joined."""
    return np.bitwise_or.reduce(bits.reshape(-1, size), axis=0)


def may_link(n1, n2, lost1, lost2, percent: int):
    """Whether sets of n1 and n2 elements may link if at least lost1 of the first and lost2 of the second are not in the other."""
    overlap = np.minimum(n1 - lost1, n2 - lost2)
    return 100 * overlap >= percent * (n1 + n2 - overlap)


def _sketch_rows(gram: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, most=SLICE_BYTES, rows=PLACES):
            elements, offsets = sets(part.column("text"), gram)
            columns = [part.column("doc_id"), part.column("hash"), pa.array(np.diff(offsets).astype(np.int64)), pa.array(names(elements, offsets))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "hash", "n", "node"])

    return rows


def _distinct(tiles: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (tile, node) in order, and where a tile begins."""
    by = np.lexsort((nodes, tiles))
    tiles, nodes = tiles[by], nodes[by]
    begins = np.ones(len(tiles), bool)
    begins[1:] = tiles[1:] != tiles[:-1]
    new = begins.copy()
    new[1:] |= nodes[1:] != nodes[:-1]
    return tiles[new], nodes[new], begins[new]


def _tile_messages(bands: Bands, gram: int, ranges: int):
    """Messages (range, shared, tiles, nodes) of all texts that have shingles; a tile's name is its range and 32 bits.

    Not shared: of each tile that the texts packed here have, one set, by the 32 bits, to the tile's range. Shared: the whole names of tiles that several
    sets of them have, and those sets, each to a range by its own name.
    """

    def messages(tile: np.ndarray, node: np.ndarray) -> Iterator[pa.RecordBatch]:
        high = (tile >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
        tile, node, begins = _distinct((high << np.uint64(32)) | (tile & np.uint64(0xFFFFFFFF)), node)
        ends = np.append(begins[1:], True)
        several = ~(begins & ends)
        to = np.concatenate([(tile[begins] >> np.uint64(32)).astype(np.int64), node[several] % ranges])
        shared = np.arange(len(to)) >= begins.sum()
        tile, node = np.concatenate([tile[begins], tile[several]]), np.concatenate([node[begins], node[several]])
        by = np.argsort(to * 2 + shared, kind="stable")
        to, shared, tile, node = to[by], shared[by], tile[by], node[by]
        edges = np.flatnonzero(np.concatenate([[True], (np.diff(to) != 0) | (np.diff(shared) != 0), [True]]))
        tiles = [(tile[a:b] if shared[a] else tile[a:b].astype(np.uint32)).tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
        nodes = [node[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
        columns = [pa.array(to[edges[:-1]]), pa.array(shared[edges[:-1]]), pa.array(tiles, pa.binary()), pa.array(nodes, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["range", "shared", "tiles", "nodes"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for part in text_slices(batches, most=SLICE_BYTES, rows=PLACES):
            elements, offsets = sets(part.column("text"), gram)
            texts, keys = tiles(elements, offsets, bands)
            held.append((keys, names(elements, offsets)[texts]))
            n += len(keys)
            if n >= PACKED:
                yield from messages(*map(np.concatenate, zip(*held, strict=True)))
                held, n = [], 0
        if n:
            yield from messages(*map(np.concatenate, zip(*held, strict=True)))

    return rows


def _shared_members(key: tuple, table: pa.Table) -> pa.Table:
    """(tile, node) of the tiles of a range that more than one set has."""
    high = np.uint64(key[0].as_py() << 32)
    own, found = [[], []], [[], []]
    for shared, tile, node in zip(*(table.column(c).to_pylist() for c in ("shared", "tiles", "nodes")), strict=True):
        to = found if shared else own
        to[0].append(np.frombuffer(tile, np.uint64 if shared else np.uint32))
        to[1].append(np.frombuffer(node, np.int64))
    if own[0]:
        tile, node, begins = _distinct(np.concatenate(own[0]), np.concatenate(own[1]))
        several = ~(begins & np.append(begins[1:], True))
        found[0].append(tile[several].astype(np.uint64) | high)
        found[1].append(node[several])
    return pa.table({"tile": pa.array(np.concatenate(found[0]).view(np.int64)), "node": pa.array(np.concatenate(found[1]))})


def _within_bound(percent: int):
    """Pairs whose bitmaps allow a link."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n1, n2 = (batch.column(c).to_numpy() for c in ("n1", "n2"))
            keep = 100 * np.minimum(n1, n2) >= percent * np.maximum(n1, n2)
            for i in np.flatnonzero(keep):
                a, b = (np.frombuffer(batch.column(c)[int(i)].as_buffer(), np.uint8) for c in ("bits1", "bits2"))
                size = min(len(a), len(b))
                a, b = _folded(a, size), _folded(b, size)
                keep[i] = may_link(n1[i], n2[i], np.bitwise_count(a & ~b).sum(), np.bitwise_count(b & ~a).sum(), percent)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("a", "b")], ["a", "b"]).filter(pa.array(keep))

    return rows


def _linked(percent: int):
    """Pairs whose sorted arrays overlap enough."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            sides = []
            for c in ("set1", "set2"):
                column = batch.column(c)
                sides.append((np.asarray(column.offsets), column.values.to_numpy()))
            for i in range(batch.num_rows):
                a, b = (values[o[i] : o[i + 1]] for o, values in sides)
                at = np.searchsorted(a, b)
                both = int((a[np.minimum(at, len(a) - 1)] == b).sum()) if len(a) else 0
                keep[i] = both > 0 and 100 * both >= percent * (len(a) + len(b) - both)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("a", "b")], ["a", "b"]).filter(pa.array(keep))

    return rows


def _block_pairs(percent: int, best: bool):
    """Of two blocks of a tile: pairs of different components whose bitmaps allow a link; with `best` only each set's likeliest one."""

    def rows(key: tuple, table: pa.Table) -> pa.Table:
        left, right = key[1].as_py(), key[2].as_py()
        block = table.column("block").to_numpy()
        node, comp, n = (table.column(c).to_numpy() for c in ("node", "component", "n"))
        bits = [np.frombuffer(x.as_buffer(), np.uint8) for x in table.column("bits")]
        size = min(map(len, bits))
        grid = np.stack([_folded(x, size) for x in bits])
        first, second = np.flatnonzero(block == left), np.flatnonzero(block == right)
        pairs, likeliest = set(), {}
        for i in first:
            j = second[second > i] if left == right else second
            j = j[comp[j] != comp[i]]
            j = j[100 * np.minimum(n[j], n[i]) >= percent * np.maximum(n[j], n[i])]
            if not len(j):
                continue
            lost1 = np.bitwise_count(grid[i] & ~grid[j]).sum(axis=1, dtype=np.int64)
            lost2 = np.bitwise_count(grid[j] & ~grid[i]).sum(axis=1, dtype=np.int64)
            ok = may_link(n[i], n[j], lost1, lost2, percent)
            j, lost = j[ok], (lost1 + lost2)[ok]
            if best:
                for k, apart in zip(j.tolist(), lost.tolist(), strict=True):
                    for one, other in ((int(i), k), (k, int(i))):
                        if one not in likeliest or (apart, node[other]) < likeliest[one][:2]:
                            likeliest[one] = (apart, node[other], other)
            else:
                pairs |= {(int(i), k) for k in j.tolist()}
        pairs |= {(one, other) for one, (_, _, other) in likeliest.items()}
        ends = np.array([(min(node[i], node[k]), max(node[i], node[k])) for i, k in pairs], np.int64).reshape(-1, 2)
        ends = np.unique(ends, axis=0)
        return pa.table({"a": pa.array(ends[:, 0]), "b": pa.array(ends[:, 1])})

    return rows


def _written(df: DataFrame, name: str) -> DataFrame:
    """Written and read back; rows go through Python `ARROW_ROWS` at a time."""
    with settings(df.sparkSession, execution__arrow__maxRecordsPerBatch=str(ARROW_ROWS)):
        return settle(df, name)


class Join:
    """The join over one table of documents; each step is written before the next reads it."""

    def __init__(self, docs: DataFrame, gram: int = 3, percent: int = 90, stars: int = 2, bests: int = 2):
        ship(docs.sparkSession)
        self.gram, self.percent, self.stars, self.bests, self.bands = gram, percent, stars, bests, Bands(percent)
        self.docs = docs.selectExpr("cast(doc_id as long) doc_id", "text", "xxhash64(text) hash")
        self.sketch = _written(self.docs.mapInArrow(_sketch_rows(gram), "doc_id long, hash long, n long, node long"), "ngram-sketch")
        named = self.sketch.where("n > 0 and doc_id is not null")
        self.nodes = _written(
            named.groupBy("node").agg(F.min(F.struct("doc_id", "n", "hash")).alias("least")).select("node", "least.doc_id", "least.n", "least.hash"),
            "ngram-nodes",
        )
        self.members = self._members()
        self.files = self.members.count() // ROWS_PER_FILE + 1  # no later step has more rows
        self.near = self._near()

    def _members(self) -> DataFrame:
        """(tile, node) of the tiles that hold several sets; of tiles with the same sets, one."""
        shingles = self.sketch.agg(F.sum("n")).first()[0] or 0
        # About so many tiles: parts of a set's own band and of the next.
        tiles_ = 5 * shingles * (100 - self.percent) // (100 + self.percent)
        messages = self.docs.where("doc_id is not null").mapInArrow(
            _tile_messages(self.bands, self.gram, max(RANGES, tiles_ // RANGE_TILES)), "range long, shared boolean, tiles binary, nodes binary"
        )
        every = messages.groupBy("range").applyInArrow(_shared_members, "tile long, node long")
        every = _written(every, "ngram-tile-members")
        members = _written(every.distinct(), "ngram-members")
        alike = members.groupBy("tile").agg(F.count("*").alias("n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("sum")).where("n > 1")
        once = _written(alike.groupBy("n", "sum").agg(F.min("tile").alias("once"), F.count("*").alias("times")).select("once", "times"), "ngram-tiles-once")
        kept = _written(members.join(once, F.col("tile") == F.col("once")).select("tile", "node", "times"), "ngram-members-once")
        release(every, members, once)
        return kept

    def _near(self) -> DataFrame:
        """(node, n, bits, wide, set) of the nodes that share a tile, from the text of each one's least document; other texts are not shuffled."""
        shared = self.members.select(F.col("node").alias("m")).distinct()
        ids = _written(self.nodes.join(shared, F.col("node") == F.col("m"), "left_semi").selectExpr("doc_id id", "hash of_text"), "ngram-wanted")
        filter_ = bloom.build(ids, F.col("id"), ids.count())
        maybe = bloom.probe(self.docs, F.col("doc_id"), filter_, "maybe").where("maybe")
        # Repeated rows come together before the shuffle and are one row of the join.
        maybe = maybe.groupBy("doc_id", "hash").agg(F.first("text").alias("text"))
        texts = maybe.join(ids, (F.col("doc_id") == F.col("id")) & (F.col("hash") == F.col("of_text"))).select("doc_id", "text")  # a semi join would be planned before the probe
        gram, bands = self.gram, self.bands

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in text_slices(batches, most=SLICE_BYTES, rows=PLACES):
                elements, offsets = sets(part.column("text"), gram)
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(elements.view(np.int64)))
                maps = [pa.array(bitmaps(elements, offsets, bands, each), pa.binary()) for each in (NARROW, WIDE)]
                columns = [pa.array(names(elements, offsets)), pa.array(np.diff(offsets).astype(np.int64)), *maps, lists]
                yield pa.RecordBatch.from_arrays(columns, ["node", "n", "bits", "wide", "set"])

        near = _written(texts.mapInArrow(rows, "node long, n long, bits binary, wide binary, set array<long>"), "ngram-near")
        release(ids, filter_.table)
        return near

    def _small(self, df: DataFrame, name: str) -> DataFrame:
        """Written in few files: rows of ids, at most as many as there are members of tiles."""
        return _written(df.coalesce(self.files), name)

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that link: within the bound of the bitmaps first, then by intersection."""
        bits = self.near.select("node", "n", "bits")
        sides = pairs.distinct().join(bits.selectExpr("node x", "n n1", "bits bits1"), F.col("a") == F.col("x")).join(
            bits.selectExpr("node y", "n n2", "bits bits2"), F.col("b") == F.col("y")
        )
        bound = _written(sides.select("a", "b", "n1", "n2", "bits1", "bits2").mapInArrow(_within_bound(self.percent), "a long, b long"), "ngram-bound")
        found = self._verified(bound)
        release(bound)
        return found

    def _verified(self, bound: DataFrame) -> DataFrame:
        """The pairs (a, b) that link, by intersection. Only the sets of these nodes cross the network."""
        ends = self._small(bound.select(F.explode(F.array("a", "b")).alias("end")).distinct(), "ngram-ends")
        kept = self.near.select("node", "set").join(ends, F.col("node") == F.col("end"), "left_semi")
        sides = bound.join(kept.selectExpr("node x", "set set1"), F.col("a") == F.col("x")).join(kept.selectExpr("node y", "set set2"), F.col("b") == F.col("y"))
        found = _written(sides.select("a", "b", "set1", "set2").mapInArrow(_linked(self.percent), "a long, b long"), "ngram-links")
        release(ends)
        return found

    def _open(self, members: DataFrame, links: DataFrame) -> DataFrame:
        """(tile, node, component) of the tiles that hold more than one component."""
        known = self._small(components(links), "ngram-components")
        named = known.select(F.col("node").alias("of"), "component")
        told = members.select("tile", "node").join(named, F.col("node") == F.col("of"), "left")
        told = self._small(told.select("tile", "node", F.coalesce("component", "node").alias("component")), "ngram-told")
        split = told.groupBy(F.col("tile").alias("open")).agg(F.min("component").alias("c1"), F.max("component").alias("c2")).where("c1 < c2")
        split = self._small(split.select("open"), "ngram-open")
        open_ = self._small(told.join(split, F.col("tile") == F.col("open"), "left_semi"), "ngram-open-members")
        release(known, told, split)
        return open_

    def _centres(self, members: DataFrame, *more: str) -> DataFrame:
        centre = members.groupBy(F.col("tile").alias("of")).agg(F.min_by(F.struct("node", *more), F.xxhash64("node")).alias("centre"))
        return self._small(centre, "ngram-centres")

    @staticmethod
    def _ordered(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.least("node", "centre.node").alias("a"), F.greatest("node", "centre.node").alias("b"))

    def node_links(self) -> DataFrame:
        """Links between nodes that join all that is joined; within a component not every link is listed."""
        centre = self._centres(self.members)
        pairs = self.members.join(centre, F.col("tile") == F.col("of")).where(F.col("node") != F.col("centre.node"))
        met = pairs.groupBy("node", "centre").agg(F.sum("times").alias("times"))
        most = self._small(met.groupBy("node").agg(F.max_by("centre", F.struct("times", "centre")).alias("centre")), "ngram-most")
        links = self.links(self._ordered(most))
        open_ = self._open(self.members, links)
        release(self.members, centre, most)
        for _ in range(self.stars):
            if not open_.count():
                return links
            centre = self._centres(open_, "component")
            around = self._small(open_.join(centre, F.col("tile") == F.col("of")).where(F.col("node") != F.col("centre.node")), "ngram-around")
            release(open_, centre)
            found = self.links(self._ordered(around.where(F.col("component") != F.col("centre.component"))))
            links = links.unionByName(found)
            # The centre has met every member, so it leaves the tile.
            open_ = self._open(around, links)
            release(around)
        for best in [True] * self.bests + [False]:
            if not open_.count():
                return links
            pairs = self._small(self._rest(open_, best), "ngram-rest")
            links = links.unionByName(self._verified(pairs))
            before, open_ = open_, self._open(open_, links) if best else open_
            release(pairs, before)
        return links

    def _rest(self, open_: DataFrame, best: bool) -> DataFrame:
        """Pairs of different components in one tile that the bitmaps allow; large tiles are dealt out in blocks."""
        size = open_.groupBy(F.col("tile").alias("of")).agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
        size = self._small(size, "ngram-tile-sizes")
        rows = open_.join(size, F.col("tile") == F.col("of")).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
        others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
        rows = rows.select("tile", "node", "component", "block", others.alias("other"))
        rows = rows.select(
            "tile", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"), "node", "component", "block"
        ).join(self.near.select(F.col("node").alias("x"), "n", F.col("bits" if best else "wide").alias("bits")), F.col("node") == F.col("x")).drop("x")
        return rows.groupBy("tile", "left", "right").applyInArrow(_block_pairs(self.percent, best), "a long, b long").distinct()

    def result(self) -> DataFrame:
        """For each row: doc_id, n_shingles, component_id."""
        joined = _written(components(self.node_links()), "ngram-final")
        release(self.near)
        joined = joined.select(F.col("node").alias("of"), "component")
        named = self.nodes.join(joined, F.col("node") == F.col("of"), "left").select("node", F.coalesce("component", "node").alias("component"), "doc_id")
        named = _written(named, "ngram-named")
        least = _written(named.groupBy(F.col("component").alias("c")).agg(F.min("doc_id").alias("component_id")), "ngram-least")
        of_node = _written(named.join(least, F.col("component") == F.col("c")).select(F.col("node").alias("of"), "component_id"), "ngram-node-components")
        own = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("node"))
        rows = self.sketch.select("doc_id", "n", own.alias("node"))
        alone = rows.where("node is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
        linked = rows.where("node is not null").join(of_node, F.col("node") == F.col("of")).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
        return linked.unionByName(alone)


def join(docs: DataFrame, gram: int = 3, percent: int = 90) -> DataFrame:
    return Join(docs, gram, percent).result()


def representatives(docs: DataFrame, gram: int = 3, percent: int = 90) -> DataFrame:
    """The rows of `docs` without those that are not the first of their group."""
    told = _written(join(docs, gram, percent).where("doc_id <> component_id").select("doc_id").distinct(), "ngram-gone")
    return bloom.without(docs, F.col("doc_id").cast("long"), told, told.count())
