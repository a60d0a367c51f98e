"""Keys of a table that grows by pulls: a new pull is checked against all before it without reading them.

Each pull leaves a filter of its keys: `HASHES` bits of each key, in blocks of 32,768 bits, some two bytes a key. A pull's keys meet the
filters of all earlier pulls by block; only keys that may have been there before are looked for in the history, exactly, and only if
there are any. The filters are versions of a table with a manifest, a pull that is added again replaces its own.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settle
from ..sources import manifest
from ..sources.tables import LOOK_UP_KEYS, look_up

BLOCK_BITS = 32768
HASHES = 3
#: Keys of the whole history that a block is meant for, and blocks of a small history.
BLOCK_KEYS, LEAST_BLOCKS = 2048, 64


def blocks_for(keys: int) -> int:
    """Blocks for a history of so many keys: with fewer, bits are set by chance and every key is looked for in the history."""
    return max(LEAST_BLOCKS, -(-keys // BLOCK_KEYS))


def _cells(second: Column) -> list[Column]:
    return [F.shiftright(second, 15 * i).bitwiseAND(BLOCK_BITS - 1) for i in range(HASHES)]


def _is_set(cell: Column) -> Column:
    byte = F.conv(F.hex(F.substring(F.col("bits"), (F.shiftright(cell, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, cell.bitwiseAND(7).cast("int")) == 1


@dataclass(frozen=True)
class KeyHistory:
    """The filters of one table's keys below `root`. `blocks`: of 4 KB, the same for all pulls; `blocks_for` the keys of the whole history keep false alarms rare."""

    spark: SparkSession
    root: str
    name: str
    keys: tuple[str, ...]
    blocks: int = LEAST_BLOCKS

    @property
    def _table(self) -> str:
        return f"{self.name}-keys"

    def _hashed(self, rows: DataFrame) -> DataFrame:
        keys = [F.col(k) for k in self.keys]
        return rows.withColumn("block", F.pmod(F.xxhash64(*keys), F.lit(self.blocks))).withColumn("second", F.xxhash64(*keys, F.lit(1)))

    def add(self, pull: DataFrame, name: str) -> None:
        """Remember the keys of a pull. Two hashes of a key go to the task of its block, once a key and task; a block itself crosses no network."""
        met = self._hashed(pull.select(*self.keys)).select("block", "second").distinct().repartition("block")
        cells = met.select("block", F.explode(F.array(*_cells(F.col("second")))).alias("cell"))
        made = f"v={uuid.uuid4().hex}"
        cells.groupBy("block").agg(F.bitmap_construct_agg("cell").alias("bits")).write.parquet(f"{self.root}/{self._table}/{made}")
        manifest.commit(self.spark, self.root, self._table, lambda now: now.replaced({name: [made]}))

    def _filters(self, besides: str | None) -> DataFrame | None:
        now = manifest.current(self.spark, self.root, self._table)
        parts = {} if now is None else {p: d for p, d in now.parts.items() if p != besides}
        if not parts:
            return None
        every = self.spark.read.schema("block long, bits binary").parquet(*[f"{self.root}/{self._table}/{d}" for dirs in parts.values() for d in dirs])
        return every.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))

    def suspects(self, keys: DataFrame, name: str | None = None) -> DataFrame:
        """Those of some keys that an earlier pull (other than `name`) may have had; all that one had are among them."""
        filters = self._filters(name)
        if filters is None:
            return keys.limit(0)
        met = self._hashed(keys).join(filters.withColumnRenamed("block", "of"), F.col("block") == F.col("of"))
        found = _is_set(_cells(F.col("second"))[0])
        for cell in _cells(F.col("second"))[1:]:
            found &= _is_set(cell)
        return met.filter(found).select(*self.keys)

    def check(self, pull: DataFrame, history: DataFrame, name: str | None = None) -> DataFrame:
        """(keys, n_rows) of the pull's keys that occur more than once in the pull and `history` together, as the check of all rows finds them.

        `history`: the rows of the pulls added before; it is read if a key may be in it, and then its keys only. A pull's name leaves its own filter out.
        """
        mine = settle(pull.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("n_rows")), f"{self.name}-pull-keys")
        suspects = settle(self.suspects(mine.select(*self.keys), name), f"{self.name}-suspects")
        n = suspects.limit(LOOK_UP_KEYS + 1).count()
        if not n:
            return mine.filter("n_rows > 1")
        before = history.select(*self.keys)
        if len(self.keys) == 1 and n <= LOOK_UP_KEYS:
            # Few: the history's row groups without them are skipped, if the key is indexed.
            listed = [r[0] for r in suspects.filter(F.col(self.keys[0]).isNotNull()).collect()]
            found = look_up(before, self.keys[0], listed)
            if len(listed) < n:
                found = found.unionByName(before.filter(F.col(self.keys[0]).isNull()))
        else:
            asked = suspects.select(*[F.col(k).alias(f"asked_{i}") for i, k in enumerate(self.keys)])
            same = [F.col(k).eqNullSafe(F.col(f"asked_{i}")) for i, k in enumerate(self.keys)]
            found = before.join(asked, same, "left_semi")
        counted = found.groupBy(*[F.col(k).alias(f"old_{i}") for i, k in enumerate(self.keys)]).agg(F.count(F.lit(1)).alias("before"))
        same = [F.col(k).eqNullSafe(F.col(f"old_{i}")) for i, k in enumerate(self.keys)]
        total = F.col("n_rows") + F.coalesce("before", F.lit(0))
        return mine.join(counted, same, "left").select(*self.keys, total.alias("n_rows")).filter("n_rows > 1")
