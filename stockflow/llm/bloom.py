"""Blocked Bloom filters as small tables: built by counting cells, probed by a broadcast join.

A key sets `HASHES` cells, all within one block of 32,768 bits, so a probe needs one row of the
filter. The filter has about `bits_per_key` cells for each key, and `max_bytes` at most: that bound is what
makes it fit for broadcasting. Beyond the bound only the share of false alarms rises; whoever probes has an exact
second step, so results never change.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.session import settle

BLOCK_BITS = 32768
BLOCK_BYTES = BLOCK_BITS // 8
HASHES = 3


@dataclass(frozen=True)
class Filter:
    """`table`: block long, bits binary; a block without a set bit has no row."""

    table: DataFrame
    blocks: int


def blocks_for(keys: int, bits_per_key: int, max_bytes: int) -> int:
    return max(1, min(-(-keys * bits_per_key // BLOCK_BITS), max_bytes // BLOCK_BYTES))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _cells(key: Column) -> list[Column]:
    second = F.xxhash64(key, F.lit(1))
    return [F.shiftright(second, 15 * i).bitwiseAND(BLOCK_BITS - 1) for i in range(HASHES)]


def build(keys: DataFrame, key: Column, n: int, least: int = 1, bits_per_key: int = 16, max_bytes: int = 32 << 20) -> Filter:
    """A filter of the cells that at least `least` rows of `keys` set (2: of keys that may repeat).

    Cells are counted by a grouping that sums before the shuffle: a key with a third of all rows
    sends one row per task.
    """
    blocks = blocks_for(n, bits_per_key, max_bytes)
    cells = keys.select(_block(key, blocks).alias("block"), F.explode(F.array_distinct(F.array(*_cells(key)))).alias("cell"))
    counted = cells.groupBy("block", "cell").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    bits = counted.groupBy("block").agg(F.bitmap_construct_agg("cell").alias("bits"))
    return Filter(settle(bits, "bloom"), blocks)


def _is_set(cell: Column) -> Column:
    byte = F.conv(F.hex(F.substring(F.col("__bits"), (F.shiftright(cell, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, cell.bitwiseAND(7).cast("int")).bitwiseAND(1) == 1


def probe(df: DataFrame, key: Column, bloom: Filter, name: str) -> DataFrame:
    """`df` with the boolean column `name`: false means that the key is surely not in the filter."""
    blocks = bloom.table.select(F.col("block").alias("__block"), F.col("bits").alias("__bits"))
    found = _is_set(_cells(key)[0])
    for cell in _cells(key)[1:]:
        found &= _is_set(cell)
    joined = df.join(F.broadcast(blocks), _block(key, bloom.blocks) == F.col("__block"), "left")
    return joined.withColumn(name, F.col("__bits").isNotNull() & F.coalesce(found, F.lit(False))).drop("__block", "__bits")


def without(df: DataFrame, key: Column, gone: DataFrame, n: int) -> DataFrame:
    """`df` without the rows whose key (null-safe) is in `gone` (one column, `n` rows, no key twice).

    Rows that the filter clears pass straight through, with their texts; only the others
    are shuffled against `gone`. The join is an outer one: an anti join would be planned before the probe, over all rows.
    """
    if not n:
        return df
    # The row as one column, so that its columns may have any names.
    rows = df.select(F.struct("*").alias("row"), key.alias("key"))
    gone = gone.select(F.col(gone.columns[0]).alias("gone"), F.lit(True).alias("is_gone"))
    probed = probe(rows, F.col("key"), build(gone, F.col("gone"), n), "maybe")
    unsure = probed.where("maybe").join(gone, F.col("key").eqNullSafe(F.col("gone")), "left").where("is_gone IS NULL")
    return probed.where("NOT maybe").select("row.*").union(unsure.select("row.*"))
