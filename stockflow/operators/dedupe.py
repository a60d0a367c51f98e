"""Duplicates: exact copies, and one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_copies(df: DataFrame, copies: str = "copies") -> DataFrame:
    """One row per distinct row, with the number of times it came in.

    Nulls count as equal. Copies collapse in each input partition before the shuffle, so a row
    that repeats without end still reaches its reducer as one row per partition.
    """
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(copies))


def drop_copies(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key in the given order, ties settled by the remaining columns.

    The smallest struct is found per input partition first, so a hot key never gathers its
    rows in one task as a ranking window would.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], *[F.col(c) for c in rest])
    first = df.groupBy(*keys).agg(F.min(ranked).alias("first"))
    return first.select(*[F.col(c) if c in keys else F.col(f"first.{c}").alias(c) for c in df.columns])


def largest_first(column: str) -> list[Column]:
    """Order keys for `first_per_key` that prefer large numbers and put nulls last."""
    return [F.col(column).isNull(), -F.col(column)]
