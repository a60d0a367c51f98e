"""Key, null and reference checks: what a database would enforce, as reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle


def known_ids(products: DataFrame) -> DataFrame:
    return products.select("product_id").filter(F.col("product_id").isNotNull())


def keep_known(df: DataFrame, products: DataFrame) -> DataFrame:
    """Rows whose product exists.

    No hint: a small product table is broadcast by its size, a large one is shuffled and the
    runtime splits a product that holds a large share of the rows. The ids are not made distinct
    first, as a grouping right below the join would keep the runtime from splitting.
    """
    return df.join(known_ids(products), "product_id", "left_semi")


def keep_orphans(df: DataFrame, products: DataFrame) -> DataFrame:
    """Rows whose product does not exist, or is null."""
    return df.join(known_ids(products), "product_id", "left_anti")


def flag_known(df: DataFrame, products: DataFrame, flag: str = "known_product") -> DataFrame:
    """Every row, with whether its product exists.

    The distinct ids are written first: the join then sees their real size, and their grouping
    is not part of its plan.
    """
    ids = settle(known_ids(products).distinct(), "product-ids").withColumn(flag, F.lit(True))
    joined = df.join(ids, "product_id", "left")
    return joined.withColumn(flag, F.coalesce(flag, F.lit(False)))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def null_counts(df: DataFrame, columns: list[str], table: str) -> DataFrame:
    """(table_name, column_name, null_rows) from one pass over the table."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], columns, "column_name", "null_rows").select(
        F.lit(table).alias("table_name"), "column_name", "null_rows"
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
