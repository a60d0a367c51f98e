"""The latest snapshot, and sales of the last days, read through partition pruning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month


def latest_snapshot(inventory: DataFrame, snapshots: DataFrame | None = None) -> DataFrame:
    """Rows of the newest snapshot.

    The newest date is a scalar subquery, over the list of snapshots where there is one and else over
    the table; the outer scan opens one partition.
    """
    newest = (inventory if snapshots is None else snapshots).agg(F.max("snapshot_date")).scalar()
    return inventory.filter(F.col("snapshot_date") == newest)


def last_sale_date(sales: DataFrame, months: DataFrame | None = None) -> Column:
    """Date of the last sale, as a scalar subquery; of a table by months, it reads the last month."""
    if "sale_month" in sales.columns:
        newest = (sales if months is None else months).agg(F.max("sale_month")).scalar()
        sales = sales.filter(F.col("sale_month") == newest)
    return sales.agg(F.max("sale_date")).scalar()


def sold_since(sales: DataFrame, days: int, months: DataFrame | None = None) -> DataFrame:
    """Sales on or after the day `days` before the last sale: days + 1 calendar days."""
    start = F.date_sub(last_sale_date(sales, months), days)
    recent = sales.filter(F.col("sale_date") >= start)
    if "sale_month" in sales.columns:
        recent = recent.filter(F.col("sale_month") >= month(start))
    return recent
