"""Headline figures and roll-ups on top of the analyses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import percent
from ..operators.dedupe import first_per_key, largest_first
from ..session import settle
from ..sources.tables import Tables
from . import analyses as A

# Display order of the formats.
FORMAT_ORDER = ("LP", "CD", '7"', "Cassette")


def kpi_totals(t: Tables) -> DataFrame:
    """One row: revenue, units, blended margin, open stockouts, open transfers.

    The margin is a ratio of sums. The two counts are scalar subqueries.
    """
    totals = A.sales_rollup(t, [], ["condition"]).agg(
        F.sum("revenue").alias("revenue"),
        F.sum("units").alias("units"),
        F.sum("gross_profit").alias("gross_profit"),
    )
    n_stockouts = A.stockout_rows(t).agg(F.count(F.lit(1))).scalar()
    n_transfers = A.transfer_count(t).scalar()
    return totals.select(
        "revenue",
        "units",
        percent(F.col("gross_profit"), F.col("revenue")).alias("blended_margin_pct"),
        n_stockouts.alias("n_stockouts"),
        n_transfers.alias("n_transfers"),
    )


def transfer_unique_rows(t: Tables, by: str = "title") -> DataFrame:
    """The best source for every opportunity at a destination.

    An opportunity is a destination and an artist and title, as the report counts them. Different
    products can share those, so `by="product_id"` keeps products apart.
    """
    keys = ["to_location", "product_id"] if by == "product_id" else ["to_location", "artist", "title"]
    best_first = [
        *largest_first("est_90d_revenue_at_dest"),
        *largest_first("from_days_sitting"),
        F.col("product_id"),
        F.col("from_location"),
    ]
    rows = A.best_transfer_rows(t).select("product_id", *A.TRANSFER_COLUMNS)
    return first_per_key(rows, keys, best_first)


def _unique(t: Tables, by: str = "title") -> DataFrame:
    return A.made_once(t, f"unique-transfers-{by}", lambda t: transfer_unique_rows(t, by))


def _best_first() -> list[Column]:
    return [
        F.col("est_90d_revenue_at_dest").desc_nulls_last(),
        F.col("from_days_sitting").desc_nulls_last(),
        F.col("product_id"),
        F.col("from_location"),
        F.col("to_location"),
    ]


def transfer_unique(t: Tables, by: str = "title") -> DataFrame:
    return _unique(t, by).orderBy(*_best_first()).select(*A.TRANSFER_COLUMNS)


def transfer_top(t: Tables, limit: int = 10) -> DataFrame:
    """The most valuable unique opportunities, labelled for a chart."""
    label = F.concat_ws(" — ", "artist", "title").alias("label")
    top = _unique(t).orderBy(*_best_first()).limit(limit)
    return top.select("to_location", label, "est_90d_revenue_at_dest")


def transfer_total(t: Tables) -> DataFrame:
    """Revenue that moving stock could recover, every opportunity counted once."""
    return _unique(t).agg(
        F.count(F.lit(1)).alias("n_opportunities"), F.sum("est_90d_revenue_at_dest").alias("est_revenue")
    )


def aging_labels(t: Tables) -> DataFrame:
    """Shelf age with the sorting prefix taken off the labels."""
    return A.aging_buckets(t).withColumn("age_bucket", F.substr("age_bucket", F.lit(4)))


def dollars(c: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(c, 2))


def top_products_display(t: Tables) -> DataFrame:
    return A.top_products(t).withColumn("revenue", dollars(F.col("revenue")))


def genre_revenue_ascending(t: Tables) -> DataFrame:
    return A.revenue_by_genre(t).orderBy("revenue", "genre")


def in_order(c: Column, order: tuple[str, ...]) -> Column:
    """Position of a category in a fixed order; unknown categories come last."""
    at = F.array_position(F.array(*[F.lit(o) for o in order]), c)
    return F.when(at > 0, at).otherwise(len(order) + 1)


def margin_by_format_display(t: Tables) -> DataFrame:
    """Margin by format and condition, with the position of the format on the axis."""
    rows = A.margin_by_format_condition(t).withColumn("format_position", in_order(F.col("format"), FORMAT_ORDER))
    return rows.select("format_position", "format", "condition", "margin_pct").orderBy(
        "format_position", "format", "condition"
    )


def genre_share_by_location(t: Tables) -> DataFrame:
    """A genre's share of each store's revenue, and against its share in the other stores.

    The grouped rows, one per store and genre, are written first, so that sales are scanned once.
    The windows run over them; the grand total is a scalar subquery, so that no task has to hold
    all of them.
    """
    rolled = settle(A.sales_rollup(t, ["location"], ["genre"]).select("location", "genre", "revenue"), "genre-sums")
    total = rolled.agg(F.sum("revenue")).scalar()
    summed = (
        rolled.withColumn("store_revenue", F.sum("revenue").over(Window.partitionBy("location")))
        .withColumn("other_genre", F.sum("revenue").over(Window.partitionBy("genre")) - F.col("revenue"))
        .withColumn("other_all", total - F.col("store_revenue"))
    )
    share = F.col("revenue").cast("double") / F.nullif(F.col("store_revenue").cast("double"), F.lit(0.0))
    others = F.col("other_genre").cast("double") / F.nullif(F.col("other_all").cast("double"), F.lit(0.0))
    return summed.select(
        "location",
        "genre",
        "revenue",
        F.round(100.0 * share, 1).alias("share_pct"),
        F.round(share / F.nullif(others, F.lit(0.0)), 2).alias("ratio_to_other_stores"),
    ).orderBy("location", F.col("revenue").desc(), "genre")


def condition_share(t: Tables) -> DataFrame:
    """Each condition's share of revenue and of gross profit, from one scan of sales."""
    rows = settle(A.sales_rollup(t, [], ["condition"]), "condition-sums")
    revenue, profit = (rows.agg(F.sum(c)).scalar() for c in ("revenue", "gross_profit"))
    return rows.select(
        "condition",
        "revenue",
        "gross_profit",
        percent(F.col("revenue"), revenue).alias("revenue_share_pct"),
        percent(F.col("gross_profit"), profit).alias("profit_share_pct"),
    ).orderBy("condition")
