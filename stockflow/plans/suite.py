"""The named results, in one registry that the batch job and every other reader share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..sources.tables import Tables
from . import analyses as A
from . import kpi as K

ANALYSES: dict[str, Callable[[Tables], DataFrame]] = {
    "monthly_revenue": A.monthly_revenue,
    "revenue_by_location": A.revenue_by_location,
    "revenue_by_genre": A.revenue_by_genre,
    "genre_by_location": A.genre_by_location,
    "top_products": A.top_products,
    "dead_stock": A.dead_stock,
    "overstock": A.overstock,
    "stockouts": A.stockouts,
    "aging_buckets": A.aging_buckets,
    "transfer_recommendations": A.transfer_recommendations,
    "margin_by_condition": A.margin_by_condition,
    "margin_by_format_condition": A.margin_by_format_condition,
    "margin_by_genre": A.margin_by_genre,
    "sell_through_by_genre": A.sell_through_by_genre,
    "sell_through_by_location": A.sell_through_by_location,
    "revenue_by_format": A.revenue_by_format,
    "bottom_products": A.bottom_products,
    "slow_categories": A.slow_categories,
}

KPIS: dict[str, Callable[[Tables], DataFrame]] = {
    "kpi_totals": K.kpi_totals,
    "transfer_unique": K.transfer_unique,
    "transfer_top10": K.transfer_top,
    "transfer_total": K.transfer_total,
    "aging_labels": K.aging_labels,
    "top_products_display": K.top_products_display,
    "genre_revenue_ascending": K.genre_revenue_ascending,
    "margin_by_format_display": K.margin_by_format_display,
    "genre_share_by_location": K.genre_share_by_location,
    "condition_share": K.condition_share,
}

RESULTS = {**ANALYSES, **KPIS}

# Results that add up the sales cube.
CUBED = {
    "revenue_by_genre",
    "genre_by_location",
    "margin_by_condition",
    "margin_by_format_condition",
    "margin_by_genre",
    "revenue_by_format",
    "kpi_totals",
    "genre_revenue_ascending",
    "margin_by_format_display",
    "genre_share_by_location",
    "condition_share",
}
