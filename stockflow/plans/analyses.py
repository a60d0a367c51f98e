"""The named analyses over products, sales and inventory.

Each takes the tables and returns one result, in its reporting order. Money stays decimal, so a
sum does not depend on the order in which tasks finish; percentages are doubles.

`*_rows` functions are the unordered inputs that KPIs share with the reports.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import month
from ..functions.numbers import money_sum, percent, to_cents
from ..operators.dedupe import first_per_key, largest_first
from ..operators.recent import latest_snapshot, sold_since
from ..session import settle
from ..sources.tables import Tables


def _units() -> Column:
    return F.sum("quantity").alias("units")


def _revenue() -> Column:
    return money_sum(to_cents(F.col("net_amount"))).alias("revenue")


def _products(t: Tables, *columns: str) -> DataFrame:
    return t.products.select("product_id", *columns)


def _desc(name: str) -> Column:
    return F.col(name).desc_nulls_last()


# -- sales -----------------------------------------------------------------------------------


def sales_rollup(t: Tables, sale_keys: list[str], product_keys: list[str]) -> DataFrame:
    """Units, revenue and gross profit by sale columns and product columns.

    Sales are first summed per product, so that a best seller crosses the network as one row per
    task, and the sums meet the products. A sale whose price or discount is not known counts in the
    units, and in the revenue if that is known, but neither its takings nor its cost enter the profit.
    """
    keys = sale_keys + product_keys
    if t.cube is not None and set(keys) <= set(t.cube.columns):
        return _add_up(t.cube, keys)
    per_unit = to_cents(F.col("unit_price")) - to_cents(F.col("discount"))
    known_units = F.sum(F.when(per_unit.isNotNull(), F.col("quantity"))).alias("known_units")
    takings = money_sum(F.col("quantity") * per_unit).alias("takings")
    summed = t.sales.groupBy("product_id", *sale_keys).agg(_units(), _revenue(), takings, known_units)
    profit = F.col("takings") - F.col("known_units") * F.col("cost")
    products = t.products.select("product_id", "cost", *product_keys)
    return _add_up(summed.join(products, "product_id").withColumn("gross_profit", profit), keys)


def _add_up(parts: DataFrame, keys: list[str]) -> DataFrame:
    return parts.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("units", "revenue", "gross_profit")]
    )


def with_cube(t: Tables) -> Tables:
    """The tables with their sales cube written, for running many roll-ups after one scan of sales."""
    cube = settle(sales_rollup(t, ["location"], ["genre", "format", "condition"]), "sales-cube")
    return replace(t, cube=cube)


def sharing(t: Tables) -> Tables:
    """The tables for running many results: what several of them start from is made once, when it is first asked for."""
    return replace(t, made={})


def made_once(t: Tables, name: str, make: Callable[[Tables], DataFrame]) -> DataFrame:
    """`make(t)`, written the first time if the tables are shared between results."""
    if t.made is None:
        return make(t)
    if name not in t.made:
        t.made[name] = settle(make(t), name)
    return t.made[name]


def latest(t: Tables) -> DataFrame:
    """Stock of the newest snapshot."""
    return made_once(t, "latest-stock", lambda t: latest_snapshot(t.inventory, t.snapshots))


def recent_demand(t: Tables, days: int) -> DataFrame:
    """Units sold in the last days, by store and product."""
    return made_once(
        t,
        f"demand-{days}",
        lambda t: sold_since(t.sales, days, t.months).groupBy("location", "product_id").agg(F.sum("quantity").alias("sold")),
    )


def monthly_revenue(t: Tables) -> DataFrame:
    """Revenue and units by calendar month; only the grouped months are put into words."""
    by_month = t.sales.groupBy(F.trunc("sale_date", "MM").alias("first_day")).agg(_revenue(), _units())
    return by_month.select(month(F.col("first_day")).alias("month"), "revenue", "units").orderBy("month")


def revenue_by_location(t: Tables) -> DataFrame:
    per_unit = F.round(F.col("revenue").cast("double") / F.nullif(F.col("units").cast("double"), F.lit(0.0)), 2)
    return (
        t.sales.groupBy("location")
        .agg(_revenue(), _units())
        .withColumn("avg_net_per_unit", per_unit)
        .orderBy(_desc("revenue"), "location")
    )


def revenue_by_genre(t: Tables) -> DataFrame:
    return sales_rollup(t, [], ["genre"]).select("genre", "revenue", "units").orderBy(_desc("revenue"), "genre")


def revenue_by_format(t: Tables) -> DataFrame:
    return sales_rollup(t, [], ["format"]).select("format", "revenue", "units").orderBy(_desc("revenue"), "format")


def genre_by_location(t: Tables) -> DataFrame:
    rolled = sales_rollup(t, ["location"], ["genre"]).select("location", "genre", "revenue", "units")
    return rolled.orderBy("location", _desc("revenue"), "genre")


# -- products --------------------------------------------------------------------------------


def _product_totals(t: Tables) -> DataFrame:
    totals = t.sales.groupBy("product_id").agg(_units(), _revenue())
    return totals.join(_products(t, "artist", "title", "format", "genre", "condition"), "product_id")


_PRODUCT_TOTALS = ["artist", "title", "format", "genre", "condition", "units", "revenue"]


def top_products(t: Tables, limit: int = 15) -> DataFrame:
    """The best sellers by revenue."""
    order = [_desc("revenue"), "product_id"]
    top = made_once(t, f"top-products-{limit}", lambda t: _product_totals(t).orderBy(*order).limit(limit))
    return top.orderBy(*order).select(*_PRODUCT_TOTALS)


def bottom_products(t: Tables, limit: int = 15) -> DataFrame:
    """The products that sold the fewest units, never-sold ones included."""
    attributes = t.products.select("product_id", "artist", "title", "format", "genre", "condition")
    totals = t.sales.groupBy("product_id").agg(_units(), _revenue())
    joined = attributes.join(totals, "product_id", "left").withColumns(
        {"units": F.coalesce("units", F.lit(0)), "revenue": F.coalesce("revenue", F.lit(0).cast("decimal(28,2)"))}
    )
    return joined.orderBy("units", "revenue", "product_id").limit(limit).select(*_PRODUCT_TOTALS)


def dead_stock(t: Tables, days: int = 90, limit: int | None = 25) -> DataFrame:
    """Stock on the shelf of products no store has sold lately, by the cost tied up in it."""
    sold = recent_demand(t, days).select("product_id").distinct()
    on_shelf = latest(t).filter("quantity_on_hand > 0")
    unsold = on_shelf.join(sold, "product_id", "left_anti").join(
        _products(t, "artist", "title", "genre", "condition", "cost"), "product_id"
    )
    tied_up = F.round(F.col("quantity_on_hand") * F.col("cost"), 2).alias("cost_tied_up")
    rows = unsold.select(
        "location", "artist", "title", "genre", "condition", "quantity_on_hand", "days_in_stock", tied_up, "product_id"
    ).orderBy(_desc("cost_tied_up"), "product_id", "location")
    return (rows if limit is None else rows.limit(limit)).drop("product_id")


# -- inventory -------------------------------------------------------------------------------


def overstock(t: Tables, min_quantity: int = 6, min_days: int = 60) -> DataFrame:
    """Piles that have been sitting."""
    piles = latest(t).filter(
        (F.col("quantity_on_hand") >= min_quantity) & (F.col("days_in_stock") >= min_days)
    )
    return (
        piles.join(_products(t, "artist", "title", "genre"), "product_id")
        .orderBy(_desc("days_in_stock"), "product_id", "location")
        .select("location", "artist", "title", "genre", "quantity_on_hand", "days_in_stock")
    )


def stockout_rows(t: Tables, days: int = 60) -> DataFrame:
    demand = recent_demand(t, days).groupBy("product_id").agg(F.sum("sold").alias("sold_last_60d_all_stores"))
    empty = latest(t).filter("quantity_on_hand = 0")
    return empty.join(demand, "product_id").join(_products(t, "artist", "title", "genre"), "product_id")


def stockouts(t: Tables, days: int = 60) -> DataFrame:
    """Empty shelves for products that sold lately in any store."""
    return (
        stockout_rows(t, days)
        .orderBy(_desc("sold_last_60d_all_stores"), "product_id", "location")
        .select("location", "artist", "title", "genre", "sold_last_60d_all_stores")
    )


# Upper bound in days and label of each shelf-age bucket.
AGE_BUCKETS = ((30, "a. 0-30 days"), (60, "b. 31-60 days"), (90, "c. 61-90 days"), (None, "d. 90+ days"))


def age_bucket(days: Column) -> Column:
    label = F.lit(AGE_BUCKETS[-1][1])
    for bound, name in reversed(AGE_BUCKETS[:-1]):
        label = F.when(days <= bound, name).otherwise(label)
    return label


def aging_buckets(t: Tables) -> DataFrame:
    """Units on the shelf by age, and their share. The window sees the four bucket rows only."""
    buckets = made_once(
        t,
        "aging",
        lambda t: latest(t)
        .filter("quantity_on_hand > 0")
        .groupBy(age_bucket(F.col("days_in_stock")).alias("age_bucket"))
        .agg(F.sum("quantity_on_hand").alias("units")),
    )
    share = percent(F.col("units"), F.sum("units").over(Window.partitionBy()))
    return buckets.withColumn("pct_of_units", share).orderBy("age_bucket")


# -- transfers -------------------------------------------------------------------------------


def _transfer_sides(t: Tables, days: int, min_source_quantity: int) -> tuple[DataFrame, DataFrame]:
    """Piles that could give, with their product; and empty shelves, with the demand at their store."""
    stock = latest(t)
    demand = recent_demand(t, days).withColumnRenamed("sold", "to_location_demand_90d")
    source = (
        stock.filter(F.col("quantity_on_hand") >= min_source_quantity)
        .join(_products(t, "artist", "title", "format", "genre", "price"), "product_id")
        .select(
            "product_id",
            F.col("location").alias("from_location"),
            "artist",
            "title",
            "format",
            "genre",
            "price",
            F.col("quantity_on_hand").alias("from_qty"),
            F.col("days_in_stock").alias("from_days_sitting"),
            spare_quantity(F.col("quantity_on_hand"), F.col("reorder_level")).alias("suggested_transfer_qty"),
        )
    )
    empty = (
        stock.filter("quantity_on_hand = 0")
        .select("location", "product_id")
        .join(demand, ["location", "product_id"], "left")
        .select(
            "product_id",
            F.col("location").alias("to_location"),
            F.coalesce("to_location_demand_90d", F.lit(0)).alias("to_location_demand_90d"),
        )
    )
    return source, empty


def _matched(source: DataFrame, empty: DataFrame) -> DataFrame:
    pairs = source.join(empty, "product_id").filter(F.col("from_location") != F.col("to_location"))
    value = F.round(F.col("to_location_demand_90d") * F.col("price"), 2)
    return pairs.withColumn("est_90d_revenue_at_dest", value)


def transfer_rows(t: Tables, days: int = 90, min_source_quantity: int = 5) -> DataFrame:
    """Every (source store, empty store) pair of a product, with the demand at the empty one.

    Both sides are cut down and given all their other columns before they meet, so that the only
    join that multiplies rows comes last.
    """
    return _matched(*_transfer_sides(t, days, min_source_quantity))


def best_transfer_rows(t: Tables, days: int = 90, min_source_quantity: int = 5) -> DataFrame:
    """One row per product and empty store that some other store could fill: from the pile that has sat longest.

    The value of a move does not depend on its source, so the best source of a product is the same
    for every destination but the source's own store. The best piles of the two best stores are found before
    the join: at most two rows per product meet the empty shelves, where the full report grows with the
    square of the number of stores. Rows that repeat a store and product are allowed on either side.
    """
    source, empty = _transfer_sides(t, days, min_source_quantity)
    longest = [*largest_first("from_days_sitting"), F.col("from_location")]
    per_store = first_per_key(source, ["product_id", "from_location"], longest)
    rank = F.row_number().over(Window.partitionBy("product_id").orderBy(_desc("from_days_sitting"), "from_location"))
    best = per_store.withColumn("rank", rank).filter("rank <= 2").drop("rank")
    return first_per_key(_matched(best, empty), ["product_id", "to_location"], longest)


def transfer_count(t: Tables, min_source_quantity: int = 5) -> DataFrame:
    """How many pairs the report has, without making them: sources times empty shelves per product."""
    on_hand = F.col("quantity_on_hand")
    per_store = (
        latest(t)
        .groupBy("product_id", "location")
        .agg(F.count_if(on_hand >= min_source_quantity).alias("gives"), F.count_if(on_hand == 0).alias("lacks"))
    )
    pairs = F.sum("gives") * F.sum("lacks") - F.sum(F.col("gives") * F.col("lacks"))
    per_product = per_store.groupBy("product_id").agg(pairs.alias("pairs"))
    counted = per_product.join(_products(t), "product_id").agg(F.sum("pairs").alias("pairs"))
    return counted.select(F.coalesce("pairs", F.lit(0)).alias("n_transfers"))


def spare_quantity(on_hand: Column, reorder_level: Column) -> Column:
    """Half the pile, rounded up, while the reorder level stays behind; null without a level."""
    half = F.floor((on_hand + 1) / 2).cast("int")
    return F.when(reorder_level.isNotNull(), F.least(on_hand - reorder_level, half))


TRANSFER_COLUMNS = [
    "from_location",
    "to_location",
    "artist",
    "title",
    "format",
    "genre",
    "from_qty",
    "from_days_sitting",
    "to_location_demand_90d",
    "suggested_transfer_qty",
    "est_90d_revenue_at_dest",
]


def transfer_recommendations(t: Tables, days: int = 90, min_source_quantity: int = 5) -> DataFrame:
    """What to move between stores, the most valuable move first."""
    return (
        transfer_rows(t, days, min_source_quantity)
        .orderBy(
            _desc("est_90d_revenue_at_dest"), _desc("from_days_sitting"), "product_id", "from_location", "to_location"
        )
        .select(*TRANSFER_COLUMNS)
    )


# -- margin ----------------------------------------------------------------------------------


def _margin(t: Tables, product_keys: list[str]) -> DataFrame:
    return sales_rollup(t, [], product_keys).withColumn(
        "margin_pct", percent(F.col("gross_profit"), F.col("revenue"))
    )


def margin_by_condition(t: Tables) -> DataFrame:
    rows = _margin(t, ["condition"]).select("condition", "revenue", "gross_profit", "margin_pct")
    return rows.orderBy(_desc("margin_pct"), "condition")


def margin_by_format_condition(t: Tables) -> DataFrame:
    rows = _margin(t, ["format", "condition"])
    return rows.select("format", "condition", "units", "revenue", "gross_profit", "margin_pct").orderBy(
        _desc("gross_profit"), "format", "condition"
    )


def margin_by_genre(t: Tables) -> DataFrame:
    rows = _margin(t, ["genre"]).select("genre", "revenue", "gross_profit", "margin_pct")
    return rows.orderBy(_desc("gross_profit"), "genre")


# -- sell-through ----------------------------------------------------------------------------


def _sell_through(grouped: DataFrame) -> DataFrame:
    sold, on_hand = F.col("units_sold"), F.col("units_on_hand")
    return grouped.withColumn("sell_through_pct", percent(sold, sold + on_hand))


def _genre_units(t: Tables) -> DataFrame:
    sold = t.sales.groupBy("product_id").agg(F.sum("quantity").alias("units_sold"))
    left = latest(t).groupBy("product_id").agg(F.sum("quantity_on_hand").alias("units_on_hand"))
    parts = t.products.select("product_id", "genre").join(sold, "product_id", "left").join(left, "product_id", "left")
    return parts.groupBy("genre").agg(
        F.sum(F.coalesce("units_sold", F.lit(0))).alias("units_sold"),
        F.sum(F.coalesce("units_on_hand", F.lit(0))).alias("units_on_hand"),
    )


def sell_through_by_genre(t: Tables) -> DataFrame:
    """Units sold against units left, over the whole catalogue, sold or not."""
    return _sell_through(made_once(t, "genre-units", _genre_units)).orderBy(_desc("sell_through_pct"), "genre")


def sell_through_by_location(t: Tables) -> DataFrame:
    """Units sold against units left, by store, whichever side knows the store."""
    zero = F.lit(0).cast("bigint")
    sold = t.sales.groupBy("location").agg(F.sum("quantity").alias("units_sold"))
    left = (
        latest(t).groupBy("location").agg(F.sum("quantity_on_hand").alias("units_on_hand"))
    )
    parts = sold.withColumn("units_on_hand", zero).unionByName(left.withColumn("units_sold", zero))
    grouped = parts.groupBy("location").agg(
        F.sum(F.coalesce("units_sold", zero)).alias("units_sold"),
        F.sum(F.coalesce("units_on_hand", zero)).alias("units_on_hand"),
    )
    return _sell_through(grouped).orderBy(_desc("sell_through_pct"), "location")


def stock_and_sales(t: Tables) -> DataFrame:
    """Stock left against units ever sold, per store and product, with the side that knows the pair: both, stock or sales.

    A full outer join on null-safe keys: a sale or a pile without a store or product is shown, not lost. Both sides are summed per pair
    before they meet, so that a store or product with most rows crosses the network as one row per task.
    """
    sold = t.sales.groupBy("location", "product_id").agg(F.sum("quantity").cast("bigint").alias("units_sold"), F.lit(True).alias("was_sold"))
    left = latest(t).groupBy(F.col("location").alias("at"), F.col("product_id").alias("of"))
    left = left.agg(F.sum("quantity_on_hand").alias("units_on_hand"), F.lit(True).alias("is_stocked"))
    met = sold.join(left, F.col("location").eqNullSafe(F.col("at")) & F.col("product_id").eqNullSafe(F.col("of")), "full_outer")
    side = F.when(F.col("was_sold").isNull(), "stock").when(F.col("is_stocked").isNull(), "sales").otherwise("both")
    return met.select(
        F.when(F.col("was_sold"), F.col("location")).otherwise(F.col("at")).alias("location"),
        F.when(F.col("was_sold"), F.col("product_id")).otherwise(F.col("of")).alias("product_id"),
        side.alias("side"),
        "units_sold",
        "units_on_hand",
    )


def slow_categories(t: Tables, below: float = 50.0) -> DataFrame:
    """Sell-through by genre, with the genres that fall below a threshold flagged."""
    return sell_through_by_genre(t).withColumn("is_slow", F.col("sell_through_pct") < below)
