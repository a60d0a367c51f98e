"""Landed point-of-sale documents flattened to the canonical tables.

The documents carry their store in `location`, so reading every store's directory at once is the
union of the stores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema
from ..functions.dates import epoch_ms, utc_date
from ..functions.numbers import cents, net_amount
from ..functions.text import split_name
from ..operators.dedupe import first_per_key
from ..operators.integrity import union_all


def _or_zero(c: Column) -> Column:
    return F.coalesce(cents(c), F.lit(0).cast(schema.MONEY))


def line_discount_cents(discounts: Column) -> Column:
    """Sum of the absolute discount amounts; a missing list or amount counts as 0."""
    amounts = F.aggregate(discounts, F.lit(0).cast("bigint"), lambda total, d: total + F.abs(F.coalesce(d["amount"], F.lit(0))))
    return F.coalesce(amounts, F.lit(0).cast("bigint"))


def line_quantity(unit_qty: Column) -> Column:
    """Units from thousandths; a missing or zero field means one piece."""
    weighed = (unit_qty / F.lit(1000)).cast(schema.WEIGHED)
    return F.when(unit_qty != 0, weighed).otherwise(F.lit(1).cast(schema.WEIGHED))


def order_lines(orders: DataFrame, *kept: str) -> DataFrame:
    """One row per line item, with the `kept` columns of its document; an order without items gives none."""
    lines = orders.select("location", "createdTime", *kept, F.explode("lineItems.elements").alias("line"))
    return lines.select(
        F.col("line.id").alias("sale_id"),
        utc_date(F.col("createdTime")).alias("sale_date"),
        "location",
        F.col("line.item.id").alias("product_id"),
        line_quantity(F.col("line.unitQty")).alias("quantity"),
        cents(F.col("line.price")).alias("unit_price"),
        cents(line_discount_cents(F.col("line.discounts.elements"))).alias("discount"),
        *kept,
    )


def whole_quantity(quantity: Column) -> Column:
    """The integral quantity of a sale; null for weighed goods that are no whole number."""
    return F.when(quantity == F.floor(quantity), quantity.try_cast("bigint"))


REJECT = "reject_reason"


def judged_lines(orders: DataFrame) -> DataFrame:
    """Every line with the reason why it does not fit the sales table, or null."""
    lines = order_lines(orders)
    reason = (
        F.when(F.col("sale_id").isNull(), "no id")
        .when(F.col("sale_date").isNull(), "no date")
        .when(F.col("product_id").isNull(), "no product")
        .when(F.col("unit_price").isNull(), "no price")
        .when(whole_quantity(F.col("quantity")).isNull(), "no whole quantity")
    )
    return lines.withColumn(REJECT, reason)


def sales_from_lines(orders: DataFrame) -> DataFrame:
    """The lines that fit the sales table; `rejected_lines` has the others."""
    fitting = judged_lines(orders).filter(F.col(REJECT).isNull()).drop(REJECT)
    fitting = fitting.withColumn("quantity", whole_quantity(F.col("quantity")))
    return fitting.withColumn("net_amount", net_amount(F.col("quantity"), F.col("unit_price"), F.col("discount")))


def rejected_lines(orders: DataFrame) -> DataFrame:
    return judged_lines(orders).filter(F.col(REJECT).isNotNull())


def judged_stock(stocks: DataFrame) -> DataFrame:
    """Stock rows with the reason why they do not fit the inventory table, or null."""
    on_hand = F.col("quantity_on_hand")
    reason = F.when(F.col("product_id").isNull(), "no product").when(on_hand != F.floor(on_hand), "no whole quantity")
    return stock_rows(stocks).withColumn(REJECT, reason)


def inventory_from_stock(stocks: DataFrame) -> DataFrame:
    fitting = judged_stock(stocks).filter(F.col(REJECT).isNull()).drop(REJECT)
    return fitting.withColumn("quantity_on_hand", F.col("quantity_on_hand").cast("int"))


def rejected_stock(stocks: DataFrame) -> DataFrame:
    return judged_stock(stocks).filter(F.col(REJECT).isNotNull())


def metrics(landed: dict[str, DataFrame]) -> DataFrame:
    """(entity, metric, n): rows in, rows kept, and rows of each reason; in = kept + all reasons."""
    judged = {
        "orders": judged_lines,
        "item_stocks": judged_stock,
        "items": lambda d: catalog_rows(d).withColumn(REJECT, F.lit(None).cast("string")),
        "payments": lambda d: payment_rows(d).withColumn(REJECT, F.lit(None).cast("string")),
        "refunds": lambda d: refund_rows(d).withColumn(REJECT, F.lit(None).cast("string")),
    }
    counted = []
    for entity, docs in landed.items():
        by_reason = judged[entity](docs).groupBy(REJECT).agg(F.count(F.lit(1)).alias("n"))
        # A handful of rows per entity: each counts towards the rows in, and towards its own reason or the rows kept.
        names = F.array(F.lit("rows_in"), F.coalesce(F.col(REJECT), F.lit("rows_kept")))
        rows = by_reason.select(F.explode(names).alias("metric"), "n").groupBy("metric").agg(F.sum("n").alias("n"))
        counted.append(rows.select(F.lit(entity).alias("entity"), "metric", "n"))
    return union_all(counted)


def catalog_rows(items: DataFrame) -> DataFrame:
    """One row per item and store. Format and condition are not in the feed and stay blank."""
    artist, title = split_name(F.col("name"))
    first_category = F.get("categories.elements", F.lit(0))["name"]
    return items.select(
        F.col("id").alias("product_id"),
        "sku",
        F.col("code").alias("upc"),
        artist.alias("artist"),
        title.alias("title"),
        F.lit("").alias("format"),
        F.coalesce(first_category, F.lit("")).alias("genre"),
        F.lit("").alias("condition"),
        cents(F.col("cost")).alias("cost"),
        cents(F.col("price")).alias("price"),
        F.lit(None).cast("int").alias("release_year"),
        "location",
    )


def products_from_items(items: DataFrame, stores: list[str]) -> DataFrame:
    """One row per product: of the first store, in the given order, that carries it."""
    rank = F.array_position(F.array(*[F.lit(s) for s in stores]), F.col("location"))
    known = F.when(rank > 0, rank).otherwise(len(stores) + 1)
    rows = first_per_key(catalog_rows(items), ["product_id"], [known])
    return rows.drop("location")


def payment_rows(payments: DataFrame) -> DataFrame:
    return payments.select(
        F.col("id").alias("payment_id"),
        utc_date(F.col("createdTime")).alias("payment_date"),
        "location",
        F.col("order.id").alias("order_id"),
        _or_zero(F.col("amount")).alias("amount"),
        _or_zero(F.col("tipAmount")).alias("tip_amount"),
        _or_zero(F.col("taxAmount")).alias("tax_amount"),
        F.coalesce("result", F.lit("")).alias("result"),
    )


def refund_rows(refunds: DataFrame) -> DataFrame:
    return refunds.select(
        F.col("id").alias("refund_id"),
        utc_date(F.col("createdTime")).alias("refund_date"),
        "location",
        F.col("payment.id").alias("payment_id"),
        _or_zero(F.col("amount")).alias("amount"),
    )


def stock_rows(stocks: DataFrame) -> DataFrame:
    """One row per stocked item, dated by its pull; a zero or missing count falls back."""
    zero = F.lit(0.0)
    on_hand = F.coalesce(F.nullif(F.col("stockCount"), zero), F.nullif(F.col("quantity"), zero), zero)
    return stocks.select(
        F.col("pull_date").alias("snapshot_date"),
        "location",
        F.col("item.id").alias("product_id"),
        on_hand.alias("quantity_on_hand"),
        F.lit(None).cast("int").alias("days_in_stock"),
        F.lit(None).cast("int").alias("reorder_level"),
    )


def month_windows(bounds: DataFrame) -> DataFrame:
    """Half-open windows [start_ms, end_ms), one per calendar month, of each (since, today) row.

    The first starts on `since`, the last ends with `today`.
    """
    months = F.sequence(F.trunc("since", "MM"), F.col("today"), F.expr("interval 1 month"))
    start = F.greatest(F.col("since"), F.col("month_start"))
    end = F.least(F.add_months("month_start", 1), F.date_add("today", 1))
    return bounds.select("since", "today", F.explode(months).alias("month_start")).select(
        "month_start", epoch_ms(start).alias("start_ms"), epoch_ms(end).alias("end_ms")
    )


def in_month_windows(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Orders or payments with the window that their client's time falls into; one outside all windows is left out.

    A window never crosses a month, so the month is an equality key and the bounds are checked
    after it: a hash join, not a range join.
    """
    made = F.col("clientCreatedTime")
    keyed = docs.withColumn("month_start", F.trunc(utc_date(made), "MM"))
    inside = (made >= F.col("start_ms")) & (made < F.col("end_ms"))
    return keyed.join(windows, "month_start").filter(inside)


def made_since(docs: DataFrame, since: str | None) -> DataFrame:
    """Documents made on the client on or after the day `since`; all of them without it, and those without a client's time."""
    made = F.col("clientCreatedTime")
    if since is None or "clientCreatedTime" not in docs.columns:
        return docs
    return docs.filter(made.isNull() | (made >= epoch_ms(F.lit(since).cast("date"))))
