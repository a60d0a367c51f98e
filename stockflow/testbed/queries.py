"""Every operator and analysis as a query over the driver's whole tables."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema
from ..functions.dates import mixed_date
from ..functions.numbers import integer, money
from ..functions.text import strip, title_case
from ..operators import integrity
from ..operators.dedupe import drop_copies
from ..operators.key_history import KeyHistory, blocks_for
from ..operators.impute import fill_with_median
from ..plans import cleaning, feed
from ..plans.analyses import stock_and_sales
from ..plans.jobs import clean_exports, write_suite
from ..plans.suite import RESULTS
from ..session import new_path, settings, settle
from ..sources.clean_csv import read_clean_csv, write_clean_csv
from ..sources.landed_json import read_landed
from ..sources.raw_csv import read_raw_csv
from ..sources import manifest
from ..sources.bucketed import bucket_count, write_bucketed
from ..sources.tables import Tables, look_up, read_directories, row_counts, write_snapshots
from ..streaming.orders import LINES, ingest_orders, read_lines
from ..streaming.revenue import keep_daily_revenue, monthly_from_daily, read_days
from . import land
from .nested import FIRST_PULL, SECOND_PULL, STORES

Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the one numeric type both engines of the comparison share."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# -- results over the clean tables ---------------------------------------------------------------


def _result(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(RESULTS[name](land.asked_tables(spark, sf_dir)))

    return run


def load_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counts(land.tables(spark, sf_dir))


def stock_sales_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(stock_and_sales(land.tables(spark, sf_dir)))


def sale_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last sale of each store by its id, looked up by key in the whole history."""
    sales = land.table(spark, sf_dir, "sales")
    keys = [r.key for r in sales.groupBy("location").agg(F.max("sale_id").alias("key")).collect()]  # a row per store
    return plain(look_up(sales, "sale_id", keys).select("sale_id", "sale_date", "location", "product_id", "quantity", "net_amount"))


BUCKETED: dict[str, Tables] = {}


def bucketed(spark: SparkSession, sf_dir: str) -> Tables:
    """The clean tables with stock and products bucketed by product, written once per application."""
    key = f"{spark.sparkContext.applicationId}:{sf_dir}"
    if key not in BUCKETED:
        prefix, t = f"b{zlib.crc32(key.encode()):08x}", land.tables(spark, sf_dir)
        buckets = bucket_count(t.inventory.count() + t.products.count())  # from the footers of the files
        BUCKETED[key] = write_bucketed(t, new_path(spark, "bucketed"), prefix, buckets)
    return BUCKETED[key]


def _bucketed(name: str) -> Query:
    return lambda spark, sf_dir: plain(RESULTS[name](bucketed(spark, sf_dir)))


EXPORTED = "margin_by_format_condition"


def suite_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result out as CSV, and back through a reader that knows doubled quotes only."""
    t, path = land.tables(spark, sf_dir), new_path(spark, "export")
    kind = write_suite(t, path, [EXPORTED], "csv")[EXPORTED].schema
    back = spark.read.schema(kind).option("header", True).option("quote", '"').option("escape", '"')
    return plain(back.option("mode", "FAILFAST").csv(f"{path}/{EXPORTED}"))


def _numbered(name: str, label: str, rows: DataFrame) -> DataFrame:
    """The position at which each row of an ordered result comes."""
    placed = rows.select(F.col(label).alias("label"), F.monotonically_increasing_id().alias("id"))
    position = F.row_number().over(Window.orderBy("id"))
    return placed.select(F.lit(name).alias("result"), position.cast("bigint").alias("position"), "label")


def reporting_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order of rows in some results, as whoever reads them from the first to the last sees it."""
    t = land.tables(spark, sf_dir)
    ordered = {"genre_revenue_ascending": "genre", "revenue_by_genre": "genre", "monthly_revenue": "month", "margin_by_genre": "genre", "sell_through_by_genre": "genre"}
    return integrity.union_all([_numbered(name, label, RESULTS[name](t)) for name, label in ordered.items()])


def suite_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows that the suite shows of a result, with their position."""
    t, path = land.tables(spark, sf_dir), new_path(spark, "preview")
    shown = write_suite(t, path, ["monthly_revenue", "revenue_by_genre"], preview=3)
    return integrity.union_all([_numbered("monthly_revenue", "month", shown["monthly_revenue"]), _numbered("revenue_by_genre", "genre", shown["revenue_by_genre"])])


def scan_clean_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean sales out to CSV and back."""
    path, kind = new_path(spark, "clean-csv"), schema.sales(land.ID)
    write_clean_csv(land.table(spark, sf_dir, "sales").select(*kind.names), path)
    return plain(read_clean_csv(spark, path, kind))


# -- cleaning ------------------------------------------------------------------------------------


def raw(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    kinds = {"products": schema.RAW_PRODUCTS, "sales": schema.RAW_SALES, "inventory": schema.RAW_INVENTORY}
    return read_raw_csv(spark, f"{land.raw_exports(spark, sf_dir, table)}/{table}", kinds[table])


def _raw(table: str, change: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain(change(raw(spark, sf_dir, table)))


def _columns(table: str, key: str, **made: Callable[[Column], Column]) -> Query:
    """The key and some columns put through a cleaning rule."""
    return _raw(table, lambda df: df.select(key, *[rule(F.col(c)).alias(c) for c, rule in made.items()]))


def _annotated(table: str, view: Callable[[DataFrame, str], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        export = raw(spark, sf_dir, table)
        if table == "products":
            rows = cleaning.annotate_products(export)
        else:
            products = cleaning.clean_products(raw(spark, sf_dir, "products"))
            annotate = {"sales": cleaning.annotate_sales, "inventory": cleaning.annotate_inventory}[table]
            rows = annotate(export, products)
        return plain(view(rows, table))

    return run


def valid_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(cleaning.clean_products(raw(spark, sf_dir, "products")).select("product_id", "cost", "price"))


def valid_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = cleaning.type_sales(drop_copies(raw(spark, sf_dir, "sales")))
    return typed.filter(F.col("sale_date").isNotNull()).select("sale_id", "sale_date")


def net_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaning.type_sales(cleaning.count_copies(raw(spark, sf_dir, "sales")))
    return plain(rows.select("sale_id", "copies", "net_amount"))


def impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Written once: the median would otherwise read the export and shuffle it for duplicates a second time.
    with settings(spark, parquet__compression__codec="zstd"):
        typed = settle(cleaning.type_inventory(drop_copies(raw(spark, sf_dir, "inventory"))), "typed-inventory")
    return fill_with_median(typed, "location", "reorder_level").select(*schema.RAW_INVENTORY.names)


def _orphans(keep: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        lines = raw(spark, sf_dir, "sales").select("sale_id", "product_id")
        return keep(lines, raw(spark, sf_dir, "products")).select("sale_id", "product_id")

    return run


def quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters that come with the cleaning of all three exports."""
    out = new_path(spark, "cleaned")
    clean_exports(spark, land.raw_exports(spark, sf_dir), out)
    return spark.read.parquet(f"{out}/quality_metrics")


def _typed(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return getattr(cleaning, f"type_{table}")(raw(spark, sf_dir, table))


def dq_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = []
    for table, keys in schema.KEYS.items():
        rows = integrity.duplicate_keys(_typed(spark, sf_dir, table), keys)
        found.append(rows.select(F.lit(table).alias("table_name"), F.concat_ws("|", *keys).alias("key"), "n_rows"))
    return integrity.union_all(found)


PULLS = 3


def dq_incremental_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sales in three pulls, each checked against those before; what was found of a key last is its number of rows."""
    rows = _typed(spark, sf_dir, "sales").withColumn("pull", F.pmod(F.xxhash64("sale_date", "location", "unit_price", "discount"), F.lit(PULLS)))
    rows = settle(rows, "typed-sales")
    keys = tuple(schema.KEYS["sales"])
    known = KeyHistory(spark, new_path(spark, "key-history"), "sales", keys, blocks=blocks_for(rows.count()))  # from the footers of the files
    found = []
    for i in range(PULLS):
        pull, before = rows.filter(F.col("pull") == i), rows.filter(F.col("pull") < i)
        found.append(settle(known.check(pull, before), "repeated-keys"))
        known.add(pull, str(i))
    last = integrity.union_all(found).groupBy(F.col("sale_id").alias("key")).agg(F.max("n_rows").alias("n_rows"))
    return last.select(F.lit("sales").alias("table_name"), "key", "n_rows")


def dq_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = []
    for table in schema.KEYS:
        rows = drop_copies(raw(spark, sf_dir, table))
        typed = getattr(cleaning, f"type_{table}")(rows)
        counted.append(integrity.null_counts(typed, cleaning.table_columns(table), table))
    return integrity.union_all(counted)


def dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a product, counted per product before the products are looked up."""
    products, counted = raw(spark, sf_dir, "products"), []
    for table in ("sales", "inventory"):
        per_product = raw(spark, sf_dir, table).groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
        missing = integrity.keep_orphans(per_product, products)
        counted.append(
            missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"), F.count("product_id").alias("orphan_products")).select(
                F.lit(table).alias("table_name"), "orphan_rows", "orphan_products"
            )
        )
    return integrity.union_all(counted)


# -- point-of-sale documents -----------------------------------------------------------------------


def docs(spark: SparkSession, sf_dir: str, entity: str, pull: str | None = None) -> DataFrame:
    landed = read_landed(spark, land.documents(spark, sf_dir, entity), entity)
    return landed if pull is None else landed.filter(F.col("pull_date") == F.lit(pull).cast("date"))


def _flat(entity: str, flatten: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain(flatten(docs(spark, sf_dir, entity)))


def json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = docs(spark, sf_dir, "orders")
    return orders.select("id", "createdTime", "location", "pull_date", F.size("lineItems.elements").alias("n_items"))


def _line_discounts(orders: DataFrame) -> DataFrame:
    lines = orders.select(F.explode("lineItems.elements").alias("line"))
    cents = feed.line_discount_cents(F.col("line.discounts.elements"))
    return lines.select(F.col("line.id").alias("sale_id"), cents.alias("discount_cents"))


def _names(items: DataFrame) -> DataFrame:
    artist, title = feed.split_name(F.col("name"))
    return items.select(F.col("id").alias("product_id"), "location", artist.alias("artist"), title.alias("title"))


def _weighed(orders: DataFrame) -> DataFrame:
    lines = feed.order_lines(orders)
    return lines.filter(feed.whole_quantity(F.col("quantity")).isNull())


def json_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.stock_rows(docs(spark, sf_dir, "item_stocks"))


def union_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every store and entity, all stores read at once."""
    flatten = {
        "catalog": feed.catalog_rows(docs(spark, sf_dir, "items")),
        "orders": feed.order_lines(docs(spark, sf_dir, "orders")),
        "payments": feed.payment_rows(docs(spark, sf_dir, "payments")),
        "refunds": feed.refund_rows(docs(spark, sf_dir, "refunds")),
        "item_stocks": feed.stock_rows(docs(spark, sf_dir, "item_stocks")),
    }
    counted = [
        rows.groupBy("location").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(e).alias("entity"), "location", "n_rows")
        for e, rows in flatten.items()
    ]
    return integrity.union_all(counted)


def feed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in, kept and quarantined by reason, of every entity."""
    return feed.metrics({entity: docs(spark, sf_dir, entity) for entity in schema.LANDED})


def month_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and payments per monthly window of the client's time, from before the first to the last."""
    bounds = land.table(spark, sf_dir, "sales").agg(F.date_sub(F.min("sale_date"), 3).alias("since"), F.max("sale_date").alias("today"))
    windows = feed.month_windows(bounds)
    counted = []
    for entity in ("orders", "payments"):
        placed = feed.in_month_windows(docs(spark, sf_dir, entity).select("clientCreatedTime"), windows)
        n = placed.groupBy("month_start", "start_ms", "end_ms").agg(F.count(F.lit(1)).alias("n_documents"))
        counted.append(n.select(F.lit(entity).alias("entity"), "*"))
    return integrity.union_all(counted)


def snapshot_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two pulls added one after the other, the second one twice; the table keeps one of each."""
    root = new_path(spark, "snapshots")
    for pull in (FIRST_PULL, SECOND_PULL, SECOND_PULL):
        pulled = feed.stock_rows(docs(spark, sf_dir, "item_stocks", pull))
        write_snapshots(pulled, root)
    # Unfitted rows: weighed stock is no whole number.
    kept = read_directories(spark, root, "inventory", pulled.schema, manifest.current(spark, root, "inventory").directories)
    return kept.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("quantity_on_hand").alias("units")
    )


# -- streams, drained --------------------------------------------------------------------------------


def _ingested(spark: SparkSession, sf_dir: str) -> str:
    sink = new_path(spark, "ingest")
    ingest_orders(spark, land.documents(spark, sf_dir, "orders"), sink).awaitTermination()
    return sink


def stream_sales_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(read_lines(spark, _ingested(spark, sf_dir)).select(*LINES.names))


def stream_monthly_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = new_path(spark, "revenue")
    keep_daily_revenue(spark, land.documents(spark, sf_dir, "orders"), sink).awaitTermination()
    return plain(monthly_from_daily(read_days(spark, sink)))


QUERIES: dict[str, Query] = {
    **{name: _result(name) for name in RESULTS},
    "suite_export": suite_export,
    "suite_preview": suite_preview,
    "reporting_order": reporting_order,
    "stock_sales_reconciliation": stock_sales_reconciliation,
    "sale_lookup": sale_lookup,
    "bucketed_sell_through_by_genre": _bucketed("sell_through_by_genre"),
    "bucketed_overstock": _bucketed("overstock"),
    "load_row_counts": load_row_counts,
    "scan_clean_sales": scan_clean_sales,
    "scan_raw_products": _raw("products", lambda df: df),
    "scan_raw_sales": _raw("sales", lambda df: df),
    "scan_raw_inventory": _raw("inventory", lambda df: df),
    "dedupe_exact": _raw("sales", drop_copies),
    "trim_text": _columns("products", "product_id", artist=strip, title=strip, format=strip),
    "normalize_case": _columns("products", "product_id", genre=title_case, condition=title_case),
    "normalize_location": _columns("sales", "sale_id", location=title_case),
    "clean_money": _columns("sales", "sale_id", unit_price=money, discount=money),
    "parse_mixed_dates": _columns("sales", "sale_id", sale_date=mixed_date),
    "cast_integers": _columns("sales", "sale_id", quantity=lambda c: integer(c, "bigint")),
    "cast_years": _columns("products", "product_id", release_year=integer),
    "valid_price": valid_price,
    "valid_date": valid_date,
    "fill_discount": _columns("sales", "sale_id", discount=cleaning.fill_discount),
    "orphans_semi": _orphans(integrity.keep_known),
    "orphans_anti": _orphans(integrity.keep_orphans),
    "net_amount": net_amount,
    "impute_median": impute_median,
    "quality_metrics": quality_metrics,
    "clean_products": _annotated("products", cleaning.accepted),
    "clean_sales": _annotated("sales", cleaning.accepted),
    "clean_inventory": _annotated("inventory", cleaning.accepted),
    "quarantine_products": _annotated("products", cleaning.rejected),
    "quarantine_sales": _annotated("sales", cleaning.rejected),
    "quarantine_inventory": _annotated("inventory", cleaning.rejected),
    "dq_duplicate_keys": dq_duplicate_keys,
    "dq_incremental_keys": dq_incremental_keys,
    "dq_null_counts": dq_null_counts,
    "dq_orphans": dq_orphans,
    "json_scan": json_scan,
    "json_order_lines": _flat("orders", feed.order_lines),
    "json_line_discount": _flat("orders", _line_discounts),
    "json_weighed_lines": _flat("orders", _weighed),
    "json_sales": _flat("orders", feed.sales_from_lines),
    "quarantine_documents": _flat("orders", feed.rejected_lines),
    "feed_metrics": feed_metrics,
    "split_artist_title": _flat("items", _names),
    "json_products": _flat("items", feed.catalog_rows),
    "first_per_product": _flat("items", lambda items: feed.products_from_items(items, STORES)),
    "json_payments": _flat("payments", feed.payment_rows),
    "json_refunds": _flat("refunds", feed.refund_rows),
    "json_inventory": json_inventory,
    "union_stores": union_stores,
    "month_windows": month_windows,
    "snapshot_append": snapshot_append,
    "stream_sales_ingest": stream_sales_ingest,
    "stream_monthly_revenue": stream_monthly_revenue,
}
