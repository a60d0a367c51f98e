"""The driver's tables seen as products, sales and inventory (see FIXTURES.md, section 3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Parts that one task unfolds.
PARTS_PER_TASK = 20_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").cast("bigint").alias("product_id"),
        F.concat(F.lit("SKU-"), F.col("p_partkey")).alias("sku"),
        F.col("p_brand").alias("artist"),
        F.col("p_name").alias("title"),
        F.expr("""CASE p_size % 4 WHEN 0 THEN 'LP' WHEN 1 THEN 'CD' WHEN 2 THEN '7"' ELSE 'Cassette' END""").alias(
            "format"
        ),
        F.col("p_type").alias("genre"),
        F.expr("CASE WHEN p_partkey % 9 < 5 THEN 'New' ELSE 'Used' END").alias("condition"),
        F.expr(
            "CAST(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(30 + p_partkey % 40 AS DECIMAL(4,0))"
            " * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2))"
        ).alias("cost"),
        F.expr("CAST(p_retailprice AS DECIMAL(12,2))").alias("price"),
        F.expr("CAST(1960 + p_partkey % 60 AS INT)").alias("release_year"),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s_suppkey, location): the region each supplier sells in."""
    supplier, nation, region = (table(spark, sf_dir, n) for n in ("supplier", "nation", "region"))
    return (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", F.col("r_name").alias("location"))
    )


def sale_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with order date, store and price; `sale_columns` makes the other columns of sales.

    The joins carry no hint: each side is broadcast by its file size or else shuffled, and the
    runtime splits an order, product or supplier that holds a large share of the lines. Orders, the
    largest side, come first, when lines have their keys only.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("sale_date"))
    prices = products(spark, sf_dir).select("product_id", F.col("price").alias("unit_price"))
    joined = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(prices, F.col("l_partkey") == F.col("product_id"))
        .join(stores(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    return joined.select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "sale_date", "location", "product_id", "unit_price")


def sale_columns(facts: DataFrame) -> DataFrame:
    """Facts with id, quantity, discount and net amount instead of the keys that these are made from."""
    discount = F.expr(
        "CAST(CASE l_orderkey % 20 WHEN 0 THEN 5 WHEN 1 THEN 2 WHEN 2 THEN 2 ELSE 0 END AS DECIMAL(12,2))"
    )
    quantity = F.col("l_quantity").cast("bigint")
    made = {
        "sale_id": F.concat_ws("-", "l_orderkey", "product_id", "l_suppkey", "l_linenumber", quantity),
        "quantity": quantity,
        "discount": discount,
    }
    rows = facts.withColumns(made).drop("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity")
    return rows.withColumn(
        "net_amount", (F.col("quantity") * (F.col("unit_price") - F.col("discount"))).cast("decimal(18,2)")
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with order date, store and price."""
    return sale_columns(sale_facts(spark, sf_dir)).select(
        "sale_id", "sale_date", "location", "product_id", "quantity", "unit_price", "discount", "net_amount"
    )


def month_ends(spark: SparkSession, sf_dir: str) -> Column:
    """Month ends of the last year of orders, as an array: thirteen dates at most."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
    newest = orders.agg(F.max("d")).scalar()
    recent = orders.filter(F.col("d") > F.date_sub(newest, 365)).select(F.last_day("d").alias("d")).distinct()
    return recent.agg(F.sort_array(F.collect_list("d"))).scalar()


def stock_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per month end, region and part, made by unfolding each part where it is; `stock_columns` makes the other columns of inventory.

    A part is a few bytes and becomes some sixty rows, so parts are dealt out by their number first: one task would
    otherwise unfold all parts of a small file, and its rows of a month cannot be split between the tasks that sort them.
    """
    region = table(spark, sf_dir, "region")
    regions = region.agg(F.collect_list(F.struct("r_regionkey", "r_name"))).scalar()
    parts = table(spark, sf_dir, "part").select("p_partkey")
    grid = (
        parts.repartition(-(-parts.count() // PARTS_PER_TASK) or 1, "p_partkey")
        .select("p_partkey", F.explode(regions).alias("r"))
        .select("p_partkey", "r.r_regionkey", "r.r_name", F.explode(month_ends(spark, sf_dir)).alias("snapshot_date"))
    )
    return grid.select("snapshot_date", F.col("r_name").alias("location"), F.col("p_partkey").cast("bigint").alias("product_id"), "r_regionkey")


def stock_columns(grid: DataFrame) -> DataFrame:
    """The grid with stock, days and reorder level instead of the region's key."""
    wave = "(product_id * 7 + r_regionkey * 13 + month(snapshot_date) * 5) % 23"
    made = {
        "quantity_on_hand": f"CAST(greatest(0, {wave} - 8) AS INT)",
        "days_in_stock": f"CAST(CASE WHEN {wave} <= 8 THEN 0"
        " ELSE (product_id * 31 + r_regionkey * 17 + month(snapshot_date) * 3) % 320 END AS INT)",
        "reorder_level": "CAST(1 + (product_id + r_regionkey) % 3 AS INT)",
    }
    return grid.withColumns({c: F.expr(e) for c, e in made.items()}).drop("r_regionkey")


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per month end, region and part."""
    return stock_columns(stock_grid(spark, sf_dir))


#: What is shuffled of a table that is written, and what makes its other columns afterwards.
NARROW = {"sales": (sale_facts, sale_columns), "inventory": (stock_grid, stock_columns)}
