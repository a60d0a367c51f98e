"""Messy string exports made from the clean views (see FIXTURES.md, section 4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRODUCTS = {
    "product_id": "CAST(product_id AS STRING)",
    "sku": "CASE WHEN product_id % 40 = 0 THEN NULL ELSE sku END",
    "artist": "CASE WHEN product_id % 10 = 0 THEN concat('  ', artist, ' ') ELSE artist END",
    "title": "CASE WHEN product_id % 14 = 0 THEN concat(title, '  ') ELSE title END",
    "format": "CASE WHEN product_id % 15 = 0 THEN concat(' ', format) ELSE format END",
    "genre": """CASE product_id % 12 WHEN 0 THEN genre WHEN 1 THEN lower(genre)
        WHEN 2 THEN concat(' ', lower(genre), '/FUNK') WHEN 3 THEN concat('hip-', lower(genre)) ELSE genre END""",
    "condition": """CASE product_id % 7 WHEN 0 THEN upper(condition) WHEN 1 THEN concat(lower(condition), ' ')
        ELSE condition END""",
    "cost": "CASE WHEN product_id % 211 = 0 THEN NULL ELSE CAST(cost AS STRING) END",
    "price": """CASE WHEN product_id % 223 = 0 THEN '0.00' WHEN product_id % 227 = 0 THEN '1,234.50'
        WHEN product_id % 12 = 0 THEN concat('$', CAST(price AS STRING)) ELSE CAST(price AS STRING) END""",
    "release_year": "CASE WHEN product_id % 27 = 0 THEN NULL ELSE concat(CAST(release_year AS STRING), '.0') END",
}

ORDER_KEY = "CAST(split_part(sale_id, '-', 1) AS BIGINT)"

SALES = {
    "sale_id": "sale_id",
    "sale_date": """CASE WHEN k % 97 = 0 THEN 'not a date' WHEN k % 8 = 0 THEN date_format(sale_date, 'M/d/yyyy')
        ELSE CAST(sale_date AS STRING) END""",
    "location": """CASE k % 12 WHEN 0 THEN upper(location) WHEN 1 THEN lower(location)
        ELSE concat(' ', location, '  ') END""",
    "product_id": "CASE WHEN k % 101 = 0 THEN concat('X', CAST(product_id AS STRING)) ELSE CAST(product_id AS STRING) END",
    "quantity": """CASE WHEN k % 113 = 0 THEN '1.5' WHEN k % 109 = 0 THEN concat(CAST(quantity AS STRING), '.0')
        ELSE CAST(quantity AS STRING) END""",
    "unit_price": """CASE WHEN k % 103 = 0 THEN '1,234.50' WHEN k % 16 = 0 THEN concat('$', CAST(unit_price AS STRING))
        ELSE CAST(unit_price AS STRING) END""",
    "discount": """CASE WHEN k % 20 = 0 THEN NULL WHEN k % 107 = 0 THEN 'n/a' ELSE CAST(discount AS STRING) END""",
}

INVENTORY = {
    "snapshot_date": """CASE WHEN product_id % 401 = 0 THEN 'unknown'
        WHEN product_id % 8 = 0 THEN date_format(snapshot_date, 'M/d/yyyy') ELSE CAST(snapshot_date AS STRING) END""",
    "location": """CASE product_id % 12 WHEN 0 THEN upper(location) WHEN 1 THEN lower(location)
        ELSE concat(' ', location) END""",
    "product_id": """CASE WHEN product_id % 131 = 0 THEN concat('X', CAST(product_id AS STRING))
        ELSE CAST(product_id AS STRING) END""",
    "quantity_on_hand": "CAST(quantity_on_hand AS STRING)",
    "days_in_stock": """CASE WHEN product_id % 137 = 0 THEN concat(CAST(days_in_stock AS STRING), '.0')
        ELSE CAST(days_in_stock AS STRING) END""",
    "reorder_level": """CASE WHEN product_id % 31 = month(snapshot_date) THEN NULL
        ELSE CAST(reorder_level AS STRING) END""",
}


def _messy(df: DataFrame, columns: dict[str, str], repeated: str) -> DataFrame:
    """The expressions over `df`, with the rows that meet `repeated` coming twice."""
    copies = F.when(F.expr(repeated), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return df.withColumn("copy", F.explode(copies)).selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])


def raw_products(products: DataFrame) -> DataFrame:
    return _messy(products, PRODUCTS, "product_id % 75 = 0")


def raw_sales(sales: DataFrame) -> DataFrame:
    return _messy(sales.withColumn("k", F.expr(ORDER_KEY)), SALES, "k % 83 = 0")


def raw_inventory(inventory: DataFrame) -> DataFrame:
    return _messy(inventory, INVENTORY, "product_id % 125 = 0")
