"""Point-of-sale documents made from the clean views and the driver's orders (FIXTURES.md, section 5).

Every document is made from one row, so nothing is gathered per order or per store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .raw import ORDER_KEY
from .views import table

FIRST_PULL = "2001-09-01"
SECOND_PULL = "2001-10-01"

# The order in which stores are preferred when several carry a product.
STORES = ["EUROPE", "ASIA", "AFRICA", "MIDDLE EAST", "AMERICA"]

_MS = "CAST(datediff({day}, DATE '1970-01-01') AS BIGINT) * 86400000 + ({k} % 86400) * 1000"


def _typed(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])


def items(spark: SparkSession, sf_dir: str, products: DataFrame) -> DataFrame:
    regions = table(spark, sf_dir, "region").agg(F.collect_list(F.struct("r_regionkey", "r_name"))).scalar()
    carried = products.select("*", F.explode(regions).alias("r")).filter("(product_id + r.r_regionkey) % 3 <> 0")
    cents = "CAST({c} * 100 AS BIGINT)"
    return _typed(
        carried,
        {
            "id": "CAST(product_id AS STRING)",
            "name": """CASE product_id % 5 WHEN 0 THEN concat(artist, ' - ', title)
                WHEN 1 THEN concat(artist, ' – ', title) WHEN 2 THEN concat(artist, ' — ', title)
                WHEN 3 THEN concat(artist, ' — ', title, ' - ', format) ELSE concat(' ', title) END""",
            "sku": "CASE WHEN product_id % 40 = 0 THEN NULL ELSE sku END",
            "code": "CASE WHEN product_id % 6 = 0 THEN NULL ELSE concat('0', CAST(product_id AS STRING)) END",
            "cost": f"CASE WHEN product_id % 17 = 0 THEN NULL ELSE {cents.format(c='cost')} END",
            "price": f"{cents.format(c='price')} + r.r_regionkey",
            "categories": """CASE WHEN product_id % 9 = 0 THEN NULL
                WHEN product_id % 11 = 0 THEN named_struct('elements', filter(array(named_struct('name', genre)), c -> false))
                ELSE named_struct('elements', array(named_struct('name', genre), named_struct('name', 'Vinyl'))) END""",
            "pull_date": f"DATE '{FIRST_PULL}'",
            "location": "r.r_name",
        },
    )


def _line(line_id: str, quantity: str) -> str:
    weight = f"CASE WHEN k % 113 = 0 THEN {quantity} * 1000 + 500 WHEN {quantity} > 1 THEN {quantity} * 1000 WHEN k % 2 = 1 THEN 0 END"
    amount = "named_struct('amount', CAST({a} AS BIGINT))"
    given = f"array({amount.format(a='100 - discount * 100')}, {amount.format(a='100')}, {amount.format(a='NULL')})"
    return f"""named_struct(
        'id', {line_id},
        'price', CAST(unit_price * 100 AS BIGINT),
        'unitQty', CAST({weight} AS BIGINT),
        'item', CASE WHEN k % 211 <> 0 THEN named_struct('id', CAST(product_id AS STRING)) END,
        'discounts', CASE WHEN discount > 0 THEN named_struct('elements', {given})
            WHEN k % 2 = 0 THEN named_struct('elements', filter({given}, d -> false)) END)"""


def orders(sales: DataFrame) -> DataFrame:
    """An order document per sale; some sales are split into two lines, some orders have none."""
    one = _line("sale_id", "quantity")
    first, second = _line("concat(sale_id, '/1')", "CAST(1 AS BIGINT)"), _line("concat(sale_id, '/2')", "(quantity - 1)")
    kinds = F.expr("CASE WHEN k % 50 = 0 THEN array('full', 'empty') ELSE array('full') END")
    pulls = F.expr(
        f"CASE WHEN k % 31 = 0 THEN array(DATE '{FIRST_PULL}', DATE '{SECOND_PULL}') ELSE array(DATE '{FIRST_PULL}') END"
    )
    rows = (
        sales.withColumn("k", F.expr(ORDER_KEY))
        .withColumn("kind", F.explode(kinds))
        .withColumn("pull", F.explode(pulls))
    )
    return _typed(
        rows,
        {
            "id": "concat(kind, '-', sale_id)",
            "createdTime": _MS.format(day="sale_date", k="k"),
            "clientCreatedTime": _MS.format(day="sale_date", k="k") + " - (k % 4) * 86400000",
            "lineItems": f"""CASE WHEN kind = 'empty' AND k % 100 = 0 THEN NULL
                WHEN kind = 'empty' THEN named_struct('elements', filter(array({one}), l -> false))
                WHEN k % 3 = 0 AND quantity > 1 THEN named_struct('elements', array({first}, {second}))
                ELSE named_struct('elements', array({one})) END""",
            "pull_date": "pull",
            "location": "location",
        },
    )


def _paid(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "orders")
        .withColumn("r_regionkey", F.expr("CAST(o_custkey % 5 AS INT)"))
        .join(region, "r_regionkey")
        .withColumn("day", F.col("o_orderdate").cast("date"))
        .withColumn("total", F.expr("CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 100 AS BIGINT)"))
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed(
        _paid(spark, sf_dir),
        {
            "id": "concat('PAY-', o_orderkey)",
            "createdTime": _MS.format(day="day", k="o_orderkey"),
            "clientCreatedTime": _MS.format(day="day", k="o_orderkey") + " - (o_orderkey % 4) * 86400000",
            "amount": "CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE total END",
            "tipAmount": "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 500 END",
            "taxAmount": "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE total % 1000 END",
            "result": "CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 'FAIL' ELSE 'SUCCESS' END",
            "order": "CASE WHEN o_orderkey % 23 <> 0 THEN named_struct('id', CAST(o_orderkey AS STRING)) END",
            "pull_date": f"DATE '{FIRST_PULL}'",
            "location": "r_name",
        },
    )


def refunds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed(
        _paid(spark, sf_dir).filter("o_orderkey % 7 = 0"),
        {
            "id": "concat('REF-', o_orderkey)",
            "createdTime": _MS.format(day="date_add(day, 3)", k="o_orderkey"),
            "amount": "CASE WHEN o_orderkey % 21 = 0 THEN NULL ELSE total END",
            "payment": "CASE WHEN o_orderkey % 5 <> 0 THEN named_struct('id', concat('PAY-', o_orderkey)) END",
            "pull_date": f"DATE '{FIRST_PULL}'",
            "location": "r_name",
        },
    )


def item_stocks(latest: DataFrame) -> DataFrame:
    """Stock of the latest snapshot, pulled twice; the second pull finds one piece more of some."""
    pulls = F.array(F.lit(FIRST_PULL).cast("date"), F.lit(SECOND_PULL).cast("date"))
    rows = latest.withColumn("pull", F.explode(pulls)).withColumn(
        "n", F.expr(f"quantity_on_hand + CASE WHEN pull = DATE '{SECOND_PULL}' AND product_id % 2 = 0 THEN 1 ELSE 0 END")
    )
    return _typed(
        rows,
        {
            "stockCount": "CAST(CASE product_id % 6 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE n END AS DOUBLE)",
            "quantity": "CAST(CASE WHEN product_id % 10 = 0 THEN NULL ELSE n END AS DOUBLE)",
            "item": "CASE WHEN product_id % 211 <> 0 THEN named_struct('id', CAST(product_id AS STRING)) END",
            "pull_date": "pull",
            "location": "location",
        },
    )
