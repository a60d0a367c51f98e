"""Results that must agree with each other."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stockflow.operators.dedupe import first_per_key
from stockflow.plans import analyses as A
from stockflow.plans import kpi as K
from stockflow.plans.suite import ANALYSES, RESULTS
from stockflow.sources.tables import Tables


def total(df, column):
    return df.agg(F.sum(column)).first()[0]


def test_revenue_agrees_however_it_is_grouped(tables):
    everything = total(tables.sales, "net_amount")
    for name in ("monthly_revenue", "revenue_by_location", "revenue_by_genre", "genre_by_location", "revenue_by_format"):
        assert total(RESULTS[name](tables), "revenue") == everything, name
    assert K.kpi_totals(tables).first().revenue == everything
    assert total(A.margin_by_genre(tables), "gross_profit") == total(A.margin_by_condition(tables), "gross_profit")


def test_shares_add_up(tables):
    assert abs(total(A.aging_buckets(tables), "pct_of_units") - 100) <= 0.2
    assert abs(total(K.condition_share(tables), "revenue_share_pct") - 100) <= 0.2
    for row in K.genre_share_by_location(tables).groupBy("location").agg(F.sum("share_pct").alias("s")).collect():
        assert abs(row.s - 100) <= 0.5


def test_sell_through_agrees_on_units(tables):
    by_genre, by_store = A.sell_through_by_genre(tables), A.sell_through_by_location(tables)
    for column in ("units_sold", "units_on_hand"):
        assert total(by_genre, column) == total(by_store, column)


def test_transfers(tables):
    rows = A.transfer_recommendations(tables)
    assert rows.filter("from_location = to_location").count() == 0
    assert rows.filter("from_qty < 5 OR suggested_transfer_qty > from_qty").count() == 0
    unique, by_product = K.transfer_unique(tables).count(), K.transfer_unique(tables, by="product_id").count()
    assert unique <= by_product <= rows.count()
    assert K.transfer_total(tables).first().n_opportunities == unique
    top = [r.est_90d_revenue_at_dest for r in K.transfer_top(tables).collect()]
    assert top == sorted(top, reverse=True) and len(top) == 10


def test_transfers_are_counted_without_making_them(tables):
    assert A.transfer_count(tables).first().n_transfers == A.transfer_rows(tables).count()
    assert A.transfer_count(tables, min_source_quantity=12).first().n_transfers == A.transfer_rows(tables, min_source_quantity=12).count()


def test_the_best_source_is_the_first_of_all_pairs(tables):
    keys = ["to_location", "product_id"]
    order = [-F.col("from_days_sitting"), F.col("from_location")]
    pairs = A.transfer_rows(tables)
    expected = first_per_key(pairs, keys, order).select(*sorted(pairs.columns))
    got = A.best_transfer_rows(tables).select(*sorted(pairs.columns))
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_reporting_order(tables):
    for name, column in (("revenue_by_genre", "revenue"), ("overstock", "days_in_stock"), ("dead_stock", "cost_tied_up")):
        values = [r[column] for r in ANALYSES[name](tables).collect()]
        assert values == sorted(values, reverse=True), name
    assert [r.month for r in A.monthly_revenue(tables).collect()] == sorted(r.month for r in A.monthly_revenue(tables).collect())


def test_parameters_change_the_result(tables):
    assert A.overstock(tables, min_quantity=1).count() > A.overstock(tables).count()
    assert A.top_products(tables, limit=3).count() == 3
    assert A.dead_stock(tables, limit=None).count() > A.dead_stock(tables, limit=3).count() == 3
    assert A.transfer_rows(tables, min_source_quantity=10).count() < A.transfer_rows(tables).count()
    assert A.slow_categories(tables, below=200.0).filter("NOT is_slow").count() == 0


@pytest.fixture()
def odd(spark):
    """Tables as no database would let them be: repeated stock keys, sales without a price or discount."""
    day = datetime.date(2025, 8, 1)
    products = [(1, "A", "T", "Rock", "LP", "New", 4, 10), (2, "B", "U", "Jazz", "CD", "Used", 2, 8), (3, "C", "V", "Jazz", "CD", "Used", None, 5)]
    sales = [(1, "S1", 1, 2, 10, 1, 18), (2, "S2", 1, 1, None, 0, None), (3, "S1", 2, 3, 8, None, None), (4, "S3", 2, 1, 8, 0, 8), (5, "S1", 3, 1, 5, 0, 5)]
    stock = [(1, "S1", 0, 5), (1, "S1", 9, 200), (1, "S3", 6, 10), (1, "S2", 0, 7), (2, "S1", 0, 9), (2, "S1", 7, 80), (2, "S2", 8, 80), (3, "S2", 9, 1), (3, "S2", 0, 1)]
    return Tables(
        spark.createDataFrame(
            [(i, a, t, g, f, c, m and Decimal(m), Decimal(p)) for i, a, t, g, f, c, m, p in products],
            "product_id long, artist string, title string, genre string, format string, condition string, cost decimal(12,2), price decimal(12,2)",
        ),
        spark.createDataFrame(
            [(i, day, s, p, q, x and Decimal(x), None if d is None else Decimal(d), n and Decimal(n)) for i, s, p, q, x, d, n in sales],
            "sale_id long, sale_date date, location string, product_id long, quantity long, unit_price decimal(12,2), discount decimal(12,2), net_amount decimal(18,2)",
        ),
        spark.createDataFrame(
            [(day, s, p, q, d, 2) for p, s, q, d in stock],
            "snapshot_date date, location string, product_id long, quantity_on_hand int, days_in_stock int, reorder_level int",
        ),
    )


def test_profit_of_sales_without_a_price(spark, odd):
    """Per row quantity * (price - discount - cost), as far as it is known; the cube and no broadcast give the same."""
    want = {"Rock": (3, 18, 2 * (10 - 1 - 4)), "Jazz": (5, 13, 1 * (8 - 0 - 2))}
    for t in (odd, A.with_cube(odd)):
        for threshold in (10 << 20, -1):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            got = {r.genre: (r.units, r.revenue, r.gross_profit) for r in A.sales_rollup(t, [], ["genre"]).collect()}
            assert got == want
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_transfers_with_repeated_stock_keys(odd):
    """The store whose pile is oldest may itself be the empty one: another store gives."""
    keys, order = ["to_location", "product_id"], [-F.col("from_days_sitting"), F.col("from_location")]
    pairs = A.transfer_rows(odd)
    expected = sorted(map(str, first_per_key(pairs, keys, order).select(*sorted(pairs.columns)).collect()))
    assert sorted(map(str, A.best_transfer_rows(odd).select(*sorted(pairs.columns)).collect())) == expected
    moves = {(r.product_id, r.from_location, r.to_location) for r in A.best_transfer_rows(odd).collect()}
    assert moves == {(1, "S3", "S1"), (1, "S1", "S2"), (2, "S2", "S1")}
    assert K.transfer_unique(odd, by="product_id").count() == 3 == K.transfer_total(odd).first().n_opportunities
    assert A.transfer_count(odd).first().n_transfers == pairs.count()
