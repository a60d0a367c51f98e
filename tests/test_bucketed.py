"""Buckets by product, and stock against sales on both sides."""

import re
from dataclasses import replace

import pytest
from compare import spark_rows

from stockflow.plans import analyses as A
from stockflow.plans.suite import RESULTS
from stockflow.sources.bucketed import read_bucketed, write_bucketed
from stockflow.sources.tables import Tables


@pytest.fixture(scope="module")
def bucketed(spark, tables, tmp_path_factory):
    return write_bucketed(tables, str(tmp_path_factory.mktemp("bucketed")), "t", buckets=4)


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.enabled")


def exchanges(df):
    """Exchanges of the physical plan by product."""
    physical = plan(df).split("== Physical Plan ==")[1]
    return len(re.findall(r"Exchange hashpartitioning\((?:\w+#\d+L?, )*product_id", physical))


@pytest.mark.parametrize("name", ["overstock", "sell_through_by_genre", "transfer_recommendations", "stockouts", "dead_stock"])
def test_the_same_results_without_shuffles_of_stock_and_products(spark, tables, bucketed, no_broadcast, name):
    assert spark_rows(RESULTS[name](bucketed)) == spark_rows(RESULTS[name](tables))
    assert exchanges(RESULTS[name](bucketed)) < exchanges(RESULTS[name](tables))


def test_stock_meets_products_without_any_shuffle(bucketed, no_broadcast):
    joined = A.latest(bucketed).join(bucketed.products, "product_id")
    assert exchanges(joined) == 0 and "Bucketed: true" in plan(joined)
    per_product = A.latest(bucketed).groupBy("product_id").sum("quantity_on_hand").join(bucketed.products, "product_id")
    assert exchanges(per_product) == 0


def test_registered_tables_are_found_again(spark, tables, bucketed):
    again = read_bucketed(spark, tables, "t")
    assert spark_rows(A.overstock(again)) == spark_rows(A.overstock(bucketed))


def test_stock_against_sales_keeps_both_sides_and_null_keys(spark):
    sales = spark.createDataFrame([("a", "1", 2), ("a", "1", 3), ("b", "2", 1), (None, "2", 4), ("c", None, 5)], "location string, product_id string, quantity bigint")
    stock = [("a", "1", 7), ("b", "9", 8), (None, "2", 1), (None, None, 6)]
    stock = spark.createDataFrame([("2025-07-31", *r) for r in stock], "snapshot_date string, location string, product_id string, quantity_on_hand int").selectExpr(
        "cast(snapshot_date as date) snapshot_date", "location", "product_id", "quantity_on_hand"
    )
    got = {tuple(r) for r in A.stock_and_sales(Tables(None, sales, stock)).collect()}
    assert got == {
        ("a", "1", "both", 5, 7),
        ("b", "2", "sales", 1, None),
        ("b", "9", "stock", None, 8),
        (None, "2", "both", 4, 1),
        ("c", None, "sales", 5, None),
        (None, None, "stock", None, 6),
    }


def test_one_row_per_pair_and_task_meets_the_other_side(spark, tables, no_broadcast):
    """A store and product with most sales is one row per task before the shuffle, and the join is a full outer one."""
    text = plan(A.stock_and_sales(replace(tables, made=None))).split("== Physical Plan ==")[1]
    assert re.search(r"FullOuter", text) and text.count("partial_sum") == 2 and "CartesianProduct" not in text and "NestedLoop" not in text
