"""Skewed and large inputs: the same results, through plans that hold up."""

import re

import pytest
from compare import spark_rows
from pyspark.sql import functions as F

from stockflow.operators.integrity import flag_known, keep_known, keep_orphans
from stockflow.plans import analyses as A
from stockflow.plans.suite import RESULTS
from stockflow.sources.tables import read_tables, write_table
from stockflow.testbed import land
from stockflow.testbed.queries import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(RESULTS))
def test_no_broadcast_is_needed(spark, tables, name):
    one = spark_rows(RESULTS[name](tables))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        result = RESULTS[name](tables)
        text = plan(result)
        assert "Broadcast" not in text and "Cartesian" not in text
        assert spark_rows(result) == one
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sales_are_summed_before_the_join(tables, no_broadcast):
    text = plan(A.margin_by_genre(tables))
    join = text.index("Join [product_id")
    assert "partial_sum(" in text[join:], "sales are summed below the join"


@pytest.fixture(scope="module")
def skewed(spark, sf_dir, tmp_path_factory):
    """A third of all sales are one product, in one store and one month."""
    t = land.tables(spark, sf_dir)
    top = t.products.agg(F.min("product_id")).first()[0]
    hot = (
        t.sales.withColumn("n", F.explode(F.array(F.lit(1), F.lit(2))))
        .limit(t.sales.count() // 2)
        .withColumn("product_id", F.lit(top))
        .withColumn("location", F.lit("ASIA"))
        .withColumn("sale_date", F.lit("2001-07-15").cast("date"))
        .withColumn("sale_id", F.concat_ws("-", F.lit("hot"), "sale_id", "n"))
        .select(*[c for c in t.sales.columns if c != "sale_month"])
    )
    root = str(tmp_path_factory.mktemp("skewed"))
    write_table(t.products, root, "products")
    write_table(t.sales.drop("sale_month").unionByName(hot), root, "sales")
    write_table(t.inventory, root, "inventory")
    return read_tables(spark, root, land.ID)


@pytest.mark.parametrize("name", ["margin_by_genre", "genre_by_location", "top_products", "transfer_recommendations", "stockouts"])
def test_skewed_sales_agree_with_and_without_broadcast(spark, skewed, name):
    one = spark_rows(RESULTS[name](skewed))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert spark_rows(RESULTS[name](skewed)) == one
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_roll_ups_from_the_cube_are_the_same(tables):
    from_cube = A.with_cube(tables)
    for name in ("revenue_by_genre", "genre_by_location", "margin_by_format_condition", "condition_share", "kpi_totals"):
        assert spark_rows(RESULTS[name](from_cube)) == spark_rows(RESULTS[name](tables)), name
    assert "sale_month" not in plan(A.margin_by_genre(from_cube))


def test_hot_product_is_one_row_per_task_after_the_partial_sum(skewed):
    per_product = skewed.sales.groupBy("product_id").agg(F.sum("quantity"))
    assert re.search(r"Exchange hashpartitioning\(product_id.*\n.*HashAggregate\(keys=\[product_id.*partial_sum", plan(per_product))


def test_a_hot_product_is_split_in_shuffled_lookups(spark, tables):
    """With a product holding a third of the rows and nothing to broadcast, the join is split."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": -1,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": 2,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.shuffle.partitions": 16,
    }
    ids = spark.range(0, 90_000, numPartitions=8)
    rows = ids.select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 400).alias("product_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        for lookup, expected in (
            (flag_known(rows, tables.products), 90_000),
            (keep_known(rows, tables.products), rows.filter("product_id < 200").count()),
            (keep_orphans(rows, tables.products), rows.filter("product_id >= 200").count()),
        ):
            counted = lookup.agg(F.count("text"), F.max("text"))
            assert counted.collect()[0][0] == expected
            assert "skew=true" in plan(counted)
    finally:
        for name in settings:
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", 4)


NO_STREAM = sorted(n for n in QUERIES if not n.startswith("stream"))


@pytest.mark.parametrize("name", NO_STREAM)
def test_no_cross_join_and_no_python_in_any_plan(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Arrow"):
        assert bad not in text


def test_latest_snapshot_reads_one_partition_and_few_columns(tables):
    text = plan(A.overstock(tables))
    assert re.search(r"PartitionFilters: \[isnotnull\(snapshot_date.*= Subquery", text)
    assert "PushedFilters: [IsNotNull(quantity_on_hand), IsNotNull(days_in_stock), GreaterThanOrEqual" in text
    assert "reorder_level" not in text


def test_recent_sales_prune_months(tables):
    text = plan(A.stockout_rows(tables))
    assert re.search(r"PartitionFilters: \[isnotnull\(sale_month\S+, \(sale_month\S+ >= date_format", text)


def test_monthly_revenue_reads_three_columns(tables):
    text = plan(A.monthly_revenue(tables))
    assert "ReadSchema: struct<sale_date:date,quantity:bigint,net_amount:decimal(18,2)>" in text


NEWEST = ["dead_stock", "overstock", "stockouts", "aging_buckets", "transfer_recommendations", "sell_through_by_genre", "sell_through_by_location", "kpi_totals", "transfer_unique"]


@pytest.mark.parametrize("name", NEWEST)
def test_the_newest_snapshot_is_found_without_opening_the_others(tables, name, capsys):
    RESULTS[name](tables).explain("formatted")
    scans = [x for x in capsys.readouterr().out.split("\n\n") if "Scan parquet" in x.strip().split("\n")[0]]
    stock = [x for x in scans if "quantity_on_hand" in x]
    assert stock and all("PartitionFilters" in x for x in stock)
    # The walk over a whole table for its greatest partition would read no column at all.
    assert not [x for x in scans if "ReadSchema: struct<>" in x]
    # The manifest tells the newest date: no scan reads dates.
    assert not [x for x in scans if "ReadSchema: struct<snapshot_date:date>" in x]


def test_only_a_local_master_may_do_without_a_shared_folder():
    from types import SimpleNamespace

    from stockflow.session import work_dir

    def session(master):
        return SimpleNamespace(conf={}, sparkContext=SimpleNamespace(applicationId="a", master=master))

    for master in ("local-cluster[2,1,1024]", "spark://host:7077", "yarn"):
        with pytest.raises(ValueError):
            work_dir(session(master))
    assert work_dir(session("local[4]")) and work_dir(session("local"))
