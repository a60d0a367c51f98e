"""What queries read is landed for them alone, and by tasks that do not grow with the input."""

import gzip
import json
import time
from dataclasses import replace
from pathlib import Path

import pytest
from compare import spark_rows
from pyspark.sql import functions as F

from stockflow import schema, session
from stockflow.operators.key_history import KeyHistory, blocks_for
from stockflow.operators.recent import latest_snapshot
from stockflow.plans.suite import RESULTS
from stockflow.sources import landed_json, raw_csv
from stockflow.sources import tables as tables_module
from stockflow.sources.bucketed import bucket_count
from stockflow.sources.landed_json import read_landed, write_landed
from stockflow.sources.tables import layout, write_table
from stockflow.streaming.orders import ingest_orders, read_lines, read_versions
from stockflow.testbed import land, queries, views


@pytest.fixture()
def nothing_landed(monkeypatch):
    monkeypatch.setattr(land, "_landed", {})
    return lambda: {kind for _, _, kind in land._landed if "/" in kind}


def test_a_query_lands_what_it_reads(spark, sf_dir, nothing_landed):
    queries.QUERIES["json_payments"](spark, sf_dir)
    assert nothing_landed() == {"feed/payments"}
    queries.QUERIES["cast_years"](spark, sf_dir)
    assert nothing_landed() == {"feed/payments", "tables/products", "raw/products"}


def test_all_is_landed_if_nothing_is_named(spark, sf_dir, nothing_landed):
    land.documents(spark, sf_dir)
    assert {k for k in nothing_landed() if k.startswith("feed/")} == {f"feed/{e}" for e in schema.LANDED}


def test_exports_and_documents_need_no_clean_sales_or_stock(spark, sf_dir, nothing_landed):
    made = {}
    for name in ("parse_mixed_dates", "json_sales", "snapshot_append", "scan_raw_inventory"):
        made[name] = spark_rows(queries.QUERIES[name](spark, sf_dir))
    assert nothing_landed() == {"raw/sales", "feed/orders", "feed/item_stocks", "raw/inventory"}
    # The same rows come from clean tables that are there already.
    land._landed.clear()
    land.tables(spark, sf_dir)
    for name, rows in made.items():
        assert spark_rows(queries.QUERIES[name](spark, sf_dir)) == rows, name
    assert spark_rows(land.latest_stock(spark, sf_dir)) == spark_rows(latest_snapshot(land.table(spark, sf_dir, "inventory")))


def test_clean_tables_are_written_small(spark, sf_dir, tmp_path):
    write_table(views.sales(spark, sf_dir), str(tmp_path), "sales")
    files = [p for p in Path(tmp_path, "sales").rglob("part-*") if not p.name.startswith(".")]
    assert files and all(".zstd." in p.name for p in files)


def test_filters_are_as_small_as_what_they_hold(spark, tmp_path):
    write_table(spark.range(100).selectExpr("id AS product_id", "'s' AS location", "DATE '2025-08-31' AS snapshot_date"), str(tmp_path), "inventory")
    files = [p for p in Path(tmp_path, "inventory").rglob("part-*") if not p.name.startswith(".")]
    # 1 MB each, if a filter does not shrink to its hundred values.
    assert files and max(p.stat().st_size for p in files) < 300_000


@pytest.mark.parametrize(("name", "made"), [("sales", "sale_id"), ("inventory", "days_in_stock")])
def test_columns_that_follow_from_others_are_not_shuffled(spark, sf_dir, nothing_landed, name, made):
    facts, widen = views.NARROW[name]
    plan = layout(facts(spark, sf_dir), name, widen)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("RebalancePartitions", 1)
    assert f"AS {made}" in above and made not in below
    whole = getattr(views, name)(spark, sf_dir)
    assert spark_rows(land.table(spark, sf_dir, name).select(*whole.columns)) == spark_rows(whole)


def test_exports_are_written_compressed_and_come_back(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(raw_csv, "ROWS_PER_FILE", 2, raising=False)
    kind = schema.RAW_INVENTORY
    rows = spark.createDataFrame([(f"day {i}", ' "a", b ', None, "" if i % 2 else "x", "1", "2") for i in range(5)], kind).coalesce(1)
    raw_csv.write_raw_csv(rows, f"{tmp_path}/out")
    files = [p for p in Path(tmp_path, "out").rglob("part-*") if not p.name.startswith(".")]
    assert files and all(p.name.endswith(".csv.gz") for p in files)
    assert max(len(gzip.open(p, "rt").readlines()) for p in files) == 3  # with the header
    back = raw_csv.read_raw_csv(spark, f"{tmp_path}/out", kind)
    assert spark_rows(back) == spark_rows(rows.replace("", None))


def documents(spark):
    rows = [(str(i), None, "no name" if i % 2 else "a - b", f"s{i % 3}", f"2025-0{1 + i % 2}-01") for i in range(30)]
    rows.append(("x", None, None, None, None))
    return spark.createDataFrame(rows, "id string, sku string, name string, location string, pull string").select(
        "id", "sku", "name", F.col("pull").cast("date").alias("pull_date"), "location"
    )


def test_documents_are_landed_compressed_and_come_back(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landed_json, "DOCUMENTS_PER_FILE", 2)
    docs = documents(spark).coalesce(1)
    write_landed(docs, str(tmp_path), "items")
    files = [p for p in Path(tmp_path, "items").rglob("part-*") if not p.name.startswith(".")]
    assert files and all(p.name.endswith(".json.gz") for p in files)
    assert max(len(gzip.open(p, "rt").readlines()) for p in files) == 2
    back = read_landed(spark, str(tmp_path), "items")
    assert spark_rows(back.select(*docs.columns)) == spark_rows(docs)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None) is None


@pytest.mark.parametrize("module", [landed_json, raw_csv])
def test_exports_and_documents_are_made_by_small_tasks(spark, tmp_path, monkeypatch, module):
    monkeypatch.setattr(module, "TASK_BYTES", "2k", raising=False)
    rows = spark.range(4000).select(F.xxhash64("id").alias("id")).distinct().select(F.col("id").cast("string").alias("id"), F.lit("s").alias("location"), F.lit("2025-01-01").alias("pull_date"))
    with session.settings(spark, adaptive__coalescePartitions__parallelismFirst="false", adaptive__coalescePartitions__minPartitionSize="1k"):
        if module is raw_csv:
            raw_csv.write_raw_csv(rows, f"{tmp_path}/out")
        else:
            write_landed(rows, str(tmp_path), "out")
    files = [p for p in Path(tmp_path, "out").rglob("part-*") if not p.name.startswith(".")]
    assert len(files) == 4  # the shuffle's partitions, which few rows would otherwise share
    back = spark.read.option("header", True).csv(f"{tmp_path}/out") if module is raw_csv else spark.read.json(f"{tmp_path}/out")
    assert back.select("id").distinct().count() == back.count() == 4000


def test_settings_leave_what_the_application_has_set(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    with session.settings(spark, adaptive__advisoryPartitionSizeInBytes="16m"):
        assert spark.conf.get(key) == "16m"
    assert spark.conf.get(key, None) is None
    spark.conf.set(key, "1m")
    try:
        with session.settings(spark, adaptive__advisoryPartitionSizeInBytes="16m"):
            assert spark.conf.get(key) == "1m"
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.unset(key)


def test_stock_is_unfolded_by_many_tasks(spark, sf_dir, monkeypatch):
    one = spark_rows(views.inventory(spark, sf_dir))
    monkeypatch.setattr(views, "PARTS_PER_TASK", 50)
    stock = views.inventory(spark, sf_dir)
    n = views.table(spark, sf_dir, "part").count()
    assert stock.rdd.getNumPartitions() == -(-n // 50) > 1
    assert spark_rows(stock) == one


def test_buckets_and_blocks_grow_with_the_rows():
    assert [bucket_count(n) for n in (0, 16_000_000, 16_000_001, 480_000_000)] == [8, 8, 9, 240]
    assert [blocks_for(n) for n in (0, 64 * 2048, 64 * 2048 + 1)] == [64, 64, 65]


def test_few_keys_are_suspects_in_a_long_history(spark, tmp_path):
    n = 400_000
    known = KeyHistory(spark, str(tmp_path), "t", ("a",), blocks=blocks_for(n))
    known.add(spark.range(n).withColumnRenamed("id", "a"), "0")
    assert known.suspects(spark.range(n, n + 20_000).withColumnRenamed("id", "a")).count() < 400
    assert known.suspects(spark.range(0, n, 100).withColumnRenamed("id", "a")).count() == n // 100


def test_a_stream_takes_landed_files_in_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landed_json, "BATCH_BYTES", 500)
    folder = tmp_path / "orders" / "pull_date=2025-08-01" / "location=s1"
    folder.mkdir(parents=True)
    for f in range(4):
        docs = [{"id": f"o{f}-{i}", "createdTime": 1751587200000, "lineItems": {"elements": [{"id": f"l{f}-{i}", "price": 100, "item": {"id": "P"}}]}} for i in range(5)]
        (folder / f"{f}.json").write_text("\n".join(json.dumps(d) for d in docs))
    sink = f"{tmp_path}/sink"
    ingest_orders(spark, str(tmp_path), sink).awaitTermination()
    assert read_versions(spark, sink).select("batch_id").distinct().count() > 1
    assert read_lines(spark, sink).count() == 20


def test_a_result_lands_the_tables_that_it_reads(spark, sf_dir, nothing_landed):
    made = {name: spark_rows(queries.QUERIES[name](spark, sf_dir)) for name in ("condition_share", "monthly_revenue")}
    assert {k for k in nothing_landed() if k.startswith("tables/")} == {"tables/products", "tables/sales"}
    all_of_them = land.tables(spark, sf_dir)
    assert {k for k in nothing_landed() if k.startswith("tables/")} == {"tables/products", "tables/sales", "tables/inventory"}
    asked = land.asked_tables(spark, sf_dir)
    assert asked.sales is asked.sales and replace(asked, cube=None).months.collect() == all_of_them.months.collect()
    assert asked.snapshots.collect() == all_of_them.snapshots.collect()
    for name, rows in made.items():
        assert spark_rows(queries.plain(RESULTS[name](all_of_them))) == rows


@pytest.mark.parametrize("write", ["table", "export", "documents"])
def test_shuffles_and_memory_are_let_go_after_each_write(spark, sf_dir, tmp_path, monkeypatch, write):
    cleaned = []
    for module in (tables_module, raw_csv, landed_json):
        monkeypatch.setattr(module, "clean_up", lambda spark: cleaned.append(1))
    rows = spark.range(10).selectExpr("id AS product_id", "'s' AS location", "DATE '2025-08-31' AS snapshot_date", "DATE '2025-08-31' AS pull_date")
    {"table": lambda: write_table(rows, str(tmp_path), "inventory"), "export": lambda: raw_csv.write_raw_csv(rows, f"{tmp_path}/x"), "documents": lambda: write_landed(rows, str(tmp_path), "orders")}[write]()
    assert cleaned == [1]


def test_a_written_table_leaves_no_shuffle(spark, tmp_path):
    """Else the shuffles of each table lie beside those of the next until its own is written."""
    statuses = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses
    spark.range(1).collect()
    session.clean_up(spark)
    time.sleep(1)
    before = statuses().size()
    rows = spark.range(1000).selectExpr("id AS product_id", "'s' AS location", "DATE '2025-08-31' AS snapshot_date", "id % 7 AS n").distinct()
    write_table(rows, str(tmp_path), "inventory")
    until = time.time() + 10
    while statuses().size() > before and time.time() < until:
        time.sleep(0.1)
    assert statuses().size() <= before
