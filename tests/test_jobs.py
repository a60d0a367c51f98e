"""The batch jobs end to end."""

import pytest
from compare import spark_rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow import schema
from stockflow.plans import analyses as A
from stockflow.plans import cleaning
from stockflow.plans.feed import products_from_items
from stockflow.plans.jobs import clean_exports, flatten_pull, flattened_tables, write_suite
from stockflow.plans.suite import RESULTS
from stockflow.session import work_dir
from stockflow.sources.raw_csv import NULL_WORDS, read_raw_csv
from stockflow.sources.tables import read_table, row_counts, write_snapshots, write_table
from stockflow.streaming.orders import read_lines
from stockflow.streaming.revenue import read_days
from stockflow.testbed import land
from stockflow.testbed.nested import FIRST_PULL, STORES
from stockflow.testbed.queries import QUERIES


@pytest.fixture(scope="module")
def cleaned(spark, sf_dir, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("cleaned"))
    return out, clean_exports(spark, land.raw_exports(spark, sf_dir), out)


def test_clean_exports_equals_the_pipelines(spark, sf_dir, cleaned):
    out, t = cleaned
    for table in ("products", "sales", "inventory"):
        columns = cleaning.table_columns(table)
        assert spark_rows(getattr(t, table).select(*[F.col(c).cast("string") for c in columns])) == spark_rows(
            {
                "products": lambda: cleaning.clean_products(raw(spark, sf_dir, "products")),
                "sales": lambda: cleaning.clean_sales(raw(spark, sf_dir, "sales"), t.products),
                "inventory": lambda: cleaning.clean_inventory(raw(spark, sf_dir, "inventory"), t.products),
            }[table]().select(*[F.col(c).cast("string") for c in columns])
        )
        assert getattr(t, table).select(*columns).dtypes == [(f.name, f.dataType.simpleString()) for f in getattr(schema, table)().fields]


def raw(spark, sf_dir, table):
    kind = {"products": schema.RAW_PRODUCTS, "sales": schema.RAW_SALES, "inventory": schema.RAW_INVENTORY}[table]
    return read_raw_csv(spark, f"{land.raw_exports(spark, sf_dir)}/{table}", kind)


def test_clean_exports_counts_every_row(spark, sf_dir, cleaned):
    out, t = cleaned
    got = {(r.table_name, r.metric): r.value for r in spark.read.parquet(f"{out}/quality_metrics").collect()}
    counted = {(r.table_name, r.metric): r.value for r in QUERIES["quality_metrics"](spark, sf_dir).collect()}
    assert got == counted
    for r in row_counts(t).collect():
        bad = spark.read.parquet(f"{out}/quarantine/{r.table_name}").count()
        assert r.n_rows == got[(r.table_name, "rows_clean")] and bad == got[(r.table_name, "rows_quarantined")]
        assert got[(r.table_name, "rows_loaded")] == r.n_rows + bad + got[(r.table_name, "duplicates_removed")]


def test_every_result_runs_on_cleaned_tables(cleaned, tmp_path):
    _, t = cleaned
    written = write_suite(t, str(tmp_path), names=["transfer_recommendations", "kpi_totals", "aging_buckets"])
    assert {n: df.count() for n, df in written.items()} == {n: RESULTS[n](t).count() for n in written}


def test_write_suite_as_csv_with_preview(tables, tmp_path):
    written = write_suite(tables, str(tmp_path), names=["monthly_revenue", "margin_by_condition"], fmt="csv", preview=5)
    assert written["monthly_revenue"].count() == 5
    assert spark_rows(written["margin_by_condition"]) == spark_rows(RESULTS["margin_by_condition"](tables))


def test_overwriting_a_table_replaces_it(spark, tables, tmp_path):
    root = str(tmp_path)
    sales = tables.sales.drop("sale_month")
    write_table(sales, root, "sales")
    write_table(sales.filter("sale_date >= DATE '2001-01-01'"), root, "sales")
    back = read_table(spark, root, "sales", land.ID)
    assert back.agg(F.min("sale_month")).first()[0] == "2001-01"
    assert back.filter("sale_month <> date_format(sale_date, 'yyyy-MM')").count() == 0


def test_a_snapshot_written_twice_is_kept_once(spark, tables, tmp_path):
    root, june = str(tmp_path), tables.inventory.filter("snapshot_date = DATE '2001-06-30'")
    july = tables.inventory.filter("snapshot_date = DATE '2001-07-31'")
    for part in (june, july, june):
        write_snapshots(part, root)
    assert read_table(spark, root, "inventory", land.ID).count() == june.count() + july.count()


def test_flatten_pull(spark, sf_dir, tmp_path):
    root, landed = str(tmp_path), land.documents(spark, sf_dir)
    assert flatten_pull(spark, landed, root, FIRST_PULL, STORES, only="payments") == ["payments", "refunds"]
    made = flatten_pull(spark, landed, root, FIRST_PULL, STORES)
    assert made == ["products", "sales", "inventory", "payments", "refunds"]
    back = spark.read.parquet(f"{root}/sales")
    assert [str(r[0]) for r in back.select("pull_date").distinct().collect()] == [FIRST_PULL]
    assert spark.read.parquet(f"{root}/payments").count() == QUERIES["json_payments"](spark, sf_dir).count()
    # Rows in are rows kept and rows rejected, for every entity.
    counted = {}
    for r in spark.read.parquet(f"{root}/feed_metrics").collect():
        counted.setdefault(r.entity, {})[r.metric] = r.n
    for entity, n in counted.items():
        assert n["rows_in"] == sum(v for k, v in n.items() if k != "rows_in"), entity
    assert back.count() == counted["orders"]["rows_kept"]
    assert spark.read.parquet(f"{root}/quarantine/sales").count() == counted["orders"]["rows_in"] - back.count()
    # The analyses run on what was flattened.
    t = flattened_tables(spark, root, FIRST_PULL)
    assert t.sales.agg(F.sum("net_amount")).first()[0] == A.monthly_revenue(t).agg(F.sum("revenue")).first()[0]
    assert A.overstock(t).count() == 0 and A.revenue_by_location(t).count() == 5


def test_broken_documents_and_rows_are_kept_apart(spark, tmp_path):
    folder = tmp_path / "landed" / "refunds" / "pull_date=2001-09-01" / "location=s1"
    folder.mkdir(parents=True)
    (folder / "1.json").write_text('{"id": "r1", "amount": 100}\n{"id": "r2", "amo\n')
    (tmp_path / "landed" / "payments" / "pull_date=2001-09-01" / "location=s1").mkdir(parents=True)
    (tmp_path / "landed" / "payments" / "pull_date=2001-09-01" / "location=s1" / "1.json").write_text('{"id": "p1"}\n')
    flatten_pull(spark, f"{tmp_path}/landed", f"{tmp_path}/out", FIRST_PULL, ["s1"], only="payments")
    bad = spark.read.parquet(f"{tmp_path}/out/quarantine/refunds_documents").collect()
    assert len(bad) == 1 and "r2" in bad[0].corrupt_line

    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.csv").write_text('a,b\n1,"x\ny"\n2,NA\n3,z,more\n4,"say ""so"""\n')
    kind = T.StructType([T.StructField(c, T.StringType()) for c in "ab"])
    rows = {r.a: (r.b, r.corrupt_line) for r in read_raw_csv(spark, str(raw), kind, NULL_WORDS, multi_line=True, corrupt=True).collect()}
    assert rows["1"] == ("x\ny", None) and rows["2"] == (None, None) and rows["4"] == ('say "so"', None)
    assert rows["3"][1] is not None


def test_first_store_wins_and_unlisted_stores_come_last(spark):
    rows = [("1", "A - x", 100, "s2"), ("1", "A - y", 200, "s1"), ("1", "A - z", 1, "new"), ("2", "B", 5, "new")]
    items = spark.createDataFrame(rows, "id string, name string, price bigint, location string").select(
        "*",
        F.lit(None).cast("string").alias("sku"),
        F.lit(None).cast("string").alias("code"),
        F.lit(None).cast("bigint").alias("cost"),
        F.lit(None).cast("struct<elements:array<struct<name:string>>>").alias("categories"),
    )
    got = {r.product_id: (r.artist, r.title, r.genre, str(r.price)) for r in products_from_items(items, ["s1", "s2"]).collect()}
    assert got == {"1": ("A", "y", "", "2.00"), "2": ("", "B", "", "0.05")}


def test_work_dir_follows_the_setting(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert work_dir(spark).endswith(spark.sparkContext.applicationId)
    if shared:
        assert work_dir(spark).startswith(shared.rstrip("/"))


def test_command_line(spark, sf_dir, tmp_path, capsys):
    from stockflow.__main__ import main

    main(["clean", land.raw_exports(spark, sf_dir), f"{tmp_path}/clean"])
    main(["analyse", f"{tmp_path}/clean", f"{tmp_path}/out", "--names", "margin_by_condition", "--preview", "2"])
    assert "margin_by_condition" in capsys.readouterr().out
    main(["ingest", land.documents(spark, sf_dir), f"{tmp_path}/sink"])
    days, lines = read_days(spark, f"{tmp_path}/sink"), read_lines(spark, f"{tmp_path}/sink")
    assert days.count() == lines.select("sale_date").distinct().count()


def test_clean_csv_refuses_values_that_do_not_fit(spark, tables, tmp_path):
    from stockflow.sources.clean_csv import read_clean_csv, write_clean_csv

    kind = schema.products(land.ID)
    write_clean_csv(tables.products, f"{tmp_path}/p")
    assert spark_rows(read_clean_csv(spark, f"{tmp_path}/p", kind)) == spark_rows(tables.products)
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "a.csv").write_text("a,b\nx,not a date\n")
    bad = read_clean_csv(spark, f"{tmp_path}/bad", schema._struct(a=schema.T.StringType(), b=schema.T.DateType()))
    with pytest.raises(Exception):
        bad.collect()
