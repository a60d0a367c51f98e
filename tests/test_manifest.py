"""Tables change from one version to the next in one step."""

import datetime

import pytest
from pyspark.sql import functions as F

from stockflow import schema
from stockflow.operators.recent import latest_snapshot
from stockflow.plans import jobs
from stockflow.sources import manifest
from stockflow.sources.raw_csv import write_raw_csv
from stockflow.sources.tables import look_up, read_table, read_tables, row_counts, write_rows, write_snapshots, write_table


def stock(spark, day, n, quantity=1):
    rows = spark.range(n).select(
        F.lit(day).cast("date").alias("snapshot_date"), F.lit("s1").alias("location"), F.col("id").cast("string").alias("product_id"),
        F.lit(quantity).alias("quantity_on_hand"), F.lit(1).alias("days_in_stock"), F.lit(1).alias("reorder_level"),
    )
    return rows.select(*[f.name for f in schema.inventory().fields])


def seen(spark, root):
    rows = read_table(spark, root, "inventory").groupBy("snapshot_date").agg(F.count("*").alias("n"), F.max("quantity_on_hand").alias("q")).collect()
    return {str(r.snapshot_date): (r.n, r.q) for r in rows}


def other_tables(spark, root):
    products = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) {f.name}" for f in schema.products().fields)
    sales = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) {f.name}" for f in schema.sales().fields)
    write_table(spark.sql(f"SELECT {products}"), root, "products")
    write_table(spark.sql(f"SELECT {sales}").withColumn("sale_date", F.lit("2025-07-04").cast("date")), root, "sales")


def test_a_job_that_ends_before_its_commit_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    other_tables(spark, root)
    write_snapshots(stock(spark, "2025-07-31", 3), root)
    # The rows of August and of a new July are there, their manifest is not.
    write_rows(stock(spark, "2025-08-31", 5), root, "inventory")
    write_rows(stock(spark, "2025-07-31", 9), root, "inventory")
    t = read_tables(spark, root)
    assert seen(spark, root) == {"2025-07-31": (3, 1)} and latest_snapshot(t.inventory, t.snapshots).count() == 3
    assert t.snapshots.first()[0] == datetime.date(2025, 7, 31) and t.months.first()[0] == "2025-07"
    write_snapshots(stock(spark, "2025-08-31", 5), root)
    t = read_tables(spark, root)
    assert latest_snapshot(t.inventory, t.snapshots).count() == 5 and len(seen(spark, root)) == 2
    assert {r.table_name: r.n_rows for r in row_counts(t).collect()} == {"products": 1, "sales": 1, "inventory": 8}


def test_readers_keep_their_version(spark, tmp_path):
    root = str(tmp_path)
    write_snapshots(stock(spark, "2025-07-31", 3), root)
    before = read_table(spark, root, "inventory")
    write_table(stock(spark, "2025-08-31", 4, quantity=7), root, "inventory")
    write_snapshots(stock(spark, "2025-09-30", 4, quantity=8), root)
    assert before.count() == 3 and seen(spark, root) == {"2025-08-31": (4, 7), "2025-09-30": (4, 8)}


def test_a_write_that_is_not_wanted_any_more_is_removed(spark, tmp_path):
    root = str(tmp_path)
    for n in (1, 2, 3):
        write_table(stock(spark, "2025-07-31", n), root, "inventory")
    lost = write_rows(stock(spark, "2025-07-31", 9), root, "inventory").token
    assert manifest.remove_unread(spark, root, "inventory") == []  # too young
    gone = manifest.remove_unread(spark, root, "inventory", keep=1, older_than_hours=0)
    assert f"v={lost}" in gone and len(gone) == 3 and seen(spark, root) == {"2025-07-31": (3, 1)}
    assert len(list((tmp_path / "inventory").glob("v=*"))) == 1
    write_snapshots(stock(spark, "2025-08-31", 1), root)
    assert len(seen(spark, root)) == 2


def test_the_slower_of_two_writers_adds_to_the_faster_one_s(spark, tmp_path):
    root = str(tmp_path)
    write_snapshots(stock(spark, "2025-07-31", 3), root)
    slow = write_rows(stock(spark, "2025-08-31", 5), root, "inventory")
    tries = []

    def change(now):
        tries.append(now.version)
        if len(tries) == 1:  # another writer commits after this one has read the manifest
            write_snapshots(stock(spark, "2025-09-30", 2), root)
        return now.replaced(slow.parts())

    manifest.commit(spark, root, "inventory", change)
    assert tries == [1, 2] and seen(spark, root) == {"2025-07-31": (3, 1), "2025-08-31": (5, 1), "2025-09-30": (2, 1)}
    assert not list((tmp_path / "manifests" / "inventory").glob("*.new"))


def test_empty_tables_and_missing_dates(spark, tmp_path):
    root = str(tmp_path)
    other_tables(spark, root)
    write_table(stock(spark, "2025-07-31", 0), root, "inventory")
    t = read_tables(spark, root)
    assert t.inventory.count() == 0 and latest_snapshot(t.inventory, t.snapshots).count() == 0
    write_snapshots(stock(spark, "2025-07-31", 2).unionByName(stock(spark, None, 3)), root)
    t = read_tables(spark, root)
    assert t.inventory.count() == 5 and latest_snapshot(t.inventory, t.snapshots).count() == 2


def exports(spark, root, sales):
    products = [("P1", "S1", "Ann", "Nights", "LP", "Latin", "New", "5.87", "$11.34", "2011.0"), ("P2", None, "Nas", "x", "LP", "x", "x", "y", "1", None)]
    inventory = [
        ("2025-07-31", "mill lane", "P1", "3", "10", "4"),
        ("2025-07-31", "mill lane", "P1", "3", "10", "4"),
        ("2025-08-31", "Mill Lane", "P1", "0", "0", None),
        ("2025-08-31", "Mill Lane", "P9", "0", "0", "2"),
        ("2025-08-31", "Mill Lane", "P9", "0", "0", None),
        ("never", "Mill Lane", "P1", "1", "1", "9"),
        ("2025-08-31", "Nowhere", "P1", "1", "1", None),
    ]
    for name, rows, kind in (("products", products, schema.RAW_PRODUCTS), ("sales", sales, schema.RAW_SALES), ("inventory", inventory, schema.RAW_INVENTORY)):
        write_raw_csv(spark.createDataFrame(rows, kind), f"{root}/{name}")
    return root


SALES = [("S1", "2025-07-04", "harbor row", "P1", "2", "11.34", None), ("S2", "soon", "Mill Lane", "P1", "1", "8.29", "0")]


def test_cleaning_writes_every_row_once_and_counts_it_there(spark, tmp_path, monkeypatch):
    writes = []

    def counted(df, root, name, *args, **metrics):
        done = write_rows(df, root, name, *args, **metrics)
        writes.append((name, spark.read.parquet(f"{root}/{name}/v={done.token}").count(), bool(metrics)))
        return done

    monkeypatch.setattr(jobs, "write_rows", counted)
    out = f"{tmp_path}/out"
    t = jobs.clean_exports(spark, exports(spark, f"{tmp_path}/raw", SALES), out)
    # Of six different stock rows three have no reorder level; only they are written again, filled.
    assert writes == [("products", 2, True), ("sales", 2, True), ("inventory", 6, True), ("inventory", 3, True)]
    assert {(str(r.snapshot_date), r.location, r.reorder_level) for r in t.inventory.collect()} == {("2025-07-31", "Mill Lane", 4), ("2025-08-31", "Mill Lane", 4)}
    reasons = {r.reject_reason: r["count"] for r in spark.read.parquet(f"{out}/quarantine/inventory").groupBy("reject_reason").count().collect()}
    assert reasons == {"unknown product": 2, "unparseable date": 1, "no reorder level": 1}
    got = {(r.table_name, r.metric): r.value for r in spark.read.parquet(f"{out}/quality_metrics").collect()}
    assert got["inventory", "rows_loaded"] == 7 and got["inventory", "duplicates_removed"] == 1 and got["inventory", "reorder_levels_imputed"] == 3
    assert (got["inventory", "rows_clean"], got["inventory", "rows_quarantined"], got["inventory", "unknown_products_dropped"]) == (2, 4, 2)
    assert {r.table_name: r.n_rows for r in row_counts(t).collect()} == {n: got[n, "rows_clean"] for n in ("products", "sales", "inventory")}


def test_cleaning_that_fails_leaves_the_tables_as_they_were(spark, tmp_path, monkeypatch):
    out, raw = f"{tmp_path}/out", f"{tmp_path}/raw"
    jobs.clean_exports(spark, exports(spark, raw, SALES), out)

    def ends(*args):
        raise RuntimeError("the job ends here")

    monkeypatch.setattr(jobs, "_clean_inventory", ends)
    with pytest.raises(RuntimeError):
        jobs.clean_exports(spark, exports(spark, f"{tmp_path}/raw2", SALES * 2 + [("S9", "2025-09-04", "x", "P1", "2", "1", None)]), out)
    t = read_tables(spark, out)
    assert t.sales.count() == 1 and t.months.first()[0] == "2025-07" and t.products.count() == 1


def rows_scanned(df):
    """Rows that the scan of a plan without shuffles gave, after it has run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()


def test_a_look_up_skips_row_groups_by_their_bloom_filters(spark, tables):
    """A sale's id says nothing about its month, nor about its place in a file: minimum and maximum do not help."""
    total, (key,) = tables.sales.count(), tables.sales.select("sale_id").orderBy(F.xxhash64("sale_id")).first()
    found = look_up(tables.sales, "sale_id", [key])
    assert [r.sale_id for r in found.collect()] == [key]
    assert rows_scanned(look_up(tables.sales, "sale_id", [key])) < total / 5
    keys = [r.sale_id for r in tables.sales.select("sale_id").orderBy(F.xxhash64("sale_id")).limit(12).collect()]
    assert {r.sale_id for r in look_up(tables.sales, "sale_id", keys).collect()} == set(keys)
    assert rows_scanned(look_up(tables.sales, "sale_id", ["nothing of the kind", "5-0"])) <= total / 5
    assert look_up(tables.sales, "sale_id", []).count() == 0
    with pytest.raises(ValueError, match="join"):
        look_up(tables.sales, "sale_id", [str(i) for i in range(10_001)])
