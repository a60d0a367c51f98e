"""Cleaning pipelines on small exports with one of everything planted."""

import datetime
from decimal import Decimal

import pytest
from stockflow import schema
from stockflow.operators.dedupe import count_copies, first_per_key, largest_first
from stockflow.operators.impute import fill_with_median, group_medians
from stockflow.operators.integrity import duplicate_keys, flag_known, keep_known, keep_orphans, null_counts
from stockflow.plans import cleaning
from stockflow.sources.raw_csv import read_raw_csv, write_raw_csv
from pyspark.sql import functions as F

D = Decimal

PRODUCTS = [
    ("P1", "S1", "  Ann Example ", "Nights", "LP", "latin", "NEW", "5.87", "$11.34", "2011.0"),
    ("P1", "S1", "  Ann Example ", "Nights", "LP", "latin", "NEW", "5.87", "$11.34", "2011.0"),
    ("P2", None, "Nas", "Echoes", '7"', "hip-hop", "used ", "$2", "8.29", None),
    ("P3", "S3", "Nas", "Free", "CD", "Soul/FUNK", "Used", "1.00", "0.00", "1999.0"),
    ("P4", "S4", "Nas", "Costly", "CD", None, "Used", "1.00", "1,234.50", "1999.0"),
    ("P5", "S5", "Nas", "Unknown cost", "CD", "Rock", "Used", None, "9.00", "1999.5"),
]

SALES = [
    ("S1", "2025-07-04", " harbor row", "P1", "2", "11.34", None),
    ("S1", "2025-07-04", " harbor row", "P1", "2", "11.34", None),
    ("S1", "2025-07-04", "Harbor Row", "P1", "2", "11.34", None),
    ("S2", "7/5/2025", "MILL LANE", "P2", "1.0", "$8.29", "0.29"),
    ("S3", "soon", "Mill Lane", "P2", "1", "8.29", "0"),
    ("S4", "2025-07-06", "Mill Lane", "P9", "1", "8.29", "0"),
    ("S5", "2025-07-06", "Mill Lane", "P2", "1.5", "8.29", "0"),
    ("S6", "2025-07-06", "Mill Lane", "P2", "1", "8,29", "x"),
    ("S7", "2025-07-06", "Mill Lane", "P3", "1", "8.29", "x"),
    ("S8", "2025-07-07", "Mill Lane", None, "1", "8.29", "x"),
]

INVENTORY = [
    ("2025-07-31", "mill lane", "P1", "3", "10", "1"),
    ("2025-07-31", "mill lane", "P2", "0", "0", None),
    ("7/31/2025", "Mill Lane", "P9", "1", "1", "2"),
    ("never", "Mill Lane", "P1", "1", "1", "2"),
    ("2025-08-31", "Harbor Row", "P1", "4", "1", None),
]


def frames(spark):
    return (
        spark.createDataFrame(PRODUCTS, schema.RAW_PRODUCTS),
        spark.createDataFrame(SALES, schema.RAW_SALES),
        spark.createDataFrame(INVENTORY, schema.RAW_INVENTORY),
    )


def test_products(spark):
    raw, _, _ = frames(spark)
    got = {r.product_id: r for r in cleaning.clean_products(raw).collect()}
    assert set(got) == {"P1", "P2"}
    assert got["P1"].artist == "Ann Example" and got["P1"].genre == "Latin" and got["P1"].condition == "New"
    assert got["P1"].price == D("11.34") and got["P1"].release_year == 2011
    assert got["P2"].format == '7"' and got["P2"].genre == "Hip-Hop" and got["P2"].cost == D("2.00")
    assert cleaning.clean_products(raw).schema == schema.products() or cleaning.clean_products(raw).columns == schema.products().names
    bad = cleaning.rejected(cleaning.annotate_products(raw), "products")
    assert {r.product_id for r in bad.collect()} == {"P3", "P4", "P5"}


def test_sales(spark):
    raw_products, raw, _ = frames(spark)
    products = cleaning.clean_products(raw_products)
    clean = cleaning.clean_sales(raw, products)
    # Copies are removed before the text is normalised, so the third S1 survives and is reported.
    assert sorted(r.sale_id for r in clean.collect()) == ["S1", "S1", "S2"]
    assert [r.sale_id for r in duplicate_keys(clean, ["sale_id"]).collect()] == ["S1"]
    s2 = clean.filter("sale_id = 'S2'").first()
    assert s2.sale_date == datetime.date(2025, 7, 5) and s2.location == "Mill Lane"
    assert s2.net_amount == D("8.00") and s2.quantity == 1
    reasons = {r.sale_id: r.reject_reason for r in cleaning.rejected(cleaning.annotate_sales(raw, products), "sales").collect()}
    assert reasons == {
        "S3": "unparseable date",
        "S4": "unknown product",
        "S5": "invalid quantity",
        "S6": "invalid unit price",
        "S7": "unknown product",
        "S8": "unknown product",
    }


def test_inventory_median_counts_orphans_and_unparsed_rows(spark):
    raw_products, _, raw = frames(spark)
    annotated = cleaning.annotate_inventory(raw, cleaning.clean_products(raw_products))
    clean = {(r.location, r.product_id): r.reorder_level for r in cleaning.accepted(annotated, "inventory").collect()}
    assert clean == {("Mill Lane", "P1"): 1, ("Mill Lane", "P2"): 2}
    reasons = sorted(r.reject_reason for r in cleaning.rejected(annotated, "inventory").collect())
    assert reasons == ["no reorder level", "unknown product", "unparseable date"]


def test_metrics(spark):
    got = {(r.table_name, r.metric): r.value for r in cleaning.quality_metrics(*frames(spark)).collect()}
    assert got[("products", "rows_loaded")] == 6 and got[("products", "duplicates_removed")] == 1
    assert got[("products", "price_dollar_stripped")] == 2  # counted before copies go
    assert got[("products", "release_year_missing")] == 1 and got[("products", "sku_missing")] == 1
    assert got[("sales", "us_dates_normalized")] == 1 and got[("sales", "unparseable_dates_dropped")] == 1
    assert got[("sales", "location_casing_fixed")] == 2 and got[("sales", "discounts_filled")] == 2
    assert got[("sales", "unknown_products_dropped")] == 3
    assert got[("inventory", "reorder_levels_imputed")] == 2
    for table, n_in in (("products", 6), ("sales", 10), ("inventory", 5)):
        assert n_in == got[(table, "rows_loaded")] == (
            got[(table, "rows_clean")] + got[(table, "rows_quarantined")] + got[(table, "duplicates_removed")]
        )


def test_csv_round_trip_keeps_quotes_blanks_and_nulls(spark, tmp_path):
    raw, _, _ = frames(spark)
    write_raw_csv(raw, f"{tmp_path}/p")
    back = read_raw_csv(spark, f"{tmp_path}/p", schema.RAW_PRODUCTS)
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0


def test_csv_null_words(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\nNA,"x ""y"""\n,"p,q"\n')
    plain = read_raw_csv(spark, str(tmp_path), schema._struct(a=schema.T.StringType(), b=schema.T.StringType()))
    assert [tuple(r) for r in plain.collect()] == [("NA", 'x "y"'), (None, "p,q")]
    words = read_raw_csv(
        spark, str(tmp_path), schema._struct(a=schema.T.StringType(), b=schema.T.StringType()), null_words=("NA",)
    )
    assert [r.a for r in words.collect()] == [None, None]


def test_median_rounds_half_up_and_keeps_hot_groups_exact(spark):
    rows = [("a", 1), ("a", 2)] + [("b", 1)] * 1000 + [("b", 9)] * 999 + [("c", None), (None, 4), (None, None)]
    df = spark.createDataFrame(rows, "g string, v int")
    assert {r.g: r.median for r in group_medians(df, "g", "v").collect()} == {"a": 2, "b": 1, None: 4}
    filled = fill_with_median(df, "g", "v")
    assert filled.count() == len(rows)
    assert filled.filter("g is null").agg(F.sum("v")).first()[0] == 8
    assert filled.filter("g = 'c'").first().v is None


def test_known_and_orphans_split_the_rows(spark):
    df = spark.createDataFrame([("P1",), ("P1",), ("P9",), (None,)], "product_id string")
    products = spark.createDataFrame([("P1",), ("P1",), (None,)], "product_id string")
    assert keep_known(df, products).count() == 2
    assert keep_orphans(df, products).count() == 2
    assert sorted(r.known_product for r in flag_known(df, products).collect()) == [False, False, True, True]


def test_first_per_key_with_a_hot_key(spark):
    rows = [("k", i % 50, f"v{i}") for i in range(500)] + [("z", None, "only")]
    df = spark.createDataFrame(rows, "k string, rank int, v string")
    got = {r.k: (r.rank, r.v) for r in first_per_key(df, ["k"], [F.col("rank")]).collect()}
    assert got == {"k": (0, "v0"), "z": (None, "only")}


def test_largest_first_puts_nulls_last(spark):
    df = spark.createDataFrame([("k", None, "n"), ("k", 3, "a"), ("k", 7, "b"), ("z", None, "n")], "k string, d int, v string")
    assert {r.k: r.v for r in first_per_key(df, ["k"], largest_first("d")).collect()} == {"k": "b", "z": "n"}


def test_copies_and_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a"), (None, None)], "a int, b string")
    got = {(r.a, r.b): r.copies for r in count_copies(df).collect()}
    assert got == {(1, None): 2, (1, "a"): 1, (None, None): 1}
    counts = {r.column_name: r.null_rows for r in null_counts(df, ["a", "b"], "t").collect()}
    assert counts == {"a": 1, "b": 3}


def test_csv_with_other_columns_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("b,a\n1,2\n")
    kind = schema._struct(a=schema.T.StringType(), b=schema.T.StringType())
    with pytest.raises(Exception, match="(?i)header"):
        read_raw_csv(spark, str(tmp_path), kind).collect()
