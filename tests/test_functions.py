"""Cleaning rules on hand-made values."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stockflow.functions.dates import epoch_ms, mixed_date, utc_date
from stockflow.functions.numbers import cents, integer, money, net_amount, percent
from stockflow.functions.text import split_name, strip, title_case
from stockflow.plans.analyses import age_bucket, spare_quantity
from stockflow.plans.feed import line_discount_cents, line_quantity, whole_quantity
from stockflow.plans.kpi import FORMAT_ORDER, dollars, in_order

D = Decimal


def apply(spark, rule, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(rule(F.col("v"))).collect()]


def test_strip_takes_all_whitespace(spark):
    assert apply(spark, strip, ["  a b ", "\t\xa0x　\n", "", None]) == ["a b", "x", "", None]


@pytest.mark.parametrize(
    "text",
    ["hip-hop", "  SOUL/funk ", "o'brien 7th", "a\tb", "MIDDLE  EAST", "éclair-été", "x", "", "r&b 2nd/3rd", "ß-a"],
)
def test_title_case_equals_python(spark, text):
    if "ß" not in text:
        assert apply(spark, title_case, [text]) == [text.strip().title()]


def test_title_case_keeps_null(spark):
    assert apply(spark, title_case, [None]) == [None]


def test_money(spark):
    values = ["$11.6", "  $$3 ", "$ 5", "1,234.50", "-2.5", "abc", "", None, "12d", "NaN", "0"]
    assert apply(spark, money, values) == [
        D("11.60"), D("3.00"), D("5.00"), None, D("-2.50"), None, None, None, None, None, D("0.00"),
    ]


def test_integer(spark):
    values = ["2011.0", " 12 ", "1.5", "12d", "1e3", "NaN", "", None, "99999999999", "-4"]
    assert apply(spark, integer, values) == [2011, 12, None, None, 1000, None, None, None, None, -4]
    assert apply(spark, lambda c: integer(c, "bigint"), ["99999999999"]) == [99999999999]


def test_mixed_date(spark):
    day = datetime.date(2025, 7, 4)
    values = ["2025-07-04", "2025-7-4", "7/4/2025", " 07/04/2025 ", "2/30/2025", "13/1/2025", "soon", "7/4/25", "", None]
    assert apply(spark, mixed_date, values) == [day] * 4 + [None] * 6


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_utc_date_ignores_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        midnight = 1751587200000  # 2025-07-04 00:00 UTC
        assert apply(spark, utc_date, [midnight - 1, midnight, midnight + 86_399_999, None], "long") == [
            datetime.date(2025, 7, 3), datetime.date(2025, 7, 4), datetime.date(2025, 7, 4), None,
        ]
        assert apply(spark, epoch_ms, [datetime.date(2025, 7, 4)], "date") == [midnight]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_split_name_tries_separators_in_order(spark):
    names = ["A - B", "A – B", "A — B", "A — B - C", " - B", "A-B", "  Only ", "", None, "A - B - C", "A - "]
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, v string").orderBy("i")
    artist, title = split_name(F.col("v"))
    assert [tuple(r) for r in rows.select(artist, title).collect()] == [
        ("A", "B"), ("A", "B"), ("A", "B"), ("A — B", "C"), ("", "B"), ("", "A-B"), ("", "Only"), ("", ""), ("", ""),
        ("A", "B - C"), ("A", ""),
    ]


def test_net_amount_rounds_half_up(spark):
    row = spark.range(1).select(net_amount(F.lit(D("0.5")), F.lit(D("0.03")), F.lit(D("0.00")))).first()
    assert row[0] == D("0.02")


def test_cents_and_percent(spark):
    assert apply(spark, cents, [1234, 0, None, -5], "long") == [D("12.34"), D("0.00"), None, D("-0.05")]
    row = spark.range(1).select(percent(F.lit(1), F.lit(3)), percent(F.lit(1), F.lit(0))).first()
    assert tuple(row) == (33.3, None)


def test_line_quantity_and_whole(spark):
    got = apply(spark, lambda c: line_quantity(c), [None, 0, 1000, 1500], "long")
    assert got == [D("1.000"), D("1.000"), D("1.000"), D("1.500")]
    assert apply(spark, lambda c: whole_quantity(line_quantity(c)), [None, 3000, 1500], "long") == [1, 3, None]


def test_line_discount(spark):
    kind = "array<struct<amount:bigint>>"
    got = apply(spark, line_discount_cents, [None, [], [(-300,), (200,), (None,)]], kind)
    assert got == [0, 0, 500]


def test_spare_quantity(spark):
    rows = spark.createDataFrame([(11, 2), (10, 3), (5, 4), (6, None)], "q int, r int")
    got = [r[0] for r in rows.select(spare_quantity(F.col("q"), F.col("r"))).collect()]
    assert got == [6, 5, 1, None]


def test_age_bucket_edges(spark):
    got = apply(spark, age_bucket, [0, 30, 31, 60, 61, 90, 91], "int")
    assert [g[0] for g in got] == list("aabbccd")


def test_display_helpers(spark):
    assert apply(spark, dollars, [D("1234.50")], "decimal(12,2)") == ["$1,234.50"]
    assert apply(spark, lambda c: in_order(c, FORMAT_ORDER), ["Cassette", "LP", "8-track"]) == [4, 1, 5]
