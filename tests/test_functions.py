"""Scalar truth tables for the column builders, in ANSI and legacy mode."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tributary.functions import codes, dates, prices
from tributary.rules import AS_CODED, DOCUMENTED


def one_col(spark, values, expr_fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(expr_fn(F.col("v"))).collect()]


D = dt.datetime

DATE_CASES = [
    ("2024-01-05T10:20:30Z", D(2024, 1, 5, 10, 20, 30)),  # F1, zone letter ignored
    ("2024-01-05T10:20Z", None),  # F1 guard matches, format does not
    ("2024-01-05", D(2024, 1, 5)),  # F2
    ("01/05/2024", D(2024, 1, 5)),  # F3 month first
    ("05/01/2024", D(2024, 5, 1)),  # day-first text read month first (swap)
    ("25/12/2024", None),  # day > 12: month-first reading invalid
    ("25-12-2024", D(2024, 12, 25)),  # F4 day first with dashes
    ("1704067200", D(2024, 1, 1)),  # F6 epoch seconds
    ("12.5", D(1970, 1, 1, 0, 0, 12)),  # fraction dropped
    ("NULL", None),
    ("", None),
    ("00/00/0000", None),
    ("99/99/9999", None),
    (None, None),
    ("2024/01/05", None),
]


@pytest.mark.parametrize("raw,expected", DATE_CASES)
def test_date_parse_as_coded(spark, ansi, raw, expected):
    got = one_col(spark, [raw], lambda c: dates.parse_date_text(c).cast("timestamp_ntz"))[0]
    assert got == expected


def test_date_parse_documented_day_first(spark, ansi):
    vals = ["25/12/2024", "05/01/2024", "13/13/2024"]
    got = one_col(spark, vals, lambda c: dates.parse_date_text(c, DOCUMENTED).cast("timestamp_ntz"))
    assert got == [D(2024, 12, 25), D(2024, 5, 1), None]
    amb = one_col(spark, vals + ["05/05/2024", None], dates.date_is_ambiguous)
    assert amb == [False, True, False, False, False]


PRICE_CASES = [
    ("123.45", 123.45, 123.45),
    ("$123.45", 123.45, 123.45),
    ("PHP 123.45", 123.45, 123.45),
    ("123.45 USD", 123.45, 123.45),
    ("45,67", 4567.0, 45.67),  # decimal comma: x100 as coded
    ("1,234.50", 1234.5, 1234.5),
    ("-9.50", -9.5, -9.5),
    ("0", 0.0, 0.0),
    ("", None, None),
    (None, None, None),
    ("INVALID", None, None),  # 'INVALI' after stripping the class
    ("1.5 php", None, 1.5),  # lower-case token: only the documented rule knows it
    ("1E5", 15.0, None),  # class strips E
]


@pytest.mark.parametrize("raw,coded,documented", PRICE_CASES)
def test_price_clean(spark, ansi, raw, coded, documented):
    got = one_col(spark, [raw], lambda c: prices.clean_price(c, AS_CODED))[0]
    assert got == coded
    got = one_col(spark, [raw], lambda c: prices.clean_price(c, DOCUMENTED))[0]
    assert got == documented


def test_status(spark, ansi):
    raw = ["COMPLETE", " complete ", "Comp", "done", "PENDING", "processing", "VOID", "canceled",
           "refund", "ERROR", "failed", "", None, "shipped"]
    want = ["completed"] * 4 + ["pending"] * 2 + ["cancelled"] * 2 + ["refunded"] + ["failed"] * 2 + [
        "unknown"
    ] * 3
    assert one_col(spark, raw, codes.standardize_status) == want


def test_customer_id(spark, ansi):
    raw = ["C00042", "C1234567", "###CORRUPT###", "", None, "x7"]
    assert one_col(spark, raw, lambda c: codes.pos_customer_id(c, AS_CODED)) == [
        "CUST-00042", "CUST-12345", "CUST-00000", None, None, "CUST-00007"
    ]
    assert one_col(spark, raw, lambda c: codes.pos_customer_id(c, DOCUMENTED)) == [
        "CUST-00042", "CUST-1234567", None, None, None, "CUST-00007"
    ]


def test_quantity(spark, ansi):
    raw = ["3", "0", "-1", "abc", "", None, "007", "99999999999"]
    assert one_col(spark, raw, codes.pos_quantity) == [3, 0, None, None, None, None, 7, None]


def test_store_and_payment(spark, ansi):
    assert one_col(spark, ["Store_A", "Store-D", "st c", None], codes.store_id) == [
        "STOREA", "STORED", "STC", "UNKNOWN"
    ]
    assert one_col(spark, ["CASH", "cash", "CREDIT", "DEBIT", None, "gift"], codes.payment_method) == [
        "cash", "cash", "credit_card", "debit_card", "other", "other"
    ]


def test_product_placeholders(spark, ansi):
    raw = ["SKU-1", "", "MISSING", None]
    assert one_col(spark, raw, lambda c: codes.product_id(c, AS_CODED)) == raw
    assert one_col(spark, raw, lambda c: codes.product_id(c, DOCUMENTED)) == ["SKU-1", None, None, None]


def test_epoch(spark, ansi):
    got = one_col(spark, [0, 1704067200, None], lambda c: dates.epoch_to_ts(c).cast("timestamp_ntz"), "bigint")
    assert got == [D(1970, 1, 1), D(2024, 1, 1), None]
    got = one_col(
        spark, [0], lambda c: dates.epoch_to_ts(c, DOCUMENTED).cast("timestamp_ntz"), "bigint"
    )
    assert got == [None]


def test_exact_rounding(spark):
    from tributary.functions.exact import exact_sum, half_up_avg, half_up_avg_int

    df = spark.createDataFrame([(1.005,), (1.005,), (None,)], "x double")
    row = df.agg(half_up_avg("x", 2).alias("a"), exact_sum("x").alias("s")).first()
    assert row.a == 1.01 and row.s == 2.01
    ints = spark.createDataFrame([(90,), (91,)], "i int")
    assert ints.agg(half_up_avg_int("i", 1).alias("a")).first().a == 90.5
    empty = spark.createDataFrame([(None,)], "x double")
    assert empty.agg(half_up_avg("x", 2).alias("a")).first().a is None


def test_half_up_is_symmetric(spark):
    from tributary.functions.exact import half_up_avg, half_up_avg_int

    df = spark.createDataFrame([(g, x) for g, xs in [(1, [-1.005, -1.005]), (2, [-0.125]), (3, [2.5, -0.5])]
                                for x in xs], "g int, x double")
    got = {r.g: r.a for r in df.groupBy("g").agg(half_up_avg("x", 2).alias("a")).collect()}
    assert got == {1: -1.01, 2: -0.13, 3: 1.0}
    ints = spark.createDataFrame([(1, -90), (1, -91), (2, -3), (2, -4), (2, -4)], "g int, i int")
    got = {r.g: r.a for r in ints.groupBy("g").agg(half_up_avg_int("i", 1).alias("a")).collect()}
    assert got == {1: -90.5, 2: -3.7}


def test_exact_aggregates_leave_nothing_out(spark, ansi):
    """A value that no DECIMAL holds counts as in a plain SUM and AVG."""
    from tributary.functions.exact import exact_avg, exact_sum, half_up_avg

    inf, nan = float("inf"), float("nan")
    cases = {
        1: ([1.0, nan, 2.0], nan, nan, nan),
        2: ([1.0, inf], inf, inf, inf),
        3: ([1e33, 2.0], 1e33, 5e32, 5e32),
        4: ([1e28, 2.0], 1e28, 5e27, 5e27),
        5: ([1e20, 2.0], 1e20, 5e19, 5e19),
        6: ([1e31] * 12, 1.2e32, 1e31, 1e31),
        7: ([None], None, None, None),
        8: ([0.125, 0.125], 0.25, 0.125, 0.13),
        9: ([-1e20, -1.0], -1e20, -5e19, -5e19),
    }
    df = spark.createDataFrame([(g, x) for g, (xs, *_) in cases.items() for x in xs], "g int, x double")
    rows = df.groupBy("g").agg(exact_sum("x").alias("s"), exact_avg("x").alias("a"), half_up_avg("x", 2).alias("h"))
    for r in rows.collect():
        for got, want in zip((r.s, r.a, r.h), cases[r.g][1:]):
            same = got is None if want is None else got != got if want != want else got == pytest.approx(want, rel=1e-15)
            assert same, (r, want)
