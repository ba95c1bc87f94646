"""Property tests: column builders against small Python models.

Each example is one DataFrame of many generated values, so a run costs a
handful of Spark jobs.
"""

from __future__ import annotations

import datetime as dt
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tributary.functions import dates, prices
from tributary.rules import DOCUMENTED

PRICE_ALPHABET = "0123456789.,-$ PHUSDx"


def price_model(s: str | None) -> float | None:
    """As coded: strip the character class, then read a plain number."""
    if s is None or s == "":
        return None
    t = re.sub(r"[$€£¥PHP USD EUR GBP,]", "", s)
    if re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)", t):
        return float(t)
    return None


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(PRICE_ALPHABET, max_size=10)), min_size=1, max_size=300))
def test_price_clean_matches_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(prices.clean_price(F.col("v"))).collect()]
    assert got == [price_model(v) for v in values]


FORMATS = {"MM/dd/yyyy": "%m/%d/%Y", "dd-MM-yyyy": "%d-%m-%Y", "yyyy-MM-dd": "%Y-%m-%d", "dd/MM/yyyy": "%d/%m/%Y"}


def date_model(d: dt.date, fmt: str, documented: bool) -> dt.datetime | None:
    if fmt != "dd/MM/yyyy":
        return dt.datetime(d.year, d.month, d.day)
    # Day-first text under the month-first reading: day <= 12 swaps.
    if d.day <= 12:
        return dt.datetime(d.year, d.day, d.month)
    return dt.datetime(d.year, d.month, d.day) if documented else None


@settings(max_examples=6, deadline=None)
@given(
    st.lists(
        st.tuples(st.dates(dt.date(1900, 1, 1), dt.date(2099, 12, 31)), st.sampled_from(sorted(FORMATS))),
        min_size=1,
        max_size=300,
    )
)
def test_date_parse_matches_model(spark, cases):
    texts = [d.strftime(FORMATS[f]) for d, f in cases]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    out = df.select(
        dates.parse_date_text(F.col("v")).cast("timestamp_ntz").alias("a"),
        dates.parse_date_text(F.col("v"), DOCUMENTED).cast("timestamp_ntz").alias("d"),
    ).collect()
    assert [r.a for r in out] == [date_model(d, f, False) for d, f in cases]
    assert [r.d for r in out] == [date_model(d, f, True) for d, f in cases]
