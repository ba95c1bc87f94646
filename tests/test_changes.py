"""Change data capture and gold from partials."""

from __future__ import annotations

import datetime as dt
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.operators import gold, partials
from tributary.plans import pipeline
from tributary.schemas import DEDUP_COLUMNS, MOBILE_SCHEMA, SCORED_SCHEMA
from tributary.session import fresh_dir

PERIOD = partials.PERIOD


def sale(number, day, month=3, product="MP-1", amount=10.0, quantity=2):
    when = int(dt.datetime(2024, month, day, 5, tzinfo=dt.timezone.utc).timestamp())
    return (f"MTX-{number}", product, f"device_{number % 3}", quantity, amount, when, "2.1.0", "iOS", "completed")


@pytest.fixture(scope="module")
def landing_files(spark):
    root = fresh_dir(spark, "tiny")
    rows = [sale(i, 1 + i % 4, product=f"MP-{i % 5}", amount=1.5 * i) for i in range(40)] + [sale(90, 20), sale(91, 21, month=5)]
    spark.createDataFrame(rows, MOBILE_SCHEMA).write.parquet(f"{root}/mobile")
    header = "TRANS_ID,CUST_NUM,PRODUCT_CODE,QTY,PRICE,TRANS_DATE,STORE,STATUS,PAYMENT_TYPE,CASHIER_ID,REGISTER_NUM"
    line = "POS1,123456,PROD-0001,1,10.00,2024-03-02,Store-001,completed,cash,C1,R1"
    spark.createDataFrame([(header,), (line,)], "value string").coalesce(1).write.text(f"{root}/pos")
    spark.createDataFrame([('{"orderId":"ORD-1","totalAmount":1.0}',)], "value string").write.text(f"{root}/ecommerce")
    return {n: f"{root}/{n}" for n in ("pos", "ecommerce", "mobile")}


@pytest.fixture
def lake(spark, landing_files):
    base = fresh_dir(spark, "tiny-lake")
    return pipeline.run(spark, None, base, landing_paths=landing_files, ingestion_ts="2024-06-01 00:00:00", register=False, period="day")


def stored(spark, lake):
    return spark.read.parquet(lake.tables["silver.unified_sales_deduped"])


def files(path):
    return {
        f"{folder}/{name}": os.stat(f"{folder}/{name}").st_mtime_ns
        for folder, _, names in os.walk(path)
        for name in names
        if name.endswith(".parquet")
    }


def changes(spark, lake, *edits):
    """(op, seq, transaction id, {column: value}) as change rows."""
    rows = {r.transaction_id: r.asDict() for r in stored(spark, lake).select(*SCORED_SCHEMA.names).collect()}
    model = next(iter(rows.values()))
    made = []
    for op, seq, key, new in edits:
        row = {**rows.get(key, {**model, "transaction_id": key}), "transaction_id": key, **new}
        made.append((op, seq, *[row[c] for c in SCORED_SCHEMA.names]))
    schema = T.StructType([T.StructField("op", T.StringType()), T.StructField("seq", T.LongType()), *SCORED_SCHEMA.fields])
    return spark.createDataFrame(made, schema)


def check_gold(spark, lake):
    """Every gold table equals its recomputation from the stored rows."""
    rows = stored(spark, lake).select(*DEDUP_COLUMNS)
    want = {
        "revenue_by_source": gold.revenue_by_source(rows),
        "product_performance": gold.product_performance(rows),
        "data_quality_metrics": gold.data_quality_metrics(rows),
        "executive_summary": gold.executive_summary(rows, "2024-06-02"),
    }
    for name, df in want.items():
        found = spark.read.parquet(lake.tables[f"gold.{name}"]).select(*df.columns)
        assert Counter(map(repr, found.collect())) == Counter(map(repr, df.collect())), name


def apply(spark, lake, batch, *edits):
    return pipeline.apply_changes(spark, lake.base, changes(spark, lake, *edits), batch, report_date="2024-06-02")


def quantities(spark, lake):
    return {r.transaction_id: r.quantity for r in stored(spark, lake).filter("source_system = 'mobile'").collect()}


def test_out_of_order_changes_and_deletes(spark, lake):
    before = quantities(spark, lake)
    apply(
        spark, lake, "b1",
        ("U", 5, "MTX-1", {"quantity": 7}), ("U", 4, "MTX-1", {"quantity": 8}), ("D", 3, "MTX-2", {}),
        ("I", 1, "MTX-500", {"quantity": 9}), ("D", 1, "MTX-900", {}), ("U", 1, "MTX-3", {"quality_tier": "rejected"}),
    )
    want = {**before, "MTX-1": 7, "MTX-500": 9}
    del want["MTX-2"], want["MTX-3"]
    assert quantities(spark, lake) == want
    check_gold(spark, lake)
    late = [("U", 4, "MTX-1", {"quantity": 1}), ("U", 2, "MTX-2", {"quantity": 1}), ("U", 1, "MTX-900", {"quantity": 1})]
    assert apply(spark, lake, "b2", *late).metrics["affected_periods"] == 0
    assert quantities(spark, lake) == want
    apply(spark, lake, "b3", ("I", 4, "MTX-2", {"quantity": 3}))
    assert quantities(spark, lake) == {**want, "MTX-2": 3}
    check_gold(spark, lake)


def test_only_touched_periods_are_opened(spark, lake):
    """Files of other periods are made unreadable; they are not opened, and
    stay as they are."""
    path = lake.tables["silver.unified_sales_deduped"]
    other = [f for f in files(path) if "2024-03-02" not in f]
    good = {f: open(f, "rb").read() for f in other}
    for f in other:
        with open(f, "wb") as out:
            out.write(b"no parquet")
    times = {f: t for f, t in files(path).items() if f in other}
    rows = changes_of_day(spark, lake, path)
    res = pipeline.apply_changes(spark, lake.base, rows, "b1", report_date="2024-06-02")
    assert res.metrics["affected_periods"] == 1
    assert {f: t for f, t in files(path).items() if f in other} == times
    for f, data in good.items():
        with open(f, "wb") as out:
            out.write(data)
        crc = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
        assert os.path.exists(crc)
    check_gold(spark, lake)


def changes_of_day(spark, lake, path):
    one = spark.read.parquet(f"{path}/{PERIOD}=2024-03-02").filter("source_system = 'mobile'").select(*SCORED_SCHEMA.names)
    return one.select(F.lit("U").alias("op"), F.lit(1).cast("long").alias("seq"), *[
        (F.col("quantity") + 1).alias("quantity") if c == "quantity" else F.col(c) for c in one.columns
    ])


def test_a_period_that_loses_all_rows_goes(spark, lake):
    path = lake.tables["silver.unified_sales_deduped"]
    assert os.path.isdir(f"{path}/{PERIOD}=2024-05-21")
    apply(spark, lake, "b1", ("D", 1, "MTX-91", {}), ("U", 1, "MTX-90", {"transaction_date": dt.datetime(2024, 7, 1)}))
    assert not os.path.isdir(f"{path}/{PERIOD}=2024-05-21") and not os.path.isdir(f"{path}/{PERIOD}=2024-03-20")
    assert os.path.isdir(f"{path}/{PERIOD}=2024-07-01")
    check_gold(spark, lake)


def test_a_retry_gives_the_same(spark, lake):
    edits = [("U", 1, "MTX-1", {"quantity": 5}), ("D", 1, "MTX-4", {})]
    rows = changes(spark, lake, *edits)
    pipeline.apply_changes(spark, lake.base, rows, "b1", report_date="2024-06-02")
    first = sorted(map(repr, stored(spark, lake).collect()))
    # As if it had been lost before the key log was written: the log's last entry goes.
    log = f"{lake.base}/silver/_keys"
    last = max(os.listdir(log), key=lambda n: int(n.split("=")[1]))
    os.remove(f"{log}/{last}/_SUCCESS")
    assert pipeline.apply_changes(spark, lake.base, rows, "b1", report_date="2024-06-02").metrics["affected_periods"] > 0
    assert sorted(map(repr, stored(spark, lake).collect())) == first
    assert pipeline.apply_changes(spark, lake.base, rows, "b1", report_date="2024-06-02").metrics["affected_periods"] == 0
    check_gold(spark, lake)


def test_partials_with_values_that_no_decimal_holds(spark):
    rows = spark.createDataFrame(
        [("p1", "pos", "t1", 1.5, 80), ("p1", "pos", "t2", float("inf"), 90), ("p2", "pos", "t1", 2.25, 91), ("p2", "web", None, None, 92)],
        f"{PERIOD} string, source_system string, transaction_id string, total_amount double, quality_score int",
    ).select(
        "*", F.lit("c").alias("customer_id"), F.lit("x").alias("product_id"), F.lit(1).cast("long").alias("quantity"),
        F.col("total_amount").alias("unit_price"), F.lit("high").alias("quality_tier"), F.lit(False).alias("is_duplicate"),
        F.lit("2024-03-01").cast("timestamp").alias("transaction_date"),
    )
    words = fresh_dir(spark, "words")
    partials.extend_dictionary(rows, words, f"{words}-new")
    partials.extend_dictionary(rows, words, f"{words}-new")
    known = partials.read_dictionary(spark, words)
    assert sorted(r.id for r in known.collect()) == list(range(4))
    parts = partials.partials(rows, known)
    for found, want in (
        (partials.executive_summary(parts, "2024-06-02"), gold.executive_summary(rows, "2024-06-02")),
        (partials.product_performance(parts), gold.product_performance(rows)),
        (partials.data_quality_metrics(parts), gold.data_quality_metrics(rows)),
    ):
        assert sorted(map(repr, found.select(*want.columns).collect())) == sorted(map(repr, want.collect()))


def test_bitmaps_follow_periods_not_days(spark):
    """Ids of a period share its bitmaps on whatever day and channel they are
    sold; a period's new ids are numbered together."""
    rows = spark.range(600).select(
        F.when(F.col("id") % 2 == 0, "2024-03").otherwise("2024-04").alias(PERIOD),
        F.when(F.col("id") % 3 == 0, "pos").when(F.col("id") % 3 == 1, "web").alias("source_system"),
        F.concat(F.lit("t"), F.col("id")).alias("transaction_id"), F.concat(F.lit("c"), F.col("id") % 7).alias("customer_id"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("x"), F.col("id") % 11)).alias("product_id"),
        F.lit(1).cast("long").alias("quantity"), F.when(F.col("id") % 13 > 0, 1.5).alias("total_amount"), F.lit(1.5).alias("unit_price"),
        F.lit(80).alias("quality_score"), F.lit("high").alias("quality_tier"), F.lit(False).alias("is_duplicate"),
        F.timestamp_seconds(F.when(F.col("id") % 2 == 0, 1709251200).otherwise(1711929600) + (F.col("id") % 29) * 86400).alias("transaction_date"),
    )
    words = fresh_dir(spark, "words")
    partials.extend_dictionary(rows, words, f"{words}-new")
    known = partials.read_dictionary(spark, words)
    parts = partials.partials(rows, known)
    assert parts["bitmaps"].count() <= 4 * len(partials.KINDS)  # at most two buckets each
    numbers = known.filter("kind = 'transaction'").selectExpr("cast(substring(value, 2) as int) % 2 as p", "id").groupBy("p")
    assert [r.n for r in numbers.agg((F.max("id") - F.min("id") + 1).alias("n")).collect()] == [300, 300]
    for found, want in (
        (partials.revenue_by_source(parts), gold.revenue_by_source(rows)),
        (partials.executive_summary(parts, "2024-06-02"), gold.executive_summary(rows, "2024-06-02")),
    ):
        assert sorted(map(repr, found.select(*want.columns).collect())) == sorted(map(repr, want.collect()))
