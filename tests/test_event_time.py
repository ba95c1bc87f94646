"""Event-time streams: several runs, late rows, bounded state."""

from __future__ import annotations

import datetime as dt
import os
from collections import Counter

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tributary.functions.exact import exact_sum
from tributary.plans.medallion import Medallion
from tributary.schemas import SCORED_SCHEMA
from tributary.session import fresh_dir
from tributary.streaming import event_time


def rows(spark, *sales):
    """(id, customer, day of 2024, total) as scored rows."""
    made = []
    for k, (number, customer, day, total) in enumerate(sales):
        when = None if day is None else dt.datetime(2024, 1, 1, 8 + k % 9) + dt.timedelta(days=day)
        values = {
            "transaction_id": number, "transaction_date": when, "customer_id": customer, "product_id": "p", "quantity": 1,
            "unit_price": total, "store_id": "s", "status": "completed", "payment_method": "cash", "source_system": "pos",
            "ingestion_timestamp": dt.datetime(2024, 12, 1, 0, 0, k), "source_file": "f", "total_amount": total, "quality_score": 100,
            "quality_tier": "high", "transformation_timestamp": dt.datetime(2024, 12, 1), "needs_review": False,
        }
        made.append(tuple(values[c] for c in SCORED_SCHEMA.names))
    return spark.createDataFrame(made, SCORED_SCHEMA)


def land(spark, path, *sales):
    rows(spark, *sales).coalesce(1).write.mode("append").parquet(path)


def kept(spark, out):
    event_time.settle(spark, out)
    return sorted(r.transaction_id for r in event_time.read_dedup(spark, out).collect())


def test_dedup_settles_late_keys(spark):
    path = fresh_dir(spark, "dedup")
    silver, out = f"{path}/silver", f"{path}/out"
    land(spark, silver, ("a1", "a", 0, 1.0), ("a2", "a", 0, 1.0), ("n1", None, 0, 1.0), ("b1", "b", 100, 1.0))
    event_time.dedup(spark, silver, out, 10)
    assert kept(spark, out) == ["a1", "b1", "n1"]
    # Day 0 and 89 are behind the watermark (90), day 91 is not; c is new and late, twice.
    land(spark, silver, ("a3", "a", 0, 1.0), ("c1", "c", 89, 1.0), ("c2", "c", 89, 1.0), ("d1", "d", 91, 1.0), ("b2", "b", 100, 1.0), ("n2", None, 1, 1.0))
    event_time.dedup(spark, silver, out, 10)
    assert sorted(r.transaction_id for r in spark.read.parquet(f"{out}/late").collect()) == ["a3", "c1"]
    assert kept(spark, out) == ["a1", "b1", "c1", "d1", "n1", "n2"]
    # Nothing new, and a later copy of a settled key: also the edge of the watermark.
    event_time.dedup(spark, silver, out, 10)
    land(spark, silver, ("c3", "c", 89, 1.0), ("e1", "e", 90, 1.0), ("d2", "d", 91, 1.0))
    event_time.dedup(spark, silver, out, 10)
    assert kept(spark, out) == ["a1", "b1", "c1", "d1", "e1", "n1", "n2"]


def test_state_takes_only_days_within_the_delay(spark):
    """A run over years: days behind all that were seen and late from the next
    run on do not go to the state; late copies of their keys are still found."""
    path = fresh_dir(spark, "closed")
    silver, out = f"{path}/silver", f"{path}/out"

    def ids(name, epoch):
        found = spark.read.parquet(f"{out}/{name}").filter(F.col("epoch") == epoch)
        return sorted(r.transaction_id for r in found.collect())

    land(spark, silver, ("a1", "a", 0, 1.0), ("a2", "a", 0, 1.0), ("b1", "b", 89, 1.0), ("c1", "c", 91, 1.0), ("d1", "d", 100, 1.0))
    event_time.dedup(spark, silver, out, 10)
    assert ids("ontime", 0) == ["c1", "d1"] and ids("closed", 0) == ["a1", "b1"]
    # Day 91 is behind the next watermark, but its keys may be in the state; 101 is not.
    land(spark, silver, ("a3", "a", 0, 1.0), ("b2", "b", 89, 1.0), ("e1", "e", 89, 1.0), ("c2", "c", 91, 1.0), ("f1", "f", 91, 1.0),
         ("g1", "g", 101, 1.0), ("h1", "h", 300, 1.0))
    event_time.dedup(spark, silver, out, 10)
    assert ids("ontime", 1) == ["c2", "f1", "h1"] and ids("closed", 1) == ["g1"] and ids("late", 1) == ["a3", "b2", "e1"]
    land(spark, silver, ("f2", "f", 91, 1.0), ("g2", "g", 101, 1.0), ("h2", "h", 300, 1.0))
    event_time.dedup(spark, silver, out, 10)
    assert kept(spark, out) == ["a1", "b1", "c1", "d1", "e1", "f1", "g1", "h1"]


def test_state_is_in_rocksdb_and_the_setting_is_restored(spark):
    path = fresh_dir(spark, "rocks")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    land(spark, f"{path}/silver", ("a1", "a", 0, 1.0))
    event_time.dedup(spark, f"{path}/silver", f"{path}/out", 10)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    offsets = f"{path}/out/dedup-checkpoint/offsets"
    text = "".join(open(f"{offsets}/{n}").read() for n in os.listdir(offsets) if not n.startswith("."))
    assert event_time.ROCKSDB in text


def test_days_are_final_once(spark):
    path = fresh_dir(spark, "days")
    silver, out = f"{path}/silver", f"{path}/out"
    land(spark, silver, ("a", "x", 0, 1.5), ("b", "x", 0, 2.0), ("c", "x", 50, 1.0))
    event_time.daily_revenue(spark, silver, out, 10)
    land(spark, silver, ("d", "x", 0, 4.0), ("e", "x", 45, 1.0), ("f", "x", 80, 9.0), ("g", "x", 39, 0.5))
    event_time.daily_revenue(spark, silver, out, 10)
    land(spark, silver, ("h", "x", 45, 0.25), ("i", "x", 120, 1.0))
    event_time.daily_revenue(spark, silver, out, 10)
    days = spark.read.parquet(f"{out}/days").collect()
    assert max(Counter((r.source_system, r.transaction_date) for r in days).values()) == 1
    got = {(r.transaction_date - dt.date(2024, 1, 1)).days: (r.transactions, r.revenue) for r in event_time.read_daily_revenue(spark, out).collect()}
    assert got == {0: (3, 7.5), 39: (1, 0.5), 45: (2, 1.25), 50: (1, 1.0), 80: (1, 9.0)}


def test_no_row_is_lost_in_many_runs(spark):
    """Rows of the fixtures in random order: final days and corrections add up
    to the batch aggregate, whatever came late."""
    main = Medallion(spark, SF_SMALL).stored_main
    path = fresh_dir(spark, "many")
    silver, out = f"{path}/silver", f"{path}/out"
    for i in range(4):
        main.filter(F.pmod(F.xxhash64("transaction_id"), F.lit(4)) == i).write.mode("append").parquet(silver)
        event_time.daily_revenue(spark, silver, out)
    assert spark.read.parquet(f"{out}/late").count() > 0
    sold = event_time._sold(main).groupBy("source_system", F.to_date(event_time.DAY).alias("transaction_date"))
    want = {(r[0], r[1]): (r.n, r.revenue) for r in sold.agg(F.count(F.lit(1)).alias("n"), exact_sum("total_amount").alias("revenue")).collect()}
    last = max(d for _, d in want) - dt.timedelta(days=event_time.DELAY_DAYS)
    final = {k: v for k, v in want.items() if k[1] + dt.timedelta(days=1) <= last}
    got = {(r[0], r[1]): (r.transactions, r.revenue) for r in event_time.read_daily_revenue(spark, out).collect()}
    assert got == final
