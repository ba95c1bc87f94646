"""Pages of an API, and lookups of single ids."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tributary.operators import maintenance
from tributary.schemas import ECOMMERCE_SCHEMA
from tributary.session import fresh_dir
from tributary.sources import paged


def answer(cursor, orders, following=None, attempt=1, status=200, cut=0):
    body = json.dumps({"next": following, "orders": [{"orderId": o, "totalAmount": 1.5, "gift": True} for o in orders]})
    return json.dumps({"cursor": cursor, "attempt": attempt, "status": status, "body": body[: len(body) - cut]})


CLEAN = [answer("a", ["1", "2"], "b"), answer("b", ["3"], "c"), answer("c", [])]


def landed(spark, lines, parts=3):
    root = fresh_dir(spark, "pages")
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(parts).write.text(f"{root}/in")
    return paged.land_pages(spark, f"{root}/in", f"{root}/bronze", "ecommerce", "orders", "2024-01-01 00:00:00")


def bronze(spark, lines):
    rows = paged.records(landed(spark, lines), ECOMMERCE_SCHEMA)
    return sorted((r.orderId, r.totalAmount, r.x) for r in rows.select("orderId", "totalAmount", F.to_json("extra").alias("x")).collect())


@pytest.mark.parametrize(
    "more",
    [
        [answer("b", [], attempt=0, status=503)],
        [answer("b", ["3"], "c", attempt=3, cut=5)],
        [answer("a", ["1", "2"], "b")] * 4,
        [answer("a", ["1"], "x", attempt=0), answer("c", ["9"], attempt=0)],
        ['{"cursor": "a", "atte', "", "[1]", '{"cursor": "b", "attempt": 9, "status": 200}'],
        ['{"attempt": 9, "status": 200, "body": "{\\"orders\\": []}"}'],
    ],
    ids=["busy", "cut", "repeated", "older", "broken", "no cursor"],
)
def test_retries_give_the_same_bronze(spark, ansi, more):
    want = bronze(spark, CLEAN)
    assert want == [(o, 1.5, '{"gift":true}') for o in "123"]
    assert bronze(spark, CLEAN + more) == want
    assert bronze(spark, more + CLEAN[::-1]) == want


def test_the_last_attempt_stands(spark):
    found = bronze(spark, [*CLEAN, answer("b", ["3", "4"], "c", attempt=2)])
    assert [o for o, *_ in found] == ["1", "2", "3", "4"]


def test_page_report_names_what_is_missing(spark):
    lines = [CLEAN[0], CLEAN[0], answer("b", [], attempt=1, status=500), answer("d", ["7"], "e", attempt=0)]
    rows = {r.cursor: (r.responses, r.failed, r.records, r.landed) for r in paged.page_report(landed(spark, lines)).collect()}
    assert rows == {"a": (2, 0, 2, True), "b": (1, 1, 0, False), "d": (1, 0, 1, True), "e": (0, 0, 0, False)}


def test_a_landing_again_replaces_its_batch(spark):
    root = fresh_dir(spark, "pages")
    spark.createDataFrame([(x,) for x in CLEAN], "value string").write.text(f"{root}/in")
    for batch in ("one", "one", "two"):
        stored = paged.land_pages(spark, f"{root}/in", f"{root}/bronze", "ecommerce", "orders", "2024-01-01 00:00:00", batch)
    assert stored.count() == 2 * len(CLEAN)
    assert paged.standing(stored).count() == len(CLEAN)


def test_no_pages(spark):
    stored = landed(spark, [])
    assert paged.records(stored, ECOMMERCE_SCHEMA).count() == 0 == paged.page_report(stored).count()


# -- lookups ---------------------------------------------------------------
def rows_read(df):
    """(rows found, rows that the scan read)."""
    found = df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    scans = plan.collectLeaves()
    return len(found), sum(scans.apply(i).metrics().apply("numOutputRows").value() for i in range(scans.size()))


def test_lookup_leaves_out_row_groups(spark):
    """Ids spread over all files: statistics leave out nothing, filters most."""
    n, files = 40_000, 16
    rows = spark.range(n).select(F.md5(F.col("id").cast("string")).alias("transaction_id"), (F.col("id") % 100).alias("v")).repartition(files)
    plain, filtered = fresh_dir(spark, "plain"), fresh_dir(spark, "filtered")
    rows.write.parquet(plain)
    maintenance.write_with_filters(rows, filtered, ["transaction_id"])
    wanted = [r[0] for r in rows.orderBy(F.xxhash64("transaction_id")).limit(1).select("transaction_id").collect()]
    before = rows_read(maintenance.lookup(spark.read.parquet(plain), "transaction_id", wanted))
    after = rows_read(maintenance.lookup(spark.read.parquet(filtered), "transaction_id", wanted))
    assert before[0] == after[0] == 1
    assert after[1] < before[1] / 4
    none = ["no such id", *(f"{i:032x}" for i in range(30))]
    found, read = rows_read(maintenance.lookup(spark.read.parquet(filtered), "transaction_id", none))
    assert found == 0 and read < n / 2


def test_lookup_of_nothing(spark):
    path = fresh_dir(spark, "filtered")
    maintenance.write_with_filters(spark.createDataFrame([("a", 1), (None, 2)], "transaction_id string, v int"), path, ["transaction_id"])
    stored = spark.read.parquet(path)
    assert maintenance.lookup(stored, "transaction_id", []).count() == 0
    assert [r.v for r in maintenance.lookup(stored, "transaction_id", ["a", "a", "b"]).collect()] == [1]


def test_cluster_of_an_empty_table(spark):
    path = fresh_dir(spark, "empty")
    spark.createDataFrame([], "k string, v long").write.parquet(path)
    assert maintenance.cluster(spark.read.parquet(path), ["k", "v"]).count() == 0
