"""Unknown JSON fields, widened types, committed versions, footer counts."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from tributary.operators import maintenance
from tributary.schemas import ECOMMERCE_SCHEMA
from tributary.session import fresh_dir
from tributary.sources import catalog, semistructured

LINES = [
    '{"orderId":"1","totalAmount":2.5,"gift":true,"customer":{"customerId":"c","tier":{"a":[1,null]}}}',
    '{"orderId":"2","lineItems":[{"productId":"p"},{"productId":"q","colour":"red"}],"shipping":{"address":{"city":"x","zip":"007"}}}',
    '{"orderId":"3","lineItems":[{"productId":"p"}],"customer":null,"gift":null}',
    '{"orderId":"4","customer":"no object","lineItems":{"neither":1},"customer.tier":"dotted"}',
    '{"orderId":"5","Customer":{"customerId":"case"}}',
    '{"orderId": "6", "cust',
    "[1, 2]",
    "   ",
    '{"orderId":"7","orderId":"8"}',
]


def landed(spark, lines):
    path = fresh_dir(spark, "lines")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(2).write.text(path)
    return semistructured.read_ecommerce(spark, path, "2024-01-01 00:00:00")


def test_unknown_fields_stay_at_every_depth(spark, ansi):
    rows = landed(spark, LINES).select("orderId", F.to_json("extra").alias("extra"), "_corrupt_record", "source_format").collect()
    extra = {r.orderId: json.loads(r.extra) if r.extra else None for r in rows if r._corrupt_record is None}
    assert extra["1"] == {"gift": True, "customer": {"tier": {"a": [1, None]}}}
    assert extra["2"] == {"lineItems": [{}, {"colour": "red"}], "shipping": {"address": {"zip": "007"}}}
    assert extra["3"] == {"gift": None}
    assert extra["5"] == {"Customer": {"customerId": "case"}}
    broken = {r._corrupt_record for r in rows if r._corrupt_record is not None}
    assert {LINES[5], LINES[6], LINES[8]} <= broken
    assert len(rows) == len(LINES) - 1 and {r.source_format for r in rows} == {"json"}


def test_promote_and_discover(spark):
    path = fresh_dir(spark, "extra")
    landed(spark, LINES).write.parquet(path)
    stored = spark.read.parquet(path)
    got = semistructured.promote(
        stored, {"gift": ("$.gift", "boolean"), "zip": ("$.shipping.address.zip", "string"), "bad": ("$.gift", "int")}
    )
    assert {r.orderId: (r.gift, r.zip) for r in got.collect() if r.orderId in ("1", "2", "3")} == {
        "1": (True, None), "2": (None, "007"), "3": (None, None),
    }
    found = {r.field: (r.type, r.records) for r in semistructured.discovered(stored).collect()}
    assert found["gift"] == ("BOOLEAN", 2) and found["shipping"] == ("OBJECT<address: OBJECT<zip: STRING>>", 1)
    none = stored.limit(0)
    assert semistructured.discovered(none).collect() == []
    assert ECOMMERCE_SCHEMA.names[0] not in found


def test_widening_and_narrowing(spark, ansi):
    path = fresh_dir(spark, "wide")
    maintenance.append_evolving(spark.sql("SELECT 1 AS a, CAST(2 AS FLOAT) AS b, DATE '2024-01-02' AS d, array(struct(1 AS x)) AS s"), path)
    maintenance.append_evolving(spark.sql("SELECT 5000000000 AS a, 2.5D AS b, TIMESTAMP '2024-01-02 03:00:00' AS d, array(struct(7L AS x, 'n' AS y)) AS s, 'new' AS e"), path)
    rows = sorted((tuple(r) for r in maintenance.read_merged(spark, path).collect()), key=lambda r: r[0])
    assert [r[:2] for r in rows] == [(1, 2.0), (5000000000, 2.5)]
    assert rows[0][2].isoformat() == "2024-01-02T00:00:00" and rows[0][4] is None
    assert [tuple(x) for x in rows[0][3]] == [(1, None)] and [tuple(x) for x in rows[1][3]] == [(7, "n")]
    before = len(os.listdir(path))
    for sql in ("SELECT 1 AS a", "SELECT 'x' AS a", "SELECT array(struct('t' AS x)) AS s"):
        with pytest.raises(maintenance.NarrowingError, match="not wider"):
            maintenance.append_evolving(spark.sql(sql), path)
    assert len(os.listdir(path)) == before
    maintenance.append_evolving(spark.sql("SELECT CAST(9 AS BIGINT) AS a"), path)
    assert maintenance.read_merged(spark, path).count() == 3


def test_a_batch_that_was_cut_off_is_not_read(spark):
    path = fresh_dir(spark, "cut")
    maintenance.append_evolving(spark.range(3), path)
    maintenance.append_evolving(spark.range(4), path)
    os.remove(f"{path}/append=1/_SUCCESS")
    assert maintenance.read_merged(spark, path).count() == 3
    maintenance.append_evolving(spark.range(5), path)
    assert maintenance.read_merged(spark, path).count() == 8


def test_a_version_that_was_cut_off_is_none(spark):
    table = maintenance.SnapshotTable(spark, fresh_dir(spark, "versions"))
    with pytest.raises(ValueError, match="no version"):
        table.read()
    table.publish(spark.range(5))
    table.publish(spark.range(6))
    os.remove(f"{table.version_path(1)}/operation=WRITE/_SUCCESS")
    os.makedirs(f"{table.version_path(2)}/operation=WRITE/_temporary/0")
    assert table.versions() == [0]
    assert table.read().count() == 5
    assert [(r.version, r.num_rows) for r in table.history().collect()] == [(0, 5)]
    with pytest.raises(ValueError, match="no version 1"):
        table.read(1)
    assert table.publish(spark.range(7)) == 3
    assert [(r.version, r.num_rows) for r in table.history().collect()] == [(3, 7), (0, 5)]


def test_counts_come_from_footers(spark):
    path = fresh_dir(spark, "counted")
    spark.range(1000).repartition(3).write.parquet(path)
    df = catalog.counted(spark, {"t": path})
    assert [tuple(r) for r in df.collect()] == [("t", 1000)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and "BatchScan" in plan
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
