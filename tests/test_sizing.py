"""Shuffle sizing and concurrent submission helpers."""

from __future__ import annotations

import pytest

from tributary.plans import queries, sizing
from tributary.plans.concurrent import run_all
from tributary.session import fresh_dir
from tributary.sources import catalog, landing


def test_tune_shuffle_scales_with_bytes_and_never_lowers(spark, monkeypatch):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    old_advisory = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        monkeypatch.setattr(sizing, "input_bytes", lambda s, p: 0)
        assert sizing.tune_shuffle(spark, ["x"]) == max(8, spark.sparkContext.defaultParallelism)
        # 100 GB of Parquet -> about 300 GB of rows -> ~1200 partitions of 256 MB.
        monkeypatch.setattr(sizing, "input_bytes", lambda s, p: 100 * 1024**3)
        n = sizing.tune_shuffle(spark, ["x"])
        assert n == 1200 and spark.conf.get("spark.sql.shuffle.partitions") == "1200"
        monkeypatch.setattr(sizing, "input_bytes", lambda s, p: 10**16)
        assert sizing.tune_shuffle(spark, ["x"]) == 111758709  # no cap
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old_advisory)


def test_input_bytes_reads_file_metadata(spark):
    path = fresh_dir(spark, "t-bytes")
    spark.range(1000).write.parquet(path)
    assert sizing.input_bytes(spark, [path, path + "-missing"]) > 0


def test_run_all_times_jobs_and_raises_errors():
    times = run_all({"a": lambda: 1, "b": lambda: 2})
    assert set(times) == {"a", "b"} and all(t >= 0 for t in times.values())

    def boom():
        raise RuntimeError("job failed")

    with pytest.raises(RuntimeError):
        run_all({"ok": lambda: 1, "bad": boom})


def tables(spark, orders=40):
    """Driver tables of a few rows."""
    root = fresh_dir(spark, "tables")
    day = "timestamp'2024-03-02 00:00:00'"
    spark.range(orders).selectExpr("id o_orderkey", "id o_custkey", "'O' o_orderstatus", "1.0D o_totalprice", f"{day} o_orderdate").write.parquet(f"{root}/orders.parquet")
    spark.range(orders).selectExpr(
        "id l_orderkey", "id l_partkey", "id l_suppkey", "1 l_linenumber", "2.0D l_quantity", "3.0D l_extendedprice", "0.1D l_discount", f"{day} l_shipdate"
    ).write.parquet(f"{root}/lineitem.parquet")
    spark.range(orders).selectExpr("id event_id", f"{day} ts", "id user_id", "'purchase' event_type", "1.0D value").write.parquet(f"{root}/events.parquet")
    return root


def test_partitions_follow_the_tables(spark, monkeypatch):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        monkeypatch.setattr(sizing, "input_bytes", lambda s, p: 3 * 1024**3)
        queries._m(spark, "x")
        assert spark.conf.get("spark.sql.shuffle.partitions") == "192"
        assert queries._buckets(spark, "x") == 192
        monkeypatch.setattr(sizing, "input_bytes", lambda s, p: 0)
        queries._m(spark, "x")
        assert spark.conf.get("spark.sql.shuffle.partitions") == "192" and queries._buckets(spark, "x") == queries.BUCKETS
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_a_query_of_one_feed_lands_that_feed(spark):
    root = tables(spark)
    assert queries.REGISTRY["store_normalize"](spark, root).count() == 42  # two copies
    landed = landing.bronze_root(spark, root)
    assert catalog.exists(spark, f"{landed}/pos") and not catalog.exists(spark, f"{landed}/ecommerce")
    assert queries.REGISTRY["landing_mobile_parquet"](spark, root).count() == 40
    assert not catalog.exists(spark, f"{landed}/ecommerce")
    assert queries.REGISTRY["dedup_stub"](spark, root).count() > 0 and catalog.exists(spark, f"{landed}/ecommerce")


def test_micro_batches_do_not_grow_with_the_files(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(queries.incremental, "stream_silver", lambda *a, **k: seen.append(k["max_files_per_trigger"]))
    root = tables(spark)
    for files in (3, 100):
        monkeypatch.setattr(queries.catalog, "listing", lambda s, p, n=files: (n, 0, 0))
        queries._silver_stream_run(spark, root)
    assert seen == [queries.BATCH_FILES, 7]


def test_pages_do_not_move_for_few_superseded_ones(spark):
    plan = queries.REGISTRY["landing_paged_api"](spark, tables(spark))
    shown = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in shown and plan.count() == 40
