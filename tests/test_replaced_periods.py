"""Periods are replaced: only rows whose duplicate key has changed are flagged again."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from test_changes import apply, check_gold, lake, landing_files, stored  # noqa: F401
from tributary.operators import dedup
from tributary.plans import pipeline
from tributary.schemas import SCORED_COLUMNS
from tributary.session import fresh_dir
from tributary.sources import catalog


def flags(rows):
    return sorted((r.transaction_id, r.source_system, r.is_duplicate, r.duplicate_resolution) for r in rows.collect())


def test_only_changed_keys_are_flagged_again(spark, lake):  # noqa: F811
    """the other rows of a period pass by with their flags."""
    first = {r.transaction_id: r.asDict() for r in stored(spark, lake).collect()}["MTX-1"]
    same = {"source_system": "ecommerce", **{c: first[c] for c in ("customer_id", "product_id", "transaction_date", "quality_tier")}}
    apply(spark, lake, "b1", ("I", 1, "E-1", same))
    found = {r.transaction_id: r.duplicate_resolution for r in stored(spark, lake).collect()}
    assert found["E-1"] == dedup.KEPT and found["MTX-1"] == dedup.SUPERSEDED
    again = spark.read.parquet(f"{lake.base}/silver/_changes/b1/rows")
    assert sorted(r.transaction_id for r in again.collect()) == ["E-1", "MTX-1"]
    check_gold(spark, lake)
    # The channel's row goes: the one that it had superseded counts again.
    rows = stored(spark, lake).filter("transaction_id = 'E-1'").select(F.lit("D").alias("op"), F.lit(2).cast("long").alias("seq"), *SCORED_COLUMNS)
    pipeline.apply_changes(spark, lake.base, rows, "b2", report_date="2024-06-02")
    whole = fresh_dir(spark, "whole")
    stored(spark, lake).select(*SCORED_COLUMNS).write.parquet(whole)
    assert flags(stored(spark, lake)) == flags(dedup.flag_duplicates(spark.read.parquet(whole)))
    assert "E-1" not in {r.transaction_id for r in stored(spark, lake).collect()}
    check_gold(spark, lake)


def test_an_increment_flags_what_it_touches(spark, lake, landing_files):  # noqa: F811
    """of the periods' rows only those with a key of the batch are read again."""
    before = stored(spark, lake).count()
    batch = {**landing_files, "mobile": fresh_dir(spark, "one-sale")}
    spark.read.parquet(landing_files["mobile"]).filter("transaction_id = 'MTX-2'").withColumn("transaction_id", F.lit("MTX-700")).write.parquet(batch["mobile"])
    for _ in range(2):  # a retry gives the same
        pipeline.run_increment(spark, lake.base, batch, ingestion_ts="2024-06-01 00:00:00", report_date="2024-06-02", batch="i1")
        again = spark.read.parquet(f"{lake.base}/silver/_increments/i1/rows")
        assert {r.transaction_id for r in again.filter("source_system = 'mobile'").collect()} == {"MTX-2", "MTX-700"}
        new = spark.read.parquet(f"{lake.base}/silver/unified_scored").filter("batch = 'i1' AND quality_tier <> 'rejected'").count()
        assert stored(spark, lake).count() == before + new
        check_gold(spark, lake)


def test_partitions_are_moved_not_copied(spark):
    path = fresh_dir(spark, "moved")
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "p string, v int")
    rows.coalesce(1).write.partitionBy("p").parquet(f"{path}/table")
    spark.createDataFrame([("b", 5), ("d", 6)], "p string, v int").coalesce(1).write.partitionBy("p").parquet(f"{path}/ready")
    names = {n for f in ("b", "d") for n in os.listdir(f"{path.removeprefix('file://')}/ready/p={f}")}
    catalog.replace_partitions(spark, f"{path}/table", "p", ["b", "c", "x"], f"{path}/ready")
    assert sorted(tuple(r) for r in spark.read.parquet(f"{path}/table").select("p", "v").collect()) == [("a", 1), ("b", 5), ("d", 6)]
    assert {n for f in ("b", "d") for n in os.listdir(f"{path.removeprefix('file://')}/table/p={f}")} == names
