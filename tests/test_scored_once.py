"""Feeds are cleaned and scored once for each use, by compiled code."""

from __future__ import annotations

from pyspark.sql import functions as F

from test_sizing import tables
from tributary.operators import maintenance, quality
from tributary.plans import queries
from tributary.plans.medallion import Medallion
from tributary.session import apply_runtime_conf, fresh_dir
from tributary.sources import fixtures


def filters(df):
    shown = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    return [line for line in shown if line.lstrip(" :+-").startswith("Filter")]


def cleans(df):
    """Whether the plan cleans feeds: only their date parser knows this pattern."""
    return "'T'HH:mm:ss" in df._jdf.queryExecution().optimizedPlan().toString()


def test_the_tier_filter_stays_above_the_scoring(spark):
    m = Medallion(spark, tables(spark))
    for rows in (m.main, m.rejected):
        assert rows.columns == m.scored.columns
        assert filters(rows) and not any("'T'HH:mm:ss" in f or "CASE WHEN" in f for f in filters(rows))
    whole = m.scored.count()
    assert m.main.count() + m.rejected.count() == whole > m.main.count() == m.scored.filter("quality_tier <> 'rejected'").count()


def test_the_tier_filter_of_a_stored_table_leaves_out_folders(spark):
    path = fresh_dir(spark, "tiers")
    spark.createDataFrame([("high", 1), ("rejected", 2)], "quality_tier string, v int").write.partitionBy("quality_tier").parquet(path)
    main, _ = quality.split_rejected(spark.read.parquet(path))
    assert "PartitionFilters: [isnotnull(quality_tier" in main._jdf.queryExecution().executedPlan().toString()


def test_versions_and_upsert_read_stored_rows(spark, monkeypatch):
    """neither the versions nor the parts of the upsert score the feeds again."""
    root, seen = tables(spark), []
    publish = maintenance.SnapshotTable.publish
    monkeypatch.setattr(maintenance.SnapshotTable, "publish", lambda t, df, op="WRITE": seen.append(cleans(df)) or publish(t, df, op))
    assert queries.REGISTRY["snapshot_diff"](spark, root).count() >= 0
    assert seen == [False] * 3
    upsert = queries.REGISTRY["incremental_upsert"](spark, root)
    assert not cleans(upsert) and upsert.count() > 0


def test_generated_methods_are_small_enough_to_be_compiled(spark):
    apply_runtime_conf(spark)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_padding(spark):
    numbers = [0, 7, 12345, 123456, -5, -123456, None]
    found = spark.createDataFrame([(n,) for n in numbers], "n long").select(fixtures.pad(F.col("n"), 5), F.format_string("%05d", "n")).collect()
    assert [r[0] for r in found] == [r[1] for r in found] == ["00000", "00007", "12345", "123456", "-0005", "-123456", " null"]
