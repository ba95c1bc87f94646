"""Table maintenance and streaming: behaviour beyond row content."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.operators import maintenance
from tributary.plans.medallion import Medallion
from tributary.session import fresh_dir
from tributary.sources.catalog import file_inventory
from tributary.streaming import incremental

from conftest import SF_SMALL


def test_snapshot_versions_and_time_travel(spark):
    t = maintenance.SnapshotTable(spark, fresh_dir(spark, "t-snap"))
    a = spark.range(10).withColumn("v", F.lit("a"))
    b = spark.range(5).withColumn("v", F.lit("b"))
    assert t.publish(a, "WRITE") == 0
    assert t.publish(b, "OVERWRITE") == 1
    assert t.read(0).count() == 10 and t.read().count() == 5
    hist = [(r.version, r.operation, r.num_rows) for r in t.history().collect()]
    assert hist == [(1, "OVERWRITE", 5), (0, "WRITE", 10)]
    diff = t.diff(0, 1).groupBy("change").count().collect()
    assert {r.change: r["count"] for r in diff} == {"added": 5, "removed": 10}
    t.publish(b.withColumn("extra", F.lit(1)), "EVOLVE")
    assert t.read().columns == ["id", "v", "extra"] and t.read(0).columns == ["id", "v"]


def test_stream_dedup_keeps_late_rows(spark):
    """Three runs on one checkpoint; a row far behind with a new key stays."""
    out = fresh_dir(spark, "t-late")
    cols = ["transaction_id", "transaction_date", "customer_id", "product_id", "quantity", "unit_price", "store_id",
            "status", "payment_method", "source_system", "ingestion_timestamp", "source_file", "total_amount", "quality_tier"]

    def land(rows):
        made = [(i, d, c, "P", 1, 1.0, "S", "completed", "cash", "pos", f"{d} 12:00:00", "f", 1.0, "high") for i, d, c in rows]
        df = spark.createDataFrame(made, cols)
        df = df.withColumn("transaction_date", F.col("transaction_date").cast("timestamp"))
        df = df.withColumn("ingestion_timestamp", F.col("ingestion_timestamp").cast("timestamp"))
        df.coalesce(1).write.mode("append").parquet(f"{out}/in")
        incremental.stream_dedup(spark, f"{out}/in", f"{out}/sink", f"{out}/ck")
        incremental.stream_revenue(spark, f"{out}/in", f"{out}/rev", f"{out}/ck-rev")
        return {r.transaction_id for r in spark.read.parquet(f"{out}/sink").collect()}

    assert land([("A", "2024-03-01", "c1"), ("N", "2024-03-01", None)]) == {"A", "N"}
    assert land([("A2", "2024-03-20", "c1"), ("B", "2024-03-01", "c1")]) == {"A", "N", "A2"}
    assert land([("LATE", "2024-03-02", "c9"), ("C", "2024-03-20", "c1")]) == {"A", "N", "A2", "LATE"}
    days = {str(r.transaction_date): (r.transactions, r.revenue) for r in incremental.read_revenue(spark, f"{out}/rev").collect()}
    assert days == {"2024-03-01": (3, 3.0), "2024-03-02": (1, 1.0), "2024-03-20": (2, 2.0)}


def test_string_clustering_uses_whole_values(spark):
    df = spark.range(20000).select(F.format_string("CUST-%08d", F.col("id") * 7919 % 20000).alias("c"), "id")
    path = fresh_dir(spark, "t-strings")
    maintenance.cluster(df, ["c"], num_files=8).write.parquet(path)
    back = spark.read.parquet(path).withColumn("f", F.col("_metadata.file_path"))
    spans = back.groupBy("f").agg((F.max("c").substr(6, 8).cast("int") - F.min("c").substr(6, 8).cast("int")).alias("s"))
    assert spans.agg(F.avg("s")).first()[0] < 20000 / 4


def test_compaction_reduces_files_and_keeps_rows(spark):
    t = maintenance.SnapshotTable(spark, fresh_dir(spark, "t-compact"))
    df = spark.range(20000).withColumn("x", F.col("id") % 7)
    t.publish(df.repartition(40), "WRITE")
    out = maintenance.compact(t, target_file_bytes=1 << 20)
    assert out["files_before"] == 40 and out["files_after"] < out["files_before"]
    assert t.read().exceptAll(df).count() == 0 and df.exceptAll(t.read()).count() == 0


def test_string_clustering_of_long_and_missing_values(spark):
    """Strings far over the quantiles' length, NULLs, and one value only."""
    rows = [(None if i % 7 == 0 else f"{i % 50:03d}" + "x" * 5000,) for i in range(1000)]
    path = fresh_dir(spark, "t-long-strings")
    maintenance.cluster(spark.createDataFrame(rows, "c string"), ["c"], num_files=5).write.parquet(path)
    back = spark.read.parquet(path)
    assert back.count() == 1000 and back.filter("c IS NULL").count() == 143
    files = back.groupBy(F.col("_metadata.file_path")).agg(F.count_distinct("c").alias("n"))
    assert files.agg(F.max("n")).first()[0] < 50
    one = spark.createDataFrame([("same",)] * 20, "c string")
    assert maintenance.cluster(one, ["c"], num_files=2).count() == 20
    assert maintenance.cluster(one.selectExpr("nullif(c, 'same') AS c"), ["c"], num_files=2).count() == 20


def test_zorder_clusters_both_columns(spark):
    """After clustering, each file covers a narrower range of either column
    than random placement does."""
    df = spark.range(40000).select(
        (F.col("id") % 200).alias("a"), ((F.col("id") * 7919) % 200).alias("b"), "id"
    )
    def mean_span(frame):
        path = fresh_dir(spark, "t-z")
        frame.write.parquet(path)
        back = spark.read.parquet(path).withColumn("f", F.col("_metadata.file_path"))
        spans = back.groupBy("f").agg(
            (F.max("a") - F.min("a")).alias("sa"), (F.max("b") - F.min("b")).alias("sb")
        )
        r = spans.agg(F.avg("sa"), F.avg("sb")).first()
        return r[0], r[1]

    random_a, random_b = mean_span(df.repartition(8))
    z_a, z_b = mean_span(maintenance.cluster(df, ["a", "b"], num_files=8))
    assert z_a < random_a * 0.75 and z_b < random_b * 0.75
    assert maintenance.cluster(df, ["a", "b"], 8).exceptAll(df).count() == 0


def test_cluster_splits_a_hot_value(spark):
    df = spark.range(20000).select(F.lit(1).alias("a"), F.lit(2).alias("b"), "id")
    path = fresh_dir(spark, "t-hot")
    maintenance.cluster(df, ["a", "b"], num_files=8).write.parquet(path)
    inv = file_inventory(spark.read.parquet(path)).first()
    assert inv["file_count"] > 1


def test_schema_evolution_merges_columns(spark):
    path = fresh_dir(spark, "t-evolve")
    maintenance.append_evolving(spark.range(3).withColumn("a", F.lit(1)), path)
    maintenance.append_evolving(spark.range(2).withColumn("a", F.lit(2)).withColumn("b", F.lit("x")), path)
    back = maintenance.read_merged(spark, path)
    assert set(back.columns) == {"id", "a", "b"}
    assert back.filter(F.col("b").isNull()).count() == 3


def test_stream_silver_equals_batch(spark):
    m = Medallion(spark, SF_SMALL)
    m.bronze
    from tributary.sources.landing import bronze_root

    root = bronze_root(spark, SF_SMALL)
    out = fresh_dir(spark, "t-stream")
    paths = {n: f"{root}/{n}" for n in ("pos", "ecommerce", "mobile")}
    incremental.stream_silver(spark, paths, f"{out}/sink", f"{out}/ck", max_files_per_trigger=1)
    streamed = spark.read.parquet(f"{out}/sink").select(*m.scored.columns)
    assert streamed.exceptAll(m.scored).count() == 0
    assert m.scored.exceptAll(streamed).count() == 0
    # A second run finds nothing new: the checkpoint tracks processed files.
    incremental.stream_silver(spark, paths, f"{out}/sink", f"{out}/ck", max_files_per_trigger=1)
    assert spark.read.parquet(f"{out}/sink").count() == m.scored.count()


def test_upsert_latest_change_wins(spark):
    cur = spark.createDataFrame([("a", 1, "old"), ("b", 1, "keep")], "k string, t int, v string")
    chg = spark.createDataFrame([("a", 2, "new"), ("c", 1, "add"), ("b", 1, "tie")], "k string, t int, v string")
    got = {r.k: r.v for r in incremental.upsert_latest(cur, chg, ["k"], ["t"]).collect()}
    assert got == {"a": "new", "b": "tie", "c": "add"}


def test_partial_compaction_leaves_packed_partitions_alone(spark):
    import os

    path = fresh_dir(spark, "t-crowded")
    rows = spark.range(3000).selectExpr("id", "cast(id % 3 as string) as part", "repeat('x', 20) as v")
    for part, files in (("0", 12), ("1", 1), ("2", 5)):
        rows.filter(f"part = '{part}'").repartition(files).write.mode("append").partitionBy("part").parquet(path)

    def files(part):
        folder = f"{path}/part={part}"
        return {n: os.stat(f"{folder}/{n}").st_mtime_ns for n in os.listdir(folder) if n.endswith(".parquet")}

    packed = files("1")
    done = maintenance.compact_partitions(spark, path, "part", f"{path}-work")
    assert done == {"0": (1, 12), "2": (1, 5)}
    assert files("1") == packed and len(files("0")) == len(files("2")) == 1
    back = spark.read.parquet(path).selectExpr("id", "cast(part as string) as part", "v")
    assert back.exceptAll(rows).count() == 0 and back.count() == 3000
    assert maintenance.compact_partitions(spark, path, "part", f"{path}-work") == {}
    # Several files where the bytes need them.
    assert maintenance.compact_partitions(spark, path, "part", f"{path}-work", 2000) == {}


def _exchanges(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_are_not_exchanged(spark):
    """Joins and groupings by the bucket key shuffle the other side only."""
    from tributary.operators import dedup
    from tributary.sources import catalog
    from tributary.streaming.incremental import upsert_latest

    path = fresh_dir(spark, "t-buckets")
    rows = spark.range(4000).selectExpr(
        "if(id % 2 = 0, 'pos', 'mobile') as source_system", "concat('T', id) as transaction_id", "id as v", "concat('C', id % 50) as customer_id",
        "concat('P', id % 7) as product_id", "date_add(date'2024-01-01', cast(id % 9 as int)) as dedup_day",
    )
    name = f"silver.t_{path.rsplit('-', 1)[1]}"
    stored = catalog.bucketed_table(rows, name, path, ["source_system", "transaction_id"], 8)
    changes = rows.filter("v % 10 = 0").withColumn("v", F.col("v") + 1)
    out = upsert_latest(stored, changes, ["source_system", "transaction_id"], ["v"])
    plan = _exchanges(out)
    below = plan.split("Bucketed: true")
    assert len(below) >= 3  # both readings of the table use its buckets
    for part in below[:-1]:
        last = part[part.rindex("SortMergeJoin"):]
        stored_side = last[last.index("+-"):].split("FileScan")[0]
        assert "Exchange" not in stored_side
    assert out.count() == 4000 and out.agg(F.sum("v")).first()[0] == sum(range(4000)) + 400
    keyed = catalog.bucketed_table(rows, f"{name}_k", f"{path}-k", ["customer_id", "product_id", "dedup_day"], 8)
    assert "Exchange" not in _exchanges(dedup.several_channels(keyed, ["customer_id", "product_id", "dedup_day"]))
