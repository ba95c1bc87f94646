"""Shuffle sizing from measured input bytes.

Shuffle partitions are sized so that each holds about ``target_bytes`` of
shuffled data when the run starts; AQE then coalesces small partitions and
splits skewed ones at runtime. The input size comes from file-system
metadata (a content summary per folder on the driver), not from a job.
"""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

# Stored bytes of the driver tables behind a partition. What the feeds derived
# from them shuffle is several times as large, and larger still in memory.
TABLE_BYTES = 16 * 1024 * 1024
TABLES = ("orders", "lineitem", "events")
TARGET_PARTITION_BYTES = 256 * 1024 * 1024
# Parquet expands when decoded and shuffled as rows.
ROW_EXPANSION = 3.0


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        if fs.exists(hp):
            total += fs.getContentSummary(hp).getLength()
    return int(total)


def partitions_for(spark: SparkSession, sf_dir: str, target_bytes: int = TABLE_BYTES) -> int:
    """Partitions of what is derived from the tables in ``sf_dir``, by their bytes."""
    size = input_bytes(spark, [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in TABLES])
    return max(1, math.ceil(size / target_bytes))


def tune_tables(spark: SparkSession, sf_dir: str) -> int:
    """Raise ``spark.sql.shuffle.partitions`` to fit the tables, so that a
    task's share stays the same as they grow; it is never lowered."""
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), partitions_for(spark, sf_dir))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n


def tune_shuffle(
    spark: SparkSession, paths: list[str], target_bytes: int = TARGET_PARTITION_BYTES
) -> int:
    """Raise ``spark.sql.shuffle.partitions`` to fit the input (never lower
    it below the configured value or the cluster's cores)."""
    try:
        size = input_bytes(spark, paths)
    except Exception:  # noqa: BLE001 - no JVM handle: keep the configured value
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = math.ceil(size * ROW_EXPANSION / target_bytes)
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        cores = spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001
        cores = 1
    n = max(current, cores, wanted)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes))
    return n
