"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.session import fresh_dir

# The only letters that the contracts lower-case.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

# Rows and bytes of one Arrow batch: the unit of memory of a Python task.
BATCH_ROWS = 2000
BATCH_BYTES = 16 * 1024 * 1024

# Spark deletes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare(spark: SparkSession) -> None:
    """Session settings of the Arrow operators: batches bounded by bytes, too."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def lower_az(col: Column) -> Column:
    """Lower-case A-Z only, in the JVM."""
    return F.translate(col, UPPER, LOWER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str, path: str | None = None, *by: str) -> DataFrame:
    """Write ``df`` to the shared folder (at ``path``, a new one by default; in a
    folder for each value of ``by``) and read it back.

    Cuts the lineage: a lost executor costs the tasks that ran on it, and what
    the table holds is not computed again. The shuffle files behind it are of
    no more use and go as soon as it is written.
    """
    spark = df.sparkSession
    path = path or fresh_dir(spark, label)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.partitionBy(*by).option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *bases: str) -> list[str]:
    """Column names that ``df`` does not have (whatever their case), one for
    each base: helper columns beside a user's own."""
    taken = {c.lower() for c in df.columns}
    found = []
    for base in bases:
        name = base
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def partitions(spark: SparkSession, n_bytes: int, target: int) -> int:
    """Number of partitions of about ``target`` bytes, at least the configured one."""
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(configured, math.ceil(n_bytes / target))


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """Texts of a batch; null counts as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def groups_of(batches: Iterable[pa.RecordBatch], limit: int, name: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of the batches of at most ``limit`` bytes of text (or one row)."""
    for batch in batches:
        n, start, total = batch.num_rows, 0, 0
        lengths = pc.binary_length(batch.column(name)).to_pylist()
        for i in range(n):
            size = lengths[i] or 0
            if i > start and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if n > start:
            yield batch.slice(start, n - start)
