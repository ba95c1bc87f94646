"""Event-time streams with bounded state.

State that is bounded needs a watermark, and a watermark drops what comes
behind it. So that no row is lost, each run has two steps:

1. ``split`` takes what is new as one micro-batch and parts it by the watermark
   of the runs before: the greatest sale day seen, less the delay. On-time rows
   go to a table that the stateful query streams from, late ones to a side
   table.
2. The stateful query takes the on-time rows. Its own watermark is never ahead
   of the one they were parted by, so it drops none; its state, in RocksDB,
   holds what the delay spans.

A row's event time is its day. All rows of a duplicate key or a window share
it, so they are all on time or, once the watermark has passed, all late.

* ``dedup``: the first arrival of each key at once; late keys are settled by a
  batch job against the months that they touch (``settle``). A run may span far
  more than the delay. Its rows of days that no run before has reached, and that
  are late for every run after it, find no key in the state and leave none that
  is looked up: they are ``closed``, and the state holds the delay's days only.
* ``daily_revenue``: each day is emitted once, when the watermark has passed
  it; late rows are corrections, partial sums that readers add.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import AbstractContextManager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions.exact import merged_sum, sum_parts
from tributary.operators import quality
from tributary.session import settings
from tributary.sources.catalog import folders
from tributary.streaming.incremental import ARRIVAL, KEY, _has_data, _read_stream, _write_epoch, first_arrivals

# Days that a sale may come behind the latest one seen.
DELAY_DAYS = 30
# Event time of a row: the start of its day.
DAY = "event_day"

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def rocksdb(spark: SparkSession) -> AbstractContextManager[None]:
    """Queries that start here keep their state in RocksDB. It does not count
    its keys, which takes a lookup more for each write."""
    prefix = "spark.sql.streaming.stateStore"
    return settings(spark, {f"{prefix}.providerClass": ROCKSDB, f"{prefix}.rocksdb.trackTotalNumberOfRows": "false"})


def _finish(writer) -> None:
    writer.trigger(availableNow=True).start().awaitTermination()


def _latest(spark: SparkSession, out: str, epoch: int):
    """The greatest day of the epochs before; None at first."""
    if not folders(spark, f"{out}/seen", "epoch="):
        return None
    seen = spark.read.schema("day date, epoch int").parquet(f"{out}/seen").filter(F.col("epoch") < epoch)
    return seen.agg(F.max("day")).first()[0]


def split(
    spark: SparkSession,
    silver_path: str,
    out: str,
    prepare: Callable[[DataFrame], DataFrame],
    delay_days: int = DELAY_DAYS,
    span_days: int = 0,
    closing: bool = False,
) -> None:
    """Part the rows that are new since the last run: ``ontime`` and ``late``
    by day, ``undated`` ones apart. ``prepare`` gives the rows with ``DAY``.

    A row is late once the watermark has reached the end of what it belongs to:
    its event time, or ``span_days`` behind it for a window.

    ``closing``: on-time rows of days behind all that runs before have seen, and
    late from the next run on, go to ``closed``, by month.

    A retry of an epoch parts it by the same watermark and replaces its rows.
    """

    def part(batch: DataFrame, epoch: int) -> None:
        rows = prepare(batch).persist()
        try:
            seen = _latest(spark, out, epoch)
            day = F.to_date(DAY)

            def past(latest) -> Column:
                return F.lit(False) if latest is None else F.date_add(day, span_days) <= F.date_sub(F.lit(latest), delay_days)

            late, closed = past(seen), F.lit(False)
            if closing:
                latest = rows.agg(F.max(day)).first()[0]
                closed = past(latest) & (F.lit(True) if seen is None else day > F.lit(seen))
                gone = rows.filter(closed).withColumn("month", _month()).hint("rebalance", "month")
                _write_epoch(gone, f"{out}/closed", epoch, ["month"])
            parts = {"ontime": day.isNotNull() & ~late & ~closed, "late": day.isNotNull() & late, "undated": day.isNull()}
            for name, which in parts.items():
                _write_epoch(rows.filter(which), f"{out}/{name}", epoch, [])
            _write_epoch(rows.agg(F.max(day).alias("day")), f"{out}/seen", epoch, [])
        finally:
            rows.unpersist()

    _finish(
        _read_stream(spark, silver_path, None).writeStream.foreachBatch(part).option("checkpointLocation", f"{out}/split-checkpoint")
    )


def _stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def _event_day() -> Column:
    return F.to_timestamp(F.to_date("transaction_date")).alias(DAY)


# --------------------------------------------------------------------------
# deduplication
# --------------------------------------------------------------------------

def _arrivals(batch: DataFrame) -> DataFrame:
    """One row per key of the micro-batch; those without a whole key, which
    duplicate nothing, without event day."""
    rows = first_arrivals(batch.filter(F.col("quality_tier") != quality.REJECTED))
    whole = F.col("customer_id").isNotNull() & F.col("product_id").isNotNull()
    return rows.withColumn(DAY, F.when(whole, F.to_timestamp("dedup_day")))


def _month() -> Column:
    return F.date_format(DAY, "yyyy-MM").alias("month")


def dedup(spark: SparkSession, silver_path: str, out: str, delay_days: int = DELAY_DAYS) -> None:
    """Take what is new in silver: first arrivals go to ``kept`` or ``closed`` at
    once, late rows to the side table ``late``."""
    split(spark, silver_path, out, _arrivals, delay_days, closing=True)
    if not _has_data(spark, f"{out}/ontime"):
        return
    schema = spark.read.parquet(f"{out}/ontime").schema
    rows = _stream(spark, f"{out}/ontime", schema).withWatermark(DAY, f"{delay_days} days")
    kept = rows.dropDuplicatesWithinWatermark(KEY).drop("epoch").withColumn("month", _month())
    with rocksdb(spark):
        _finish(
            kept.writeStream.format("parquet")
            .option("path", f"{out}/kept")
            .option("checkpointLocation", f"{out}/dedup-checkpoint")
            .partitionBy("month")
        )


def settle(spark: SparkSession, out: str) -> None:
    """The late rows whose key was never kept: its first arrival among them.
    Only the months of late rows are read; a retry replaces the result."""
    if not _has_data(spark, f"{out}/late"):
        return
    late = spark.read.parquet(f"{out}/late")
    columns = [c for c in late.columns if c != "epoch"]
    order = ["epoch", *ARRIVAL, *[c for c in columns if c not in {*KEY, *ARRIVAL}]]
    first = late.groupBy(*KEY).agg(F.min(F.struct(*order)).alias("_row"))
    rows = first.select(*[F.col(c) if c in KEY else F.col(f"_row.{c}").alias(c) for c in columns])
    months = [r[0] for r in rows.select(_month()).distinct().collect()]  # bounded by the calendar
    found = None
    for name in ("kept", "closed"):
        if _has_data(spark, f"{out}/{name}"):
            part = spark.read.parquet(f"{out}/{name}").filter(F.col("month").cast("string").isin(months)).select(*KEY)
            found = part if found is None else found.unionByName(part)
    if found is not None:
        rows = rows.join(found, KEY, "left_anti")
    rows.write.mode("overwrite").parquet(f"{out}/settled")


def read_dedup(spark: SparkSession, out: str) -> DataFrame:
    """What was kept, closed, settled, or never a duplicate."""
    parts = [spark.read.parquet(f"{out}/{n}").drop("month", "epoch", DAY) for n in ("kept", "closed", "settled", "undated") if _has_data(spark, f"{out}/{n}")]
    if not parts:
        raise ValueError(f"no run at {out}")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


# --------------------------------------------------------------------------
# daily revenue
# --------------------------------------------------------------------------

def _sold(batch: DataFrame) -> DataFrame:
    rows = batch.filter(
        F.col("quality_tier").isin(quality.USABLE_TIERS) & F.col("transaction_date").isNotNull() & F.col("total_amount").isNotNull()
    )
    return rows.select("source_system", "total_amount", _event_day())


def daily_revenue(spark: SparkSession, silver_path: str, out: str, delay_days: int = DELAY_DAYS) -> None:
    """Take what is new in silver: days that the watermark has passed are added
    to ``days``, once each; late rows are summed up in ``corrections``."""
    split(spark, silver_path, out, _sold, delay_days, span_days=1)
    if _has_data(spark, f"{out}/late"):
        late = spark.read.parquet(f"{out}/late").groupBy("source_system", F.to_date(DAY).alias("transaction_date"), "epoch")
        late.agg(*sum_parts("total_amount", "total")).write.mode("overwrite").parquet(f"{out}/corrections")
    if not _has_data(spark, f"{out}/ontime"):
        return
    schema = spark.read.parquet(f"{out}/ontime").schema
    rows = _stream(spark, f"{out}/ontime", schema).withWatermark(DAY, f"{delay_days} days")
    days = rows.groupBy(F.window(DAY, "1 day").alias("day"), "source_system").agg(*sum_parts("total_amount", "total"))
    flat = days.select("source_system", F.to_date("day.start").alias("transaction_date"), *[c for c in days.columns if c.startswith("total")])
    with rocksdb(spark):
        _finish(
            flat.writeStream.format("parquet")
            .outputMode("append")
            .option("path", f"{out}/days")
            .option("checkpointLocation", f"{out}/days-checkpoint")
        )


def read_daily_revenue(spark: SparkSession, out: str) -> DataFrame:
    """Revenue of the days that are final, with the corrections so far."""
    parts = [spark.read.parquet(f"{out}/{n}").drop("epoch") for n in ("days", "corrections") if _has_data(spark, f"{out}/{n}")]
    if not parts:
        raise ValueError(f"no final day at {out}")
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows.groupBy("source_system", "transaction_date").agg(
        F.sum("total_n").alias("transactions"), merged_sum("total").alias("revenue")
    )
