"""Incremental and streaming variants of the batch pipeline.

* ``stream_silver`` — bronze files as a file stream, the same normalisation
  and scoring ``Column`` builders as batch, written to a Parquet sink
  partitioned by tier. ``availableNow`` processes everything present and
  stops, so a scheduled run is an incremental batch with exactly-once file
  tracking from the checkpoint.
* ``stream_dedup`` — first arrival per duplicate key. Each micro-batch is
  reduced to one row per key and joined against the keys kept so far, of the
  months it touches only; the sink itself is the state, so none is held in
  memory, and a row that comes late is kept if its key is new. Channel
  priority needs the whole key group, so it stays a batch operator.
* ``stream_revenue`` — daily revenue per channel as exact partial sums, one
  partition per micro-batch; readers add them up. Nothing is rewritten, so
  readers never miss the table, and late rows count.
* ``upsert_latest`` — change data capture without MERGE: current snapshot
  plus changes, latest version per key by one aggregate (``max_by``), which
  combines map-side so a hot key never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators import normalize, quality
from tributary.operators.dedup import ORDER
from tributary.rules import AS_CODED, CleaningRules


def _read_stream(spark: SparkSession, path: str, max_files: int | None) -> DataFrame:
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def scored_stream(
    spark: SparkSession,
    bronze_paths: dict[str, str],
    rules: CleaningRules = AS_CODED,
    transformation_ts: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    s = {n: _read_stream(spark, p, max_files_per_trigger) for n, p in bronze_paths.items()}
    unified = normalize.unify(
        normalize.normalize_pos(s["pos"], rules),
        normalize.normalize_ecommerce(s["ecommerce"], rules),
        normalize.normalize_mobile(s["mobile"], rules),
    )
    return quality.score(unified, transformation_ts, rules)


def stream_silver(
    spark: SparkSession,
    bronze_paths: dict[str, str],
    sink: str,
    checkpoint: str,
    rules: CleaningRules = AS_CODED,
    transformation_ts: str | None = None,
    max_files_per_trigger: int | None = None,
) -> None:
    """Run bronze -> scored silver over every file present, then stop."""
    scored = scored_stream(spark, bronze_paths, rules, transformation_ts, max_files_per_trigger)
    q = (
        scored.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .partitionBy("quality_tier")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


KEY = ["customer_id", "product_id", "dedup_day"]
# Arrival order of the rows of a key within a micro-batch.
ARRIVAL = ["ingestion_timestamp", "source_system", *ORDER]


def first_arrivals(rows: DataFrame) -> DataFrame:
    """One row per full key, the first by arrival; rows whose key has a NULL
    part are never duplicates and pass through unchanged."""
    dated = rows.withColumn("dedup_day", F.to_date("transaction_date"))
    full = F.col("customer_id").isNotNull() & F.col("product_id").isNotNull() & F.col("dedup_day").isNotNull()
    rest = [c for c in dated.columns if c not in {*KEY, *ARRIVAL}]
    first = (
        dated.filter(full)
        .groupBy(*KEY)
        .agg(F.min(F.struct(*ARRIVAL, *rest)).alias("_row"))
        .select(*[F.col(c) if c in KEY else F.col(f"_row.{c}") for c in dated.columns])
    )
    return first.unionByName(dated.filter(~full))


def _write_epoch(rows: DataFrame, sink: str, epoch: int, parts: list[str]) -> None:
    """The micro-batch's partitions; a retry of it replaces them."""
    writer = rows.withColumn("epoch", F.lit(epoch)).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*parts, "epoch").parquet(sink)


def stream_dedup(
    spark: SparkSession, silver_path: str, sink: str, checkpoint: str, max_files_per_trigger: int | None = None
) -> None:
    """Keep the first arrival of each key over all micro-batches."""
    src = _read_stream(spark, silver_path, max_files_per_trigger).filter(F.col("quality_tier") != quality.REJECTED)
    month = F.coalesce(F.date_format("dedup_day", "yyyy-MM"), F.lit("none"))

    def keep(batch: DataFrame, epoch: int) -> None:
        new = first_arrivals(batch).withColumn("month", month).persist()
        try:
            months = [r[0] for r in new.select("month").distinct().collect()]  # bounded by the calendar
            if _has_data(spark, sink):
                kept = spark.read.parquet(sink).filter(F.col("month").isin(months) & (F.col("epoch") != epoch))
                new_rows = new.join(kept.select(*KEY), KEY, "left_anti")
            else:
                new_rows = new
            _write_epoch(new_rows.select(*new.columns).hint("rebalance", "month"), sink, epoch, ["month"])
        finally:
            new.unpersist()

    q = (
        src.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def _has_data(spark: SparkSession, path: str) -> bool:
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath) and fs.getContentSummary(hpath).getLength() > 0


def revenue_parts(silver: DataFrame) -> DataFrame:
    """Partial channel-day revenue of usable rows: count, exact sum (NULL
    if a value or the sum has none) and plain sum."""
    rows = silver.filter(
        F.col("quality_tier").isin(quality.USABLE_TIERS)
        & F.col("transaction_date").isNotNull()
        & F.col("total_amount").isNotNull()
    )
    return rows.groupBy("source_system", F.to_date("transaction_date").alias("transaction_date")).agg(
        F.count(F.lit(1)).alias("transactions"),
        F.expr(
            "CASE WHEN COUNT(total_amount) = COUNT(TRY_CAST(total_amount AS DECIMAL(38,6))) "
            "THEN TRY_SUM(TRY_CAST(total_amount AS DECIMAL(38,6))) END"
        ).alias("exact"),
        F.sum("total_amount").alias("plain"),
    )


def stream_revenue(
    spark: SparkSession, silver_path: str, sink: str, checkpoint: str, max_files_per_trigger: int | None = None
) -> None:
    """A partition of partial sums per micro-batch."""

    def publish(batch: DataFrame, epoch: int) -> None:
        _write_epoch(revenue_parts(batch), sink, epoch, [])

    q = (
        _read_stream(spark, silver_path, max_files_per_trigger)
        .writeStream.foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def read_revenue(spark: SparkSession, sink: str) -> DataFrame:
    """The revenue of all micro-batches so far."""
    exact = "COUNT(exact) = COUNT(1) AND TRY_SUM(exact) IS NOT NULL"
    return spark.read.parquet(sink).groupBy("source_system", "transaction_date").agg(
        F.sum("transactions").alias("transactions"),
        F.expr(f"CASE WHEN {exact} THEN CAST(TRY_SUM(exact) AS DOUBLE) ELSE SUM(plain) END").alias("revenue"),
    )


def upsert_latest(current: DataFrame, changes: DataFrame, key: list[str], order_by: list[str]) -> DataFrame:
    """The latest row per key over ``current`` and ``changes``; on equal
    ``order_by`` values the change wins."""
    cols = current.columns
    # Only keys that the changes name can have several rows: the others pass.
    named = changes.select(*key).distinct()
    # A snapshot bucketed by key is joined where it lies; only its touched rows
    # and the changes are exchanged.
    old = current.join(named, key, "left_semi").withColumn("_seq", F.lit(0))
    touched = old.unionByName(changes.select(*cols).withColumn("_seq", F.lit(1)))
    order = F.struct(*order_by, "_seq")
    latest = touched.groupBy(*key).agg(F.max_by(F.struct(*cols), order).alias("_row"))
    untouched = current.join(named, key, "left_anti")
    return untouched.select(*cols).unionByName(latest.select(*[F.col(f"_row.{c}").alias(c) for c in cols]))
