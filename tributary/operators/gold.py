"""Gold tables and reports.

All are grouped aggregates over the silver table: partial aggregation runs
before the shuffle, so a hot group (one channel-day, one constant store) is
combined map-side and only per-task partial rows move. Distinct counts are
exact (the original uses COUNT(DISTINCT)); Spark plans several of them as one
Expand + two aggregation stages, which spreads a hot group over the distinct
values instead of one task. Sums and averages use the exact helpers, so the
numbers do not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions.exact import exact_avg, exact_sum, half_up_avg, half_up_avg_int, int_avg
from tributary.operators.quality import USABLE_TIERS


def usable(df: DataFrame) -> DataFrame:
    """High and medium tier rows that are not superseded duplicates."""
    out = df.filter(F.col("quality_tier").isin(USABLE_TIERS))
    if "is_duplicate" in df.columns:
        out = out.filter(~F.col("is_duplicate"))
    return out


def revenue_by_source(deduped: DataFrame) -> DataFrame:
    """G1: per channel and day."""
    rows = usable(deduped).filter(
        F.col("transaction_date").isNotNull() & F.col("total_amount").isNotNull()
    )
    return rows.groupBy(
        "source_system", F.to_date("transaction_date").alias("transaction_date")
    ).agg(
        F.count_distinct("transaction_id").alias("transaction_count"),
        F.count_distinct("customer_id").alias("unique_customers"),
        exact_sum("total_amount").alias("total_revenue"),
        exact_avg("total_amount").alias("avg_transaction_value"),
        F.sum("quantity").alias("total_items_sold"),
        F.count_distinct("product_id").alias("unique_products"),
    )


def product_performance(deduped: DataFrame) -> DataFrame:
    """Per product and channel."""
    rows = usable(deduped).filter(F.col("product_id").isNotNull())
    return rows.groupBy("product_id", "source_system").agg(
        F.count(F.lit(1)).alias("times_sold"),
        F.sum("quantity").alias("total_quantity_sold"),
        exact_sum("total_amount").alias("total_revenue"),
        half_up_avg("unit_price", 2).alias("avg_unit_price"),
    )


def data_quality_metrics(silver_main: DataFrame) -> DataFrame:
    """Per channel and tier over the production table (before dedup)."""
    return silver_main.groupBy("source_system", "quality_tier").agg(
        F.count(F.lit(1)).alias("record_count"),
        half_up_avg_int("quality_score", 1).alias("avg_quality_score"),
    )


def executive_summary(deduped: DataFrame, report_date: str) -> DataFrame:
    """One row. ``report_date`` is a parameter (the original used the
    current date, which makes the table unreproducible)."""
    return usable(deduped).agg(
        F.count_distinct("transaction_id").alias("total_transactions"),
        F.count_distinct("customer_id").alias("unique_customers"),
        exact_sum("total_amount").alias("total_revenue"),
        half_up_avg("total_amount", 2).alias("avg_transaction_value"),
        half_up_avg_int("quality_score", 1).alias("avg_data_quality"),
    ).select(
        F.to_date(F.lit(report_date)).alias("report_date"),
        "total_transactions",
        "unique_customers",
        "total_revenue",
        "avg_transaction_value",
        "avg_data_quality",
    )


def channel_revenue(revenue: DataFrame) -> DataFrame:
    """The documented report over G1. ``transactions`` counts G1 rows
    (channel-days), as the documented query does."""
    return (
        revenue.groupBy("source_system")
        .agg(exact_sum("total_revenue").alias("revenue"), F.count(F.lit(1)).alias("transactions"))
        .orderBy(F.col("revenue").desc())
    )


def quality_trends(silver_main: DataFrame) -> DataFrame:
    """Records and unrounded average score per channel and tier."""
    return silver_main.groupBy("source_system", "quality_tier").agg(
        F.count(F.lit(1)).alias("records"), int_avg("quality_score").alias("avg_score")
    )


def daily_quality_report(silver_main: DataFrame, report_date: str) -> DataFrame:
    """G6 restricted to rows transformed on ``report_date``."""
    day = F.to_date("transformation_timestamp") == F.to_date(F.lit(report_date))
    return quality_trends(silver_main.filter(day))


def quality_trend(silver_main: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Average score per transformation day since ``as_of - days``."""
    since = F.date_sub(F.to_date(F.lit(as_of)), days).cast("timestamp")
    return (
        silver_main.filter(F.col("transformation_timestamp") >= since)
        .groupBy(F.to_date("transformation_timestamp").alias("date"))
        .agg(int_avg("quality_score").alias("avg_score"))
        .orderBy("date")
    )
