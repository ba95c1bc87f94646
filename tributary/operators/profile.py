"""Bronze profiling.

The original profile re-counted the table once per column and printed from a
driver loop. Here each profile is one aggregate: every counter is a
conditional ``count`` in the same pass, unpivoted into rows afterwards.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions.prices import price_is_conforming

# Tokens that mean "missing" in landing text, and the columns
# the missing-value profile covers.
MISSING_TOKENS = ["NULL", "N/A"]
PROFILED_COLUMNS = ["TRANS_ID", "CUST_NUM", "PRODUCT_CODE", "PRICE", "TRANS_DATE"]


def is_missing(name: str):
    c = F.col(name)
    return c.isNull() | (c == "") | c.isin(MISSING_TOKENS)


def missing_profile(bronze: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing count and percentage per column, from one aggregate."""
    columns = columns or PROFILED_COLUMNS
    counts = bronze.agg(
        F.count(F.lit(1)).alias("total_records"),
        *[F.count(F.when(is_missing(c), 1)).alias(c) for c in columns],
    )
    return counts.unpivot(["total_records"], columns, "column_name", "missing_count").select(
        "column_name",
        "missing_count",
        "total_records",
        (F.col("missing_count") / F.col("total_records") * F.lit(100)).alias("missing_pct"),
    )


def date_variants(bronze: DataFrame, column: str = "TRANS_DATE") -> DataFrame:
    """Distinct non-empty date spellings."""
    c = F.col(column)
    return bronze.select(column).filter(c.isNotNull() & (c != "")).distinct()


def value_frequency(bronze: DataFrame, column: str = "STATUS") -> DataFrame:
    """Rows per raw value, most frequent first."""
    return bronze.groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(
        F.col("count").desc()
    )


def price_nonconforming(bronze: DataFrame) -> DataFrame:
    """Rows whose price text is not a plain number, or is NULL."""
    return bronze.filter(~price_is_conforming("PRICE")).select("TRANS_ID", "PRICE")


def source_counts(feeds: dict[str, DataFrame]) -> DataFrame:
    """Rows per landing feed (P5), as a union of single-row counts."""
    # Display names of the feeds.
    labels = {"pos": "POS", "ecommerce": "E-commerce", "mobile": "Mobile App"}
    parts = [
        df.agg(F.count(F.lit(1)).alias("records")).select(
            F.lit(labels[name]).alias("source"), "records"
        )
        for name, df in feeds.items()
    ]
    return reduce(DataFrame.unionAll, parts)


def grand_total(counts: DataFrame) -> DataFrame:
    """Sum of the per-feed counts."""
    return counts.agg(F.sum("records").alias("total_records"))


def row_counts(tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """Row count per (layer, table)."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count"
        )
        for (layer, name), df in tables.items()
    ]
    return reduce(DataFrame.unionAll, parts)
