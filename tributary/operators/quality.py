"""Quality framework: eight-dimension score, tiers, quarantine split, and the
reports built on them (D1-D15).

Scoring is a projection (no shuffle). The reports are small aggregates: a
conditional ``agg`` grouped by source, so partial aggregation runs map-side
and only a handful of rows per task cross the network.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions.exact import int_avg
from tributary.rules import AS_CODED, CleaningRules

# The eight quality dimensions, their failure test and penalty.
# (name, penalty); the tests are in ``dimension_failures``.
DIMENSIONS = [
    ("transaction_id", 100),
    ("product_id", 100),
    ("customer_id", 10),
    ("transaction_date", 20),
    ("unit_price", 50),
    ("quantity", 30),
    ("status", 5),
    ("store_id", 5),
]
# Tier thresholds, highest first; below the last is 'rejected'.
TIERS = [("high", 90), ("medium", 70), ("low", 50)]
REJECTED = "rejected"
USABLE_TIERS = ["high", "medium"]

# Review flag (quantity above, unit price below).
REVIEW_QUANTITY_OVER = 100
REVIEW_PRICE_UNDER = 1


def dimension_failures() -> dict[str, Column]:
    """Boolean failure test per dimension (never NULL)."""
    c = F.col
    return {
        "transaction_id": c("transaction_id").isNull(),
        "product_id": c("product_id").isNull(),
        "customer_id": c("customer_id").isNull(),
        "transaction_date": c("transaction_date").isNull(),
        "unit_price": c("unit_price").isNull() | (c("unit_price") <= 0),
        "quantity": c("quantity").isNull() | (c("quantity") <= 0),
        "status": F.coalesce(c("status") == "unknown", F.lit(False)),
        "store_id": F.coalesce(c("store_id") == "UNKNOWN", F.lit(False)),
    }


def quality_score(rules: CleaningRules = AS_CODED) -> Column:
    fails = dimension_failures()
    score = F.lit(100)
    for name, penalty in DIMENSIONS:
        score = score - F.when(fails[name], F.lit(penalty)).otherwise(F.lit(0))
    if rules.clamp_score:
        score = F.greatest(score, F.lit(0))
    return score.cast("int")


def quality_tier(score: Column) -> Column:
    out = None
    for name, floor in TIERS:
        out = (F.when if out is None else out.when)(score >= floor, F.lit(name))
    return out.otherwise(F.lit(REJECTED))


def score(
    unified: DataFrame,
    transformation_ts: str | None = None,
    rules: CleaningRules = AS_CODED,
) -> DataFrame:
    """Append quality_score, quality_tier, transformation_timestamp and
    needs_review.

    ``transformation_ts`` is the run's timestamp (a literal, so a rerun gives
    the same rows). When None, each row is stamped with its landing time,
    which replays a series of daily runs deterministically.
    """
    stamp = (
        F.lit(transformation_ts).cast("timestamp")
        if transformation_ts
        else F.col("ingestion_timestamp")
    )
    return (
        unified.withColumn("quality_score", quality_score(rules))
        .withColumn("quality_tier", quality_tier(F.col("quality_score")))
        .withColumn("transformation_timestamp", stamp)
        .withColumn("needs_review", review_flag())
    )


def split_rejected(scored: DataFrame, stored: bool = True) -> tuple[DataFrame, DataFrame]:
    """(production rows, quarantined rows): two filters over one input.

    ``stored``: the tier is a stored column, and the filter goes into the scan.
    Of a tier that is still to be computed the filter would go below the scoring
    and repeat all of the cleaning for each row; a row number, which no filter
    passes, keeps it above."""
    rejected = F.col("quality_tier") == REJECTED
    if stored:
        return scored.filter(~rejected), scored.filter(rejected)
    numbered, there = scored.withColumn("_row", F.monotonically_increasing_id()), F.col("_row") >= 0
    return numbered.filter(~rejected & there).drop("_row"), numbered.filter(rejected & there).drop("_row")


def distribution(scored: DataFrame) -> DataFrame:
    """Rows per source and tier."""
    return (
        scored.groupBy("source_system", "quality_tier")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("source_system", "quality_tier")
    )


def review_flag() -> Column:
    """Cross-field check: a large quantity at a tiny unit price."""
    return F.coalesce(
        (F.col("quantity") > REVIEW_QUANTITY_OVER) & (F.col("unit_price") < REVIEW_PRICE_UNDER),
        F.lit(False),
    )


def review_summary(scored: DataFrame) -> DataFrame:
    return scored.groupBy("source_system").agg(
        F.count(F.lit(1)).alias("records"),
        F.count(F.when(review_flag(), 1)).alias("needs_review"),
    )


# Documented rejection rules, in report order.
REJECTION_RULES = [
    "missing_transaction_id",
    "missing_product_id",
    "missing_quantity_and_price",
]
LOW_SCORE_REASON = "score_below_threshold"


def rejection_reasons(rejected: DataFrame) -> DataFrame:
    """``reasons``: the documented rejection rules a quarantined row breaks,
    or the low-score reason when it breaks none of them (D13)."""
    c = F.col
    rules = F.array(
        F.when(c("transaction_id").isNull(), F.lit(REJECTION_RULES[0])),
        F.when(c("product_id").isNull(), F.lit(REJECTION_RULES[1])),
        F.when(c("quantity").isNull() & c("unit_price").isNull(), F.lit(REJECTION_RULES[2])),
    )
    broken = F.filter(rules, lambda x: x.isNotNull())
    return rejected.withColumn(
        "reasons",
        F.when(F.size(broken) > 0, broken).otherwise(F.array(F.lit(LOW_SCORE_REASON))),
    )


def rejection_reason_counts(rejected: DataFrame) -> DataFrame:
    return (
        rejection_reasons(rejected)
        .select("source_system", F.explode("reasons").alias("reason"))
        .groupBy("source_system", "reason")
        .agg(F.count(F.lit(1)).alias("records"))
    )


def issue_ranking(scored: DataFrame, top: int = 3) -> DataFrame:
    """Failures per dimension and source, with each source's top issues.

    One conditional aggregate per source (8 counters), unpivoted to rows, then
    ranked within the source; the window runs over at most 8 rows per source.
    """
    fails = dimension_failures()
    per_source = scored.groupBy("source_system").agg(
        F.count(F.lit(1)).alias("records"),
        *[F.count(F.when(fails[name], 1)).alias(name) for name, _ in DIMENSIONS],
    )
    long = per_source.unpivot(
        ["source_system", "records"], [n for n, _ in DIMENSIONS], "dimension", "failures"
    )
    w = Window.partitionBy("source_system").orderBy(F.col("failures").desc(), F.col("dimension"))
    return (
        long.withColumn("failure_rate", F.col("failures") / F.col("records"))
        .withColumn("issue_rank", F.row_number().over(w))
        .filter((F.col("issue_rank") <= top) & (F.col("failures") > 0))
    )


def average_quality(scored: DataFrame) -> DataFrame:
    """Average score per source and overall ('ALL'), rejected rows included
    (D15); one rollup aggregate."""
    return (
        scored.rollup("source_system")
        .agg(F.count(F.lit(1)).alias("records"), int_avg("quality_score").alias("avg_quality_score"))
        .select(
            F.coalesce(F.col("source_system"), F.lit("ALL")).alias("source_system"),
            "records",
            "avg_quality_score",
        )
    )
