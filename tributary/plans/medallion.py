"""The medallion pipeline as lazily composed frames.

``Medallion`` wires bronze -> silver -> gold for one input folder. Every
property is a lazy ``DataFrame``; nothing runs until an action or a write.
``plans.pipeline`` materialises the layers for production runs; the registered
queries read the same properties.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tributary.operators import dedup, gold, normalize, quality
from tributary.rules import AS_CODED, CleaningRules
from tributary.session import fresh_dir
from tributary.sources.landing import land_bronze

# The as-of date of the reports over the fixture data.
DEFAULT_REPORT_DATE = "2024-03-10"


class Medallion:
    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str,
        rules: CleaningRules = AS_CODED,
        transformation_ts: str | None = None,
        report_date: str = DEFAULT_REPORT_DATE,
        dedup_mode: str = "priority",
    ):
        """``dedup_mode``: ``priority`` flags cross-channel duplicates (the
        documented behaviour, default); ``none`` is the original stub, under
        which Gold counts every production row."""
        if dedup_mode not in ("priority", "none"):
            raise ValueError(f"unknown dedup_mode {dedup_mode!r}")
        self.dedup_mode = dedup_mode
        self.spark = spark
        self.sf_dir = sf_dir
        self.rules = rules
        self.transformation_ts = transformation_ts
        self.report_date = report_date

    # bronze ---------------------------------------------------------------
    @cached_property
    def bronze(self) -> dict[str, DataFrame]:
        return land_bronze(self.spark, self.sf_dir)

    # silver ---------------------------------------------------------------
    def feed(self, name: str) -> DataFrame:
        """One landed feed; the others are landed only if they are used, too."""
        if "bronze" in self.__dict__:
            return self.bronze[name]
        return land_bronze(self.spark, self.sf_dir, (name,))[name]

    @cached_property
    def pos(self) -> DataFrame:
        return normalize.normalize_pos(self.feed("pos"), self.rules)

    @cached_property
    def ecommerce(self) -> DataFrame:
        return normalize.normalize_ecommerce(self.feed("ecommerce"), self.rules)

    @cached_property
    def mobile(self) -> DataFrame:
        return normalize.normalize_mobile(self.feed("mobile"), self.rules)

    @cached_property
    def unified(self) -> DataFrame:
        self.bronze  # all three feeds are landed side by side
        return normalize.unify(self.pos, self.ecommerce, self.mobile)

    @cached_property
    def scored(self) -> DataFrame:
        return quality.score(self.unified, self.transformation_ts, self.rules)

    @cached_property
    def main(self) -> DataFrame:
        return quality.split_rejected(self.scored, stored=False)[0]

    @cached_property
    def rejected(self) -> DataFrame:
        return quality.split_rejected(self.scored, stored=False)[1]

    @cached_property
    def stored_main(self) -> DataFrame:
        """Production rows as a stored table: deduplication reads them more
        than once, and the feeds are normalised and scored once."""
        path = fresh_dir(self.spark, "silver-main")
        self.main.write.parquet(path)
        return self.spark.read.schema(self.main.schema).parquet(path)

    @cached_property
    def deduped(self) -> DataFrame:
        if self.dedup_mode == "none":
            return dedup.mark_stub(self.main)
        return dedup.flag_duplicates(self.stored_main)

    # gold -----------------------------------------------------------------
    @cached_property
    def revenue_by_source(self) -> DataFrame:
        return gold.revenue_by_source(self.deduped)

    @cached_property
    def product_performance(self) -> DataFrame:
        return gold.product_performance(self.deduped)

    @cached_property
    def data_quality_metrics(self) -> DataFrame:
        return gold.data_quality_metrics(self.main)

    @cached_property
    def executive_summary(self) -> DataFrame:
        return gold.executive_summary(self.deduped, self.report_date)

    def layer_tables(self) -> dict[tuple[str, str], DataFrame]:
        return {
            ("bronze", "pos_raw"): self.bronze["pos"],
            ("bronze", "ecommerce_raw"): self.bronze["ecommerce"],
            ("bronze", "mobile_raw"): self.bronze["mobile"],
            ("silver", "unified_sales"): self.main,
            ("silver", "unified_sales_deduped"): self.deduped,
            ("silver", "sales_rejected"): self.rejected,
            ("gold", "revenue_by_source"): self.revenue_by_source,
            ("gold", "product_performance"): self.product_performance,
            ("gold", "data_quality_metrics"): self.data_quality_metrics,
            ("gold", "executive_summary"): self.executive_summary,
        }
