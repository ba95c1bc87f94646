"""The materialised run registers layer tables; the documented SQL runs on them."""

from __future__ import annotations

import glob
import os

import pytest

from pyspark.sql import functions as F

from tributary.operators import gold
from tributary.plans import pipeline
from tributary.session import fresh_dir

from tributary.rules import DOCUMENTED

from conftest import SF_SMALL


def _bag(df):
    return sorted(tuple(r) for r in df.collect())


def test_pipeline_registers_layers_and_sql_matches_api(spark):
    res = pipeline.run(spark, SF_SMALL, fresh_dir(spark, "t-lake"))
    dbs = {d.name for d in spark.catalog.listDatabases()}
    assert {"bronze", "silver", "gold"} <= dbs
    for t in ["bronze.pos_raw", "bronze.ecommerce_raw", "bronze.mobile_raw", "silver.unified_sales",
              "silver.sales_rejected", "silver.unified_sales_deduped", "gold.revenue_by_source",
              "gold.product_performance", "gold.data_quality_metrics", "gold.executive_summary"]:
        assert spark.table(t).count() >= 1, t
    assert res.metrics["scored_rows"] == spark.table("silver.unified_scored").count()
    assert res.metrics["rejected_rows"] == spark.table("silver.sales_rejected").count()

    # Revenue by channel, as documented.
    sql = spark.sql("""
        SELECT source_system, SUM(total_revenue) AS revenue, COUNT(*) AS transactions
        FROM gold.revenue_by_source GROUP BY source_system ORDER BY revenue DESC""")
    api = gold.channel_revenue(spark.table("gold.revenue_by_source"))
    got = {r.source_system: (round(r.revenue, 2), r.transactions) for r in sql.collect()}
    want = {r.source_system: (round(r.revenue, 2), r.transactions) for r in api.collect()}
    assert got == want

    # Quality trends, as documented.
    sql = spark.sql("""
        SELECT source_system, quality_tier, COUNT(*) AS records, AVG(quality_score) AS avg_score
        FROM silver.unified_sales GROUP BY source_system, quality_tier""")
    api = gold.quality_trends(spark.table("silver.unified_sales"))
    assert _bag(sql.select("source_system", "quality_tier", "records")) == _bag(
        api.select("source_system", "quality_tier", "records")
    )

    # Quarantine and production are disjoint partitions of one scored write.
    both = spark.table("silver.unified_sales").unionByName(spark.table("silver.sales_rejected"))
    assert both.count() == spark.table("silver.unified_scored").count()
    assert spark.table("silver.unified_sales").filter(F.col("quality_tier") == "rejected").count() == 0


def test_pipeline_from_landing_files_matches_fixture_run(spark):
    """CSV / JSON / Parquet landing files in, same gold revenue out."""
    from tributary.plans.medallion import Medallion
    from tributary.sources import landing

    m = Medallion(spark, SF_SMALL)
    paths = landing.write_landing_files(m.bronze, fresh_dir(spark, "t-landing"))
    res = pipeline.run(
        spark, None, fresh_dir(spark, "t-lake-files"), landing_paths=paths,
        ingestion_ts="2024-03-10 00:00:00", register=False, period="month",
    )
    from_files = spark.read.parquet(res.tables["gold.revenue_by_source"]).drop("sale_period")
    assert _bag(from_files) == _bag(m.revenue_by_source)
    assert res.metrics["scored_rows"] == m.scored.count()


def test_overwrite_replaces_schema(spark):
    """Overwriting a layer table replaces its files and its schema."""
    from tributary.sources import catalog

    path = fresh_dir(spark, "t-overwrite")
    catalog.write_table(spark.range(3).withColumn("a", F.lit(1)), path)
    catalog.write_table(spark.range(2).withColumn("b", F.lit("x")), path)
    back = spark.read.parquet(path)
    assert back.columns == ["id", "b"] and back.count() == 2
    t = catalog.register_table(spark, "silver.t_overwrite", path)
    assert t.columns == ["id", "b"]


def test_increment_equals_full_rebuild(spark):
    """run(first days) + run_increment(later days) == run(all days)."""
    from tributary.plans.medallion import Medallion
    from tributary.sources import landing

    bronze = Medallion(spark, SF_SMALL).bronze
    early = F.to_date("ingestion_timestamp") <= F.lit("2024-03-05").cast("date")
    parts = {
        "all": bronze,
        "first": {n: df.filter(early) for n, df in bronze.items()},
        "second": {n: df.filter(~early) for n, df in bronze.items()},
    }
    paths = {k: landing.write_landing_files(v, fresh_dir(spark, f"t-inc-{k}")) for k, v in parts.items()}
    ts = "2024-03-10 00:00:00"
    full = pipeline.run(spark, None, fresh_dir(spark, "t-full"), landing_paths=paths["all"],
                        ingestion_ts=ts, register=False, period="month")
    first = pipeline.run(spark, None, fresh_dir(spark, "t-inc"), landing_paths=paths["first"],
                         ingestion_ts=ts, register=False, period="month")
    day = "2024-03-10"
    with pytest.raises(ValueError, match="dedup_mode"):
        pipeline.run_increment(spark, first.base, paths["second"], dedup_mode="none")
    with pytest.raises(ValueError, match="rules"):
        pipeline.run_increment(spark, first.base, paths["second"], rules=DOCUMENTED)
    for _ in range(2):  # the retry changes nothing
        inc = pipeline.run_increment(spark, first.base, paths["second"], ingestion_ts=ts, report_date=day)
    assert inc.metrics["affected_periods"] > 0
    for n, t in (("pos", "pos_raw"), ("ecommerce", "ecommerce_raw"), ("mobile", "mobile_raw")):
        assert spark.read.parquet(inc.tables[f"bronze.{t}"]).count() == bronze[n].count()
    for table in ["silver.unified_scored", "silver.unified_sales_deduped", "gold.revenue_by_source",
                  "gold.product_performance", "gold.data_quality_metrics", "gold.executive_summary"]:
        # source_file is lineage: the two landings used different files.
        a = spark.read.parquet(full.tables[table]).drop("source_file", "batch")
        b = spark.read.parquet(inc.tables[table]).select(*a.columns)
        assert a.count() == b.count(), table
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, table

    # A batch of one sale rewrites the files of its month only.
    def times():
        root = inc.tables["silver.unified_sales_deduped"]
        return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{root}/sale_period=*/*.parquet")}

    one = {n: df.limit(0) for n, df in bronze.items()}
    one["mobile"] = bronze["mobile"].filter("transaction_id is not null").limit(1)
    before = times()
    pipeline.run_increment(spark, first.base, landing.write_landing_files(one, fresh_dir(spark, "t-inc-one")),
                           ingestion_ts=ts, report_date=day)
    after = times()
    same = {os.path.dirname(p) for p in before if after.get(p) == before[p]}
    assert len({os.path.dirname(p) for p in before} - same) == 1
