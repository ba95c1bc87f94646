"""The command line runs in-process against the test session."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tributary.__main__ import main
from tributary.plans import pipeline
from tributary.plans.medallion import Medallion
from tributary.session import fresh_dir
from tributary.sources import catalog, landing

from conftest import SF_SMALL


def test_cli_list_and_query(spark, capsys):
    assert main(["list"]) == 0
    names = capsys.readouterr().out.split()
    assert "gold_revenue_by_source" in names and len(names) >= 60
    out = fresh_dir(spark, "t-cli")
    assert main(["query", "channel_revenue", "--input", SF_SMALL, "--out", out]) == 0
    assert spark.read.parquet(out).count() == 3


def test_maintain_packs_a_lake_that_takes_increments_after(spark, capsys):
    """Same rows in fewer files; a second call finds nothing to do, and an
    increment afterwards gives what it gives without."""
    bronze = Medallion(spark, SF_SMALL).bronze
    early = F.to_date("ingestion_timestamp") <= F.lit("2024-03-05").cast("date")
    first, second = (
        landing.write_landing_files({n: df.filter(when).repartition(4) for n, df in bronze.items()}, fresh_dir(spark, "t-maintain"))
        for when in (early, ~early)
    )
    ts, day = "2024-04-01 00:00:00", "2024-04-01"
    lakes = [
        pipeline.run(spark, None, fresh_dir(spark, "t-lake"), landing_paths=first, ingestion_ts=ts, transformation_ts=ts, register=False, period="month")
        for _ in range(2)
    ]
    plain, packed = (lake.base for lake in lakes)
    before = {n: catalog.data_file_stats(spark, f"{packed}/silver/{n}")[0] for n in ("unified_scored", "unified_sales_deduped")}
    assert main(["maintain", "--lake", packed]) == 0
    done = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert any("quality_tier=" in k for k in done) and all(b > a for a, b in done.values())
    after = {n: catalog.data_file_stats(spark, f"{packed}/silver/{n}")[0] for n in before}
    assert after["unified_scored"] == before["unified_scored"] - sum(b - a for k, (a, b) in done.items() if "quality_tier=" in k)
    assert pipeline.maintain(spark, packed) == {}

    def same():
        for name in ("unified_scored", "unified_sales_deduped"):
            a, b = (spark.read.parquet(f"{x}/silver/{name}").drop("source_file", "batch") for x in (plain, packed))
            assert a.schema == b.schema
            assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()

    same()
    for lake in (plain, packed):
        pipeline.run_increment(spark, lake, second, ingestion_ts=ts, transformation_ts=ts, report_date=day)
    same()
