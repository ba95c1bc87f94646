"""Invariants of the medallion pipeline over the fixture feeds (sf0.001)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.operators import dedup, gold, quality
from tributary.plans.medallion import Medallion
from tributary.schemas import SCORED_SCHEMA, UNIFIED_SCHEMA

from conftest import SF_SMALL


def test_schema_pins(spark):
    m = Medallion(spark, SF_SMALL)
    types = [(f.name, f.dataType) for f in m.unified.schema.fields]
    assert types == [(f.name, f.dataType) for f in UNIFIED_SCHEMA.fields]
    scored = m.scored.schema
    assert [f.name for f in scored.fields] == SCORED_SCHEMA.fieldNames()
    assert scored["quality_score"].dataType == T.IntegerType()
    assert scored["transaction_date"].dataType == T.TimestampType()
    assert scored["quantity"].dataType == T.LongType()


def test_split_is_a_partition(spark):
    m = Medallion(spark, SF_SMALL)
    n = m.scored.count()
    assert m.main.count() + m.rejected.count() == n
    assert m.main.filter(F.col("quality_tier") == "rejected").count() == 0
    assert m.rejected.filter(F.col("quality_tier") != "rejected").count() == 0


def test_tier_rules(spark):
    s = Medallion(spark, SF_SMALL).scored
    usable = s.filter(F.col("quality_tier").isin("high", "medium"))
    assert usable.filter(
        F.col("transaction_id").isNull() | F.col("product_id").isNull() | ~(F.col("unit_price") > 0)
    ).count() == 0
    bad_qty = s.filter(F.col("quantity").isNull() | (F.col("quantity") <= 0))
    assert bad_qty.filter(F.col("quality_score") > 70).count() == 0
    bounds = s.agg(F.min("quality_score"), F.max("quality_score")).first()
    assert -220 <= bounds[0] and bounds[1] <= 100


def test_one_survivor_per_duplicate_key(spark):
    d = Medallion(spark, SF_SMALL).deduped
    keyed = d.filter(
        F.col("customer_id").isNotNull() & F.col("product_id").isNotNull() & F.col("transaction_date").isNotNull()
    ).groupBy("customer_id", "product_id", F.to_date("transaction_date").alias("day"))
    per_key = keyed.agg(
        F.count_distinct("source_system").alias("channels"),
        F.count_distinct("transaction_id").alias("ids"),
        F.count(F.when(~F.col("is_duplicate"), 1)).alias("kept"),
    )
    # One survivor across channels; within one channel one for each id.
    want = F.when(F.col("channels") > 1, 1).otherwise(F.col("ids"))
    assert per_key.filter(F.col("kept") != want).count() == 0
    assert per_key.filter(F.col("channels") > 1).count() > 0
    assert d.filter(F.col("is_duplicate") != (F.col("duplicate_resolution") == "superseded")).count() == 0


def test_gold_consistency(spark):
    m = Medallion(spark, SF_SMALL)
    rev = m.revenue_by_source
    ch = {r.source_system: r for r in gold.channel_revenue(rev).collect()}
    per_day = rev.groupBy("source_system").agg(F.count(F.lit(1)).alias("days")).collect()
    for r in per_day:
        assert ch[r.source_system].transactions == r.days
    q = m.data_quality_metrics.agg(F.sum("record_count")).first()[0]
    assert q == m.main.count()


def test_dedup_hot_key_matches_brute_force(spark):
    """One key holds most rows: the aggregate + join flags must equal a
    window-based reference, and exactly one row of the key survives."""
    rows = []
    for i in range(3000):
        src = ["pos", "mobile", "ecommerce"][i % 3]
        rows.append((f"T{i:05d}", "2024-01-01 10:00:00", "CUST-HOT", "P1", src))
    for i in range(300):
        rows.append((f"U{i:05d}", "2024-01-02 11:00:00", f"CUST-{i % 7}", f"P{i % 5}", ["pos", "mobile"][i % 2]))
    rows.append(("N1", "2024-01-03 00:00:00", None, "P1", "pos"))
    # Sent again word for word: within a channel, and by the winning channel.
    rows += [("R1", "2024-01-04 00:00:00", "CUST-R", "P1", "pos")] * 3 + [("R2", "2024-01-04 01:00:00", "CUST-R", "P1", "pos")]
    rows += [("S1", "2024-01-04 00:00:00", "CUST-S", "P1", s) for s in ("ecommerce", "ecommerce", "pos")]
    df = spark.createDataFrame(
        rows, "transaction_id string, ts string, customer_id string, product_id string, source_system string"
    ).withColumn("transaction_date", F.col("ts").cast("timestamp")).drop("ts")
    flagged = dedup.flag_duplicates(df)
    prio = F.when(F.col("source_system") == "ecommerce", 1).when(F.col("source_system") == "mobile", 2).otherwise(3)
    w = Window.partitionBy("customer_id", "product_id", F.to_date("transaction_date"))
    same = Window.partitionBy("customer_id", "product_id", F.to_date("transaction_date"), "transaction_id")
    ref = (
        df.withColumn("p", prio)
        .withColumn("rk", F.row_number().over(w.orderBy("p", "transaction_date", "transaction_id")))
        .withColumn("again", F.row_number().over(same.orderBy("transaction_date")))
        .withColumn("cross", F.min("p").over(w) < F.max("p").over(w))
        .withColumn("copies", F.count(F.lit(1)).over(same))
        .select(
            *df.columns,
            F.when(F.col("customer_id").isNull() | (~F.col("cross") & (F.col("copies") == 1)), "no_duplicate")
            .when(F.when(F.col("cross"), F.col("rk")).otherwise(F.col("again")) == 1, "kept_by_priority")
            .otherwise("superseded")
            .alias("duplicate_resolution"),
        )
    )
    got = flagged.drop("is_duplicate").select(*ref.columns)
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0
    hot = flagged.filter(F.col("customer_id") == "CUST-HOT")
    assert hot.filter(~F.col("is_duplicate")).count() == 1
    assert hot.filter(~F.col("is_duplicate")).first().source_system == "ecommerce"


def test_review_flag_literal_frame(spark):
    df = spark.createDataFrame(
        [(101, 0.99), (100, 0.99), (101, 1.0), (None, 0.5), (500, None)],
        "quantity bigint, unit_price double",
    )
    got = [r[0] for r in df.select(quality.review_flag()).collect()]
    assert got == [True, False, False, False, False]


def test_rejection_reasons(spark):
    df = spark.createDataFrame(
        [(None, "P", 1, 1.0), ("T", None, None, None), ("T", "P", 1, -1.0)],
        "transaction_id string, product_id string, quantity bigint, unit_price double",
    )
    got = [r.reasons for r in quality.rejection_reasons(df).collect()]
    assert got == [
        ["missing_transaction_id"],
        ["missing_product_id", "missing_quantity_and_price"],
        ["score_below_threshold"],
    ]


def test_dedup_hot_key_is_split_by_skew_join(spark):
    """One key holds a third of all rows: the final adaptive plan must split
    that key's join partition over several tasks, and one row survives."""
    confs = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * 1024),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024),
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
        "spark.sql.shuffle.partitions": "32",
        # As at scale: the per-key summary is too big to broadcast.
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        hot = F.col("id") % 3 == 0
        df = spark.range(150000).select(
            F.format_string("T%07d", "id").alias("transaction_id"),
            F.when(hot, F.lit("CUST-HOT")).otherwise(F.format_string("C%07d", "id")).alias("customer_id"),
            F.when(hot, F.lit("P1")).otherwise(F.format_string("P%d", F.col("id") % 97)).alias("product_id"),
            F.lit("2024-01-01 10:00:00").cast("timestamp").alias("transaction_date"),
            F.element_at(
                F.array(F.lit("pos"), F.lit("mobile"), F.lit("ecommerce")), (F.floor(F.col("id") / 3) % 3 + 1).cast("int")
            ).alias("source_system"),
            F.rpad(F.lit("x"), 200, "y").alias("payload"),
        )
        flagged = dedup.flag_duplicates(df)
        qe = flagged._jdf.queryExecution()
        qe.toRdd().count()
        plan = spark._jvm.PythonSQLUtils.explainString(qe, "formatted")
        assert "SortMergeJoin(skew=true)" in plan
        assert "Broadcast" not in plan
        survivors = flagged.filter((F.col("customer_id") == "CUST-HOT") & ~F.col("is_duplicate"))
        assert survivors.count() == 1
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_dedup_broadcast_and_shuffle_paths_agree(spark):
    from tributary.session import fresh_dir

    main = Medallion(spark, SF_SMALL).main
    path = fresh_dir(spark, "t-dupkeys")
    dedup.duplicate_keys(main).write.parquet(path)
    keys = spark.read.parquet(path)
    assert keys.count() > 0 and keys.filter("_best is null").count() == 0
    a = dedup.flag_duplicates(main, dup_keys=keys, broadcast_keys=True)
    b = dedup.flag_duplicates(main)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_dedup_candidates_by_broadcast_and_by_filter_agree(spark):
    """Only candidate rows are exchanged where suspects are too many to be
    broadcast: the filter bitmap lets few others through."""
    from tributary.session import fresh_dir

    path = fresh_dir(spark, "t-suspects")
    m = Medallion(spark, SF_SMALL)
    dedup.suspects(m.stored_main).write.parquet(path)
    found = spark.read.parquet(path)
    few = dedup.candidates(m.stored_main, found, True)
    many = dedup.candidates(m.stored_main, found, False)
    assert 0 < found.count() < few.count() < m.stored_main.count() / 4
    assert few.exceptAll(many).count() == 0 and many.exceptAll(few).count() == 0
    names = ("Exchange hashpartitioning(_hash", "SortMergeJoin", "BroadcastHashJoin")
    plan = many._jdf.queryExecution().executedPlan().toString()
    rows = plan.index("getbit") if "getbit" in plan else -1
    assert rows > 0 and all(n in plan for n in names)
    # The rows' exchange is above the filter: what does not pass is not shuffled.
    assert plan.index("SortMergeJoin") < plan.index("Exchange hashpartitioning(_hash") < rows


def test_dedup_looks_at_few_rows_exactly(spark):
    """No sort aggregate over all rows, and one pass of 64-bit hashes."""
    m = Medallion(spark, SF_SMALL)
    plan = dedup.suspects(m.stored_main)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("Exchange") == 1
    assert "Exchange hashpartitioning(_hash" in plan
