"""Registered queries: one per operator of the inventory.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole input. Columns are named exactly as in ``plans.oracle``; timestamps are
returned zone-free (TIMESTAMP_NTZ, the session zone is UTC) so they compare
as wall-clock values.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions import codes, dates, prices
from tributary.functions.exact import exact_avg, exact_sum, half_up_avg
from tributary.operators import dedup, gold, maintenance, normalize, profile, quality
from tributary.plans import pipeline, sizing
from tributary.plans.medallion import DEFAULT_REPORT_DATE, Medallion
from tributary.rules import DOCUMENTED
from tributary.schemas import DEDUP_COLUMNS, ECOMMERCE_SCHEMA, MOBILE_SCHEMA, POS_FIELDS, SCORED_COLUMNS, SCORED_SCHEMA
from tributary.session import apply_runtime_conf, fresh_dir
from tributary.sources import catalog, landing, paged, semistructured
from tributary.streaming import event_time, incremental

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn

    return deco


def zone_free(df: DataFrame) -> DataFrame:
    """Cast zone-aware timestamps to TIMESTAMP_NTZ (wall clock in UTC)."""
    cols = [
        F.col(f.name).cast(T.TimestampNTZType()).alias(f.name)
        if isinstance(f.dataType, T.TimestampType)
        else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(cols)


def _m(spark: SparkSession, sf_dir: str, **kw) -> Medallion:
    apply_runtime_conf(spark)
    sizing.tune_tables(spark, sf_dir)
    return Medallion(spark, sf_dir, **kw)


# --------------------------------------------------------------------------
# bronze (S2-S6, S13, O7)
# --------------------------------------------------------------------------

AUDIT = ["source_system", "source_format", "ingestion_timestamp", "file_name"]


@register("bronze_pos")
def bronze_pos(spark, sf_dir):
    return _m(spark, sf_dir).feed("pos").select(*POS_FIELDS, *AUDIT)


@register("bronze_ecommerce")
def bronze_ecommerce(spark, sf_dir):
    """Nested orders, compared flattened: struct fields, the first line item,
    and the item count and total quantity over the whole array."""
    e = _m(spark, sf_dir).feed("ecommerce")
    first = F.get(F.col("lineItems"), 0)
    qty_total = F.aggregate(
        "lineItems", F.lit(0).cast("bigint"), lambda acc, x: acc + x["quantity"].try_cast("bigint")
    )
    return e.select(
        "orderId",
        "orderDate",
        F.col("customer.customerId").alias("customer_id"),
        F.col("customer.email").alias("customer_email"),
        F.col("customer.loyaltyTier").alias("loyalty_tier"),
        F.size("lineItems").alias("item_count"),
        qty_total.alias("item_quantity_total"),
        first["productId"].alias("first_product_id"),
        first["productName"].alias("first_product_name"),
        first["quantity"].alias("first_quantity"),
        first["unitPrice"].alias("first_unit_price"),
        first["discount"].alias("first_discount"),
        F.col("payment.method").alias("payment_method"),
        F.col("payment.status").alias("payment_status"),
        F.col("payment.transactionId").alias("payment_transaction_id"),
        F.col("shipping.method").alias("shipping_method"),
        F.col("shipping.address.country").alias("shipping_country"),
        F.col("shipping.address.city").alias("shipping_city"),
        "platform",
        "totalAmount",
        *AUDIT,
    )


@register("bronze_mobile")
def bronze_mobile(spark, sf_dir):
    return _m(spark, sf_dir).feed("mobile")


@register("bronze_sample")
def bronze_sample(spark, sf_dir):
    """First 10 POS rows by id (top-k: the limit is the feature)."""
    pos = _m(spark, sf_dir).feed("pos")
    return (
        pos.select("TRANS_ID", "PRODUCT_CODE", "PRICE", "QTY", "TRANS_DATE", "STATUS")
        .orderBy(F.col("TRANS_ID").asc_nulls_last())
        .limit(10)
    )


# --------------------------------------------------------------------------
# profiling
# --------------------------------------------------------------------------

@register("bronze_missing_profile")
def bronze_missing_profile(spark, sf_dir):
    return profile.missing_profile(_m(spark, sf_dir).feed("pos"))


@register("date_variants")
def date_variants(spark, sf_dir):
    return profile.date_variants(_m(spark, sf_dir).feed("pos"))


@register("status_frequency")
def status_frequency(spark, sf_dir):
    return profile.value_frequency(_m(spark, sf_dir).feed("pos"), "STATUS")


@register("price_nonconforming")
def price_nonconforming(spark, sf_dir):
    return profile.price_nonconforming(_m(spark, sf_dir).feed("pos"))


@register("bronze_source_counts")
def bronze_source_counts(spark, sf_dir):
    return profile.source_counts(_m(spark, sf_dir).bronze)


@register("bronze_total")
def bronze_total(spark, sf_dir):
    return profile.grand_total(profile.source_counts(_m(spark, sf_dir).bronze))


@register("bronze_footer_counts")
def bronze_footer_counts(spark, sf_dir):
    """Records per source and in all, read from the footers of the stored
    feeds (P5, P6): the scan opens no row group."""
    _m(spark, sf_dir).bronze  # make sure the feeds are landed
    root = landing.bronze_root(spark, sf_dir)
    names = {"POS": "pos", "E-commerce": "ecommerce", "Mobile App": "mobile"}
    counts = catalog.counted(spark, {shown: f"{root}/{n}" for shown, n in names.items()})
    total = counts.agg(F.sum("row_count").alias("row_count")).select(F.lit("all").alias("name"), "row_count")
    return counts.unionAll(total).select(F.col("name").alias("source"), F.col("row_count").alias("records"))


# --------------------------------------------------------------------------
# scalar functions over every raw value
# --------------------------------------------------------------------------

def _raw_dates(m: Medallion) -> DataFrame:
    b = m.bronze
    return reduce(
        DataFrame.unionAll,
        [
            b["pos"].select(F.lit("pos").alias("source"), F.col("TRANS_DATE").alias("raw_value")),
            b["ecommerce"].select(
                F.lit("ecommerce").alias("source"), F.col("orderDate").alias("raw_value")
            ),
            b["mobile"].select(
                F.lit("mobile").alias("source"),
                F.col("timestamp").cast("string").alias("raw_value"),
            ),
        ],
    )


@register("date_parse")
def date_parse(spark, sf_dir):
    raw = _raw_dates(_m(spark, sf_dir))
    return raw.select("source", "raw_value", dates.parse_date_text("raw_value").alias("parsed_value"))


@register("date_parse_documented")
def date_parse_documented(spark, sf_dir):
    raw = _raw_dates(_m(spark, sf_dir))
    return raw.select(
        "source",
        "raw_value",
        dates.parse_date_text("raw_value", DOCUMENTED).alias("parsed_value"),
        dates.date_is_ambiguous("raw_value").alias("date_ambiguous"),
    )


@register("price_clean")
def price_clean(spark, sf_dir):
    pos = _m(spark, sf_dir).feed("pos")
    return pos.select(F.col("PRICE").alias("raw_price"), prices.clean_price("PRICE").alias("unit_price"))


@register("price_clean_documented")
def price_clean_documented(spark, sf_dir):
    pos = _m(spark, sf_dir).feed("pos")
    return pos.select(
        F.col("PRICE").alias("raw_price"), prices.clean_price("PRICE", DOCUMENTED).alias("unit_price")
    )


@register("status_standardize")
def status_standardize(spark, sf_dir):
    b = _m(spark, sf_dir).bronze
    raw = reduce(
        DataFrame.unionAll,
        [
            b["pos"].select(F.lit("pos").alias("source"), F.col("STATUS").alias("raw_status")),
            b["ecommerce"].select(
                F.lit("ecommerce").alias("source"), F.col("payment.status").alias("raw_status")
            ),
            b["mobile"].select(
                F.lit("mobile").alias("source"), F.col("payment_status").alias("raw_status")
            ),
        ],
    )
    return raw.select("source", "raw_status", codes.standardize_status("raw_status").alias("status"))


@register("store_normalize")
def store_normalize(spark, sf_dir):
    pos = _m(spark, sf_dir).feed("pos")
    return pos.select(F.col("STORE").alias("raw_store"), codes.store_id("STORE").alias("store_id"))


@register("payment_normalize")
def payment_normalize(spark, sf_dir):
    pos = _m(spark, sf_dir).feed("pos")
    return pos.select(
        F.col("PAYMENT_TYPE").alias("raw_payment"),
        codes.payment_method("PAYMENT_TYPE").alias("payment_method"),
    )


# --------------------------------------------------------------------------
# source transforms
# --------------------------------------------------------------------------

@register("pos_normalized")
def pos_normalized(spark, sf_dir):
    return _m(spark, sf_dir).pos


@register("ecommerce_normalized")
def ecommerce_normalized(spark, sf_dir):
    return _m(spark, sf_dir).ecommerce


@register("mobile_normalized")
def mobile_normalized(spark, sf_dir):
    return _m(spark, sf_dir).mobile


@register("unified_sales")
def unified_sales(spark, sf_dir):
    return _m(spark, sf_dir).unified


@register("ecommerce_line_items")
def ecommerce_line_items(spark, sf_dir):
    return normalize.ecommerce_line_items(_m(spark, sf_dir).feed("ecommerce"))


@register("unified_sales_documented")
def unified_sales_documented(spark, sf_dir):
    """The unified feed under the documented rule set."""
    return _m(spark, sf_dir, rules=DOCUMENTED).unified


@register("quality_distribution_documented")
def quality_distribution_documented(spark, sf_dir):
    """Tier counts under the documented rules (score floored at 0)."""
    scored = _m(spark, sf_dir, rules=DOCUMENTED).scored
    return scored.groupBy("source_system", "quality_tier").agg(
        F.count(F.lit(1)).alias("count"), F.min("quality_score").alias("min_score")
    )


# --------------------------------------------------------------------------
# quality (D1-D15)
# --------------------------------------------------------------------------

@register("quality_scored")
def quality_scored(spark, sf_dir):
    return _m(spark, sf_dir).scored


@register("quality_distribution")
def quality_distribution(spark, sf_dir):
    return quality.distribution(_m(spark, sf_dir).scored)


@register("silver_main")
def silver_main(spark, sf_dir):
    return _m(spark, sf_dir).main


@register("silver_rejected")
def silver_rejected(spark, sf_dir):
    return _m(spark, sf_dir).rejected


@register("review_flags")
def review_flags(spark, sf_dir):
    return quality.review_summary(_m(spark, sf_dir).scored)


@register("rejection_reasons")
def rejection_reasons(spark, sf_dir):
    return quality.rejection_reason_counts(_m(spark, sf_dir).rejected)


@register("quality_issue_ranking")
def quality_issue_ranking(spark, sf_dir):
    return quality.issue_ranking(_m(spark, sf_dir).scored)


@register("source_average_quality")
def source_average_quality(spark, sf_dir):
    return quality.average_quality(_m(spark, sf_dir).scored)


# --------------------------------------------------------------------------
# dedup (U1-U4)
# --------------------------------------------------------------------------

@register("dedup_flagged")
def dedup_flagged(spark, sf_dir):
    return _m(spark, sf_dir).deduped


@register("dedup_stub")
def dedup_stub(spark, sf_dir):
    """The original dedup step: every row marked as a non-duplicate."""
    return dedup.mark_stub(_m(spark, sf_dir).main)


@register("dedup_summary")
def dedup_summary(spark, sf_dir):
    return dedup.summary(dedup.flag_duplicates(_m(spark, sf_dir).stored_main, with_winner=True))


# Audit columns are not content: a re-sent copy may arrive in another file.
@register("pos_content_duplicates")
def pos_content_duplicates(spark, sf_dir):
    pos = _m(spark, sf_dir).feed("pos").select(*POS_FIELDS)
    flagged = dedup.content_duplicates(pos, "TRANS_ID")
    return flagged.select(
        "TRANS_ID", "CUST_NUM", "PRODUCT_CODE", "TRANS_DATE", "copies", "canonical_id"
    )


# --------------------------------------------------------------------------
# gold (G1-G8)
# --------------------------------------------------------------------------

@register("gold_revenue_by_source")
def gold_revenue_by_source(spark, sf_dir):
    return _m(spark, sf_dir).revenue_by_source


@register("gold_revenue_by_source_no_dedup")
def gold_revenue_by_source_no_dedup(spark, sf_dir):
    """G1 as the original computed it: over the dedup stub, so duplicates
    are counted (reproduces the original's numbers)."""
    return _m(spark, sf_dir, dedup_mode="none").revenue_by_source


@register("gold_product_performance")
def gold_product_performance(spark, sf_dir):
    return _m(spark, sf_dir).product_performance


@register("gold_data_quality_metrics")
def gold_data_quality_metrics(spark, sf_dir):
    return _m(spark, sf_dir).data_quality_metrics


@register("gold_executive_summary")
def gold_executive_summary(spark, sf_dir):
    return _m(spark, sf_dir).executive_summary


@register("channel_revenue")
def channel_revenue(spark, sf_dir):
    return gold.channel_revenue(_m(spark, sf_dir).revenue_by_source)


@register("quality_trends")
def quality_trends(spark, sf_dir):
    return gold.quality_trends(_m(spark, sf_dir).main)


@register("daily_quality_report")
def daily_quality_report(spark, sf_dir):
    m = _m(spark, sf_dir)
    return gold.daily_quality_report(m.main, m.report_date)


@register("quality_trend_7d")
def quality_trend_7d(spark, sf_dir):
    m = _m(spark, sf_dir)
    return gold.quality_trend(m.main, m.report_date, 7)


@register("layer_audit")
def layer_audit(spark, sf_dir):
    """Row counts of the ten tables that a run stores and registers."""
    _lake(spark, sf_dir)
    names = [tuple(t.split(".")) for t in AUDITED]
    return profile.row_counts({n: spark.table(".".join(n)) for n in names})


# Extreme values, one per group, among the orders' totals: what a price text
# can turn into. The group is the order key modulo EXACT_GROUPS.
EXACT_GROUPS = 97
EXTREMES = {1: "NaN", 2: "Infinity", 3: "1e20", 4: "1e28", 5: "1e33", 6: "-1e33"}


@register("exact_aggregates")
def exact_aggregates(spark, sf_dir):
    """Exact sums and averages with values that no DECIMAL holds (F24). Figures
    of 10^15 and more are compared by their logarithm."""
    apply_runtime_conf(spark)
    value = F.when(F.col("g") == 7, F.lit(None)).otherwise(F.col("o_totalprice"))
    for key, text in EXTREMES.items():
        value = F.when(F.col("o_orderkey") == key, F.lit(text).cast("double")).otherwise(value)
    rows = (
        spark.read.parquet(f"{sf_dir}/orders.parquet")
        .withColumn("g", (F.col("o_orderkey") % EXACT_GROUPS).cast("int"))
        .select("g", value.cast("double").alias("x"))
    )
    sums = rows.groupBy("g").agg(
        F.count("x").alias("n"),
        exact_sum("x").alias("total"),
        exact_avg("x").alias("mean"),
        half_up_avg("x", 2).alias("mean_2"),
    )

    def shown(name):
        x = F.col(name)
        huge = (F.abs(x) >= 1e15) & ~F.isnan(x) & (F.abs(x) < float("inf"))
        return F.when(huge, F.signum(x) * F.round(F.log10(F.abs(x)), 6)).otherwise(x).alias(name)

    return sums.select("g", "n", shown("total"), shown("mean"), shown("mean_2"))


@register("epoch_range")
def epoch_range(spark, sf_dir):
    """Epoch text in seconds, in milliseconds (a year far ahead, as coded) and
    beyond what a timestamp holds, as seconds of the parsed value (F6, F16)."""
    apply_runtime_conf(spark)
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("s")
    )
    raw = e.select(
        "event_id",
        F.explode(
            F.array(
                F.col("s").cast("string"),
                (F.col("s") * 1000).cast("string"),
                (-F.col("s") * 1000).cast("string"),
                (F.col("s") * 1000000).cast("string"),
            )
        ).alias("raw_value"),
    )
    return raw.select("event_id", "raw_value", F.unix_seconds(dates.parse_date_text("raw_value")).alias("seconds"))


# --------------------------------------------------------------------------
# landing files, layer tables and catalog
# --------------------------------------------------------------------------

# Ingestion time given to re-read landing files in the queries.
LANDING_TS = "2024-04-01 00:00:00"


READERS = {"pos": landing.read_pos_csv, "ecommerce": landing.read_ecommerce_json, "mobile": landing.read_mobile_parquet}


def _landed_files(spark, sf_dir, name: str) -> DataFrame:
    """Write a bronze feed as CSV / JSON / Parquet landing files into a fresh
    workspace folder and read them back through its reader."""
    paths = landing.write_landing_files({name: _m(spark, sf_dir).feed(name)}, fresh_dir(spark, "landing"))
    return READERS[name](spark, paths[name], LANDING_TS)


@register("landing_pos_csv")
def landing_pos_csv(spark, sf_dir):
    """POS rows after a CSV round trip: NULL and '' must both survive."""
    return _landed_files(spark, sf_dir, "pos").select(*POS_FIELDS, "source_system", "source_format")


@register("landing_ecommerce_json")
def landing_ecommerce_json(spark, sf_dir):
    return _landed_orders(_landed_files(spark, sf_dir, "ecommerce"))


def _landed_orders(e: DataFrame) -> DataFrame:
    first = F.get(F.col("lineItems"), 0)
    return e.select(
        "orderId",
        "orderDate",
        F.col("customer.customerId").alias("customer_id"),
        F.size("lineItems").alias("item_count"),
        first["productId"].alias("first_product_id"),
        first["unitPrice"].alias("first_unit_price"),
        F.col("payment.status").alias("payment_status"),
        F.col("shipping.address.city").alias("shipping_city"),
        "totalAmount",
        "source_system",
        "source_format",
    )


@register("landing_mobile_parquet")
def landing_mobile_parquet(spark, sf_dir):
    cols = [f.name for f in MOBILE_SCHEMA.fields]
    return _landed_files(spark, sf_dir, "mobile").select(*cols, "source_system", "source_format")


# What the later orders bring besides the known fields, by the
# number that ends their id.
def _with_new_fields(orders: DataFrame) -> DataFrame:
    """The orders landed after the split day, as JSON lines with new fields: a
    flag, an object, a member of a known object and one of its line items."""
    k = F.regexp_extract("orderId", r"(\d+)$", 1).cast("bigint")
    gift = F.when(k % 2 == 0, k % 3 == 0)
    campaign = F.when(k % 4 == 0, F.struct(F.concat(F.lit("C"), (k % 7).cast("string")).alias("code"), (k % 5).alias("percent")))
    segment = F.when(k % 5 == 1, F.concat(F.lit("S"), (k % 3).cast("string")))
    late = orders.filter(F.to_date("ingestion_timestamp") > F.lit(UPSERT_SPLIT_DAY).cast("date")).drop(*AUDIT)
    late = late.select(
        *[F.col(c) for c in late.columns if c not in ("customer", "lineItems")],
        F.col("customer").withField("segment", segment).alias("customer"),
        F.transform("lineItems", lambda x: x.withField("warrantyMonths", F.when(k % 6 == 0, k % 24))).alias("lineItems"),
        gift.alias("giftWrap"),
        campaign.alias("campaign"),
    )
    return late.select(F.to_json(F.struct(*late.columns)).alias("value"))


def _evolved_orders(spark, sf_dir) -> DataFrame:
    """Stored orders of two landings: the first ones read with the schema
    alone, the later ones, which have new fields, with all they bring."""
    orders = _m(spark, sf_dir).feed("ecommerce")
    early = orders.filter(F.to_date("ingestion_timestamp") <= F.lit(UPSERT_SPLIT_DAY).cast("date"))
    root = fresh_dir(spark, "new-fields")
    early.drop(*AUDIT).write.option("compression", "gzip").json(f"{root}/first")
    _with_new_fields(orders).write.option("compression", "gzip").text(f"{root}/second")
    maintenance.append_evolving(landing.read_ecommerce_json(spark, f"{root}/first", LANDING_TS), f"{root}/bronze")
    maintenance.append_evolving(semistructured.read_ecommerce(spark, f"{root}/second", LANDING_TS), f"{root}/bronze")
    return maintenance.read_merged(spark, f"{root}/bronze")


@register("landing_new_fields")
def landing_new_fields(spark, sf_dir):
    """Fields that no schema knows are kept at landing and promoted to typed
    columns (S4, M5); orders landed before have NULL there."""
    promoted = semistructured.promote(
        _evolved_orders(spark, sf_dir),
        {
            "gift_wrap": ("$.giftWrap", "boolean"),
            "campaign_code": ("$.campaign.code", "string"),
            "campaign_percent": ("$.campaign.percent", "bigint"),
            "segment": ("$.customer.segment", "string"),
            "first_warranty": ("$.lineItems[0].warrantyMonths", "bigint"),
        },
    )
    return promoted.select(
        "orderId",
        F.col("customer.customerId").alias("customer_id"),
        F.size("lineItems").alias("item_count"),
        "totalAmount",
        "gift_wrap",
        "campaign_code",
        "campaign_percent",
        "segment",
        "first_warranty",
    )


@register("landing_discovered_fields")
def landing_discovered_fields(spark, sf_dir):
    """The unknown fields of the landed orders: name, type, orders with it."""
    return semistructured.discovered(_evolved_orders(spark, sf_dir))


# Order numbers that an API page spans.
PAGE_KEYS = 512


def _responses(spark, sf_dir) -> DataFrame:
    """The online orders as stored responses of a paged API. Every page was
    answered in full at the third attempt. Before that, by the page's number:
    a busy server, a body that was cut off, an older state without its first
    order; and some clients recorded the answer twice."""
    orders = _m(spark, sf_dir).feed("ecommerce").drop(*AUDIT)
    k = F.regexp_extract("orderId", r"(\d+)$", 1).try_cast("bigint")
    number = F.floor(F.coalesce(k, F.lit(0)) / PAGE_KEYS).cast("bigint")
    pages = orders.select(number.alias("page"), F.struct(*orders.columns).alias("o")).groupBy("page").agg(F.collect_list("o").alias("orders"))
    last = orders.agg(F.max(number)).first()[0]
    following = F.when(F.col("page") < last, F.concat(F.lit("c"), (F.col("page") + 1).cast("string"))).alias("next")
    full = F.to_json(F.struct(following, "orders"))
    older = F.to_json(F.struct(following, F.slice("orders", 2, F.greatest(F.size("orders") - 1, F.lit(0))).alias("orders")))
    answers = [
        (F.lit(True), 3, 200, full),
        (F.col("page") % 4 == 1, 3, 200, full),
        (F.col("page") % 5 == 0, 1, 503, F.lit('{"error": "busy"}')),
        (F.col("page") % 7 == 2, 2, 200, F.substring("full", F.lit(1), F.length("full") - 9)),
        (F.col("page") % 3 == 1, 1, 200, older),
    ]
    cursor = F.concat(F.lit("c"), F.col("page").cast("string")).alias("cursor")
    recorded = [
        F.when(said, F.to_json(F.struct(cursor, F.lit(attempt).alias("attempt"), F.lit(status).alias("status"), body.alias("body"))))
        for said, attempt, status, body in answers
    ]
    root = fresh_dir(spark, "pages")
    lines = pages.withColumn("full", full).select(F.explode(F.array(*recorded)).alias("value")).filter("value IS NOT NULL")
    lines.write.option("compression", "gzip").text(f"{root}/recorded")
    return paged.land_pages(spark, f"{root}/recorded", f"{root}/bronze", "ecommerce", "orders", LANDING_TS)


@register("landing_paged_api")
def landing_paged_api(spark, sf_dir):
    """Orders landed from an API's pages: retries, older answers and repeated
    pages give the same bronze as one file of all orders (S4)."""
    return _landed_orders(paged.records(_responses(spark, sf_dir), ECOMMERCE_SCHEMA))


@register("landing_page_report")
def landing_page_report(spark, sf_dir):
    """Responses, failures and landed orders of each page."""
    return paged.page_report(_responses(spark, sf_dir))


# Files that the broken sales are exported to.
EXPORTS = 16


@register("landing_rejects")
def landing_rejects(spark, sf_dir):
    """Broken lines among the landing files keep their text: sales with fields
    missing or too many, and orders cut off in the middle."""
    m = _m(spark, sf_dir)
    root = fresh_dir(spark, "broken")
    k = F.col("o_orderkey")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey")
    short = F.concat(F.lit("POS"), k.cast("string"), F.lit(",C1,SKU-1,1"))
    long = F.concat_ws(",", F.lit("POS"), k.cast("string"), *map(F.lit, "abcdefghijkl"))
    sales = orders.filter(k % 50 < 2).select(F.lit(1).alias("o"), F.when(k % 50 == 0, short).otherwise(long).alias("value"), (k % EXPORTS).alias("export"))
    header = spark.range(EXPORTS).select(F.lit(0).alias("o"), F.lit(",".join(POS_FIELDS)).alias("value"), F.col("id").alias("export"))
    # A file per export, whose header stands above its lines.
    exports = header.unionByName(sales).repartition("export").sortWithinPartitions("export", "o")
    exports.select("value", "export").write.partitionBy("export").text(f"{root}/pos")
    cut = F.concat(F.lit('{"orderId": "ORD-'), k.cast("string"), F.lit('", "customer": {"cust'))
    orders.filter(k % 50 == 2).select(cut.alias("value")).write.text(f"{root}/ecommerce")
    good = landing.write_landing_files(m.bronze, f"{root}-good")
    pos = landing.read_pos_csv(spark, f"{root}/pos/*", LANDING_TS).unionByName(landing.read_pos_csv(spark, good["pos"], LANDING_TS))
    online = landing.read_ecommerce_json(spark, f"{root}/ecommerce", LANDING_TS).unionByName(
        landing.read_ecommerce_json(spark, good["ecommerce"], LANDING_TS)
    )
    stored = {}
    for name, df in (("pos", pos), ("ecommerce", online)):
        df.write.parquet(f"{root}-bronze/{name}")
        stored[name] = spark.read.parquet(f"{root}-bronze/{name}")
    return landing.rejects(stored).select(
        "feed", F.col("file_name").endswith(".txt").alias("from_text_file"), "raw_text"
    )


def _lake(spark, sf_dir):
    """Run the materialised pipeline into a fresh lake (tables registered)."""
    return pipeline.run(spark, sf_dir, fresh_dir(spark, "lake"))


# The tables a pipeline run registers, in catalog order.
LAYER_TABLES = [
    "silver.unified_scored",
    "silver.unified_sales",
    "silver.sales_rejected",
    "silver.unified_sales_deduped",
    "gold.revenue_by_source",
    "gold.product_performance",
    "gold.data_quality_metrics",
    "gold.executive_summary",
]


# The ten tables of the closing audit, in its order.
AUDITED = [
    "bronze.pos_raw",
    "bronze.ecommerce_raw",
    "bronze.mobile_raw",
    "silver.unified_sales",
    "silver.unified_sales_deduped",
    "silver.sales_rejected",
    "gold.revenue_by_source",
    "gold.product_performance",
    "gold.data_quality_metrics",
    "gold.executive_summary",
]


@register("layer_roundtrip")
def layer_roundtrip(spark, sf_dir):
    """Write every layer, register it in the catalog, read it back: rows, and
    what stands in them by counts of distinct and non-NULL values."""
    _lake(spark, sf_dir)
    parts = []
    for t in LAYER_TABLES:
        df = spark.table(t)
        key = "transaction_id" if t.startswith("silver.") else df.columns[0]
        parts.append(
            df.agg(
                F.count(F.lit(1)).alias("row_count"),
                F.count_distinct(key).alias("distinct_keys"),
                F.count("total_amount" if "total_amount" in df.columns else key).alias("filled"),
            ).select(F.lit(t).alias("table_name"), "*")
        )
    return reduce(DataFrame.unionAll, parts)


@register("file_inventory")
def file_inventory_q(spark, sf_dir):
    """Files and bytes behind each physical table of a run, with its rows.
    The layout decides on file counts and sizes, so what is compared is that
    they fit together."""
    res = _lake(spark, sf_dir)
    parts = []
    for t, path in sorted(res.tables.items()):
        df = spark.read.parquet(path)
        files = catalog.file_inventory(df).select(
            F.lit(t).alias("table_name"),
            (F.col("file_count") > 0).alias("has_files"),
            (
                (F.col("min_file_bytes") > 0)
                & (F.col("min_file_bytes") * F.col("file_count") <= F.col("total_bytes"))
                & (F.col("max_file_bytes") * F.col("file_count") >= F.col("total_bytes"))
            ).alias("sizes_fit"),
        )
        rows = df.agg(F.count(F.lit(1)).alias("row_count")).withColumn("table_name", F.lit(t))
        parts.append(files.join(rows, "table_name"))
    return reduce(DataFrame.unionAll, parts)


# --------------------------------------------------------------------------
# table maintenance (M1-M5)
# --------------------------------------------------------------------------

def _snapshots(spark, sf_dir) -> maintenance.SnapshotTable:
    """v0: dedup stub flags (the original behaviour); v1: real flags;
    v2: v1 compacted."""
    m = _m(spark, sf_dir)
    table = maintenance.SnapshotTable(spark, fresh_dir(spark, "snapshots"))
    # Both are of the stored production rows: the feeds are scored once.
    table.publish(dedup.mark_stub(m.stored_main), "WRITE")
    table.publish(m.deduped, "OVERWRITE")
    maintenance.compact(table)
    return table


@register("snapshot_history")
def snapshot_history(spark, sf_dir):
    """DESCRIBE HISTORY: the last 5 versions, newest first (top-k)."""
    return _snapshots(spark, sf_dir).history(limit=5).select("version", "operation", "num_rows")


@register("snapshot_as_of")
def snapshot_as_of(spark, sf_dir):
    """Time travel: version 0 read back after later versions were published."""
    return _snapshots(spark, sf_dir).read(0)


@register("snapshot_diff")
def snapshot_diff(spark, sf_dir):
    """Rows that differ between version 0 and version 1."""
    return _snapshots(spark, sf_dir).diff(0, 1)


@register("compact_table")
def compact_table(spark, sf_dir):
    """A table written as many small files, compacted, read back."""
    table = maintenance.SnapshotTable(spark, fresh_dir(spark, "compact"))
    table.publish(_m(spark, sf_dir).deduped.repartition(64), "WRITE")
    maintenance.compact(table, target_file_bytes=1 << 20)
    return table.read()


@register("compact_partitions")
def compact_partitions(spark, sf_dir):
    """A table by channel, two of whose partitions have many small files: only
    these are rewritten (M3); rows, and files before and after, by channel."""
    path = fresh_dir(spark, "crowded")
    rows = _m(spark, sf_dir).stored_main
    for source, files in (("pos", 24), ("mobile", 9), ("ecommerce", 1)):
        part = rows.filter(F.col("source_system") == source).repartition(files)
        part.write.mode("append").partitionBy("source_system").parquet(path)
    before = {s: catalog.listing(spark, f"{path}/source_system={s}")[0] for s in ("pos", "mobile", "ecommerce")}
    maintenance.compact_partitions(spark, path, "source_system", f"{path}-work")
    after = {s: catalog.listing(spark, f"{path}/source_system={s}")[0] for s in before}
    counts = spark.read.parquet(path).groupBy("source_system").agg(
        F.count(F.lit(1)).alias("records"), F.count_distinct("transaction_id").alias("ids")
    )
    files = spark.createDataFrame([(s, before[s], after[s]) for s in before], "source_system string, files_before int, files_after int")
    return counts.join(F.broadcast(files), "source_system")


@register("cluster_table")
def cluster_table(spark, sf_dir):
    """Deduped silver clustered by (source_system, transaction_date)."""
    path = fresh_dir(spark, "clustered")
    stored = f"{path}-in"
    _m(spark, sf_dir).deduped.write.parquet(stored)
    clustered = maintenance.cluster(
        spark.read.parquet(stored), ["source_system", "transaction_date"], target_file_bytes=1 << 20
    )
    clustered.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


# Ids looked up at a time.
LOOKUP_IDS = 25


@register("point_lookup")
def point_lookup(spark, sf_dir):
    """Sales of given transaction ids from a clustered table whose files carry
    Bloom filters on the id (M4): the ids least by their digests."""
    path = fresh_dir(spark, "lookup")
    main = _m(spark, sf_dir).stored_main
    ids = main.select("transaction_id").filter("transaction_id IS NOT NULL").distinct()
    wanted = [r[0] for r in ids.orderBy(F.md5("transaction_id")).limit(LOOKUP_IDS).collect()]
    clustered = maintenance.cluster(main, ["source_system", "transaction_date"], target_file_bytes=1 << 20)
    maintenance.write_with_filters(clustered, path, ["transaction_id"])
    return maintenance.lookup(spark.read.parquet(path), "transaction_id", wanted)


@register("schema_evolution")
def schema_evolution(spark, sf_dir):
    """Point-of-sale rows written first; the other channels appended later
    with a new ``channel_group`` column; read with merged schemas."""
    main = _m(spark, sf_dir).main
    path = fresh_dir(spark, "evolving")
    maintenance.append_evolving(main.filter(F.col("source_system") == "pos"), path)
    maintenance.append_evolving(
        main.filter(F.col("source_system") != "pos").withColumn("channel_group", F.lit("online")),
        path,
    )
    return maintenance.read_merged(spark, path)


@register("type_widening")
def type_widening(spark, sf_dir):
    """Three batches whose types widen: int to bigint, float to double, date to
    timestamp, and a member of a nested column; read in the widest types."""
    apply_runtime_conf(spark)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    k, path = F.col("o_orderkey"), fresh_dir(spark, "widening")

    def batch(n, key, price, day):
        rows = orders.filter(k % 3 == n)
        nested = F.struct((k % 100).cast(key).alias("slot"), F.col("o_orderstatus").alias("status"))
        return rows.select(
            k.cast(key).alias("order_key"),
            F.floor("o_totalprice").cast(price).alias("price"),
            F.col("o_orderdate").cast(day).alias("ordered"),
            nested.alias("place"),
        )

    maintenance.append_evolving(batch(0, "int", "float", "date"), path)
    maintenance.append_evolving(batch(1, "bigint", "float", "date"), path)
    maintenance.append_evolving(batch(2, "bigint", "double", "timestamp"), path)
    rows = maintenance.read_merged(spark, path)
    return rows.select("order_key", "price", "ordered", F.col("place.slot").alias("slot"), F.col("place.status").alias("status"))


# --------------------------------------------------------------------------
# streaming and incremental
# --------------------------------------------------------------------------

# Files of a feed per micro-batch, at least, and micro-batches, at most: each has
# a planning and commit of its own, however few rows it takes.
BATCH_FILES = 2
MICRO_BATCHES = 16


def _silver_stream_run(spark, sf_dir) -> str:
    """W1 over the landed bronze files, two files per micro-batch, or more where
    there are so many that it takes over ``MICRO_BATCHES``; returns the sink path."""
    _m(spark, sf_dir).bronze  # make sure the feeds are landed
    root = landing.bronze_root(spark, sf_dir)
    paths = {n: f"{root}/{n}" for n in ("pos", "ecommerce", "mobile")}
    most = max(catalog.listing(spark, p)[0] for p in paths.values())
    out = fresh_dir(spark, "stream-silver")
    incremental.stream_silver(
        spark, paths, f"{out}/sink", f"{out}/checkpoint", max_files_per_trigger=max(BATCH_FILES, math.ceil(most / MICRO_BATCHES))
    )
    return f"{out}/sink"


@register("stream_silver")
def stream_silver(spark, sf_dir):
    """Scored silver produced incrementally by a file stream."""
    return spark.read.parquet(_silver_stream_run(spark, sf_dir)).select(*SCORED_COLUMNS)


@register("stream_dedup")
def stream_dedup(spark, sf_dir):
    """Rows kept by the streaming first-arrival dedup, in one micro-batch, so
    that the arrival order is that of the rows: one row per full key, plus
    every row whose key has a NULL part (never a duplicate)."""
    silver = _silver_stream_run(spark, sf_dir)
    out = fresh_dir(spark, "stream-dedup")
    incremental.stream_dedup(spark, silver, f"{out}/sink", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/sink").select(*SCORED_COLUMNS, "dedup_day")


@register("stream_revenue")
def stream_revenue(spark, sf_dir):
    silver = _silver_stream_run(spark, sf_dir)
    out = fresh_dir(spark, "stream-revenue")
    incremental.stream_revenue(spark, silver, f"{out}/sink", f"{out}/checkpoint", max_files_per_trigger=8)
    return incremental.read_revenue(spark, f"{out}/sink")


# Rows arrive in drops of two years of sales; those with such a
# digest of the transaction id, one in ten, come with the next drop.
DROPS = 5
LATE_SHARE = 10


def _in_drops(spark, sf_dir, run) -> str:
    """Production rows as they arrive: each drop is appended to the stored
    table, then ``run`` takes what is new."""
    m = _m(spark, sf_dir)
    path = fresh_dir(spark, "drops")
    mark = F.conv(F.substring(F.md5("transaction_id"), 1, 8), 16, 10).cast("bigint")
    number = F.floor((F.year("transaction_date") - 1992) / 2)
    drop = F.least(F.greatest(F.coalesce(number, F.lit(0)), F.lit(0)), F.lit(DROPS - 2))
    drop = drop + F.when(mark % LATE_SHARE == 0, 1).otherwise(0)
    m.main.withColumn("_drop", drop).write.partitionBy("_drop").parquet(f"{path}/all")
    for i in range(DROPS):
        part = spark.read.schema(SCORED_SCHEMA).parquet(f"{path}/all/_drop={i}")
        part.write.mode("append").parquet(f"{path}/silver")
        run(f"{path}/silver", f"{path}/out")
    return f"{path}/out"


@register("stream_dedup_watermark")
def stream_dedup_watermark(spark, sf_dir):
    """First arrival of each key over several micro-batches, state bounded by
    a watermark; late rows are settled apart, none is lost (W2)."""
    out = _in_drops(spark, sf_dir, lambda silver, out: event_time.dedup(spark, silver, out))
    event_time.settle(spark, out)
    return event_time.read_dedup(spark, out).select(*SCORED_COLUMNS, "dedup_day")


@register("stream_revenue_windows")
def stream_revenue_windows(spark, sf_dir):
    """Daily revenue finalised by a watermark, each day emitted once, with the
    corrections of late rows (W3)."""
    out = _in_drops(spark, sf_dir, lambda silver, out: event_time.daily_revenue(spark, silver, out))
    return event_time.read_daily_revenue(spark, out)


# Buckets of a table stored by key, a file each: so many at least, more for
# larger tables.
BUCKETS = 16


def _buckets(spark, sf_dir) -> int:
    return max(BUCKETS, sizing.partitions_for(spark, sf_dir))


# The snapshot/change split day and the status update replay.
UPSERT_SPLIT_DAY = "2024-03-05"
UPSERT_DELAY = "INTERVAL 10 DAYS"


def _snapshot_and_changes(main: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Snapshot of the first landing days, then a change set: the later days
    plus pending online orders re-sent as completed ten days later."""
    day = F.to_date("ingestion_timestamp")
    current = main.filter(day <= F.lit(UPSERT_SPLIT_DAY).cast("date"))
    later = main.filter(day > F.lit(UPSERT_SPLIT_DAY).cast("date"))
    updates = (
        current.filter((F.col("source_system") == "ecommerce") & (F.col("status") == "pending"))
        .withColumn("status", F.lit("completed"))
        .withColumn("ingestion_timestamp", F.col("ingestion_timestamp") + F.expr(UPSERT_DELAY))
        .withColumn("transformation_timestamp", F.col("transformation_timestamp") + F.expr(UPSERT_DELAY))
    )
    return current, later.unionByName(updates)


@register("incremental_upsert")
def incremental_upsert(spark, sf_dir):
    # Snapshot and changes are read several times each.
    current, changes = _snapshot_and_changes(_m(spark, sf_dir).stored_main)
    return incremental.upsert_latest(current, changes, ["source_system", "transaction_id"], ["ingestion_timestamp"])


@register("bucketed_upsert")
def bucketed_upsert(spark, sf_dir):
    """The same upsert into a snapshot stored in buckets of its key (S9, W4):
    the stored side is not exchanged."""
    current, changes = _snapshot_and_changes(_m(spark, sf_dir).stored_main)
    key = ["source_system", "transaction_id"]
    path = fresh_dir(spark, "bucketed")
    name = f"silver.snapshot_{path.rsplit('-', 1)[1]}"
    stored = catalog.bucketed_table(current, name, path, key, _buckets(spark, sf_dir))
    return incremental.upsert_latest(stored, changes, key, ["ingestion_timestamp"])


@register("bucketed_dedup_keys")
def bucketed_dedup_keys(spark, sf_dir):
    """Keys with rows of several channels, from silver stored in buckets of the
    duplicate key (S9, U2): grouped without an exchange."""
    rows = _m(spark, sf_dir).stored_main.withColumn("dedup_day", F.to_date("transaction_date"))
    key = ["customer_id", "product_id", "dedup_day"]
    path = fresh_dir(spark, "bucketed")
    stored = catalog.bucketed_table(rows, f"silver.keyed_{path.rsplit('-', 1)[1]}", path, key, _buckets(spark, sf_dir))
    return dedup.several_channels(stored, key)


@register("incremental_run")
def incremental_run(spark, sf_dir):
    """A base run over the first landing days plus ``run_increment`` with
    the rest, from CSV / JSON / Parquet landing files. Returns the deduped
    silver table without the columns that record file names and landing
    times (those depend on the landing, not on the data)."""
    bronze = _m(spark, sf_dir).bronze
    early = F.to_date("ingestion_timestamp") <= F.lit(UPSERT_SPLIT_DAY).cast("date")
    first = landing.write_landing_files(
        {n: df.filter(early) for n, df in bronze.items()}, fresh_dir(spark, "inc-first")
    )
    second = landing.write_landing_files(
        {n: df.filter(~early) for n, df in bronze.items()}, fresh_dir(spark, "inc-second")
    )
    base = pipeline.run(
        spark, None, fresh_dir(spark, "inc-lake"), landing_paths=first, ingestion_ts=LANDING_TS,
        register=False, period="month",
    )
    # A retry of the same batch must change nothing.
    for _ in range(2):
        res = pipeline.run_increment(spark, base.base, second, ingestion_ts=LANDING_TS, report_date=DEFAULT_REPORT_DATE)
    return spark.read.parquet(res.tables["silver.unified_sales_deduped"]).select(
        *[c for c in DEDUP_COLUMNS if c not in ("source_file", "ingestion_timestamp", "transformation_timestamp")]
    )


# Changes are drawn from rows of the first days of a month whose
# key occurs once, by a digest of the transaction id modulo CHANGE_KINDS.
CHANGE_DAYS = 6
CHANGE_KINDS = 10


def _changes(deduped: DataFrame) -> list[DataFrame]:
    """Two batches of changes, some of them out of order: updates that an older
    one follows, deletes that a late update or an insert follows, rows that
    move to another month, and new rows."""
    rows = deduped.filter(F.dayofmonth("transaction_date") <= CHANGE_DAYS).select(*SCORED_COLUMNS)
    once = deduped.groupBy("source_system", "transaction_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n = 1")
    rows = rows.join(once.drop("_n"), ["source_system", "transaction_id"], "left_semi")
    mark = F.conv(F.substring(F.md5("transaction_id"), 1, 8), 16, 10).cast("bigint")
    rows = rows.withColumn("_kind", mark % CHANGE_KINDS).withColumn("_again", mark % (5 * CHANGE_KINDS) == 1)
    # Stored: both batches are made of them, kind by kind.
    path = fresh_dir(deduped.sparkSession, "changing")
    rows.write.parquet(path)
    rows = deduped.sparkSession.read.schema(rows.schema).parquet(path)

    def some(kind, op, seq, **new):
        found = rows.filter(F.col("_kind") == kind)
        for name, value in new.items():
            found = found.withColumn(name, value)
        return found.select(F.lit(op).alias("op"), F.lit(seq).cast("long").alias("seq"), *SCORED_COLUMNS, "_again")

    more = F.col("quantity") + 1
    moved = F.col("transaction_date") + F.expr("INTERVAL 40 DAYS")
    first = [
        some(0, "U", 2, quantity=more),
        some(1, "D", 3),
        some(2, "U", 5, transaction_date=moved),
        some(3, "I", 1, transaction_id=F.concat("transaction_id", F.lit("-N"))),
    ]
    second = [
        some(0, "U", 1, quantity=F.lit(100).cast("long")),
        some(1, "U", 2, quantity=F.lit(100).cast("long")),
        some(1, "I", 4).filter("_again"),
        some(2, "U", 6, quantity=more, transaction_date=moved),
    ]
    return [reduce(DataFrame.unionByName, batch).drop("_again") for batch in (first, second)]


# The changed lake of an application's input, which two queries read.
_CHANGED: dict[tuple[str, str], dict[str, str]] = {}


def _changed_lake(spark, sf_dir) -> dict[str, str]:
    """Tables of a lake of all landing files to which both batches have been
    applied, the first one twice, as in a retry."""
    known = (spark.sparkContext.applicationId, sf_dir)
    if known in _CHANGED:
        return _CHANGED[known]
    files = landing.write_landing_files(_m(spark, sf_dir).bronze, fresh_dir(spark, "cdc-files"))
    base = pipeline.run(
        spark, None, fresh_dir(spark, "cdc-lake"), landing_paths=files, ingestion_ts=LANDING_TS,
        register=False, period="month",
    )
    stored = f"{base.base}-rows"
    # The changes of a source system, as it would send them.
    spark.read.parquet(base.tables["silver.unified_sales_deduped"]).select(*SCORED_COLUMNS).write.parquet(stored)
    batches = _changes(spark.read.parquet(stored))
    for name, batch in (("c1", batches[0]), ("c1", batches[0]), ("c2", batches[1])):
        pipeline.apply_changes(spark, base.base, batch, name, report_date=DEFAULT_REPORT_DATE)
    return _CHANGED.setdefault(known, base.tables)


@register("cdc_apply")
def cdc_apply(spark, sf_dir):
    """Inserts, updates and deletes applied in two batches, out of order."""
    path = _changed_lake(spark, sf_dir)["silver.unified_sales_deduped"]
    return spark.read.parquet(path).select(
        *[c for c in DEDUP_COLUMNS if c not in ("source_file", "ingestion_timestamp", "transformation_timestamp")]
    )


@register("cdc_gold")
def cdc_gold(spark, sf_dir):
    """The four gold tables after the changes, kept up from the partials of the
    periods that changed (G1-G4): figures by table and key."""
    tables = _changed_lake(spark, sf_dir)
    shapes = {
        "revenue_by_source": ("source_system", "transaction_date", ["transaction_count", "unique_customers", "unique_products", "total_revenue", "avg_transaction_value"]),
        "product_performance": ("source_system", "product_id", ["times_sold", "total_quantity_sold", "total_revenue", "avg_unit_price"]),
        "data_quality_metrics": ("source_system", "quality_tier", ["record_count", "avg_quality_score"]),
        "executive_summary": (None, "report_date", ["total_transactions", "unique_customers", "total_revenue", "avg_transaction_value", "avg_data_quality"]),
    }
    parts = []
    for name, (source, key, figures) in shapes.items():
        columns = [F.col(c).cast("double") for c in figures] + [F.lit(None).cast("double")] * (5 - len(figures))
        parts.append(
            spark.read.parquet(tables[f"gold.{name}"]).select(
                F.lit(name).alias("table_name"),
                (F.col(source) if source else F.lit(None).cast("string")).alias("source_system"),
                F.col(key).cast("string").alias("key"),
                *[c.alias(f"figure_{i}") for i, c in enumerate(columns, 1)],
            )
        )
    return reduce(DataFrame.unionAll, parts)


def queries() -> dict[str, Query]:
    def wrap(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return zone_free(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        return run

    return {name: wrap(fn) for name, fn in REGISTRY.items()}
