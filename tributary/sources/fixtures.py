"""Deterministic bronze feeds derived from the driver tables.

The three landing feeds are views over ``orders``, ``lineitem`` and
``events``: integer arithmetic on the row key decides every dirty value, so the
same rows come out on every run, in every engine, at every scale. The rates
follow the original random generators (about 20% missing customers, 10% bad
product codes, 12% odd prices, 8% odd quantities, 15% missing dates, 1%
corrupt rows, 5% duplicate copies, 5% broken orders).

Each feed is a narrow projection of one scan, except the e-commerce feed,
which nests an order's lines into an array (one aggregation on the order key,
co-partitioned with the join to ``orders``).

Every row also gets a landing day, ``2024-03-01 + key % 10``: it stands for the
daily file the record arrived in and is carried as ``ingestion_timestamp``
and ``file_name``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.schemas import ECOMMERCE_SCHEMA, MOBILE_SCHEMA

# First landing day and number of daily batches.
FIRST_LANDING_DAY = "2024-03-01"
LANDING_DAYS = 10


def table(spark: SparkSession, sf_dir: str, name: str, key: str | None = None) -> DataFrame:
    return fan_out(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"), key)


def fan_out(df: DataFrame, key: str | None = None) -> DataFrame:
    """Spread a scan that has fewer splits than the cluster has cores.

    A large input already arrives as many file splits and is returned as is
    (no shuffle). A small single-file table would otherwise run all the
    per-row derivation below in one task, and its landed output would be
    one file that serialises every later stage.

    When the next operator groups by ``key``, the fan-out hash-partitions on
    it, so that aggregation reuses the partitioning instead of shuffling again.
    """
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        # Split count of the planned scan (file listing only; no job, no Python RDD).
        splits = df._jdf.queryExecution().toRdd().getNumPartitions()
    except Exception:  # noqa: BLE001 - no JVM handle: leave the scan as it is
        return df
    if splits >= cores:
        return df
    return df.repartition(cores, key) if key else df.repartition(cores)


def pad(c: Column, width: int) -> Column:
    """Zero-padded decimal text; never truncates. Java's formatter, which is
    slow, is left to negative numbers and NULL."""
    text = c.cast("string")
    padded = F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))
    return F.when(c >= 0, padded).otherwise(F.format_string(f"%0{width}d", c))


def _pick(selector: Column, values: list) -> Column:
    """``values[selector]`` for a 0-based integer selector (None = NULL)."""
    out = None
    for i, v in enumerate(values):
        lit = F.lit(v) if v is not None else F.lit(None).cast("string")
        out = F.when(selector == i, lit) if out is None else out.when(selector == i, lit)
    return out


def landing_day(key: Column) -> Column:
    return F.date_add(F.to_date(F.lit(FIRST_LANDING_DAY)), (key % LANDING_DAYS).cast("int"))


def _audit(day: Column, system: str, fmt: str, prefix: str, ext: str) -> list[Column]:
    return [
        F.lit(system).alias("source_system"),
        F.lit(fmt).alias("source_format"),
        day.cast("timestamp").alias("ingestion_timestamp"),
        F.concat(F.lit(prefix), F.date_format(day, "yyyyMMdd"), F.lit(ext)).alias("file_name"),
    ]


# --------------------------------------------------------------------------
# point of sale
# --------------------------------------------------------------------------

def pos_raw(orders: DataFrame) -> DataFrame:
    """One row per order (key k); k % 100 = 99 is a corrupt row; k % 20 = 3
    has a second copy whose id ends in ``_DUP``; k % 20 = 7 sells the same
    product, customer and day as its online order (a cross-channel echo)."""
    k = F.col("o_orderkey")
    corrupt = (k % 100) == 99
    p = (k * 15485863 + 7) % 64
    q = (k * 32452843 + 11) % 26
    r_prod = (k * 104729 + 3) % 100
    r_qty = (k * 1299709 + 5) % 100
    x = F.concat((F.lit(10) + k % 490).cast("string"), F.lit("."), pad((k * 37) % 100, 2))
    od = F.col("o_orderdate")

    # Fixed values, from here on: the dirty spellings that the rules clean.
    trans_id = F.when(~corrupt, F.concat(F.lit("POS"), pad(k, 8)))
    cust = (
        F.when(corrupt, F.lit("###CORRUPT###"))
        .when((k * 7919 + 1) % 100 < 20, F.lit(None))
        .otherwise(F.concat(F.lit("C"), pad(F.col("o_custkey"), 5)))
    )
    product = (
        F.when(corrupt, F.lit(None))
        .when(k % 20 == 7, F.concat(F.lit("PROD-"), pad((k * 31 + 7) % 50 + 1, 4)))
        .when(r_prod < 4, F.lit(None))
        .when(r_prod < 7, F.lit(""))
        .when(r_prod < 10, F.lit("MISSING"))
        .otherwise(F.concat(F.lit("SKU-"), (F.lit(1000) + (k * 31) % 9000).cast("string")))
    )
    qty = (
        F.when(corrupt, F.lit("abc"))
        .when(r_qty < 2, F.lit(None))
        .when(r_qty < 4, F.lit(""))
        .when(r_qty < 6, F.lit("0"))
        .when(r_qty < 8, F.lit("-1"))
        .when(k % 50 == 13, (F.lit(100) + k % 401).cast("string"))
        .otherwise((F.lit(1) + k % 5).cast("string"))
    )
    price = (
        F.when(corrupt, F.lit("INVALID"))
        .when(k % 100 == 13, F.lit("0.75"))
        .when(p == 0, F.concat(F.lit("$"), x))
        .when(p == 1, F.concat(F.lit("PHP "), x))
        .when(p == 2, F.concat(x, F.lit(" USD")))
        .when(p == 3, F.regexp_replace(x, r"\.", ","))
        .when(p == 4, F.concat(F.lit("-"), x))
        .when(p == 5, F.lit(None))
        .when(p == 6, F.lit(""))
        .when(p == 7, F.lit("0"))
        .otherwise(x)
    )
    date_text = (
        F.when(corrupt, F.lit("99/99/9999"))
        .when(q == 0, F.lit(None))
        .when(q == 1, F.lit(""))
        .when(q == 2, F.lit("NULL"))
        .when(q == 3, F.lit("00/00/0000"))
        .when(q % 4 == 0, F.date_format(od, "MM/dd/yyyy"))
        .when(q % 4 == 1, F.date_format(od, "dd-MM-yyyy"))
        .when(q % 4 == 2, F.date_format(od, "yyyy-MM-dd"))
        .otherwise(F.date_format(od, "dd/MM/yyyy"))
    )
    store = F.when(~corrupt, _pick(k % 5, ["Store_A", "Store_B", "Store_C", "Store-D", None]))
    status = F.when(corrupt, F.lit("ERROR")).otherwise(
        _pick(F.floor(k / 5) % 6, ["COMPLETE", "complete", "PENDING", "VOID", "", None])
    )
    payment = F.when(~corrupt, _pick(F.floor(k / 7) % 5, ["CASH", "cash", "CREDIT", "DEBIT", None]))
    cashier = F.when(~corrupt, F.concat(F.lit("EMP"), pad(k % 50 + 1, 3)))
    register = F.when(~corrupt, F.concat(F.lit("REG"), pad(k % 10 + 1, 2)))

    day = landing_day(k)
    columns = [
        ("CUST_NUM", cust),
        ("PRODUCT_CODE", product),
        ("QTY", qty),
        ("PRICE", price),
        ("TRANS_DATE", date_text),
        ("STORE", store),
        ("STATUS", status),
        ("PAYMENT_TYPE", payment),
        ("CASHIER_ID", cashier),
        ("REGISTER_NUM", register),
    ]
    rest = [c.alias(n) for n, c in columns] + _audit(day, "legacy_pos", "csv", "pos_export_", ".csv")
    base = orders.select(trans_id.alias("TRANS_ID"), *rest)
    # Same-content copies under a ``_DUP`` id. The key filter is evaluated on
    # the scan, so this branch reads only the matching orders.
    copies = orders.filter(k % 20 == 3).select(
        F.concat(trans_id, F.lit("_DUP")).alias("TRANS_ID"), *rest
    )
    return base.unionByName(copies)


# --------------------------------------------------------------------------
# e-commerce
# --------------------------------------------------------------------------

def ecommerce_raw(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One nested row per order, one without lines included (an empty array);
    k % 20 = 19 is a broken order.

    A line's position is its rank in (linenumber, partkey, suppkey, shipdate,
    extendedprice) order within the order. The array is bounded by the order
    (the driver tables have at most 7 lines per order); at scale this feed
    lands already nested from JSON, and this aggregation exists only to derive
    it from the flat tables.
    """
    line = F.struct(
        F.col("l_linenumber"),
        F.col("l_partkey"),
        F.col("l_suppkey"),
        F.col("l_shipdate"),
        F.col("l_extendedprice"),
        F.col("l_quantity"),
        F.col("l_discount"),
    )
    qty = F.lit(1) + F.col("l_quantity").cast("bigint") % 8
    cents = F.lit(1500) + (F.col("l_partkey") * 3701) % 58500
    per_order = lineitem.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(line)).alias("_lines"),
        F.sum(qty * cents).alias("_cents"),
    )
    k = F.col("o_orderkey")
    broken = (k % 20) == 19

    def item(x: Column, i: Column) -> Column:
        pid = F.concat(F.lit("PROD-"), pad((k * 31 + (i + 1) * 7) % 50 + 1, 4))
        return F.struct(
            pid.alias("productId"),
            F.concat(F.lit("Product "), pid).alias("productName"),
            (F.lit(1) + x["l_quantity"].cast("bigint") % 8).cast("string").alias("quantity"),
            ((F.lit(1500) + (x["l_partkey"] * 3701) % 58500) / F.lit(100.0)).alias("unitPrice"),
            x["l_discount"].alias("discount"),
        )

    od = F.col("o_orderdate")
    order_date = F.concat(
        F.date_format(od, "yyyy-MM-dd"),
        F.lit("T"),
        pad((k * 13) % 24, 2),
        F.lit(":"),
        pad((k * 29) % 60, 2),
        F.lit(":00Z"),
    )
    cust_key = F.col("o_custkey")
    customer = F.struct(
        F.when((k * 7919 + 2) % 100 >= 10, F.concat(F.lit("CUST-"), pad(cust_key, 5))).alias(
            "customerId"
        ),
        F.when(
            (k * 104729 + 4) % 100 >= 5,
            F.concat(F.lit("customer"), cust_key.cast("string"), F.lit("@example.com")),
        ).alias("email"),
        _pick(k % 5, ["bronze", "silver", "gold", "platinum", None]).alias("loyaltyTier"),
    )
    payment = F.struct(
        F.when(~broken, _pick(k % 4, ["credit_card", "paypal", "apple_pay", "google_pay"])).alias(
            "method"
        ),
        F.when(broken, F.lit("error"))
        .otherwise(_pick(k % 4, ["completed", "pending", "failed", "refunded"]))
        .alias("status"),
        F.when(~broken, F.concat(F.lit("TXN-"), k.cast("string"))).alias("transactionId"),
    )
    shipping = F.struct(
        _pick(k % 3, ["standard", "express", "overnight"]).alias("method"),
        F.struct(
            F.lit("PH").alias("country"),
            _pick(k % 4, ["Manila", "Quezon City", "Makati", "Cebu"]).alias("city"),
        ).alias("address"),
    )
    empty = F.array().cast(ECOMMERCE_SCHEMA["lineItems"].dataType)
    items = F.coalesce(F.transform(F.col("_lines"), item), empty)
    day = landing_day(k)
    joined = orders.join(per_order, orders["o_orderkey"] == per_order["l_orderkey"], "left")
    return joined.select(
        F.when(broken, F.concat(F.lit("ORD-ERROR-"), k.cast("string")))
        .otherwise(F.concat(F.lit("ORD-"), pad(k, 8)))
        .alias("orderId"),
        F.when(~broken, order_date).alias("orderDate"),
        F.when(~broken, customer).alias("customer"),
        F.when(broken, empty).otherwise(items).alias("lineItems"),
        payment.alias("payment"),
        F.when(~broken, shipping).alias("shipping"),
        F.when(broken, F.lit("unknown"))
        .when(k % 10 < 7, F.lit("web"))
        .otherwise(F.lit("mobile_web"))
        .alias("platform"),
        F.when(broken, F.lit(0.0)).otherwise(F.coalesce("_cents", F.lit(0)) / F.lit(100.0)).alias("totalAmount"),
        *_audit(day, "ecommerce_platform", "json", "orders_", ".json"),
    )


# --------------------------------------------------------------------------
# mobile
# --------------------------------------------------------------------------

def mobile_raw(events: DataFrame) -> DataFrame:
    """One row per event; 'error' events are broken rows, 'signup' is a status
    that no mapping knows."""
    e = F.col("event_id")
    et = F.col("event_type")
    broken = et == "error"
    epoch = F.unix_seconds(F.col("ts").cast("timestamp"))
    day = landing_day(e)
    return events.select(
        F.when(~broken, F.concat(F.lit("MTX-"), e.cast("string"))).alias("transaction_id"),
        F.when(~broken, F.concat(F.lit("MP-"), ((e * 17) % 200).cast("string"))).alias(
            "product_id"
        ),
        F.concat(F.lit("device_"), pad(F.col("user_id"), 16)).alias("device_id"),
        F.when(broken, F.lit(0)).otherwise(F.lit(1) + e % 5).cast("bigint").alias("quantity"),
        F.when(broken, F.lit(0.0)).otherwise(F.col("value")).alias("amount"),
        F.when(broken, F.lit(0)).otherwise(epoch).cast("bigint").alias("timestamp"),
        F.when(broken, F.lit("unknown"))
        .otherwise(_pick(e % 4, ["2.1.0", "2.2.0", "2.3.0", "2.4.0"]))
        .alias("app_version"),
        F.when(broken, F.lit("unknown")).otherwise(_pick(e % 2, ["iOS", "Android"])).alias(
            "platform"
        ),
        F.when(et == "purchase", F.lit("completed"))
        .when(et == "click", F.lit("pending"))
        .when(et == "view", F.lit("failed"))
        .when(et.isin("error", "signup"), et)
        .alias("payment_status"),
        *_audit(day, "mobile_app", "parquet", "mobile_txn_", ".parquet"),
    )


def bronze_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three bronze feeds over the tables in ``sf_dir``."""
    orders = table(spark, sf_dir, "orders")
    lineitem = table(spark, sf_dir, "lineitem", key="l_orderkey")
    events = table(spark, sf_dir, "events")
    return {
        "pos": pos_raw(orders),
        "ecommerce": ecommerce_raw(orders, lineitem),
        "mobile": mobile_raw(events),
    }


__all__ = [
    "MOBILE_SCHEMA",
    "bronze_feeds",
    "ecommerce_raw",
    "mobile_raw",
    "pad",
    "pos_raw",
    "table",
]
