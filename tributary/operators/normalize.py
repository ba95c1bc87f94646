"""Source transforms: each feed to the unified sales schema.

Each transform is a single narrow ``select`` over its bronze feed, so the
union of the three is a plain ``Union`` of projections: no shuffle, and
filters on the unified frame are pushed into each branch's scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions import codes, dates, prices
from tributary.rules import AS_CODED, CleaningRules
from tributary.schemas import UNIFIED_SCHEMA, conform


def _total(quantity: str, price: str):
    q, p = F.col(quantity), F.col(price)
    return F.when(q.isNotNull() & p.isNotNull(), q * p)


def normalize_pos(bronze: DataFrame, rules: CleaningRules = AS_CODED) -> DataFrame:
    out = bronze.select(
        F.col("TRANS_ID").alias("transaction_id"),
        dates.parse_date_text("TRANS_DATE", rules).alias("transaction_date"),
        codes.pos_customer_id("CUST_NUM", rules).alias("customer_id"),
        codes.product_id("PRODUCT_CODE", rules).alias("product_id"),
        codes.pos_quantity("QTY").alias("quantity"),
        prices.clean_price("PRICE", rules).alias("unit_price"),
        codes.store_id("STORE").alias("store_id"),
        codes.standardize_status("STATUS").alias("status"),
        codes.payment_method("PAYMENT_TYPE").alias("payment_method"),
        F.lit("pos").alias("source_system"),
        F.col("ingestion_timestamp"),
        F.col("file_name").alias("source_file"),
    ).withColumn("total_amount", _total("quantity", "unit_price"))
    return conform(out, UNIFIED_SCHEMA)


def normalize_ecommerce(bronze: DataFrame, rules: CleaningRules = AS_CODED) -> DataFrame:
    """Order grain: product, quantity and price come from the first line item,
    the amount is the order total (exact for single-item orders)."""
    first = F.get(F.col("lineItems"), 0)
    out = bronze.select(
        F.col("orderId").alias("transaction_id"),
        dates.parse_iso_z("orderDate").alias("transaction_date"),
        F.col("customer.customerId").alias("customer_id"),
        first["productId"].alias("product_id"),
        first["quantity"].try_cast("bigint").alias("quantity"),
        first["unitPrice"].alias("unit_price"),
        F.col("totalAmount").alias("total_amount"),
        F.lit("ONLINE").alias("store_id"),
        codes.standardize_status(F.col("payment.status")).alias("status"),
        F.col("payment.method").alias("payment_method"),
        F.lit("ecommerce").alias("source_system"),
        F.col("ingestion_timestamp"),
        F.col("file_name").alias("source_file"),
    )
    return conform(out, UNIFIED_SCHEMA)


def normalize_mobile(bronze: DataFrame, rules: CleaningRules = AS_CODED) -> DataFrame:
    q, amount = F.col("quantity"), F.col("amount")
    out = bronze.select(
        F.col("transaction_id"),
        dates.epoch_to_ts("timestamp", rules).alias("transaction_date"),
        codes.device_customer_id("device_id").alias("customer_id"),
        F.col("product_id"),
        q.cast("bigint").alias("quantity"),
        F.when(q.isNotNull() & (q > 0) & amount.isNotNull(), amount / q).alias("unit_price"),
        amount.alias("total_amount"),
        F.lit("MOBILE").alias("store_id"),
        codes.standardize_status("payment_status").alias("status"),
        F.lit("mobile_app_payment").alias("payment_method"),
        F.lit("mobile").alias("source_system"),
        F.col("ingestion_timestamp"),
        F.col("file_name").alias("source_file"),
    )
    return conform(out, UNIFIED_SCHEMA)


def unify(pos: DataFrame, ecommerce: DataFrame, mobile: DataFrame) -> DataFrame:
    """Union by name, duplicates kept, types already pinned per branch."""
    return pos.unionByName(ecommerce).unionByName(mobile)


def unified_sales(feeds: dict[str, DataFrame], rules: CleaningRules = AS_CODED) -> DataFrame:
    return unify(
        normalize_pos(feeds["pos"], rules),
        normalize_ecommerce(feeds["ecommerce"], rules),
        normalize_mobile(feeds["mobile"], rules),
    )


def ecommerce_line_items(bronze: DataFrame) -> DataFrame:
    """Line grain: one row per line item (``posexplode_outer``: an order
    with no lines is kept as one row with NULL line fields).
    ``line_number`` is 1-based."""
    exploded = bronze.select(
        F.col("orderId").alias("transaction_id"),
        dates.parse_iso_z("orderDate").alias("transaction_date"),
        F.col("customer.customerId").alias("customer_id"),
        F.posexplode_outer("lineItems").alias("_pos", "_item"),
    )
    item = F.col("_item")
    qty = item["quantity"].try_cast("bigint")
    return exploded.select(
        "transaction_id",
        "transaction_date",
        "customer_id",
        (F.col("_pos") + 1).cast("int").alias("line_number"),
        item["productId"].alias("product_id"),
        item["productName"].alias("product_name"),
        qty.alias("quantity"),
        item["unitPrice"].alias("unit_price"),
        item["discount"].alias("discount"),
        (qty * item["unitPrice"]).alias("gross_amount"),
    )
