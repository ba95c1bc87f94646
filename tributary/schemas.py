"""Schemas of the three landing feeds and the pinned silver schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S = T.StringType()
D = T.DoubleType()
L = T.LongType()

# Audit columns every bronze table carries.
AUDIT_FIELDS = [
    T.StructField("source_system", S),
    T.StructField("source_format", S),
    T.StructField("ingestion_timestamp", T.TimestampType()),
    T.StructField("file_name", S),
]

# Point of sale: flat, every field is text.
POS_FIELDS = [
    "TRANS_ID",
    "CUST_NUM",
    "PRODUCT_CODE",
    "QTY",
    "PRICE",
    "TRANS_DATE",
    "STORE",
    "STATUS",
    "PAYMENT_TYPE",
    "CASHIER_ID",
    "REGISTER_NUM",
]
POS_SCHEMA = T.StructType([T.StructField(n, S) for n in POS_FIELDS])

# E-commerce: nested orders; line quantity arrives as text.
LINE_ITEM = T.StructType(
    [
        T.StructField("productId", S),
        T.StructField("productName", S),
        T.StructField("quantity", S),
        T.StructField("unitPrice", D),
        T.StructField("discount", D),
    ]
)
ECOMMERCE_SCHEMA = T.StructType(
    [
        T.StructField("orderId", S),
        T.StructField("orderDate", S),
        T.StructField(
            "customer",
            T.StructType(
                [
                    T.StructField("customerId", S),
                    T.StructField("email", S),
                    T.StructField("loyaltyTier", S),
                ]
            ),
        ),
        T.StructField("lineItems", T.ArrayType(LINE_ITEM)),
        T.StructField(
            "payment",
            T.StructType(
                [
                    T.StructField("method", S),
                    T.StructField("status", S),
                    T.StructField("transactionId", S),
                ]
            ),
        ),
        T.StructField(
            "shipping",
            T.StructType(
                [
                    T.StructField("method", S),
                    T.StructField(
                        "address",
                        T.StructType([T.StructField("country", S), T.StructField("city", S)]),
                    ),
                ]
            ),
        ),
        T.StructField("platform", S),
        T.StructField("totalAmount", D),
    ]
)

# Mobile: flat and typed; timestamp is epoch seconds.
MOBILE_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", S),
        T.StructField("product_id", S),
        T.StructField("device_id", S),
        T.StructField("quantity", L),
        T.StructField("amount", D),
        T.StructField("timestamp", L),
        T.StructField("app_version", S),
        T.StructField("platform", S),
        T.StructField("payment_status", S),
    ]
)


# Unified sale, in union order (point of sale first).
UNIFIED_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", S),
        T.StructField("transaction_date", T.TimestampType()),
        T.StructField("customer_id", S),
        T.StructField("product_id", S),
        T.StructField("quantity", L),
        T.StructField("unit_price", D),
        T.StructField("store_id", S),
        T.StructField("status", S),
        T.StructField("payment_method", S),
        T.StructField("source_system", S),
        T.StructField("ingestion_timestamp", T.TimestampType()),
        T.StructField("source_file", S),
        T.StructField("total_amount", D),
    ]
)
UNIFIED_COLUMNS = UNIFIED_SCHEMA.fieldNames()

SCORED_SCHEMA = T.StructType(
    list(UNIFIED_SCHEMA.fields)
    + [
        T.StructField("quality_score", T.IntegerType()),
        T.StructField("quality_tier", S),
        T.StructField("transformation_timestamp", T.TimestampType()),
        T.StructField("needs_review", T.BooleanType()),
    ]
)
SCORED_COLUMNS = SCORED_SCHEMA.fieldNames()

DEDUP_COLUMNS = SCORED_COLUMNS + ["is_duplicate", "duplicate_resolution"]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema``'s columns in order, cast to its types.

    Casts here only widen or restate types already produced by the cleaning
    expressions, so they cannot fail under ANSI mode.
    """
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
