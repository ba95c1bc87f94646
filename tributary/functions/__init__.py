"""Column builders: pure ``Column -> Column`` functions, no UDFs."""

from tributary.functions.codes import (
    device_customer_id,
    payment_method,
    pos_customer_id,
    pos_quantity,
    product_id,
    standardize_status,
    store_id,
)
from tributary.functions.dates import date_is_ambiguous, epoch_to_ts, parse_date_text, parse_iso_z
from tributary.functions.exact import exact_avg, exact_sum, half_up_avg, half_up_avg_int, int_avg
from tributary.functions.prices import clean_price, price_is_conforming

__all__ = [
    "clean_price",
    "date_is_ambiguous",
    "device_customer_id",
    "epoch_to_ts",
    "exact_avg",
    "exact_sum",
    "half_up_avg",
    "half_up_avg_int",
    "int_avg",
    "parse_date_text",
    "parse_iso_z",
    "payment_method",
    "pos_customer_id",
    "pos_quantity",
    "price_is_conforming",
    "product_id",
    "standardize_status",
    "store_id",
]
