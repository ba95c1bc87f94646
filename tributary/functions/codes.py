"""Identifier and code normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.rules import AS_CODED, CleaningRules

# Raw status spellings and the canonical status each maps to.
# Anything else (including NULL and '') is 'unknown'.
STATUS_MAP = {
    "completed": ["completed", "complete", "comp", "done"],
    "pending": ["pending", "processing"],
    "cancelled": ["cancelled", "canceled", "void"],
    "refunded": ["refunded", "refund"],
    "failed": ["failed", "error"],
}
UNKNOWN_STATUS = "unknown"

# Payment-type keywords, checked in this order, and their method.
PAYMENT_KEYWORDS = [("cash", "cash"), ("credit", "credit_card"), ("debit", "debit_card")]
OTHER_PAYMENT = "other"

UNKNOWN_STORE = "UNKNOWN"
# Product codes that stand for "no product".
PRODUCT_PLACEHOLDERS = ["", "MISSING", "NULL", "N/A"]


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def standardize_status(c: str | Column) -> Column:
    s = F.lower(F.trim(_col(c)))
    out = None
    for canonical, spellings in STATUS_MAP.items():
        out = (F.when if out is None else out.when)(s.isin(spellings), F.lit(canonical))
    return out.otherwise(F.lit(UNKNOWN_STATUS))


def pos_customer_id(c: str | Column, rules: CleaningRules = AS_CODED) -> Column:
    """``CUST-`` + first digit run padded to 5.

    as coded: ``lpad`` also truncates to 5, and text without digits becomes
    ``CUST-00000``. ``rules.strict_customer_id`` keeps long runs whole and
    maps no-digit text to NULL.
    """
    s = _col(c)
    digits = F.regexp_extract(s, r"(\d+)", 1)
    if not rules.strict_customer_id:
        return F.when(s.isNotNull() & (s != ""), F.concat(F.lit("CUST-"), F.lpad(digits, 5, "0")))
    padded = F.when(F.length(digits) >= 5, digits).otherwise(F.lpad(digits, 5, "0"))
    return F.when(digits != "", F.concat(F.lit("CUST-"), padded))


def pos_quantity(c: str | Column) -> Column:
    """Only all-digit text is a quantity (so '-1', 'abc', '' are NULL; '0' is
    0). Values beyond the INT range are NULL, as in the original INT cast."""
    s = _col(c)
    return F.when(s.rlike(r"^\d+$"), s.try_cast("int")).cast("bigint")


def store_id(c: str | Column) -> Column:
    s = _col(c)
    return F.when(s.isNotNull(), F.upper(F.regexp_replace(s, r"[_\-\s]", ""))).otherwise(
        F.lit(UNKNOWN_STORE)
    )


def payment_method(c: str | Column) -> Column:
    s = F.lower(_col(c))
    out = None
    for keyword, method in PAYMENT_KEYWORDS:
        out = (F.when if out is None else out.when)(s.contains(keyword), F.lit(method))
    return out.otherwise(F.lit(OTHER_PAYMENT))


def product_id(c: str | Column, rules: CleaningRules = AS_CODED) -> Column:
    s = _col(c)
    if rules.null_product_placeholders:
        return F.when(~F.upper(F.trim(s)).isin(PRODUCT_PLACEHOLDERS), s)
    return s


def device_customer_id(c: str | Column) -> Column:
    return F.concat(F.lit("DEVICE-"), _col(c))
