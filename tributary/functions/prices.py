"""Price text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.rules import AS_CODED, CleaningRules

# The character class the original cleaner strips. It is a
# class, not a token list: any of $ € £ ¥ P H U S D E R G B, space or comma is
# removed anywhere in the text.
STRIP_CLASS = r"[$€£¥PHP USD EUR GBP,]"

# Currency tokens recognised at either end of a price.
_TOKEN_ALT = r"\$|€|£|¥|PHP|USD|EUR|GBP"
LEADING_TOKEN = rf"(?i)^\s*({_TOKEN_ALT})\s*"
TRAILING_TOKEN = rf"(?i)\s*({_TOKEN_ALT})\s*$"
DECIMAL_COMMA = r"^-?\d+,\d{2}$"
THOUSANDS = r"^-?\d{1,3}(,\d{3})+(\.\d+)?$"
PLAIN_NUMBER = r"^-?\d+(\.\d+)?$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_price(c: str | Column, rules: CleaningRules = AS_CODED) -> Column:
    """Price text -> DOUBLE, NULL when it cannot be read.

    as coded: NULL/'' -> NULL, strip ``STRIP_CLASS`` everywhere, cast. So
    ``45,67`` becomes 4567 and ``-9.5`` stays negative (the quality score
    penalises it). ``rules.currency_tokens`` strips tokens only at the ends,
    reads ``45,67`` as 45.67 and ``1,234.50`` as 1234.50, and accepts only a
    plain decimal number after that.
    """
    s = _col(c)
    if not rules.currency_tokens:
        return (
            F.when(s.isNull() | (s == ""), F.lit(None))
            .otherwise(F.regexp_replace(s, STRIP_CLASS, ""))
            .try_cast("double")
        )
    core = F.trim(F.regexp_replace(F.regexp_replace(s, LEADING_TOKEN, ""), TRAILING_TOKEN, ""))
    core = (
        F.when(core.rlike(DECIMAL_COMMA), F.regexp_replace(core, ",", "."))
        .when(core.rlike(THOUSANDS), F.regexp_replace(core, ",", ""))
        .otherwise(core)
    )
    return F.when(core.rlike(PLAIN_NUMBER), core.try_cast("double"))


def price_is_conforming(c: str | Column) -> Column:
    """Profiling predicate: plain unsigned decimal text (NULL is not)."""
    s = _col(c)
    return F.coalesce(s.rlike(r"^\d+\.?\d*$"), F.lit(False))
