"""Multi-format date parsing.

All branches use ``try_*`` forms so the result is the same with ANSI mode on
(Spark 4 default) or off: an unparseable value is NULL, never an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.rules import AS_CODED, CleaningRules

# The guard patterns and parse formats of the date parser, in
# the order they are tried (first match wins).
ISO_Z_GUARD = r"^\d{4}-\d{2}-\d{2}T"
ISO_Z_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
ISO_DATE_GUARD = r"^\d{4}-\d{2}-\d{2}$"
ISO_DATE_FORMAT = "yyyy-MM-dd"
SLASH_GUARD = r"^\d{2}/\d{2}/\d{4}$"
MONTH_FIRST_SLASH = "MM/dd/yyyy"
DAY_FIRST_SLASH = "dd/MM/yyyy"
DASH_GUARD = r"^\d{2}-\d{2}-\d{4}$"
DAY_FIRST_DASH = "dd-MM-yyyy"
# Numeric text read as epoch seconds; the fraction is dropped.
EPOCH_GUARD = r"^\s*[+-]?\d+(\.\d+)?\s*$"
# Epoch seconds that a timestamp (64-bit microseconds) can hold.
EPOCH_MAX = (2**63 - 1) // 1_000_000


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _try_ts(c: Column, fmt: str) -> Column:
    return F.try_to_timestamp(c, F.lit(fmt))


def epoch_seconds_to_ts(seconds: Column) -> Column:
    """Epoch seconds -> timestamp, NULL only for what no timestamp can hold
    (a feed in milliseconds is read as a year far ahead, as coded)."""
    return F.when(seconds.between(-EPOCH_MAX, EPOCH_MAX), F.timestamp_seconds(seconds))


def parse_date_text(c: str | Column, rules: CleaningRules = AS_CODED) -> Column:
    """Parse a date/time string written in any of the supported formats.

    as coded: ``MM/dd/yyyy`` wins for every ``nn/nn/nnnn`` value, so day-first
    text with day > 12 is NULL and day <= 12 is read with day and month
    swapped. ``rules.day_first_fallback`` tries ``dd/MM/yyyy`` when the
    month-first reading is invalid.
    """
    s = _col(c)
    slash = _try_ts(s, MONTH_FIRST_SLASH)
    if rules.day_first_fallback:
        slash = F.coalesce(slash, _try_ts(s, DAY_FIRST_SLASH))
    epoch = s.try_cast("decimal(38,6)").try_cast("bigint")
    return (
        F.when(s.rlike(ISO_Z_GUARD), _try_ts(s, ISO_Z_FORMAT))
        .when(s.rlike(ISO_DATE_GUARD), _try_ts(s, ISO_DATE_FORMAT))
        .when(s.rlike(SLASH_GUARD), slash)
        .when(s.rlike(DASH_GUARD), _try_ts(s, DAY_FIRST_DASH))
        .when(s.rlike(EPOCH_GUARD), epoch_seconds_to_ts(epoch))
    )


def date_is_ambiguous(c: str | Column) -> Column:
    """True for ``nn/nn/nnnn`` text that is a valid date read either way and
    the two readings differ (both parts <= 12 and unequal)."""
    s = _col(c)
    return F.coalesce(
        s.rlike(SLASH_GUARD)
        & _try_ts(s, MONTH_FIRST_SLASH).isNotNull()
        & _try_ts(s, DAY_FIRST_SLASH).isNotNull()
        & (F.substring(s, 1, 2) != F.substring(s, 4, 2)),
        F.lit(False),
    )


def parse_iso_z(c: str | Column) -> Column:
    """E-commerce order timestamps (``...T..Z``); the zone letter is a literal,
    so the wall clock is taken in the session zone (UTC)."""
    return _try_ts(_col(c), ISO_Z_FORMAT)


def epoch_to_ts(c: str | Column, rules: CleaningRules = AS_CODED) -> Column:
    """Mobile epoch seconds -> timestamp (0 is 1970-01-01 unless the rules say
    it means missing)."""
    s = _col(c).cast("bigint")
    ts = epoch_seconds_to_ts(s)
    if rules.zero_epoch_is_null:
        ts = F.when(s != 0, ts)
    return ts
