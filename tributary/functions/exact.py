"""Order-independent numeric aggregates.

A DOUBLE sum depends on the order rows are added, which differs between runs,
partitionings and engines. Money is therefore summed as DECIMAL and turned
into DOUBLE once; averages are one IEEE division of two exact numbers; and
rounding to n places is done half away from zero (as Spark's ROUND) in exact
integer arithmetic, so every engine and every partitioning gets the same
bits. A group with a value that a DECIMAL cannot hold (NaN, infinities,
10^32 and more), or whose sum outgrows it, falls back to the plain DOUBLE
aggregate: nothing is left out, nothing wraps and nothing fails under ANSI.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(38,6)"


# Sums below this bound leave room for micro-units in DECIMAL(38,6).
EXACT_BOUND = "CAST('10000000000000000000000000' AS DECIMAL(38,6))"


def _total(name: str) -> str:
    """Exact sum, NULL if it outgrows the type or without input."""
    return f"TRY_SUM(TRY_CAST({name} AS {MONEY}))"


def _exact(name: str) -> str:
    """Whether every value of the group, and its sum, is a DECIMAL."""
    return f"(COUNT({name}) = COUNT(TRY_CAST({name} AS {MONEY})) AND {_total(name)} IS NOT NULL)"


def exact_sum(name: str) -> Column:
    """SUM of a DOUBLE column as an exact decimal, returned as DOUBLE (NULL
    when there is no non-NULL input)."""
    return F.expr(f"CASE WHEN {_exact(name)} THEN CAST({_total(name)} AS DOUBLE) ELSE SUM({name}) END")


def exact_avg(name: str) -> Column:
    """AVG as exact sum / count: one IEEE division."""
    return F.expr(
        f"CASE WHEN {_exact(name)} THEN CAST({_total(name)} AS DOUBLE) / CAST(COUNT({name}) AS DOUBLE) "
        f"ELSE AVG({name}) END"
    )


def int_avg(name: str) -> Column:
    """AVG of an integer column: exact sum / count."""
    return F.expr(f"CAST(SUM({name}) AS DOUBLE) / CAST(COUNT({name}) AS DOUBLE)")


def _half_up_div(num: str, den: str) -> str:
    """round(num / den) half away from zero, den > 0, for integral operands.

    The remainder is taken off first, so the division is exact for DECIMAL
    operands, too (DIV would go through BIGINT and wrap).
    """
    twice = f"(2 * ABS({num}) + {den})"
    whole = f"({twice} - {twice} % (2 * {den})) / (2 * {den})"
    return f"SIGN({num}) * CAST({whole} AS DOUBLE)"


def half_up_avg(name: str, places: int) -> Column:
    """ROUND(AVG(x), places), exact, half away from zero (Spark's ROUND).

    With M the sum of x in micro-units (6 decimals) and n the count, the
    result in units of 10^-places is round(M / (n * 10^(6-places))). Beyond
    ``EXACT_BOUND`` cents are below a DOUBLE's resolution: the plain average.
    """
    u = 10 ** (6 - places)
    m = f"CAST({_total(name)} * 1000000 AS DECIMAL(37,0))"
    n = f"CAST(COUNT({name}) * {u} AS DECIMAL(30,0))"
    return F.expr(
        f"CASE WHEN {_exact(name)} AND ABS({_total(name)}) < {EXACT_BOUND} THEN "
        f"{_half_up_div(m, n)} / {float(10**places)}D ELSE AVG({name}) END"
    )


def half_up_avg_int(name: str, places: int) -> Column:
    """ROUND(AVG(i), places) of an integer column, exact, half away from zero."""
    s = 10**places
    n = f"COUNT({name})"
    return F.expr(
        f"CASE WHEN {n} > 0 THEN "
        f"{_half_up_div(f'CAST({s} * SUM({name}) AS DECIMAL(30,0))', f'CAST({n} AS DECIMAL(20,0))')} / {float(s)}D END"
    )


# --------------------------------------------------------------------------
# partial aggregates that add up to the same exact results
# --------------------------------------------------------------------------

def sum_parts(name: str, prefix: str) -> list[Column]:
    """What an exact sum or average of a group needs of each part of it."""
    return [
        F.count(name).alias(f"{prefix}_n"),
        F.expr(f"COUNT(TRY_CAST({name} AS {MONEY}))").alias(f"{prefix}_exact_n"),
        F.expr(_total(name)).alias(f"{prefix}_exact"),
        F.sum(name).alias(f"{prefix}_plain"),
    ]


def _merged_exact(prefix: str) -> str:
    """Whether every value of all parts, and their sum, is a DECIMAL."""
    return (
        f"(SUM({prefix}_n) = SUM({prefix}_exact_n) AND COUNT_IF({prefix}_n > 0 AND {prefix}_exact IS NULL) = 0 "
        f"AND TRY_SUM({prefix}_exact) IS NOT NULL)"
    )


def merged_sum(prefix: str) -> Column:
    """``exact_sum`` over the union of the parts."""
    exact = f"CAST(TRY_SUM({prefix}_exact) AS DOUBLE)"
    return F.expr(f"CASE WHEN {_merged_exact(prefix)} THEN {exact} ELSE SUM({prefix}_plain) END")


def merged_avg(prefix: str) -> Column:
    """``exact_avg`` over the union of the parts."""
    exact = f"CAST(TRY_SUM({prefix}_exact) AS DOUBLE) / CAST(SUM({prefix}_n) AS DOUBLE)"
    plain = f"TRY_DIVIDE(SUM({prefix}_plain), CAST(SUM({prefix}_n) AS DOUBLE))"
    return F.expr(f"CASE WHEN {_merged_exact(prefix)} THEN {exact} ELSE {plain} END")


def merged_half_up(prefix: str, places: int) -> Column:
    """``half_up_avg`` over the union of the parts."""
    total = f"TRY_SUM({prefix}_exact)"
    m = f"CAST({total} * 1000000 AS DECIMAL(37,0))"
    n = f"CAST(SUM({prefix}_n) * {10 ** (6 - places)} AS DECIMAL(30,0))"
    plain = f"TRY_DIVIDE(SUM({prefix}_plain), CAST(SUM({prefix}_n) AS DOUBLE))"
    return F.expr(
        f"CASE WHEN {_merged_exact(prefix)} AND ABS({total}) < {EXACT_BOUND} THEN "
        f"{_half_up_div(m, n)} / {float(10**places)}D ELSE {plain} END"
    )


def merged_half_up_int(total: str, count: str, places: int) -> Column:
    """``half_up_avg_int`` from partial sums and counts."""
    s = 10**places
    num, den = f"CAST({s} * SUM({total}) AS DECIMAL(30,0))", f"CAST(SUM({count}) AS DECIMAL(20,0))"
    return F.expr(f"CASE WHEN SUM({count}) > 0 THEN {_half_up_div(num, den)} / {float(s)}D END")
