"""Numeric expressions with engine-independent rounding.

Money stays DECIMAL while it is summed (exact, order-insensitive, so the
result does not depend on how a 1000-executor cluster partitions it) and
becomes DOUBLE only in the output.  Ratios that are printed are divided as
DOUBLE, pinned to 12 decimals and rounded half away from zero as a DECIMAL.
Ratios that are compared with a threshold are not divided at all: see
:func:`exceeds_ratio` and ``operators.series.beyond``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_PINNED = "decimal(38,12)"


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def ratio(num, den) -> Column:
    """num / NULLIF(den, 0) as DOUBLE."""
    return _c(num).cast("double") / F.nullif(_c(den).cast("double"), F.lit(0.0))


def rounded(x, digits: int) -> Column:
    """ROUND(x, digits) on the decimal value of x (DECIMAL result)."""
    return F.round(_c(x).cast("double").cast(_PINNED), digits)


def pct(num, den, digits: int = 2) -> Column:
    """ROUND(num / NULLIF(den, 0) * 100, digits) as DECIMAL."""
    return rounded(ratio(num, den) * F.lit(100.0), digits)


def text_1dp(x) -> Column:
    """ROUND(x, 1) printed as numeric text, e.g. ``45.0``."""
    return rounded(x, 1).cast("decimal(38,1)").cast("string")


def cents(x) -> Column:
    """Exact integer cents of a DECIMAL(p,2) amount with p <= 15.

    |amount| < 1e13, so |cents| < 1e15 < 2**53: the DOUBLE product is within one ulp
    of the integer and ``round`` recovers it exactly.  Summing cents as
    BIGINT keeps aggregation buffers primitive (a DECIMAL(20,2) sum buffer
    is a BigDecimal per group); ANSI mode raises on overflow.
    """
    return F.round(_c(x).cast("double") * F.lit(100.0)).cast("long")


def from_cents(x) -> Column:
    """BIGINT cents back to an exact DECIMAL(38,2) amount."""
    return (_c(x).cast("decimal(38,0)") / F.lit(100)).cast("decimal(38,2)")


def as_money(x) -> Column:
    """Exact decimal money to the DOUBLE used in outputs."""
    return _c(x).cast("double")


def exceeds_ratio(change, base, threshold: float) -> Column:
    """ABS(change / base) > threshold for money, compared exactly as
    ABS(change) > threshold * ABS(base) on DECIMAL (NULL when base is 0)."""
    c, b = (F.abs(_c(x)).cast("decimal(30,2)") for x in (change, base))
    return F.when(b != 0, c > b * F.lit(Decimal(str(threshold))).cast("decimal(6,4)"))
