"""Calendar expressions.

A month is always the DATE of its first day (``trunc``), never a
timestamp, so that keys compare equal across sources and time zones.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(c) -> Column:
    """DATE_TRUNC('month', d) as a DATE."""
    return F.trunc(F.col(c) if isinstance(c, str) else c, "month")


def month_from_text(c) -> Column:
    """'YYYY-MM' text to the DATE of the month's first day."""
    c = F.col(c) if isinstance(c, str) else c
    return F.to_date(F.concat(c, F.lit("-01")), "yyyy-MM-dd")


def months_ahead(c, n) -> Column:
    """month + INTERVAL '1 month' * n."""
    c = F.col(c) if isinstance(c, str) else c
    return F.add_months(c, n)


def month_label(c) -> Column:
    """TO_CHAR(d, 'Month YYYY'): English month name blank-padded to 9."""
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(F.rpad(F.date_format(c, "MMMM"), 9, " "), F.lit(" "), F.date_format(c, "yyyy"))
