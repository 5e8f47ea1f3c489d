"""Column expressions built only from ``pyspark.sql.functions`` (JVM side,
whole-stage codegen); no Python UDF anywhere in the hot path."""

from tidemark.functions.dates import month_from_text, month_label, month_start, months_ahead
from tidemark.functions.numeric import (
    as_money,
    cents,
    exceeds_ratio,
    from_cents,
    pct,
    ratio,
    rounded,
    text_1dp,
)

__all__ = [
    "as_money",
    "cents",
    "exceeds_ratio",
    "from_cents",
    "month_from_text",
    "month_label",
    "month_start",
    "months_ahead",
    "pct",
    "ratio",
    "rounded",
    "text_1dp",
]
