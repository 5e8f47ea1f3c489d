"""Operators over monthly series (one row per month, or per month and a
small dimension such as segment).

Monthly tables have a calendar-bounded number of rows, so a window
ordered by month without ``partitionBy`` (one partition) is acceptable
here and nowhere else; dimensioned series use ``partitionBy(dim)``.
Frames count rows, not calendar months, as in the reference.
Nothing here uses a cross join: scalars such as "the latest month" are
attached with whole-table window aggregates, horizons with ``explode``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import exceeds_ratio, months_ahead


def window(order: str = "month", partition: Sequence[str] = (), descending: bool = False):
    o = F.col(order).desc_nulls_first() if descending else F.col(order).asc_nulls_last()
    w = Window.orderBy(o)
    if partition:
        w = Window.partitionBy(*partition).orderBy(o)
    return w


def whole(partition: Sequence[str] = ()):
    """Frame over the whole (partition of the) series."""
    w = Window.partitionBy(*partition) if partition else Window.partitionBy()
    return w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def with_lag(df: DataFrame, value: str, name: str, n: int = 1, order: str = "month", partition: Sequence[str] = ()) -> DataFrame:
    return df.withColumn(name, F.lag(value, n).over(window(order, partition)))


def with_moving_avg(df: DataFrame, value: str, rows: int, name: str, order: str = "month", partition: Sequence[str] = ()) -> DataFrame:
    """AVG over ROWS BETWEEN rows-1 PRECEDING AND CURRENT ROW (double)."""
    w = window(order, partition).rowsBetween(-(rows - 1), 0)
    return df.withColumn(name, F.avg(F.col(value).cast("double")).over(w))


def with_trailing_stats(
    df: DataFrame,
    value: str,
    rows: int,
    avg_name: str,
    sd_name: str,
    order: str = "month",
    partition: Sequence[str] = (),
) -> DataFrame:
    """Mean and sample stddev of the ``rows`` rows before the current one,
    and the exact sum (``_t_sum``) and count (``_t_n``) behind the mean."""
    w = window(order, partition).rowsBetween(-rows, -1)
    v = F.col(value).cast("double")
    return df.withColumns(
        {
            avg_name: F.avg(v).over(w),
            sd_name: F.stddev_samp(v).over(w),
            "_t_sum": F.sum(F.col(value).cast("decimal(26,2)")).over(w),
            "_t_n": F.count(value).over(w),
        }
    )


def beyond(value: str, sigma: float, sd: Column) -> Column:
    """value - mean > sigma * sd, without dividing: n * value - sum is exact,
    so a flat series is never beyond its own mean.  A negative sigma asks
    for value - mean < sigma * sd."""
    n = F.col("_t_n").cast("decimal(10,0)")
    gap = (F.col(value).cast("decimal(26,2)") * n - F.col("_t_sum")).cast("double")
    limit = F.lit(float(sigma)) * F.col("_t_n") * sd
    return F.when(F.col("_t_n") > 0, gap < limit if sigma < 0 else gap > limit)


def with_prior_totals(
    df: DataFrame, value: str, sum_name: str, count_name: str, order: str = "month", partition: Sequence[str] = ()
) -> DataFrame:
    """SUM and COUNT of ``value`` over all earlier rows.

    Replaces a correlated ``(SELECT AVG(x) FROM t WHERE month < outer.month)``
    (valid because months are unique per partition) without the nested
    loop or cartesian product the correlated form plans.
    """
    w = window(order, partition).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumns({sum_name: F.sum(value).over(w), count_name: F.count(value).over(w)})


def with_latest(df: DataFrame, name: str = "latest_month", order: str = "month", partition: Sequence[str] = ()) -> DataFrame:
    """Attach MAX(order) of the whole series to every row."""
    return df.withColumn(name, F.max(order).over(whole(partition)))


def latest_row(df: DataFrame, order: str = "month") -> DataFrame:
    """The row of the latest month (``WHERE month = (SELECT MAX(month) ...)``)."""
    return with_latest(df, "_latest", order).where(F.col(order) == F.col("_latest")).drop("_latest")


def since_latest(df: DataFrame, months: int, order: str = "month") -> DataFrame:
    """Rows with order >= MAX(order) - months (inclusive, so months + 1 rows)."""
    return with_latest(df, "_latest", order).where(F.col(order) >= months_ahead("_latest", -months)).drop("_latest")


def horizon(df: DataFrame, steps: int, name: str = "k", start: int = 1) -> DataFrame:
    """Repeat each (one-row) input for k = start..steps: ``generate_series``."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(start), F.lit(steps))))


def band_flag(change, base, high: float, medium: float, high_text: str, medium_text: str, other) -> Column:
    """CASE WHEN |change / base| > high THEN .. WHEN > medium THEN .. ELSE other END, exactly."""
    other_col = other if isinstance(other, Column) else F.lit(other)
    return (
        F.when(exceeds_ratio(change, base, high), F.lit(high_text))
        .when(exceeds_ratio(change, base, medium), F.lit(medium_text))
        .otherwise(other_col)
    )


def month_align(left: DataFrame, right: DataFrame, left_key: str, right_key: str, out: str) -> DataFrame:
    """FULL OUTER JOIN on month keys, keeping both keys and adding
    ``out = COALESCE(left_key, right_key)``."""
    return left.join(right, left[left_key] == right[right_key], "full_outer").withColumn(
        out, F.coalesce(F.col(left_key), F.col(right_key))
    )


def fill_month_gaps(df: DataFrame, values: Sequence[str], order: str = "month") -> DataFrame:
    """Continuous months from the first to the last row, ``values`` 0 in
    months without a row.  Each row expands to itself and the missing
    months up to the next row (``lead``), so the series is read once and
    no spine is joined back to it."""
    s = df.withColumn("_next", F.lead(order).over(window(order)))
    last = F.coalesce(F.add_months("_next", -1), F.col(order))
    s = s.select(F.explode(F.sequence(F.col(order), last, F.expr("INTERVAL 1 MONTH"))).alias("_m"), order, *values)
    same = F.col("_m") == F.col(order)
    return s.select(
        F.col("_m").alias(order), *[F.when(same, F.col(v)).otherwise(F.lit(0)).alias(v) for v in values]
    )


def ordered(df: DataFrame, *cols) -> DataFrame:
    """ORDER BY for a calendar-bounded result (one row per month, or per
    month and a small dimension: hundreds of rows however large the facts).

    A global ``orderBy`` range-partitions its input and first runs a
    sampling job to find the bounds; for a bounded result one sorted
    partition gives the same order without that job.  Never use it on
    fact-sized data.
    """
    return df.repartition(1).sortWithinPartitions(*cols)


def month_index(c="month") -> Column:
    """Months since year 0 (year * 12 + month - 1): a numeric key for
    calendar-offset RANGE frames."""
    c = F.col(c) if isinstance(c, str) else c
    return F.year(c) * 12 + F.month(c) - 1


def with_calendar_lag(df: DataFrame, value: str, name: str, months: int, order: str = "month") -> DataFrame:
    """``value`` of the row exactly ``months`` calendar months earlier
    (NULL if that month is missing): a RANGE frame on the month index
    instead of a self-join, so the series is computed and read once."""
    w = Window.orderBy(month_index(order).asc_nulls_last()).rangeBetween(-months, -months)
    return df.withColumn(name, F.max(value).over(w))
