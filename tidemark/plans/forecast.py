"""Revenue forecasts (moving averages, linear trend, seasonal, combined).

All work on the monthly revenue series (one row per month, aggregated
from payments in a distributed way first).  Means and forecasts are
DOUBLE, rounded to 4 decimals in the output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import as_money, months_ahead, rounded
from tidemark.model import Tables
from tidemark.operators import monthly as M
from tidemark.operators import series as S
from tidemark.params import COMBINED_METHOD, DEFAULT, FORECAST, HISTORICAL, Params

DIGITS = 4


def _r(c) -> F.Column:
    return rounded(c, DIGITS).cast("double")


def _revenue(t: Tables, p: Params) -> DataFrame:
    return M.revenue_only_by_month(t.payments, p)


# F1 ---------------------------------------------------------------------------
def moving_averages_of(m: DataFrame, p: Params = DEFAULT) -> DataFrame:
    w = S.window()
    rev = F.col("revenue").cast("double")
    return m.withColumns(
        {
            "_ma_short": F.avg(rev).over(w.rowsBetween(-(p.short_window - 1), 0)),
            "_ma_long": F.avg(rev).over(w.rowsBetween(-(p.long_window - 1), 0)),
            "_prev": F.lag("revenue", 1).over(w),
            "_prev_year": F.lag("revenue", 12).over(w),
        }
    )


def revenue_moving_averages(t: Tables, p: Params = DEFAULT) -> DataFrame:
    s = moving_averages_of(M.revenue_by_month(t.payments, p), p)
    return s.select(
        "month",
        as_money("revenue").alias("revenue"),
        F.col("paying_customers").alias("customers"),
        _r("_ma_short").alias("revenue_3month_avg"),
        _r("_ma_long").alias("revenue_6month_avg"),
        as_money("_prev").alias("prev_month"),
        as_money("_prev_year").alias("prev_year_same_month"),
    ).transform(S.ordered, F.col("month").desc_nulls_first())


# F2 ---------------------------------------------------------------------------
def linear_forecast_of(m: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Latest revenue + k x mean of the latest ``trend_sample`` non-NULL
    month-over-month changes (Q1: the reference's intent; its SQL is not
    valid).  Window ranks replace the scalar subquery and the cross join."""
    s = S.with_lag(m.select("month", "revenue"), "revenue", "_prev")
    s = s.withColumn("_change", (F.col("revenue") - F.col("_prev")).cast("double"))
    has_change = F.col("_change").isNotNull()
    rank_w = Window.partitionBy(has_change).orderBy(F.col("month").desc())
    s = s.withColumn("_rank", F.row_number().over(rank_w))
    sample = F.when(has_change & (F.col("_rank") <= p.trend_sample), F.col("_change"))
    s = s.withColumn("_trend", F.avg(sample).over(S.whole()))
    latest = S.latest_row(s)
    cols = [
        F.col("month").alias("historical_month"),
        as_money("revenue").alias("historical_revenue"),
        _r("_trend").alias("avg_growth_rate"),
    ]
    for k in range(1, p.linear_horizon + 1):
        cols.append(_r(F.col("revenue").cast("double") + F.col("_trend") * F.lit(k)).alias(f"forecast_month_{k}"))
    return latest.select(*cols)


def linear_forecast(t: Tables, p: Params = DEFAULT) -> DataFrame:
    return linear_forecast_of(_revenue(t, p), p)


# F3 ---------------------------------------------------------------------------
def moving_average_forecast_of(m: DataFrame, p: Params = DEFAULT) -> DataFrame:
    s = S.with_moving_avg(m.select("month", "revenue"), "revenue", p.long_window, "_ma_long")
    s = S.with_moving_avg(s, "revenue", p.short_window, "_ma_short")
    latest = S.latest_row(s).withColumn("_trend", F.col("_ma_short") - F.col("_ma_long"))
    steps = S.horizon(latest, p.horizon, "k", start=0)
    k = F.col("k")
    forecast = F.greatest(F.lit(0.0), F.col("_ma_short") + F.col("_trend") * k)
    return steps.select(
        F.when(k == 0, F.lit(HISTORICAL)).otherwise(F.lit(FORECAST)).alias("period_type"),
        months_ahead("month", k).alias("period"),
        _r(F.when(k == 0, F.col("revenue").cast("double")).otherwise(forecast)).alias("value"),
    ).transform(S.ordered, F.col("period_type").desc_nulls_first(), F.col("period").asc_nulls_last())


def moving_average_forecast(t: Tables, p: Params = DEFAULT) -> DataFrame:
    return moving_average_forecast_of(_revenue(t, p), p)


# F4 ---------------------------------------------------------------------------
def seasonal_forecast_of(m: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """latest x (1 + g/100)^(k/12), g = mean year-over-year growth % of the
    target calendar month (0 when the previous year's revenue is not > 0;
    months of the year without any year-over-year pair get no forecast).

    One pass over the monthly series: the previous year comes from a
    12-month RANGE frame, the per-calendar-month means (at most 12) are
    attached to every row as a small map, and the latest row is expanded
    to the horizon."""
    s = S.with_calendar_lag(m.select("month", "revenue"), "revenue", "_prev", 12)
    growth = F.when(
        F.col("_prev") > 0,
        (F.col("revenue") - F.col("_prev")).cast("double") / F.col("_prev").cast("double") * F.lit(100.0),
    ).otherwise(F.lit(0.0))
    s = s.withColumns({"_g": F.when(F.col("_prev").isNotNull(), growth), "_moy": F.month("month")})
    s = s.withColumn("_g_moy", F.avg("_g").over(Window.partitionBy("_moy")))
    entry = F.when(F.col("_g_moy").isNotNull(), F.struct("_moy", "_g_moy"))
    s = s.withColumn("_season", F.map_from_entries(F.collect_set(entry).over(S.whole())))
    steps = S.horizon(S.latest_row(s), p.horizon, "months_ahead")
    target = months_ahead("month", F.col("months_ahead"))
    steps = steps.withColumns({"forecast_month": target, "_g_target": F.element_at("_season", F.month(target))})
    g = F.col("_g_target")
    value = F.col("revenue").cast("double") * F.pow(F.lit(1.0) + g / F.lit(100.0), F.col("months_ahead") / F.lit(12.0))
    return steps.where(g.isNotNull()).select(
        "forecast_month",
        _r(value).alias("forecasted_revenue"),
        _r(g).alias("yoy_growth_rate"),
    ).transform(S.ordered, F.col("forecast_month").asc_nulls_last())


def seasonal_forecast(t: Tables, p: Params = DEFAULT) -> DataFrame:
    return seasonal_forecast_of(_revenue(t, p), p)


# F5 ---------------------------------------------------------------------------
def combined_forecast_of(m: DataFrame, p: Params = DEFAULT, corrected: bool = False) -> DataFrame:
    """Last ``report_span_months`` + 1 actual months, then ``horizon`` months of
    (MA3 + max(0, latest + k x last change)) / 2.

    Literal (Q2): the reference takes its LAG after keeping only the latest
    month, so the change is always NULL, GREATEST(0, NULL) = 0 and the
    forecast is a flat MA3 / 2.  ``corrected=True`` uses the change from the
    previous month.  One pass: every monthly row expands to its candidate
    output rows (its history row, and the forecast rows if it is the
    latest), which are then filtered.
    """
    w = S.window()
    h = m.select("month", "revenue").withColumns(
        {
            "_ma_short": F.avg(F.col("revenue").cast("double")).over(w.rowsBetween(-(p.short_window - 1), 0)),
            "_prev": F.lag("revenue").over(w),
            "_latest": F.max("month").over(S.whole()),
        }
    )
    change = (F.col("revenue") - F.col("_prev")).cast("double") if corrected else F.lit(None).cast("double")
    is_latest = F.col("month") == F.col("_latest")
    in_history = F.col("month") >= months_ahead("_latest", -p.report_span_months)

    def row(keep, data_type, period, value, method):
        return F.struct(
            keep.alias("keep"),
            F.lit(data_type).alias("data_type"),
            period.alias("period"),
            _r(value).alias("value"),
            method.alias("forecast_method"),
        )

    history = row(in_history, HISTORICAL, F.col("month"), F.col("revenue"), F.lit(None).cast("string"))

    def forecast(k):
        linear = F.greatest(F.lit(0.0), F.col("revenue").cast("double") + change * k)
        return row(is_latest, FORECAST, months_ahead("month", k), (F.col("_ma_short") + linear) / F.lit(2.0), F.lit(COMBINED_METHOD))

    candidates = F.concat(F.array(history), F.transform(F.sequence(F.lit(1), F.lit(p.horizon)), forecast))
    out = h.select(F.explode(candidates).alias("r")).where("r.keep")
    return out.select("r.data_type", "r.period", "r.value", "r.forecast_method").transform(
        S.ordered, F.col("data_type").desc_nulls_first(), F.col("period").asc_nulls_last()
    )


def combined_forecast(t: Tables, p: Params = DEFAULT) -> DataFrame:
    return combined_forecast_of(_revenue(t, p), p)


def combined_forecast_corrected(t: Tables, p: Params = DEFAULT) -> DataFrame:
    return combined_forecast_of(_revenue(t, p), p, corrected=True)
