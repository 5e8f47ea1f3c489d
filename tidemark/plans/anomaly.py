"""Anomaly flags on revenue, churn and conversion series.

Trailing statistics use the 5 rows before the current one (the
reference's "6 months" frame is 5 PRECEDING .. 1 PRECEDING, Q8).
Correlated "mean of all earlier months" subqueries become
unbounded-preceding windows; comparisons against a multiple of such a
mean are made exactly as ``x * count > factor * sum``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import as_money, exceeds_ratio, month_label, pct, ratio, rounded, text_1dp
from tidemark.model import Tables
from tidemark.operators import monthly as M
from tidemark.operators import series as S
from tidemark import params as P
from tidemark.params import DEFAULT, Params


def _desc(c: str):
    return F.col(c).desc_nulls_first()


def _sd(c: str):
    return F.coalesce(F.col(c), F.lit(0.0))


# A1 ---------------------------------------------------------------------------
def revenue_anomalies_of(m: DataFrame, p: Params = DEFAULT) -> DataFrame:
    s = S.with_lag(m.select("month", "revenue"), "revenue", "_prev")
    s = S.with_trailing_stats(s, "revenue", p.trailing_rows, "_avg", "_sd")
    change = F.col("revenue") - F.col("_prev")
    return s.where(F.col("_prev").isNotNull()).select(
        "month",
        as_money("revenue").alias("revenue"),
        as_money("_prev").alias("prev_month_revenue"),
        pct(change, "_prev").cast("double").alias("mom_change_pct"),
        rounded("_avg", 4).cast("double").alias("avg_prev_6months"),
        S.band_flag(change, "_prev", p.high_change, p.medium_change, P.REVENUE_HIGH_FLAG, P.REVENUE_MEDIUM_FLAG, P.NORMAL_FLAG).alias(
            "anomaly_flag"
        ),
        F.when(S.beyond("revenue", -p.sigma_high, _sd("_sd")), F.lit(P.OUTLIER_BELOW_FLAG))
        .when(S.beyond("revenue", p.sigma_high, _sd("_sd")), F.lit(P.OUTLIER_ABOVE_FLAG))
        .alias("statistical_anomaly"),
    ).transform(S.ordered, _desc("month"))


def revenue_anomalies(t: Tables, p: Params = DEFAULT) -> DataFrame:
    return revenue_anomalies_of(M.revenue_only_by_month(t.payments, p), p)


# A2 ---------------------------------------------------------------------------
def _churn_stats(churn: DataFrame, p: Params) -> DataFrame:
    s = S.with_lag(churn, "churned_customers", "_prev")
    s = S.with_trailing_stats(s, "churned_customers", p.trailing_rows, "_avg", "_sd")
    c = "churned_customers"
    flag = (
        F.when(S.beyond(c, p.sigma_high, _sd("_sd")), F.lit(P.CHURN_SPIKE_FLAG))
        .when(S.beyond(c, p.sigma_mid, _sd("_sd")), F.lit(P.CHURN_ELEVATED_FLAG))
        .otherwise(F.lit(P.NORMAL_FLAG))
    )
    return s.withColumn("anomaly_flag", flag).where(F.col("_prev").isNotNull())


def churn_spikes_of(churn: DataFrame, p: Params = DEFAULT) -> DataFrame:
    s = _churn_stats(churn, p)
    return s.select(
        "month",
        "churned_customers",
        F.col("_prev").alias("prev_month_churn"),
        pct(F.col("churned_customers") - F.col("_prev"), "_prev").cast("double").alias("churn_increase_pct"),
        "anomaly_flag",
    ).transform(S.ordered, _desc("month"))


def churn_spikes(t: Tables, p: Params = DEFAULT) -> DataFrame:
    return churn_spikes_of(M.churned_by_month(t.subscriptions), p)


def churn_spikes_export_of(churn: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """The exported projection: trailing mean rounded to 0 decimals."""
    s = _churn_stats(churn, p)
    return s.select(
        "month",
        "churned_customers",
        rounded("_avg", 0).cast("double").alias("avg_prev_6months"),
        "anomaly_flag",
    ).transform(S.ordered, _desc("month"))


def churn_spikes_export(t: Tables, p: Params = DEFAULT) -> DataFrame:
    return churn_spikes_export_of(M.churned_by_month(t.subscriptions), p)


# A3 ---------------------------------------------------------------------------
def segment_churn_spikes(t: Tables, p: Params = DEFAULT) -> DataFrame:
    seg = M.churned_by_segment_month(t.subscriptions, t.customers)
    s = S.with_trailing_stats(seg, "churned_customers", p.trailing_rows, "_avg", "_sd", partition=["segment"])
    c = F.col("churned_customers")
    above = ratio(c - F.col("_avg"), "_avg") * F.lit(100.0)
    status = F.when(
        S.beyond("churned_customers", p.sigma_high, _sd("_sd")),
        F.concat(F.lit("SPIKE: "), text_1dp(above), F.lit("% above average")),
    ).otherwise(F.lit(P.NORMAL_FLAG))
    return s.where(F.col("_avg").isNotNull()).select(
        "segment",
        "month",
        "churned_customers",
        rounded("_avg", 0).cast("double").alias("avg_prev_6months"),
        status.alias("anomaly_status"),
    ).transform(S.ordered, _desc("month"), _desc("churned_customers"), "segment")


# A4 ---------------------------------------------------------------------------
def conversion_drops_of(conv: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """conv: month, total_signups, converted_customers."""
    s = conv.select("month", pct("converted_customers", "total_signups").alias("rate"))
    s = S.with_lag(s, "rate", "_prev")
    s = S.with_trailing_stats(s, "rate", p.trailing_rows, "_avg", "_sd")
    rate = F.col("rate")
    flag = (
        F.when(S.beyond("rate", -p.sigma_high, _sd("_sd")), F.lit(P.CONVERSION_SIGNIFICANT_FLAG))
        .when(S.beyond("rate", -p.sigma_mid, _sd("_sd")), F.lit(P.CONVERSION_MODERATE_FLAG))
        # exact decimal comparison of two rounded rates
        .when(rate < F.col("_prev") - F.lit(Decimal(str(p.conversion_pp_drop))), F.lit(P.CONVERSION_MOM_FLAG))
        .otherwise(F.lit(P.NORMAL_FLAG))
    )
    return s.where(F.col("_prev").isNotNull()).select(
        "month",
        rate.cast("double").alias("conversion_rate_pct"),
        F.col("_prev").cast("double").alias("prev_month_rate"),
        F.round(rate - F.col("_prev"), 2).cast("double").alias("rate_change"),
        flag.alias("anomaly_flag"),
    ).transform(S.ordered, _desc("month"))


def conversion_drops(t: Tables, p: Params = DEFAULT) -> DataFrame:
    return conversion_drops_of(M.conversions_by_month(t.customers, t.subscriptions), p)


# A5 ---------------------------------------------------------------------------
def anomaly_report(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """Revenue, churn and conversion flags side by side for the latest
    ``report_span_months`` + 1 months of any of the three series."""
    ra = S.with_lag(M.revenue_only_by_month(t.payments, p), "revenue", "_prev")
    ra = ra.select(F.col("month").alias("ra_month"), "revenue", "_prev")

    ca = S.with_prior_totals(M.churned_by_month(t.subscriptions), "churned_customers", "_c_sum", "_c_n")
    ca = ca.select(F.col("month").alias("ca_month"), F.col("churned_customers").alias("churned"), "_c_sum", "_c_n")

    conv = M.conversions_by_month(t.customers, t.subscriptions)
    # equal quotients give equal decimals, whose sums are exact
    conv = conv.withColumn("_rate", ratio("converted_customers", "total_signups").cast("decimal(20,16)"))
    conv = S.with_prior_totals(conv, "_rate", "_r_sum", "_r_n")
    conv = conv.select(F.col("month").alias("cv_month"), "total_signups", "converted_customers", "_rate", "_r_sum", "_r_n")

    j = S.month_align(ra, ca, "ra_month", "ca_month", "_key")
    j = j.join(conv, j["_key"] == conv["cv_month"], "full_outer")
    j = j.withColumn("month", F.coalesce("ra_month", "ca_month", "cv_month"))
    j = S.since_latest(j, p.report_span_months)

    churn_factor = F.lit(Decimal(p.report_churn_factor))
    churn_flag = F.when(
        F.col("churned") * F.col("_c_n") > churn_factor * F.col("_c_sum"), F.lit(P.REPORT_CHURN_FLAG)
    )
    conv_flag = F.when(
        F.col("_rate") * F.col("_r_n").cast("decimal(8,0)")
        < F.col("_r_sum").cast("decimal(28,16)") * F.lit(Decimal(str(p.report_conversion_factor))),
        F.lit(P.REPORT_CONVERSION_FLAG),
    )
    rev_flag = S.band_flag(
        F.col("revenue") - F.col("_prev"),
        "_prev",
        p.high_change,
        p.medium_change,
        P.REPORT_REVENUE_HIGH_FLAG,
        P.REPORT_REVENUE_MEDIUM_FLAG,
        F.lit(None).cast("string"),
    )
    return j.select(
        "month",
        as_money("revenue").alias("revenue"),
        rev_flag.alias("revenue_anomaly"),
        "churned",
        churn_flag.alias("churn_anomaly"),
        pct("converted_customers", "total_signups").cast("double").alias("conversion_rate"),
        conv_flag.alias("conversion_anomaly"),
    ).transform(S.ordered, _desc("month"))


# A6 ---------------------------------------------------------------------------
def revenue_churn_insights(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """Months with a revenue move > ``insight_list_change`` next to each
    segment's churn; a sentence when the move is > ``insight_change`` and
    the segment's churn is > ``insight_churn_factor`` x its earlier mean.
    The sentence says 'dropped' for rises too (Q10) and pads the month
    name to 9 characters (Q9)."""
    rc = S.with_lag(M.revenue_only_by_month(t.payments, p), "revenue", "_prev")
    cbs = S.with_prior_totals(
        M.churned_by_segment_month(t.subscriptions, t.customers),
        "churned_customers",
        "_c_sum",
        "_c_n",
        partition=["segment"],
    ).withColumnRenamed("month", "churn_month")
    j = rc.join(cbs, rc.month == cbs.churn_month)
    move = ratio(F.col("revenue") - F.col("_prev"), "_prev")
    j = j.where(exceeds_ratio(F.col("revenue") - F.col("_prev"), "_prev", p.insight_list_change))
    churned = F.col("churned_customers")
    prior_mean = F.col("_c_sum").cast("double") / F.nullif(F.col("_c_n").cast("double"), F.lit(0.0))
    increase = (ratio(churned, prior_mean) - F.lit(1.0)) * F.lit(100.0)
    sentence = F.concat(
        F.lit("Revenue dropped "),
        text_1dp(F.abs(move) * F.lit(100.0)),
        F.lit("% in "),
        month_label("month"),
        F.lit(" due to "),
        text_1dp(increase),
        F.lit("% increase in churn among "),
        F.col("segment"),
        F.lit(" customers."),
    )
    factor = F.lit(Decimal(p.insight_churn_factor))
    insight = F.when(
        exceeds_ratio(F.col("revenue") - F.col("_prev"), "_prev", p.insight_change)
        & (churned * F.col("_c_n") > factor * F.col("_c_sum")),
        sentence,
    )
    return j.select(
        "month",
        as_money("revenue").alias("revenue"),
        pct(F.col("revenue") - F.col("_prev"), "_prev").cast("double").alias("revenue_change_pct"),
        "segment",
        churned.alias("segment_churn"),
        insight.alias("insight"),
    ).transform(S.ordered, _desc("month"), _desc("segment_churn"), "segment")


__all__ = [
    "anomaly_report",
    "churn_spikes",
    "churn_spikes_export",
    "conversion_drops",
    "revenue_anomalies",
    "revenue_churn_insights",
    "segment_churn_spikes",
]
