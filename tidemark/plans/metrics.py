"""KPI analyses (revenue, churn, retention, conversion, growth, margin, LTV).

Each function takes the model :class:`~tidemark.model.Tables` and returns a
lazy DataFrame in the reference's column order and sort order.  Money is
summed exactly (BIGINT cents below month level, DECIMAL above) and output
as DOUBLE; percentages are rounded half away from zero (see
:mod:`tidemark.functions.numeric`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import as_money, from_cents, month_from_text, pct, ratio, rounded
from tidemark.model import Tables
from tidemark.operators import monthly as M
from tidemark.operators import series as S
from tidemark.params import DEFAULT, Params


def _desc(c: str):
    return F.col(c).desc_nulls_first()


# K1 -------------------------------------------------------------------------
def monthly_revenue(t: Tables, p: Params = DEFAULT) -> DataFrame:
    m = M.revenue_by_month(t.payments, p)
    return m.select(
        "month",
        as_money("revenue").alias("monthly_revenue"),
        "paying_customers",
        "total_payments",
    ).transform(S.ordered, _desc("month"))


# K2 -------------------------------------------------------------------------
def revenue_by_segment(t: Tables, p: Params = DEFAULT) -> DataFrame:
    m = M.revenue_by_customer_attr(t.payments, t.customers, "segment", p)
    return m.select(
        "segment", "month", as_money("revenue").alias("segment_revenue"), F.col("paying_customers").alias("customers")
    ).transform(S.ordered, _desc("month"), F.col("segment").asc_nulls_last())


# K2b ------------------------------------------------------------------------
def revenue_by_segment_total(t: Tables, p: Params = DEFAULT) -> DataFrame:
    per_customer = M.customer_totals(t.payments, p)
    attrs = t.customers.groupBy("customer_id", "segment").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_customer.join(attrs, "customer_id")
        .groupBy("segment")
        .agg(
            as_money(from_cents(F.sum(F.col("revenue_cents") * F.col("n")))).alias("total_revenue"),
            F.count("customer_id").alias("customers"),
        )
        .transform(S.ordered, F.col("segment").asc_nulls_last())
    )


# K3 -------------------------------------------------------------------------
def revenue_by_plan(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """Payments joined to *every* subscription of their customer (the
    reference's many-to-many join, Q5), computed without the fan-out: both
    sides are pre-aggregated, the join is then at most
    (customer, month) x (customer, plan)."""
    cm = M.customer_months(t.payments, p)
    plans = t.subscriptions.groupBy("customer_id", "plan_type").agg(F.count(F.lit(1)).alias("n_subs"))
    return (
        cm.join(plans, "customer_id")
        .groupBy("plan_type", "month")
        .agg(
            from_cents(F.sum(F.col("revenue_cents") * F.col("n_subs"))).alias("plan_revenue"),
            F.count("customer_id").alias("customers"),
        )
        .select("plan_type", "month", as_money("plan_revenue").alias("plan_revenue"), "customers")
        .transform(S.ordered, _desc("month"), _desc("plan_revenue"))
    )


# K4 -------------------------------------------------------------------------
def churn_rate_of(monthly: DataFrame, subs_monthly: DataFrame) -> DataFrame:
    """monthly: month, paying_customers; subs_monthly: month, new_customers,
    churned_customers (:func:`~tidemark.operators.monthly.starts_and_churn_by_month`).

    The month shown is the start month when the month has new
    subscriptions, else the payment month: a month with churn only has no
    month (Q12), as in the reference's chain of full joins."""
    active = monthly.select(F.col("month").alias("active_month"), F.col("paying_customers").alias("active_customers"))
    subs = subs_monthly.withColumnRenamed("month", "subs_month")
    j = active.join(subs, active.active_month == subs.subs_month, "full_outer")
    a = F.coalesce(F.col("active_customers"), F.lit(0))
    c = F.coalesce(F.col("churned_customers"), F.lit(0))
    has_new = F.coalesce(F.col("has_starts"), F.lit(False))
    return j.select(
        F.when(has_new, F.col("subs_month")).otherwise(F.col("active_month")).alias("month"),
        a.alias("active_customers"),
        c.alias("churned_customers"),
        F.when(a > 0, pct(c, a + c)).otherwise(F.lit(0)).cast("double").alias("churn_rate_pct"),
    ).transform(S.ordered, _desc("month"))


def churn_rate(t: Tables, p: Params = DEFAULT) -> DataFrame:
    return churn_rate_of(M.revenue_by_month(t.payments, p), M.starts_and_churn_by_month(t.subscriptions))


# K5 -------------------------------------------------------------------------
def churn_by_segment(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """Literal: the WHERE keeps ended subscriptions only, so the 'active'
    count is always 0 and the rate 100 (Q4).

    Subscriptions are reduced to one row per (customer, end month) before
    the join to customers, so a customer holding a third of all
    subscriptions is one row per month, not a hot join task."""
    per_customer = (
        M.ended_subscriptions(t.subscriptions)
        .groupBy("customer_id", F.trunc("end_date", "month").alias("month"))
        .agg(F.max(F.col("end_date").isNull().cast("int")).alias("open"))
    )
    seg = t.customers.select("customer_id", "segment").distinct()
    g = (
        per_customer.join(seg, "customer_id")
        .groupBy("segment", "month")
        .agg(F.count("customer_id").alias("churned_customers"), F.sum("open").cast("long").alias("active_customers"))
    )
    return g.select(
        "segment",
        "month",
        "churned_customers",
        "active_customers",
        pct("churned_customers", F.col("churned_customers") + F.col("active_customers")).cast("double").alias("churn_rate_pct"),
    ).transform(S.ordered, _desc("month"), _desc("churn_rate_pct"), "segment")


def churn_by_segment_corrected(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """Subscription churn per segment and month: ended in the month /
    (ended in the month + open at the month's end).

    Open subscriptions at each month end come from +1/-1 events summed
    cumulatively per segment (a window over months), not from a
    month-by-subscription range join.  Events are netted per (customer,
    month) before the join to customers, so a hot customer is one row per
    month.
    """
    start_m = F.trunc("start_date", "month")
    end_m = F.trunc("end_date", "month")

    def event(month, opened, ended):
        return F.struct(month.alias("month"), F.lit(opened).alias("opened"), F.lit(ended).alias("ended"))

    ev = t.subscriptions.select(
        "customer_id",
        F.explode(
            F.when(F.col("end_date").isNull(), F.array(event(start_m, 1, 0))).otherwise(
                # closed in the later of start and end month (an end before the
                # start is never open); counted as churn in its end month
                F.array(event(start_m, 1, 0), event(F.greatest(start_m, end_m), -1, 0), event(end_m, 0, 1))
            )
        ).alias("e"),
    ).select("customer_id", "e.month", "e.opened", "e.ended")
    per_customer = ev.groupBy("customer_id", "month").agg(
        F.sum("opened").cast("long").alias("opened"), F.sum("ended").cast("long").alias("ended")
    )
    seg = t.customers.select("customer_id", "segment").distinct()
    ev = per_customer.join(seg, "customer_id").groupBy("segment", "month").agg(
        F.sum("opened").cast("long").alias("opened"), F.sum("ended").cast("long").alias("ended")
    )
    w = S.window("month", ["segment"]).rowsBetween(Window.unboundedPreceding, 0)
    running = ev.withColumn("open_subscriptions", F.sum("opened").over(w).cast("long"))
    return (
        running.where(F.col("ended") > 0)
        .select(
            "segment",
            "month",
            F.col("ended").alias("churned_subscriptions"),
            "open_subscriptions",
            pct("ended", F.col("ended") + F.col("open_subscriptions")).cast("double").alias("churn_rate_pct"),
        )
        .transform(S.ordered, _desc("month"), _desc("churn_rate_pct"), "segment")
    )


# K6 -------------------------------------------------------------------------
def retention_rate(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """Literal (Q3): 'start' and 'end' are the same monthly count, so the
    reference's self-join on month is the identity and is not repeated."""
    m = M.revenue_by_month(t.payments, p).select("month", "paying_customers")
    new = M.new_by_month(t.subscriptions).withColumnRenamed("month", "new_month")
    j = m.join(new, m.month == new.new_month, "left")
    n = F.coalesce(F.col("new_customers"), F.lit(0))
    return j.where(F.col("month").isNotNull()).select(
        "month",
        F.col("paying_customers").alias("customers_at_start"),
        n.alias("new_customers"),
        F.col("paying_customers").alias("customers_at_end"),
        F.when(F.col("paying_customers") > 0, pct(F.col("paying_customers") - n, "paying_customers"))
        .otherwise(F.lit(0))
        .cast("double")
        .alias("retention_rate_pct"),
    ).transform(S.ordered, _desc("month"))


# K7 / K8 ----------------------------------------------------------------------
def _conversion(g: DataFrame, key: str) -> DataFrame:
    return g.select(
        key,
        "total_signups",
        "converted_customers",
        pct("converted_customers", "total_signups").cast("double").alias("conversion_rate_pct"),
    )


def conversion_rate_of(conv: DataFrame) -> DataFrame:
    return _conversion(conv, "month").transform(S.ordered, _desc("month"))


def conversion_rate(t: Tables, p: Params = DEFAULT) -> DataFrame:
    return conversion_rate_of(M.conversions_by_month(t.customers, t.subscriptions))


def conversion_by_channel(t: Tables, p: Params = DEFAULT) -> DataFrame:
    g = M.conversions_by(t.customers, t.subscriptions, "acquisition_channel")
    return _conversion(g, "acquisition_channel").transform(S.ordered, _desc("conversion_rate_pct"))


# K9 / K10 ---------------------------------------------------------------------
def mom_growth_of(m: DataFrame, value: str = "revenue") -> DataFrame:
    """month, value series -> lag, change, growth % (input: one row per month)."""
    s = S.with_lag(m.select("month", value), value, "_prev")
    return s.select(
        "month",
        F.col(value),
        F.col("_prev"),
        (F.col(value) - F.col("_prev")).alias("_change"),
        pct(F.col(value) - F.col("_prev"), "_prev").cast("double").alias("mom_growth_pct"),
    )


def mom_growth(t: Tables, p: Params = DEFAULT) -> DataFrame:
    g = mom_growth_of(M.revenue_only_by_month(t.payments, p))
    return g.select(
        "month",
        as_money("revenue").alias("revenue"),
        as_money("_prev").alias("previous_month_revenue"),
        as_money("_change").alias("revenue_change"),
        "mom_growth_pct",
    ).transform(S.ordered, _desc("month"))


def customer_mom_growth(t: Tables, p: Params = DEFAULT) -> DataFrame:
    m = M.revenue_by_month(t.payments, p).withColumnRenamed("paying_customers", "customer_count")
    g = mom_growth_of(m, "customer_count")
    return g.select(
        "month",
        "customer_count",
        F.col("_prev").alias("previous_month_customers"),
        F.col("_change").alias("customer_change"),
        "mom_growth_pct",
    ).transform(S.ordered, _desc("month"))


# K11 ----------------------------------------------------------------------------
def yoy_growth_of(m: DataFrame) -> DataFrame:
    """Same calendar month one year earlier (not LAG 12): a 12-month RANGE
    frame on the month index replaces the reference's self-join."""
    s = S.with_calendar_lag(m.select("month", "revenue"), "revenue", "_prev", 12)
    return s.select(
        "month",
        "revenue",
        "_prev",
        (F.col("revenue") - F.col("_prev")).alias("_change"),
        pct(F.col("revenue") - F.col("_prev"), "_prev").cast("double").alias("yoy_growth_pct"),
    )


def yoy_growth(t: Tables, p: Params = DEFAULT) -> DataFrame:
    g = yoy_growth_of(M.revenue_only_by_month(t.payments, p))
    return g.select(
        "month",
        as_money("revenue").alias("current_revenue"),
        as_money("_prev").alias("previous_year_revenue"),
        as_money("_change").alias("revenue_change"),
        "yoy_growth_pct",
    ).transform(S.ordered, _desc("month"))


# K12 / K13 ------------------------------------------------------------------------
def costs_with_revenue(costs: DataFrame, revenue: DataFrame) -> DataFrame:
    """costs LEFT JOIN successful revenue of the same month.

    The status predicate sits in the reference's ON clause, so cost months
    without revenue survive with revenue 0 (Q13): revenue is filtered and
    aggregated per month *before* the join.  Duplicate cost rows would each
    see the month's payments (literal grouping), hence the multiplicity n.
    """
    c = costs.groupBy("month", "infra_cost", "marketing_cost", "support_cost").agg(F.count(F.lit(1)).alias("_n"))
    r = revenue.select(F.col("month").alias("_rev_month"), F.col("revenue").alias("_rev"))
    j = c.join(r, month_from_text(c.month) == r._rev_month, "left")
    rev = F.coalesce(F.col("_rev") * F.col("_n"), F.lit(0))
    total = F.col("infra_cost") + F.col("marketing_cost") + F.col("support_cost")
    return j.select(
        "month",
        rev.alias("revenue"),
        "infra_cost",
        "marketing_cost",
        "support_cost",
        total.alias("total_costs"),
        (rev - total).alias("profit"),
    )


def gross_margin_of(costs: DataFrame, revenue: DataFrame) -> DataFrame:
    j = costs_with_revenue(costs, revenue)
    return j.select(
        "month",
        as_money("revenue").alias("revenue"),
        as_money("total_costs").alias("total_costs"),
        as_money("profit").alias("gross_profit"),
        pct("profit", "revenue").cast("double").alias("gross_margin_pct"),
    ).transform(S.ordered, _desc("month"))


def gross_margin(t: Tables, p: Params = DEFAULT) -> DataFrame:
    return gross_margin_of(t.costs, M.revenue_only_by_month(t.payments, p))


def cost_vs_revenue(t: Tables, p: Params = DEFAULT) -> DataFrame:
    j = costs_with_revenue(t.costs, M.revenue_only_by_month(t.payments, p))
    return j.select(
        "month",
        as_money("revenue").alias("revenue"),
        as_money("infra_cost").alias("infra_cost"),
        as_money("marketing_cost").alias("marketing_cost"),
        as_money("support_cost").alias("support_cost"),
        as_money("total_costs").alias("total_costs"),
        as_money("profit").alias("net_profit"),
    ).transform(S.ordered, _desc("month"))


# K14 ------------------------------------------------------------------------------
def _customer_ltv(t: Tables, p: Params) -> DataFrame:
    """Per customer: total successful revenue and payment count (one pass
    over payments instead of the reference's two), joined to (customer,
    segment) with the number ``n`` of such customer rows (literal fan-out
    without repeating rows)."""
    per_customer = M.customer_totals(t.payments, p)
    attrs = t.customers.groupBy("customer_id", "segment").agg(F.count(F.lit(1)).alias("n"))
    return attrs.join(per_customer, "customer_id")


def ltv_by_segment(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """Literal (Q6): the average runs over payment rows, so each customer's
    LTV weighs by its payment count."""
    j = _customer_ltv(t, p)
    # one cast per customer: products of totals and counts outgrow BIGINT
    n = F.col("n").cast("decimal(10,0)")
    total = F.col("revenue_cents").cast("decimal(19,0)")
    weight = F.col("n_payments").cast("decimal(14,0)") * n
    g = j.groupBy("segment").agg(
        F.count("customer_id").alias("total_customers"),
        from_cents(F.sum((total * n).cast("decimal(38,0)"))).alias("total_revenue"),
        from_cents(F.sum((total * F.col("n_payments").cast("decimal(14,0)") * F.col("n").cast("decimal(4,0)")).cast("decimal(38,0)"))).alias("_weighted"),
        F.sum(weight.cast("decimal(38,0)")).alias("_n"),
    )
    return g.select(
        "segment",
        "total_customers",
        as_money("total_revenue").alias("total_revenue"),
        rounded(ratio("_weighted", "_n"), 2).cast("double").alias("avg_ltv"),
    ).transform(S.ordered, _desc("avg_ltv"))


def ltv_by_segment_corrected(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """Average LTV over customers (each paying customer once)."""
    per_customer = M.customer_totals(t.payments, p)
    seg = t.customers.select("customer_id", "segment").distinct()
    g = per_customer.join(seg, "customer_id").groupBy("segment").agg(
        F.count("customer_id").alias("total_customers"), from_cents(F.sum("revenue_cents")).alias("total_revenue")
    )
    return g.select(
        "segment",
        "total_customers",
        as_money("total_revenue").alias("total_revenue"),
        rounded(ratio("total_revenue", "total_customers"), 2).cast("double").alias("avg_ltv"),
    ).transform(S.ordered, _desc("avg_ltv"))


# K15 -------------------------------------------------------------------------------
def executive_summary(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """Latest payment month; churn rate = churned / active (Q7)."""
    paid = t.payments.where(F.col("payment_status") == F.lit(p.paid_status))
    # the latest month first, so that only its payments are counted
    month = paid.agg(F.trunc(F.max("payment_date"), "month").alias("m")).scalar()
    latest = M.revenue_by_month(t.payments.where(F.col("payment_date") >= month), p)
    churn = M.churned_by_month(t.subscriptions).withColumnRenamed("month", "churn_month")
    j = latest.join(churn, latest.month == churn.churn_month, "left")
    c = F.coalesce(F.col("churned_customers"), F.lit(0))
    return j.select(
        "month",
        as_money("revenue").alias("revenue"),
        F.col("paying_customers").alias("active_customers"),
        c.alias("churned_customers"),
        F.when(F.col("paying_customers") > 0, pct(c, "paying_customers")).otherwise(F.lit(0)).cast("double").alias("churn_rate_pct"),
    )
