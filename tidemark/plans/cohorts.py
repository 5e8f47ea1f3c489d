"""Analyses the reference announces without SQL: conversion by country,
retention cohorts, month-over-month retention (definitions are ours)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import month_start, pct
from tidemark.model import Tables
from tidemark.operators import monthly as M
from tidemark.operators import series as S
from tidemark.params import DEFAULT, Params


# N1 ---------------------------------------------------------------------------
def conversion_by_country(t: Tables, p: Params = DEFAULT) -> DataFrame:
    g = M.conversions_by(t.customers, t.subscriptions, "country")
    return g.select(
        "country",
        "total_signups",
        "converted_customers",
        pct("converted_customers", "total_signups").cast("double").alias("conversion_rate_pct"),
    ).transform(S.ordered, F.col("conversion_rate_pct").desc_nulls_first(), F.col("country").asc_nulls_last())


# N2 ---------------------------------------------------------------------------
def retention_cohorts(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """cohort = signup month; for each later month k, the share of the
    cohort's customers with a successful payment in that month."""
    cohort = t.customers.select("customer_id", month_start("signup_date").alias("cohort_month")).distinct()
    sizes = cohort.groupBy("cohort_month").agg(F.count("customer_id").alias("cohort_size"))
    cm = M.customer_months(t.payments, p).select("customer_id", "month")
    active = (
        cm.join(cohort, "customer_id")
        .withColumn("months_since_signup", F.months_between("month", "cohort_month").cast("int"))
        .groupBy("cohort_month", "months_since_signup")
        .agg(F.count("customer_id").alias("active_customers"))
    )
    return active.join(sizes, "cohort_month").select(
        "cohort_month",
        "months_since_signup",
        "cohort_size",
        "active_customers",
        pct("active_customers", "cohort_size").cast("double").alias("retention_pct"),
    ).transform(S.ordered, "cohort_month", "months_since_signup")


# N3 ---------------------------------------------------------------------------
def retention_month_over_month(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """Of the customers paying in month m-1, the share also paying in m
    (for every month m with payers whose previous month had payers).

    Payments are shuffled once, by customer, as the set of their months
    (map-side sets, at most one entry per calendar month); each month of a
    customer then looks for the month before it in the set.  Monthly totals
    and a calendar lag of the payer count follow."""
    months = (
        t.payments.where((F.col("payment_status") == F.lit(p.paid_status)) & F.col("payment_date").isNotNull())
        .groupBy("customer_id")
        .agg(F.collect_set(F.trunc("payment_date", "month")).alias("_set"))
    )
    per_month = (
        months.select("customer_id", "_set", F.explode("_set").alias("month"))
        .withColumn("_kept", F.array_contains("_set", F.add_months("month", -1)).cast("int"))
        .groupBy("month")
        .agg(F.count("customer_id").alias("payers"), F.sum("_kept").alias("retained"))
    )
    s = S.with_calendar_lag(per_month, "payers", "customers_prev_month", 1)
    r = F.coalesce(F.col("retained"), F.lit(0)).cast("long")
    return s.where(F.col("customers_prev_month").isNotNull()).select(
        "month",
        "customers_prev_month",
        r.alias("retained_customers"),
        pct(r, "customers_prev_month").cast("double").alias("retention_rate_pct"),
    ).transform(S.ordered, F.col("month").desc_nulls_first())
