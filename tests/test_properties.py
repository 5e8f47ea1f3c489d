"""Invariants between analyses."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_ORACLE


@pytest.fixture(scope="module")
def q():
    return E.queries()


def total(df, col):
    return round(df.agg(F.sum(col)).first()[0], 2)


def test_segments_sum_to_total(spark, q):
    t = total(q["monthly_revenue"](spark, SF_ORACLE), "monthly_revenue")
    assert total(q["revenue_by_segment_total"](spark, SF_ORACLE), "total_revenue") == t
    assert total(q["revenue_by_segment"](spark, SF_ORACLE), "segment_revenue") == t
    assert total(q["ltv_by_segment"](spark, SF_ORACLE), "total_revenue") == t
    assert total(q["month_spine"](spark, SF_ORACLE), "revenue") == t


def test_paying_customers_agree(spark, q):
    a = {r.month: r.paying_customers for r in q["monthly_revenue"](spark, SF_ORACLE).collect()}
    b = {r.month: r.customers_at_start for r in q["retention_rate"](spark, SF_ORACLE).collect()}
    c = {r.month: r.customer_count for r in q["customer_mom_growth"](spark, SF_ORACLE).collect()}
    assert a == b == c


@pytest.mark.parametrize(
    "key,col",
    [("conversion_rate", "conversion_rate_pct"), ("conversion_by_channel", "conversion_rate_pct"),
     ("conversion_by_country", "conversion_rate_pct"), ("churn_by_segment_corrected", "churn_rate_pct"),
     ("retention_cohorts", "retention_pct"), ("retention_month_over_month", "retention_rate_pct")],
)
def test_percentages_in_range(spark, q, key, col):
    lo, hi = q[key](spark, SF_ORACLE).agg(F.min(col), F.max(col)).first()
    assert 0 <= lo <= hi <= 100


def test_billing_starts_at_start_date(spark, q):
    sched = q["billing_schedule"](spark, SF_ORACLE)
    first = sched.where("installment = 0").select("subscription_id", "due_date")
    from tidemark.sources import fixtures

    subs = fixtures.tables(spark, SF_ORACLE).subscriptions.select("subscription_id", "start_date")
    bad = first.join(subs, "subscription_id").where("due_date != start_date").count()
    assert bad == 0
    gaps = sched.groupBy("subscription_id").agg(
        (F.datediff(F.max("due_date"), F.min("due_date")) - 30 * (F.count(F.lit(1)) - 1)).alias("d")
    ).where("d != 0").count()
    assert gaps == 0


def test_churn_by_segment_literal_rate(spark, q):
    rates = {r[0] for r in q["churn_by_segment"](spark, SF_ORACLE).select("churn_rate_pct").distinct().collect()}
    assert rates == {100.0}  # Q4: the WHERE leaves no active rows
