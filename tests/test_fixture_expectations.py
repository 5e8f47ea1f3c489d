"""Counts stated for the sf0.01 test tables (FIXTURES.md section 3)."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_ORACLE


@pytest.fixture(scope="module")
def q():
    return E.queries()


def counts(spark, q, key, col):
    return {r[0]: r[1] for r in q[key](spark, SF_ORACLE).groupBy(col).count().collect()}


def test_revenue_flags(spark, q):
    assert counts(spark, q, "revenue_anomalies", "anomaly_flag") == {
        "HIGH ANOMALY (>15% change)": 26, "MEDIUM ANOMALY (>10% change)": 10, "Normal": 43}


def test_churn_flags(spark, q):
    assert counts(spark, q, "churn_spikes", "anomaly_flag") == {
        "CHURN SPIKE DETECTED": 7, "Elevated Churn": 3, "Normal": 66}


def test_conversion_flags(spark, q):
    assert counts(spark, q, "conversion_drops", "anomaly_flag") == {
        "CONVERSION DROP: Significant decrease detected": 7, "CONVERSION DROP: Moderate decrease": 4,
        "CONVERSION DROP: >5% MoM decrease": 9, "Normal": 30}


def test_insights(spark, q):
    df = q["revenue_churn_insights"](spark, SF_ORACLE)
    assert df.count() == 147
    assert df.where("insight IS NOT NULL").count() == 44


def test_plan_fan_out(spark, q):
    k3 = q["revenue_by_plan"](spark, SF_ORACLE).agg(F.sum("plan_revenue")).first()[0]
    k1 = q["monthly_revenue"](spark, SF_ORACLE).agg(F.sum("monthly_revenue")).first()[0]
    assert round(k3, 2) == 5497203857.26 and round(k1, 2) == 2525269068.32


def test_table_shapes(spark, q):
    got = {r.table_name: r.row_count for r in q["table_row_counts"](spark, SF_ORACLE).collect()}
    assert got == {"customers": 1500, "subscriptions": 2978, "payments": 15000, "costs": 83}
    checks = {r.check_type: r["count"] for r in q["load_checks"](spark, SF_ORACLE).collect()}
    assert checks["Sample subscriptions (churned)"] == 751
    assert q["monthly_revenue"](spark, SF_ORACLE).count() == 80
    assert q["conversion_rate"](spark, SF_ORACLE).count() == 51


def test_outputs_keep_reference_order(spark, q):
    months = [r.month for r in q["monthly_revenue"](spark, SF_ORACLE).collect()]
    assert months == sorted(months, reverse=True)
    fc = [(r.data_type, r.period) for r in q["combined_forecast"](spark, SF_ORACLE).collect()]
    assert [d for d, _ in fc] == ["Historical"] * 13 + ["Forecast"] * 6
    assert [p for _, p in fc] == sorted(p for _, p in fc)
    ch = [r.conversion_rate_pct for r in q["conversion_by_channel"](spark, SF_ORACLE).collect()]
    assert ch == sorted(ch, reverse=True)
