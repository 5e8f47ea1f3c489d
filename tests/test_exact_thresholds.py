"""Bands are compared on exact numbers: a move of exactly 10, 12 or 15% is
not above it, and a flat series is never an outlier of itself."""

import datetime as dt
from decimal import Decimal

from tidemark.plans import anomaly, metrics
from tidemark.model import Tables
from tidemark.schema import TABLES


def month(i):
    return dt.date(2020 + i // 12, i % 12 + 1, 5)


def tables(spark, payments, customers=(), subscriptions=()):
    rows = {"payments": payments, "customers": customers, "subscriptions": subscriptions, "costs": ()}
    return Tables(**{k: spark.createDataFrame(list(v), TABLES[k]) for k, v in rows.items()})


def pay(i, amount, customer="C1", n=0):
    return (f"P{i}-{n}", customer, month(i), Decimal(amount), "Success")


def flags(spark, amounts):
    t = tables(spark, [pay(i, a) for i, a in enumerate(amounts)])
    rows = anomaly.revenue_anomalies(t).collect()
    return [(r.anomaly_flag, r.statistical_anomaly) for r in sorted(rows, key=lambda r: r.month)]


def test_exact_moves(spark):
    assert flags(spark, ["9.00", "10.35"])[0][0] == "MEDIUM ANOMALY (>10% change)"
    assert flags(spark, ["1.40", "1.54"])[0][0] == "Normal"
    assert flags(spark, ["1.40", "1.55"])[0][0] == "MEDIUM ANOMALY (>10% change)"
    assert flags(spark, ["9.00", "10.36"])[0][0] == "HIGH ANOMALY (>15% change)"


def test_flat_revenue_has_no_outlier(spark):
    assert set(flags(spark, ["0.05"] * 7)) == {("Normal", None)}


def test_flat_conversion_has_no_drop(spark):
    customers, subscriptions = [], []
    for i in range(8):
        for j in range(7):
            c = f"C{i}-{j}"
            customers.append((c, month(i), "SMB", "X", "Organic", True))
            if j < 2:
                subscriptions.append((f"S{i}-{j}", c, "Basic", month(i), None, Decimal("29.99")))
    rows = anomaly.conversion_drops(tables(spark, [], customers, subscriptions)).collect()
    assert len(rows) == 7 and {r.anomaly_flag for r in rows} == {"Normal"}


def test_lifetime_value_of_a_very_hot_customer(spark):
    n, amount = 400_000, Decimal("999999.99")
    t = tables(spark, [], [("C1", month(0), "SMB", "X", "Organic", True)])
    many = spark.range(n).selectExpr(
        "concat('P', id) AS payment_id", "'C1' AS customer_id", "date'2020-01-05' AS payment_date",
        f"CAST({amount} AS DECIMAL(10,2)) AS amount", "'Success' AS payment_status",
    )
    t = Tables(customers=t.customers, subscriptions=t.subscriptions, payments=many, costs=t.costs)
    row = metrics.ltv_by_segment(t).first()
    assert row.avg_ltv == float(amount * n) and row.total_revenue == float(amount * n)


def test_no_customer_is_lost(spark):
    import os

    from conftest import TESTDATA
    from tidemark.sources import fixtures

    for sf in ("sf0.001", "sf0.01", "sf0.1"):
        d = os.path.join(TESTDATA, sf)
        assert fixtures.tables(spark, d).customers.count() == fixtures.read(spark, d, "customer").count()
