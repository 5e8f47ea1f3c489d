"""Interval and as-of joins, rollup, ranks and sets under skew: one customer
holds a third of all rows, some days repeat, keys and dates may be NULL."""

import datetime as dt
from decimal import Decimal

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from oracle_compare import compare
from test_edge_cases import DUCK_TYPES, relaxed
from tidemark.model import Tables
from tidemark.operators import intervals
from tidemark.oracle import model_sql
from tidemark.params import DEFAULT
from tidemark.plans import ANALYSES, rollups
from tidemark.schema import TABLES

KEYS = [
    "revenue_by_plan_corrected", "billing_reconciliation", "revenue_rollup", "top_customers_by_segment", "revenue_deciles",
    "customer_movements", "retention_matrix", "payers_by_period",
]


@pytest.fixture(scope="module")
def skewed(spark):
    import pandas as pd

    rng = np.random.default_rng(8)
    day = lambda n: dt.date(2000, 1, 1) + dt.timedelta(days=int(n))
    who = lambda: "HOT" if rng.random() < 0.34 else None if rng.random() < 0.02 else f"C{rng.integers(25)}"
    data = {
        "customers": [(f"C{i}", day(rng.integers(200)), ["SMB", "Enterprise", "Mid-Market"][i % 3], "US", "Organic", True) for i in range(23)]
        + [("HOT", day(3), "SMB", "US", "Organic", True), ("IDLE", day(9), "SMB", "US", "Organic", False)],
        "subscriptions": [
            (f"S{i % 250}", who(), ["Basic", "Pro", "Enterprise"][int(rng.integers(3))], day(s := int(rng.integers(420))),
             day(s + int(rng.integers(-5, 90))) if rng.random() < 0.7 else None, Decimal("29.99")) for i in range(300)
        ],
        "payments": [
            (f"P{i}", who(), day(rng.integers(400)), Decimal(int(rng.integers(0, 4)) * 10), "Success" if rng.random() < 0.9 else "Failed") for i in range(1500)
        ],
        "costs": [("2000-01", Decimal(1), Decimal(2), Decimal(3))],
    }
    con, frames = duckdb.connect(), {}
    for name, rows in data.items():
        con.execute(f"CREATE TABLE {name} ({DUCK_TYPES[name]})")
        frame = pd.DataFrame(rows, columns=[f.name for f in TABLES[name].fields])  # noqa: F841 - read by name
        con.execute(f"INSERT INTO {name} SELECT * FROM frame")
        frames[name] = spark.createDataFrame(rows, relaxed(TABLES[name]))
    return Tables(**frames), con


@pytest.mark.parametrize("key", KEYS)
def test_skewed_tables(skewed, key):
    t, con = skewed
    ok, msg = compare(ANALYSES[key](t, DEFAULT), con, model_sql(key))
    assert ok, msg


def test_hot_customer_is_a_row_a_day_before_it_is_joined(skewed):
    t, _ = skewed
    days = intervals.customer_days(t.payments)
    assert days.where("customer_id = 'HOT'").count() <= 400 < t.payments.where("customer_id = 'HOT'").count()
    last = F.lit("2001-02-04").cast("date")
    bins = intervals.open_intervals(t.subscriptions, last)
    # a bin holds no more than the customer's distinct intervals
    most = bins.groupBy("customer_id", "bin").count().agg(F.max("count")).first()[0]
    assert most <= t.subscriptions.where("customer_id = 'HOT'").select("start_date", "end_date").distinct().count()


def test_corrected_plans_add_up_to_the_month(skewed):
    t, _ = skewed
    by_plan = {r.month: r.s for r in ANALYSES["revenue_by_plan_corrected"](t).groupBy("month").agg(F.sum("plan_revenue").alias("s")).collect()}
    assert by_plan == {r.month: r.monthly_revenue for r in ANALYSES["monthly_revenue"](t).collect()}


def test_as_of_join_of_any_rows(spark):
    left = spark.createDataFrame([("a", 1, "x"), ("a", 5, "y"), ("a", 5, "y"), ("b", 2, "z"), (None, 1, "n"), ("c", None, "m")], "k string, t int, v string")
    right = spark.createDataFrame([("a", 3), ("a", 5), ("a", 5), ("b", 1), (None, 4), ("c", 9)], "k string, u int")
    got = intervals.next_match(left, right, "k", "t", "u", "found")
    assert got.columns == ["k", "t", "v", "found"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [("a", 1, "x", 3), ("a", 5, "y", 5), ("a", 5, "y", 5), ("b", 2, "z", None), (None, 1, "n", None), ("c", None, "m", None)], key=str
    )


def test_top_k_is_limited_before_the_shuffle(skewed):
    t, _ = skewed
    plan = ANALYSES["top_customers_by_segment"](t)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan[plan.index("WindowGroupLimit"):]


def test_sketches_merge_as_well_as_they_count(spark):
    """Error of merged monthly sketches against exact counts, on 120,000 customers."""
    rows = spark.range(120_000).select(
        F.col("id").cast("string").alias("customer_id"), F.explode(F.sequence(F.lit(0), F.pmod(F.hash("id"), F.lit(5)))).alias("k")
    ).select(F.lit("P").alias("payment_id"), "customer_id", F.add_months(F.lit(dt.date(2000, 1, 1)), F.col("k")).alias("payment_date"),
             F.lit("1").cast("decimal(10,2)").alias("amount"), F.lit("Success").alias("payment_status"))
    got = rollups.payers_by_period(Tables(customers=None, subscriptions=None, payments=rows, costs=None)).collect()
    assert len(got) == 5 + 2 + 1 and all(r.estimate_within_bound for r in got)
    assert {r.period: r.payers for r in got if r.period == "year"} == {"year": 120_000}
