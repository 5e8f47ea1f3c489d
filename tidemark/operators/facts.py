"""Row-level jobs on the fact tables: active status, billing schedule.

Both are narrow (``explode``) or one shuffle on customer_id after
a map-side distinct, so they scale linearly with the tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def open_customer_ids(subscriptions: DataFrame) -> DataFrame:
    """Distinct customers holding a subscription without end date."""
    return (
        subscriptions.where(F.col("end_date").isNull())
        .select(F.col("customer_id").alias("open_customer_id"))
        .distinct()
    )


def with_active_status(customers: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """customers.is_active = customer_id has an open subscription.

    A left join to a *distinct* id list: no fan-out, and Catalyst drops
    the join entirely when ``is_active`` is not used downstream.
    """
    base = customers.drop("is_active") if "is_active" in customers.columns else customers
    open_ids = open_customer_ids(subscriptions)
    return base.join(open_ids, base.customer_id == open_ids.open_customer_id, "left").select(
        *[base[c] for c in base.columns], F.col("open_customer_id").isNotNull().alias("is_active")
    )


def billing_schedule(subscriptions: DataFrame, horizon, interval_days: int = 30) -> DataFrame:
    """One row per due date: every ``interval_days`` from start_date up to
    min(end_date or horizon, horizon), inclusive.

    ``sequence`` raises when start > stop, so those subscriptions (start
    after the horizon, or an end date before the start) are filtered first
    and yield no rows.
    """
    if isinstance(horizon, (str, dt.date)):
        horizon = F.lit(str(horizon)).cast("date")
    stop = F.least(F.coalesce(F.col("end_date"), horizon), horizon)
    due = subscriptions.select(
        "subscription_id", "customer_id", "start_date", "monthly_price", stop.alias("stop_date")
    ).where(F.col("start_date") <= F.col("stop_date"))
    last = F.floor(F.datediff("stop_date", "start_date") / F.lit(interval_days)).cast("int")
    return due.select(
        "subscription_id",
        "customer_id",
        F.explode(F.sequence(F.lit(0), last)).alias("installment"),
        "start_date",
        "monthly_price",
    ).select(
        "subscription_id",
        "customer_id",
        F.col("installment").cast("long").alias("installment"),
        F.date_add("start_date", F.col("installment") * F.lit(interval_days)).alias("due_date"),
        F.col("monthly_price").cast("double").alias("amount"),
    )
