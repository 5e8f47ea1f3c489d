"""Interval and as-of joins without a range cross.

Both sides are reduced before they meet: facts to one row per (customer,
day), intervals to the distinct ones of a customer.  So a customer that holds
a third of all rows is at most one row per calendar day on either side,
whatever the number of payments, and its days spread over the month bins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import cents, month_start
from tidemark.operators.monthly import paid_payments
from tidemark.params import DEFAULT, Params


def customer_days(payments: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """(customer_id, day) -> revenue_cents, n_payments of successful payments."""
    return (
        paid_payments(payments, p)
        .where(F.col("payment_date").isNotNull())
        .groupBy("customer_id", F.col("payment_date").alias("day"))
        .agg(F.sum(cents("amount")).alias("revenue_cents"), F.count(F.lit(1)).alias("n_payments"))
    )


def open_intervals(subscriptions: DataFrame, horizon: Column) -> DataFrame:
    """The distinct intervals of every customer, one row per month they
    touch: (customer_id, bin, start_date, stop_date, sub), with ``sub`` the
    interval's largest (subscription_id, plan_type).

    An interval without end is open up to ``horizon``, the last day that a
    fact can have; one that ends before it starts, or starts later, is none.
    """
    # an end after the horizon admits no other fact than the horizon does
    stop = F.least(F.coalesce("end_date", horizon), horizon)
    distinct = (
        subscriptions.select("customer_id", "subscription_id", "plan_type", "start_date", stop.alias("stop_date"))
        .where(F.col("start_date") <= F.col("stop_date"))
        .groupBy("customer_id", "start_date", "stop_date")
        .agg(F.max(F.struct("subscription_id", "plan_type")).alias("sub"))
    )
    months = F.sequence(month_start("start_date"), month_start("stop_date"), F.expr("INTERVAL 1 MONTH"))
    return distinct.select("customer_id", F.explode(months).alias("bin"), "start_date", "stop_date", "sub")


def open_plan(days: DataFrame, intervals: DataFrame) -> DataFrame:
    """``days`` with ``plan_type`` of the subscription open on the day: of
    several the one started last, ties to the larger id; NULL if none is.

    A binned range join: an equi-join on (customer, month), the dates
    compared inside; the best match is a map-side maximum.
    """
    d = days.withColumn("bin", month_start("day"))
    i = intervals.withColumnRenamed("customer_id", "_customer").withColumnRenamed("bin", "_bin")
    inside = (d.day >= i.start_date) & (d.day <= i.stop_date)
    met = d.join(i, (d.customer_id == i._customer) & (d.bin == i._bin) & inside, "left")
    best = F.max(F.when(F.col("sub").isNotNull(), F.struct("start_date", "sub")))
    return (
        met.groupBy("customer_id", "day", "revenue_cents", "n_payments")
        .agg(best.alias("_best"))
        .select("customer_id", "day", "revenue_cents", "n_payments", F.col("_best.sub.plan_type").alias("plan_type"))
    )


def next_match(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, out: str) -> DataFrame:
    """As-of join: every row of ``left`` with the first ``right_time`` of its
    key at or after its ``left_time`` as ``out`` (NULL without one).

    Both sides are reduced to distinct (key, time), so the sorted merge of one
    key holds at most two rows per day; the result is joined back on
    (key, time).  Rows with a NULL key or time match nothing.
    """
    asked = left.select(F.col(key).alias("_k"), F.col(left_time).alias("_t"))
    given = right.select(F.col(key).alias("_k"), F.col(right_time).alias("_t"))
    events = (
        asked.withColumn("_here", F.lit(False)).unionByName(given.withColumn("_here", F.lit(True)))
        .where(F.col("_k").isNotNull() & F.col("_t").isNotNull())
        .groupBy("_k", "_t")
        .agg(F.bool_or("_here").alias("_here"), F.bool_or(~F.col("_here")).alias("_asked"))
    )
    # backwards in time, so that the frame only grows
    ahead = Window.partitionBy("_k").orderBy(F.col("_t").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    merged = events.withColumn(out, F.last(F.when(F.col("_here"), F.col("_t")), ignorenulls=True).over(ahead))
    found = merged.where("_asked").select("_k", "_t", out)
    return left.join(found, (left[key] == found["_k"]) & (left[left_time] == found["_t"]), "left").drop("_k", "_t")
