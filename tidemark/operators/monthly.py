"""Fact-level aggregation to small monthly tables.

These are the only operators that touch the large tables (payments,
subscriptions, customers).  Each one shrinks its input with a partial
(map-side) aggregation before the shuffle, so a hot key -- one customer
or one month holding a third of all rows -- is collapsed inside every map
task instead of landing in a single reducer.  Everything downstream works
on one row per month (or per month and dimension).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import cents, from_cents, month_start
from tidemark.params import DEFAULT, Params


def paid_payments(payments: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Successful payments only (filter reaches the Parquet scan)."""
    return payments.where(F.col("payment_status") == F.lit(p.paid_status))


def customer_months(payments: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """(customer_id, month) -> revenue_cents, n_payments of successful payments.

    The shared pre-aggregate: at most one row per customer and month,
    whatever the payment frequency, so joins on customer_id after it
    neither fan out nor skew.  Revenue is kept as exact BIGINT cents until
    it is rolled up to months (:func:`tidemark.functions.from_cents`).
    """
    return (
        paid_payments(payments, p)
        .groupBy("customer_id", month_start("payment_date").alias("month"))
        .agg(F.sum(cents("amount")).alias("revenue_cents"), F.count(F.lit(1)).alias("n_payments"))
    )


def customer_totals(payments: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """customer_id -> revenue_cents, n_payments over all successful payments."""
    return (
        paid_payments(payments, p)
        .groupBy("customer_id")
        .agg(F.sum(cents("amount")).alias("revenue_cents"), F.count(F.lit(1)).alias("n_payments"))
    )


def revenue_by_month(payments: DataFrame, p: Params = DEFAULT, dims: Sequence[str] = ()) -> DataFrame:
    """month [, dims] -> revenue, paying_customers, total_payments.

    ``dims`` are columns already on ``payments`` (callers join dimension
    attributes onto :func:`customer_months` instead, see
    :func:`revenue_by_customer_attr`).
    """
    cm = customer_months(payments, p)
    return rollup_customer_months(cm, dims)


def revenue_only_by_month(payments: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """month -> revenue, for analyses that need no customer counts.

    One shuffle of partial sums: each map task sends at most one row per
    month, where :func:`revenue_by_month` must shuffle (customer, month)
    pairs for its distinct count.
    """
    return (
        paid_payments(payments, p)
        .groupBy(month_start("payment_date").alias("month"))
        .agg(from_cents(F.sum(cents("amount"))).alias("revenue"))
    )


def rollup_customer_months(cm: DataFrame, dims: Sequence[str] = ()) -> DataFrame:
    keys = ["month", *dims]
    return cm.groupBy(*keys).agg(
        from_cents(F.sum("revenue_cents")).alias("revenue"),
        # rows are unique per (customer, month [, dims]): count = COUNT(DISTINCT customer_id)
        F.count("customer_id").alias("paying_customers"),
        F.sum("n_payments").alias("total_payments"),
    )


def revenue_by_customer_attr(payments: DataFrame, customers: DataFrame, attr: str, p: Params = DEFAULT) -> DataFrame:
    """(attr, month) -> revenue, paying_customers via an inner join to customers.

    Payments are pre-aggregated per (customer, month) before the join;
    customers are reduced to distinct (customer_id, attr) so a duplicated
    customer row cannot double-count (literal SQL would fan out: handled by
    the row multiplicity ``n``).
    """
    cm = customer_months(payments, p)
    attrs = customers.groupBy("customer_id", attr).agg(F.count(F.lit(1)).alias("n"))
    joined = cm.join(attrs, "customer_id")
    return joined.groupBy(attr, "month").agg(
        from_cents(F.sum(F.col("revenue_cents") * F.col("n"))).alias("revenue"),
        # (customer, month, attr) is unique after the distinct attrs
        F.count("customer_id").alias("paying_customers"),
    )


def new_by_month(subscriptions: DataFrame) -> DataFrame:
    """start month -> distinct customers starting a subscription."""
    return subscriptions.groupBy(month_start("start_date").alias("month")).agg(
        F.count_distinct("customer_id").alias("new_customers")
    )


def starts_and_churn_by_month(subscriptions: DataFrame) -> DataFrame:
    """month -> new_customers (distinct customers starting a subscription)
    and churned_customers (distinct customers with one ending), from one
    pass: each subscription becomes a start and an end event, events are
    made distinct per (customer, kind, month), then counted."""
    event = lambda kind, d: F.struct(F.lit(kind).alias("kind"), month_start(d).alias("month"))
    ev = (
        subscriptions.select("customer_id", F.explode(F.array(event("start", "start_date"), event("end", "end_date"))).alias("e"))
        # a subscription without end date has no end event
        .where(F.col("e.month").isNotNull() | (F.col("e.kind") == "start"))
        .select("customer_id", "e.kind", "e.month")
        .distinct()
    )
    start, end = F.col("kind") == "start", F.col("kind") == "end"
    return ev.groupBy("month").agg(
        F.count(F.when(start, F.col("customer_id"))).alias("new_customers"),
        F.count(F.when(end, F.col("customer_id"))).alias("churned_customers"),
        # the month has subscription starts (even if their customer ids are NULL)
        (F.count(F.when(start, F.lit(1))) > 0).alias("has_starts"),
    )


def ended_subscriptions(subscriptions: DataFrame) -> DataFrame:
    return subscriptions.where(F.col("end_date").isNotNull())


def churned_by_month(subscriptions: DataFrame) -> DataFrame:
    """end month -> distinct customers with a subscription ending then."""
    return ended_subscriptions(subscriptions).groupBy(month_start("end_date").alias("month")).agg(
        F.count_distinct("customer_id").alias("churned_customers")
    )


def churned_by_segment_month(subscriptions: DataFrame, customers: DataFrame) -> DataFrame:
    """(segment, end month) -> distinct churned customers (inner join to customers)."""
    ended = ended_subscriptions(subscriptions).select(
        "customer_id", month_start("end_date").alias("month")
    ).distinct()
    seg = customers.select("customer_id", "segment").distinct()
    return ended.join(seg, "customer_id").groupBy("segment", "month").agg(
        F.count("customer_id").alias("churned_customers")
    )


def subscriber_ids(subscriptions: DataFrame) -> DataFrame:
    """Distinct customers that have at least one subscription."""
    return subscriptions.select(F.col("customer_id").alias("subscriber_id")).distinct()


def conversions_by(customers: DataFrame, subscriptions: DataFrame, key) -> DataFrame:
    """key -> total_signups, converted_customers.

    Literal meaning of ``customers LEFT JOIN subscriptions`` with two
    distinct counts, without the join's fan-out (one customer with many
    subscriptions) and without an ``Expand`` of two distinct aggregates:
    distinct (key, customer) pairs, flagged by a join to distinct
    subscriber ids, then plain counts.
    """
    key_col = key if not isinstance(key, str) else F.col(key)
    name = key if isinstance(key, str) else "month"
    pairs = customers.select(key_col.alias(name), "customer_id").distinct()
    flagged = pairs.join(subscriber_ids(subscriptions), pairs.customer_id == F.col("subscriber_id"), "left")
    return flagged.groupBy(name).agg(
        F.count("customer_id").alias("total_signups"),
        F.count("subscriber_id").alias("converted_customers"),
    )


def conversions_by_month(customers: DataFrame, subscriptions: DataFrame) -> DataFrame:
    return conversions_by(customers, subscriptions, month_start("signup_date"))
