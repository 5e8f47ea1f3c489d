"""Analyses that match rows by date: payments to the subscription open on
their day, due dates to the payment that follows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import as_money, from_cents, month_start
from tidemark.model import Tables
from tidemark.operators import intervals as I
from tidemark.operators import monthly as M
from tidemark.operators import series as S
from tidemark.params import DEFAULT, Params
from tidemark.plans.data_jobs import billing_schedule


def last_payment_date(t: Tables):
    """A one-row aggregate as a scalar column."""
    return t.payments.agg(F.max("payment_date").alias("last")).scalar()


def plan_days(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """(customer_id, day) -> revenue_cents, n_payments, plan_type open then."""
    return I.open_plan(I.customer_days(t.payments, p), I.open_intervals(t.subscriptions, last_payment_date(t)))


# K3 corrected -------------------------------------------------------------------
def revenue_by_plan_corrected(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """Each successful payment under the plan of the one subscription open on
    its date (K3 counts it under every subscription of the customer); NULL
    plan where none is open, so the plans add up to the month's revenue."""
    cm = plan_days(t, p).groupBy("customer_id", "plan_type", month_start("day").alias("month")).agg(
        F.sum("revenue_cents").alias("revenue_cents"), F.sum("n_payments").alias("n_payments")
    )
    return (
        cm.groupBy("plan_type", "month")
        .agg(
            from_cents(F.sum("revenue_cents")).alias("revenue"),
            F.count("customer_id").alias("customers"),
            F.sum("n_payments").alias("payments"),
        )
        .select("plan_type", "month", as_money("revenue").alias("plan_revenue"), "customers", "payments")
        .transform(S.ordered, F.col("month").desc_nulls_first(), F.col("plan_type").asc_nulls_last())
    )


# G1 matched with payments -------------------------------------------------------
def billing_reconciliation(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """Every due date with the customer's next successful payment on or after
    it: ``on time`` within the billing interval, else ``late``; ``open``
    without one."""
    due = billing_schedule(t, p)
    paid = M.paid_payments(t.payments, p).select("customer_id", "payment_date")
    met = I.next_match(due, paid, "customer_id", "due_date", "payment_date", "paid_date")
    days = F.datediff("paid_date", "due_date")
    status = F.when(F.col("paid_date").isNull(), "open").when(days < p.billing_interval_days, "on time").otherwise("late")
    return met.select(
        "subscription_id", "customer_id", "installment", "due_date", "amount", "paid_date", days.cast("int").alias("days_to_payment"), status.alias("status")
    )
