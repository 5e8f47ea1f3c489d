"""Declared schemas of the four model tables.

CSV sources are always read with these schemas (never inferred).  Only
``subscriptions.end_date`` is nullable; Spark does not enforce NOT NULL,
primary or foreign keys, so :mod:`tidemark.plans.data_jobs` reports
violations instead.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)

CUSTOMERS = T.StructType(
    [
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("signup_date", T.DateType(), False),
        T.StructField("segment", T.StringType(), False),
        T.StructField("country", T.StringType(), False),
        T.StructField("acquisition_channel", T.StringType(), False),
        T.StructField("is_active", T.BooleanType(), False),
    ]
)

SUBSCRIPTIONS = T.StructType(
    [
        T.StructField("subscription_id", T.StringType(), False),
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("plan_type", T.StringType(), False),
        T.StructField("start_date", T.DateType(), False),
        T.StructField("end_date", T.DateType(), True),
        T.StructField("monthly_price", MONEY, False),
    ]
)

PAYMENTS = T.StructType(
    [
        T.StructField("payment_id", T.StringType(), False),
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("payment_date", T.DateType(), False),
        T.StructField("amount", MONEY, False),
        T.StructField("payment_status", T.StringType(), False),
    ]
)

COSTS = T.StructType(
    [
        T.StructField("month", T.StringType(), False),
        T.StructField("infra_cost", MONEY, False),
        T.StructField("marketing_cost", MONEY, False),
        T.StructField("support_cost", MONEY, False),
    ]
)

TABLES = {
    "customers": CUSTOMERS,
    "subscriptions": SUBSCRIPTIONS,
    "payments": PAYMENTS,
    "costs": COSTS,
}

# primary key, NOT NULL columns and foreign keys as declared
PRIMARY_KEYS = {
    "customers": "customer_id",
    "subscriptions": "subscription_id",
    "payments": "payment_id",
    "costs": "month",
}
FOREIGN_KEYS = {
    "subscriptions": ("customer_id", "customers", "customer_id"),
    "payments": ("customer_id", "customers", "customer_id"),
}
DECIMAL_COLUMNS = {
    "subscriptions": ("monthly_price",),
    "payments": ("amount",),
    "costs": ("infra_cost", "marketing_cost", "support_cost"),
}
# declared lengths of the text columns (fixed values)
VARCHAR = {
    "customers": {"customer_id": 20, "segment": 20, "country": 5, "acquisition_channel": 50},
    "subscriptions": {"subscription_id": 20, "customer_id": 20, "plan_type": 20},
    "payments": {"payment_id": 20, "customer_id": 20, "payment_status": 20},
    "costs": {"month": 7},
}


def not_null_columns(table: str) -> list[str]:
    return [f.name for f in TABLES[table].fields if not f.nullable]
