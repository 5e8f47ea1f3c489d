"""Model tables derived from the TPC-H-like test tables.

Deterministic mapping (same definition as the DuckDB oracle's CTEs):

* payments      <- orders: status Failed when o_orderstatus = 'F', amount 0 then
* subscriptions <- orders with priority '1-URGENT'; plan by o_orderkey % 3;
                   ends (o_orderkey % 4 = 0) after 30 * (3 + o_orderkey % 16) days,
                   at the latest on the last order date
* customers     <- customer + nation + first order date as signup date
                   (1995-01-01 without orders: no customer is lost);
                   channel by c_custkey % 4; active = has an open subscription
* costs         <- lineitem per ship month (decimal sums)

All are projections or aggregations of the scanned tables, so the work
grows with them and Catalyst prunes columns and pushes filters through.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.model import Tables
from tidemark.operators.facts import with_active_status
from tidemark.params import CHANNELS, FAILED_STATUS, PAID_STATUS, PLAN_PRICES
from tidemark.schema import MONEY

# fixed values of the mapping
SUBSCRIPTION_PRIORITY = "1-URGENT"
FAILED_ORDER_STATUS = "F"
NO_ORDER_SIGNUP = "1995-01-01"  # signup date of customers without any order
PLAN_ORDER = ("Basic", "Pro", "Enterprise")  # o_orderkey % 3 = 0, 1, 2
COST_MONEY = "decimal(18,2)"


# Declared schemas of the test tables (only the columns the mapping reads):
# reading with a schema skips the footer-inference job per table and
# fails loudly if a table changes type.
RAW_SCHEMAS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in RAW_SCHEMAS:
        reader = reader.schema(RAW_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(key, values):
    """CASE key WHEN 0 THEN values[0] WHEN 1 THEN values[1] ... END."""
    expr = None
    for i, v in enumerate(values):
        expr = F.when(key == i, v) if expr is None else expr.when(key == i, v)
    return expr


def payments(orders: DataFrame) -> DataFrame:
    failed = F.col("o_orderstatus") == F.lit(FAILED_ORDER_STATUS)
    return orders.select(
        F.col("o_orderkey").alias("payment_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("payment_date"),
        F.when(failed, F.lit(0).cast(MONEY)).otherwise(F.col("o_totalprice").cast(MONEY)).alias("amount"),
        F.when(failed, F.lit(FAILED_STATUS)).otherwise(F.lit(PAID_STATUS)).alias("payment_status"),
    )


def subscriptions(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    start = F.to_date("o_orderdate")
    plan_idx = key % 3
    lifetime_days = (F.lit(30) * (F.lit(3) + key % 16)).cast("int")
    # the last order date, a one-row aggregate: no literal cuts newer data
    last = orders.agg(F.max(F.to_date("o_orderdate")).alias("last")).scalar()
    end = F.least(F.date_add(start, lifetime_days), last)
    return orders.where(F.col("o_orderpriority") == F.lit(SUBSCRIPTION_PRIORITY)).select(
        key.alias("subscription_id"),
        F.col("o_custkey").alias("customer_id"),
        _pick(plan_idx, [F.lit(p) for p in PLAN_ORDER]).alias("plan_type"),
        start.alias("start_date"),
        F.when(key % 4 == 0, end).alias("end_date"),
        _pick(plan_idx, [F.lit(Decimal(PLAN_PRICES[p])).cast(MONEY) for p in PLAN_ORDER]).alias("monthly_price"),
    )


def customers(customer: DataFrame, nation: DataFrame, orders: DataFrame, subs: DataFrame) -> DataFrame:
    first_order = orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.min(F.to_date("o_orderdate")).alias("signup_date")
    )
    base = (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_mktsegment").alias("segment"),
            F.col("n_name").alias("country"),
            _pick(F.col("c_custkey") % 4, [F.lit(c) for c in CHANNELS]).alias("acquisition_channel"),
        )
        .join(first_order, "customer_id", "left")
        .withColumn("signup_date", F.coalesce("signup_date", F.lit(NO_ORDER_SIGNUP).cast("date")))
    )
    return with_active_status(base, subs).select(
        "customer_id", "signup_date", "segment", "country", "acquisition_channel", "is_active"
    )


def costs(lineitem: DataFrame) -> DataFrame:
    """Monthly costs from lineitem: infra = sum(price x tax), marketing =
    sum(price x discount), support = sum(quantity), as DECIMAL(18,2).

    The inputs carry at most two decimals, so their exact values are
    integer cents: products are then exact integers in 1e-4 units and the
    sums exact BIGINTs (ANSI mode raises on overflow), equal to summing
    ``CAST(x AS DECIMAL(15,2))`` products without a BigDecimal per row.
    The final DECIMAL(18,2) rounds half up, as the oracle's cast does.
    """
    def units(c):
        return F.round(F.col(c) * F.lit(100.0)).cast("long")

    def total(x, scale: int):
        return (F.sum(x).cast("decimal(38,0)") / F.lit(10**scale)).cast(COST_MONEY)

    price = units("l_extendedprice")
    return lineitem.groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("month")).agg(
        total(price * units("l_tax"), 4).alias("infra_cost"),
        total(price * units("l_discount"), 4).alias("marketing_cost"),
        total(units("l_quantity"), 2).alias("support_cost"),
    )


class FixtureTables(Tables):
    """The mapped tables, each built on first use: a query that reads only
    payments neither analyzes nor plans the customers or costs mapping."""

    def __init__(self, spark: SparkSession, sf_dir: str):  # noqa: D107 - no dataclass init
        object.__setattr__(self, "_spark", spark)
        object.__setattr__(self, "_dir", sf_dir)
        object.__setattr__(self, "_cache", {})

    def _get(self, name: str, build) -> DataFrame:
        cache = self._cache
        if name not in cache:
            cache[name] = build()
        return cache[name]

    def _orders(self) -> DataFrame:
        return self._get("orders", lambda: read(self._spark, self._dir, "orders"))

    @property
    def payments(self) -> DataFrame:  # type: ignore[override]
        return self._get("payments", lambda: payments(self._orders()))

    @property
    def subscriptions(self) -> DataFrame:  # type: ignore[override]
        return self._get("subscriptions", lambda: subscriptions(self._orders()))

    @property
    def customers(self) -> DataFrame:  # type: ignore[override]
        return self._get(
            "customers",
            lambda: customers(
                read(self._spark, self._dir, "customer"),
                read(self._spark, self._dir, "nation"),
                self._orders(),
                self.subscriptions,
            ),
        )

    @property
    def costs(self) -> DataFrame:  # type: ignore[override]
        return self._get("costs", lambda: costs(read(self._spark, self._dir, "lineitem")))

    def raw(self) -> Tables:
        """The tables before the casts that a wrong value would not survive:
        payment amounts as the source's numbers."""
        failed = F.col("o_orderstatus") == F.lit(FAILED_ORDER_STATUS)
        pay = self._orders().select(
            F.col("o_orderkey").alias("payment_id"), F.col("o_custkey").alias("customer_id"), F.to_date("o_orderdate").alias("payment_date"),
            F.when(failed, F.lit(0.0)).otherwise(F.col("o_totalprice")).alias("amount"),
            F.when(failed, F.lit(FAILED_STATUS)).otherwise(F.lit(PAID_STATUS)).alias("payment_status"),
        )
        return Tables(customers=self.customers, subscriptions=self.subscriptions, payments=pay, costs=self.costs)

    def __repr__(self) -> str:
        return f"FixtureTables({self._dir!r})"


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return FixtureTables(spark, sf_dir)
