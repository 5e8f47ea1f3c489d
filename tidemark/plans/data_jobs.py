"""Load, integrity and billing jobs around the analyses.

* L2 ``table_row_counts`` and L3 ``load_checks``: the loader's checks, one
  scan per table, conditional counts in a single aggregate.
* L4 ``integrity_report``: the declared constraints (primary keys, NOT
  NULL, foreign keys, DECIMAL(10,2) range) as a violation report, since
  Spark enforces none of them at write time.
* G1 ``billing_schedule``, G2 ``active_status``, G3 ``month_spine``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.model import Tables
from tidemark.operators import facts
from tidemark.operators import monthly as M
from tidemark.operators import series as S
from tidemark.params import DEFAULT, FAILED_STATUS, Params
from tidemark.schema import DECIMAL_COLUMNS, FOREIGN_KEYS, PRIMARY_KEYS, VARCHAR, not_null_columns

# fixed labels of the loader's checks
LOAD_CHECK_LABELS = (
    "Sample customers",
    "Sample subscriptions (active)",
    "Sample subscriptions (churned)",
    "Sample payments (success)",
    "Sample payments (failed)",
)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


# L2 ---------------------------------------------------------------------------
def table_row_counts(t: Tables, p: Params = DEFAULT) -> DataFrame:
    rows = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in t.as_dict().items()
    ]
    return union_all(rows)


# L3 ---------------------------------------------------------------------------
def load_checks(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """One conditional aggregate per table (one scan each), unpivoted to
    (check_type, count) rows."""

    def n(cond):
        return F.count(F.when(cond, F.lit(1))).alias

    cust = t.customers.agg(F.count(F.lit(1)).alias(LOAD_CHECK_LABELS[0]))
    subs = t.subscriptions.agg(
        n(F.col("end_date").isNull())(LOAD_CHECK_LABELS[1]), n(F.col("end_date").isNotNull())(LOAD_CHECK_LABELS[2])
    )
    pays = t.payments.agg(
        n(F.col("payment_status") == F.lit(p.paid_status))(LOAD_CHECK_LABELS[3]),
        n(F.col("payment_status") == F.lit(FAILED_STATUS))(LOAD_CHECK_LABELS[4]),
    )
    return union_all([row.unpivot([], [f"`{c}`" for c in row.columns], "check_type", "count") for row in (cust, subs, pays)])


# L4 ---------------------------------------------------------------------------
def _table_checks(name: str, df: DataFrame) -> DataFrame:
    """All row checks of one table as one conditional aggregate (no shuffle
    of rows), unpivoted to (check_name, column_name, violations)."""
    totals = []

    def add(label: str, cond) -> None:
        totals.append(F.count(F.when(cond, F.lit(1))).alias(label))

    for c in not_null_columns(name):
        add(f"not_null|{c}", F.col(c).isNull())
    for c in DECIMAL_COLUMNS.get(name, ()):
        add(f"decimal_range|{c}", F.col(c).isNotNull() & F.col(c).try_cast("decimal(10,2)").isNull())
    if name == "subscriptions":
        add("end_before_start|end_date", F.col("end_date") < F.col("start_date"))

    for c, n in VARCHAR.get(name, {}).items():
        add(f"varchar_length|{c}", F.length(F.col(c).cast("string")) > n)

    row = df.agg(*totals)
    parts = F.split("_check", r"\|")
    return row.unpivot([], [f"`{c}`" for c in row.columns], "_check", "violations").select(
        F.lit(name).alias("table_name"),
        parts.getItem(0).alias("check_name"),
        parts.getItem(1).alias("column_name"),
        "violations",
    )


def key_checks(tables: dict[str, DataFrame]) -> list[DataFrame]:
    """Key values that occur more than once, and child rows whose customer_id
    is not a customer.  Keys alone are shuffled; the child side is reduced to
    (id, row count) before the anti join, so a customer holding a third of
    all payments is one row, not a hot task."""
    out = []

    def add(table: str, check: str, column: str, df: DataFrame) -> None:
        out.append(df.select(F.lit(table).alias("table_name"), F.lit(check).alias("check_name"), F.lit(column).alias("column_name"), "violations"))

    for name, key in PRIMARY_KEYS.items():
        per_key = tables[name].groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        add(name, "primary_key", key, per_key.agg(F.count(F.when(F.col("_n") > 1, F.lit(1))).alias("violations")))
    parent_ids = tables["customers"].select(F.col("customer_id").alias("_pid")).distinct()
    for child, (col, _parent, _pcol) in FOREIGN_KEYS.items():
        # a NULL reference breaks no foreign key (not_null reports it)
        per_id = tables[child].where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
        orphans = per_id.join(parent_ids, per_id[col] == parent_ids["_pid"], "left_anti")
        add(child, "foreign_key", col, orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("violations")))
    return out


def integrity_report(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """One row per (table, check, column) with the number of violations:

    * ``primary_key``: key values occurring more than once
    * ``not_null``: NULLs in a NOT NULL column
    * ``decimal_range``: values outside DECIMAL(10,2), where the source's type can hold them
    * ``varchar_length``: texts longer than declared
    * ``end_before_start``: subscriptions ending before they start (Q15)
    * ``foreign_key``: child rows whose customer_id is not a customer

    ``raw_load_report`` counts the same on text, before any cast.
    """
    tables = t.as_dict()
    return union_all([*[_table_checks(name, df) for name, df in tables.items()], *key_checks(tables)])


# G1 ---------------------------------------------------------------------------
def billing_schedule(t: Tables, p: Params = DEFAULT, horizon=None) -> DataFrame:
    """Due dates up to ``horizon``, by default the last payment's date."""
    if horizon is None:
        horizon = t.payments.agg(F.max("payment_date").alias("h")).scalar()
    return facts.billing_schedule(t.subscriptions, horizon, p.billing_interval_days)


# G2 ---------------------------------------------------------------------------
def active_status(t: Tables, p: Params = DEFAULT) -> DataFrame:
    return facts.with_active_status(t.customers.select("customer_id"), t.subscriptions)


# G3 ---------------------------------------------------------------------------
def month_spine(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """Every month from the first to the last payment month, with the
    month's successful revenue and payers (0 for months without any)."""
    m = M.revenue_by_month(t.payments, p).select("month", "revenue", "paying_customers")
    return S.fill_month_gaps(m, ["revenue", "paying_customers"]).select(
        "month", F.col("revenue").cast("double").alias("revenue"), "paying_customers"
    ).transform(S.ordered, "month")
