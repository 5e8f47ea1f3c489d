"""L1 and L4 on raw loads, and the L1/L5 round trip.

* ``raw_load_report``: the declared constraints counted on text, before any
  cast, so that values no typed column can hold are counted, not fatal.
* ``csv_round_trip``: the four tables written as CSV, loaded again with bad
  rows captured, and summed up.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import cents, from_cents
from tidemark.model import Tables
from tidemark.params import DEFAULT, Params
from tidemark.plans.data_jobs import key_checks, union_all
from tidemark.schema import TABLES
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources.files import export_csv
from tidemark.sources.raw import FAULTS, accepted, as_text, checked, load_raw, row_checks


def raw_tables(t: Tables) -> Tables:
    """The tables as text; sources that know an earlier form of a value give that one."""
    raw = t.raw() if hasattr(t, "raw") else t
    return Tables(**{name: as_text(df, name) for name, df in raw.as_dict().items()})


def report(raw: Tables) -> DataFrame:
    """(table_name, check_name, column_name, violations) of four raw tables:
    every row check in one conditional aggregate per table, the number of
    accepted and rejected rows in the same scan, and the key checks."""
    tables = raw.as_dict()
    out = []
    for name, df in tables.items():
        checks = row_checks(name)
        totals = [F.count(F.when(cond, F.lit(1))).alias("|".join(key)) for key, cond in checks.items()]
        if name == "subscriptions":
            end, start = F.col("end_date").try_cast("date"), F.col("start_date").try_cast("date")
            totals.append(F.count(F.when(end < start, F.lit(1))).alias("end_before_start|end_date"))
        good = F.size(FAULTS) == 0
        totals += [F.count(F.when(good, F.lit(1))).alias("accepted_rows|*"), F.count(F.when(~good, F.lit(1))).alias("rejected_rows|*")]
        row = checked(df, name).agg(*totals)
        parts = F.split("_check", r"\|")
        out.append(
            row.unpivot([], [f"`{c}`" for c in row.columns], "_check", "violations").select(
                F.lit(name).alias("table_name"), parts.getItem(0).alias("check_name"), parts.getItem(1).alias("column_name"), "violations"
            )
        )
    return union_all([*out, *key_checks(tables)])


def raw_load_report(t: Tables, p: Params = DEFAULT) -> DataFrame:
    return report(raw_tables(t))


def summary(t: Tables) -> DataFrame:
    """(table_name, row_count, money, first_date, last_date): what a load must not change."""
    money = {"subscriptions": ["monthly_price"], "payments": ["amount"], "costs": ["infra_cost", "marketing_cost", "support_cost"]}
    dates = {"customers": ["signup_date"], "subscriptions": ["start_date", "end_date"], "payments": ["payment_date"]}
    rows = []
    for name, df in t.as_dict().items():
        total = sum((F.coalesce(F.sum(cents(c)), F.lit(0)) for c in money.get(name, ())), F.lit(0).cast("long"))
        first = F.least(*[F.min(c) for c in dates[name]], F.lit(None).cast("date")) if name in dates else F.lit(None).cast("date")
        last = F.greatest(*[F.max(c) for c in dates[name]], F.lit(None).cast("date")) if name in dates else F.lit(None).cast("date")
        rows.append(
            df.agg(F.count(F.lit(1)).alias("row_count"), from_cents(total).cast("double").alias("money"), first.alias("first_date"), last.alias("last_date"))
            .select(F.lit(name).alias("table_name"), "row_count", "money", "first_date", "last_date")
        )
    return union_all(rows)


def csv_round_trip(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """Written as CSV below the shared checkpoint folder and loaded again.
    Lengths are not checked here: the fixture's names are longer than declared."""
    spark = t.payments.sparkSession
    root = f"{ensure_checkpoint_dir(spark)}/csv-{uuid.uuid4().hex}"
    for name, df in t.as_dict().items():
        declared = df.select(*[F.col(f.name).cast("string" if name == "costs" else f.dataType).alias(f.name) for f in TABLES[name].fields])
        export_csv(declared, f"{root}/{name}.csv")
    raw = load_raw(spark, root).as_dict()
    typed = {}
    for name, df in raw.items():
        ok = checked(df, name).where(~F.exists(FAULTS, lambda f: f["check_name"] == "broken_line"))
        typed[name] = ok.select(*[F.col(f.name).cast("decimal(18,2)" if name == "costs" and f.name != "month" else f.dataType).alias(f.name) for f in TABLES[name].fields])
    return summary(Tables(**typed))


__all__ = ["accepted", "csv_round_trip", "raw_load_report", "raw_tables", "report", "summary"]
