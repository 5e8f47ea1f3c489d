"""The stored tables: few files a month, single months replaced, other
months' folders never read."""

import datetime as dt
import glob
import os
import re
import tempfile

from pyspark.sql import functions as F

from test_dashboard_and_files import model_tables
from tidemark.model import Tables
from tidemark.plans import ANALYSES
from tidemark.sources import latest_month, read_parquet, refresh_months, write_parquet


def files(root, table):
    out = {}
    for f in glob.glob(os.path.join(root, table, "*=*", "*.parquet")):
        out.setdefault(os.path.basename(os.path.dirname(f)), []).append((f, os.path.getmtime(f)))
    return out


def stored(spark):
    root = tempfile.mkdtemp(prefix="tidemark-layout-")
    frames = model_tables(spark)
    # many small input tasks, and a third of all rows in one month
    pay = frames["payments"].repartition(40)
    pay = pay.unionByName(pay.where(F.hash("payment_id") % 2 == 0).withColumn("payment_date", F.lit(dt.date(1997, 5, 9))))
    tables = Tables(**{**frames, "payments": pay})
    write_parquet(tables, root)
    return root, tables


def test_few_files_a_month(spark):
    root, tables = stored(spark)
    months = files(root, "payments")
    assert len(months) == tables.payments.select(F.trunc("payment_date", "month")).distinct().count()
    assert max(len(f) for f in months.values()) == 1
    assert read_parquet(spark, root).payments.count() == tables.payments.count()


def test_large_month_is_split(spark):
    """A month beyond the advisory size goes to several tasks, not to one."""
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8k")
    try:
        root, _ = stored(spark)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    counts = {m: len(f) for m, f in files(root, "payments").items()}
    assert counts["payment_month=1997-05-01"] > 1
    assert sorted(counts.values())[len(counts) // 2] <= 2


def test_one_month_is_replaced_alone(spark):
    root, tables = stored(spark)
    before = files(root, "payments")
    month = tables.payments.where("payment_date between date'1996-03-01' and date'1996-03-31'")
    refresh_months(month.withColumn("amount", F.lit("1.00").cast("decimal(10,2)")), root, "payments")
    after = files(root, "payments")
    changed = {m for m in before if before[m] != after[m]}
    assert set(before) == set(after) and changed == {"payment_month=1996-03-01"}
    back = read_parquet(spark, root).payments
    assert back.count() == tables.payments.count()
    assert back.where("payment_date between date'1996-03-01' and date'1996-03-31'").agg(F.sum("amount")).first()[0] == month.count()


def test_months_read_are_the_months_asked_for(spark):
    root, _ = stored(spark)
    whole = {r.month: tuple(r) for r in ANALYSES["monthly_revenue"](read_parquet(spark, root)).collect()}
    some = ANALYSES["monthly_revenue"](read_parquet(spark, root, dt.date(1996, 2, 10), dt.date(1996, 4, 1)))
    assert [tuple(r) for r in some.collect()] == [whole[dt.date(1996, m, 1)] for m in (4, 3, 2)]
    node = some._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*payment_month[^\]]*>= 1996-02-01", node)
    # the summary of the latest month needs that month's payments only
    assert latest_month(spark, root) >= max(whole)
    last = latest_month(spark, root, where=F.col("payment_status") == "Success")
    assert last == max(whole)
    a = ANALYSES["executive_summary"](read_parquet(spark, root, first=last)).collect()
    assert a == ANALYSES["executive_summary"](read_parquet(spark, root)).collect()
