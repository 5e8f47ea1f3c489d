"""File sources and sinks for the model tables.

* :func:`load_tables` (L1): typed CSV loads with header, an empty field
  is NULL, malformed rows fail the job (``FAILFAST``) as a database
  ``COPY`` would.  Splits are read in parallel by the executors.
* :func:`export_csv` (L5): CSV sink with header.
* :func:`write_parquet` / :func:`read_parquet`: the native form; payments
  and subscriptions are partitioned by month, a few files each, so month
  filters prune folders; :func:`refresh_months` replaces single months.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import month_start
from tidemark.model import Tables
from tidemark.schema import TABLES

# partition column added on write (dropped again on read)
PARTITION_BY = {
    "payments": ("payment_month", "payment_date"),
    "subscriptions": ("start_month", "start_date"),
}


def read_csv(spark: SparkSession, path: str, table: str, mode: str = "FAILFAST") -> DataFrame:
    return (
        spark.read.schema(TABLES[table])
        .option("header", True)
        .option("mode", mode)
        .option("dateFormat", "yyyy-MM-dd")
        .option("emptyValue", None)
        .option("nullValue", "")
        .csv(path)
    )


def load_tables(spark: SparkSession, paths, mode: str = "FAILFAST") -> Tables:
    """Load the four CSVs.  ``paths`` is a directory holding
    ``<table>.csv`` or a dict table -> path."""
    if isinstance(paths, str):
        paths = {t: os.path.join(paths, f"{t}.csv") for t in TABLES}
    return Tables(**{t: read_csv(spark, paths[t], t, mode) for t in TABLES})


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header and no index column (one directory of part files)."""
    df.write.mode(mode).option("header", True).csv(path)


def by_month(df: DataFrame, table: str) -> DataFrame:
    """``df`` with its month column, dealt out by month before it is
    written: a month's rows meet in few tasks, so a month has few files, and
    a month larger than the advisory partition size is split over several
    tasks by the adaptive execution instead of filling one."""
    part, src = PARTITION_BY[table]
    return df.withColumn(part, month_start(src)).hint("rebalance", part)


def write_table(df: DataFrame, root: str, table: str, mode: str = "overwrite") -> None:
    path = os.path.join(root, table)
    if table in PARTITION_BY:
        by_month(df, table).write.mode(mode).partitionBy(PARTITION_BY[table][0]).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


def write_parquet(tables: Tables, root: str, mode: str = "overwrite") -> None:
    for name, df in tables.as_dict().items():
        write_table(df, root, name, mode)


def refresh_months(df: DataFrame, root: str, table: str) -> None:
    """Replace the months that ``df`` has rows of, and no other one: a
    dynamic partition overwrite.  ``df`` must not read the table it replaces."""
    writer = by_month(df, table).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(PARTITION_BY[table][0]).parquet(os.path.join(root, table))


def latest_month(spark: SparkSession, root: str, table: str = "payments", where=None):
    """The last stored month (a date) that has a row, or None: read from the
    partition values and, with a condition, the columns that it names."""
    part = PARTITION_BY[table][0]
    rows = spark.read.parquet(os.path.join(root, table))
    return (rows if where is None else rows.where(where)).agg(F.max(part)).first()[0]


def read_parquet(spark: SparkSession, root: str, first=None, last=None) -> Tables:
    """The stored tables; payments of the months ``first`` to ``last`` only,
    if given (dates): other months' folders are not read.  Subscriptions are
    read whole, since one that started earlier may end or be open later."""
    out = {}
    for name in TABLES:
        df = spark.read.parquet(os.path.join(root, name))
        if name == "payments":
            part = F.col(PARTITION_BY[name][0])
            if first is not None:
                df = df.where(part >= F.trunc(F.lit(first).cast("date"), "month"))
            if last is not None:
                df = df.where(part <= F.trunc(F.lit(last).cast("date"), "month"))
        out[name] = df.select(*[F.col(f.name) for f in TABLES[name].fields])
    return Tables(**out)
