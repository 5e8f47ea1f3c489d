"""Stateful payment ingestion: each payment once, however often and late it comes.

A payment is known by its id and date.  Rows that a source delivers again
(a re-sent file, overlapping extracts) are dropped in two places:

* in the stream, by state: keys seen within ``horizon`` of arrival are kept
  by :meth:`dropDuplicatesWithinWatermark`.  The watermark runs on the time of
  arrival, not on the payment's date, so state is bounded by what arrives
  within the horizon and no payment is ever dropped for being late;
* at compaction and at reading, exactly: a row that comes again after the
  horizon meets the stored one by its key, in its own month.

Layout below ``table_dir``::

    arrivals/batch_id=<n>/          rows of one micro-batch; a replay overwrites it
    payments/payment_month=<m>/     compacted rows, each with its batch_id
    compacted/                      batch ids whose rows are in payments

:func:`compact` moves the rows of finished batches to their months, rewrites
only the months that they touch and then removes their folders.  It may die at any
point and be run again: until a batch is entered in ``compacted``, readers
take its rows from ``arrivals`` and pass over those in ``payments``.  One
compaction runs at a time; the stream need not stop for it.  A reader whose files
were replaced meanwhile fails and reads again.

Defined results: of rows with one key that of the earliest batch stays (within
a batch, any one of them); rows without an id or a date have no key and all
stay.  No files give no rows.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import month_start
from tidemark.schema import PAYMENTS
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources.files import refresh_months
from tidemark.streaming.ingest import payment_stream

KEY = ["payment_id", "payment_date"]
NO_KEY = "payment_id is null or payment_date is null"
HAS_KEY = f"not ({NO_KEY})"
BATCH = T.StructField("batch_id", T.LongType())
ROWS = T.StructType([*PAYMENTS.fields, BATCH])
MONTHS = T.StructType([*ROWS.fields, T.StructField("payment_month", T.DateType())])
LAYOUT = {"arrivals": (ROWS, "batch_id"), "payments": (MONTHS, "payment_month"), "compacted": (T.StructType([BATCH]), None)}


def create(spark: SparkSession, table_dir: str) -> None:
    """The table's empty folders, where they do not exist yet."""
    for name, (schema, part) in LAYOUT.items():
        writer = spark.createDataFrame([], schema).write.mode("ignore")
        (writer.partitionBy(part) if part else writer).parquet(os.path.join(table_dir, name))


def _read(spark: SparkSession, table_dir: str, name: str) -> DataFrame:
    return spark.read.schema(LAYOUT[name][0]).parquet(os.path.join(table_dir, name))


def once_within(payments: DataFrame, horizon: str) -> DataFrame:
    """A stream of payments without the keys that came before within ``horizon``."""
    rows = payments.withColumn("arrived", F.current_timestamp()).withWatermark("arrived", horizon)
    keyed = rows.where(HAS_KEY).dropDuplicatesWithinWatermark(KEY)
    return keyed.unionByName(rows.where(NO_KEY)).drop("arrived")


def _writer(table_dir: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(table_dir, "arrivals", f"batch_id={batch_id}"))

    return write


def start_settling(
    spark: SparkSession,
    landing_dir: str,
    table_dir: str,
    checkpoint_location: str,
    horizon: str = "7 days",
    fmt: str = "csv",
    available_now: bool = True,
) -> StreamingQuery:
    """Start the stream.  ``horizon`` bounds its state, not its results: a
    payment that comes again later is found by the exact way."""
    create(spark, table_dir)
    stream = once_within(payment_stream(spark, landing_dir, fmt), horizon).writeStream.foreachBatch(_writer(table_dir))
    stream = stream.option("checkpointLocation", checkpoint_location).queryName("payments_settle")
    stream = stream.trigger(availableNow=True) if available_now else stream.trigger(processingTime="1 minute")
    return stream.start()


def _batches(rows: DataFrame) -> set[int]:
    return {r.batch_id for r in rows.select("batch_id").distinct().collect()}


def _pending(spark: SparkSession, table_dir: str) -> set[int]:
    """Batches with rows in ``arrivals`` that are not entered in ``compacted``."""
    return _batches(_read(spark, table_dir, "arrivals")) - _batches(_read(spark, table_dir, "compacted"))


def _firsts(rows: DataFrame) -> DataFrame:
    """The earliest row of each key; a map-side minimum before the shuffle."""
    rest = [c for c in rows.columns if c not in KEY and c != "batch_id"]
    keyed = rows.where(HAS_KEY).groupBy(*KEY).agg(F.min(F.struct("batch_id", *rest)).alias("row"))
    return keyed.select(*KEY, "row.*").select(rows.columns).unionByName(rows.where(NO_KEY))


def _parts(spark: SparkSession, table_dir: str, pending: set[int]) -> tuple[DataFrame, DataFrame]:
    """(stored rows but those of ``pending``, rows of ``pending`` that are not stored)."""
    some = sorted(pending)
    stored = _read(spark, table_dir, "payments").where(~F.col("batch_id").isin(some))
    new = _firsts(_read(spark, table_dir, "arrivals").where(F.col("batch_id").isin(some)))
    new = new.withColumn("payment_month", month_start("payment_date"))
    # the few new keys select the stored ones, months first; the table itself is not shuffled
    on = ["payment_month", *KEY]
    known = stored.select(on).join(new.where(HAS_KEY).select(on), on, "left_semi")
    return stored, new.join(known, on, "left_anti").select(MONTHS.fieldNames())


def settled_payments(spark: SparkSession, table_dir: str) -> DataFrame:
    """Every payment that has arrived, once: the payments table of any analysis."""
    stored, new = _parts(spark, table_dir, _pending(spark, table_dir))
    return stored.unionByName(new).select(PAYMENTS.fieldNames())


def compact(spark: SparkSession, table_dir: str, stopped: bool = False) -> list[int]:
    """Move finished batches to their months; the batch ids that were moved.

    The newest batch may still be being written and waits for the next call,
    unless the stream is known to have ``stopped``."""
    pending = _pending(spark, table_dir)
    if not stopped:
        pending -= {max(pending, default=-1)}
    if pending:
        ensure_checkpoint_dir(spark)
        stored, new = _parts(spark, table_dir, pending)
        new = new.checkpoint()
        months = [r.payment_month for r in new.select("payment_month").distinct().collect()]
        touched = F.col("payment_month").isin([m for m in months if m is not None])
        if None in months:
            touched = touched | F.col("payment_month").isNull()
        # read before it is replaced, so it is written out first
        rows = stored.where(touched).unionByName(new).checkpoint()
        refresh_months(rows, table_dir, "payments")
        spark.createDataFrame([(b,) for b in sorted(pending)], LAYOUT["compacted"][0]).coalesce(1).write.mode("append").parquet(
            os.path.join(table_dir, "compacted")
        )
    _remove_compacted(spark, table_dir)
    return sorted(pending)


def _remove_compacted(spark: SparkSession, table_dir: str) -> None:
    """Remove the folders of compacted batches, also those that an earlier
    call left behind."""
    done = _batches(_read(spark, table_dir, "arrivals")) & _batches(_read(spark, table_dir, "compacted"))
    sc = spark.sparkContext
    for b in sorted(done):
        path = sc._jvm.org.apache.hadoop.fs.Path(os.path.join(table_dir, "arrivals", f"batch_id={b}"))
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
