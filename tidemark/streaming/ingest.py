"""Incremental payment ingestion with Structured Streaming.

Payment files landing in a folder (the loader's CSV copy, repeated as new
files arrive) are read as a file stream.  Each micro-batch is
pre-aggregated to (customer_id, month) -- the shared pre-aggregate of
:mod:`tidemark.operators.monthly` -- and written to its own
``batch_id=<n>`` folder of a Parquet table.  A batch that is replayed
after a failure overwrites the same folder, so the table stays
exactly-once, across restarts with the same checkpoint location, and no row is ever dropped for
being late (no watermark): readers re-aggregate across batches.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import monthly as M
from tidemark.operators import series as S
from tidemark.params import DEFAULT, Params
from tidemark.schema import PAYMENTS


def payment_stream(spark: SparkSession, landing_dir: str, fmt: str = "csv", max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(PAYMENTS).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(landing_dir)


def _writer(table_dir: str, p: Params):
    def write(batch: DataFrame, batch_id: int) -> None:
        cm = M.customer_months(batch, p)
        cm.write.mode("overwrite").parquet(os.path.join(table_dir, f"batch_id={batch_id}"))

    return write


def start_ingest(
    spark: SparkSession,
    landing_dir: str,
    table_dir: str,
    checkpoint_location: str,
    fmt: str = "csv",
    available_now: bool = True,
    p: Params = DEFAULT,
) -> StreamingQuery:
    """Start the ingestion stream.  ``available_now`` processes what has
    landed and stops (scheduled runs); otherwise it keeps polling.
    ``checkpoint_location`` belongs to this table and must outlive the
    application: it tells a restarted stream which batches are done."""
    writer = payment_stream(spark, landing_dir, fmt).writeStream.foreachBatch(_writer(table_dir, p))
    writer = writer.option("checkpointLocation", checkpoint_location).queryName("payments_ingest")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def customer_months(spark: SparkSession, table_dir: str) -> DataFrame:
    """(customer_id, month) -> revenue_cents, n_payments over all ingested batches."""
    return (
        spark.read.parquet(table_dir)
        .groupBy("customer_id", "month")
        .agg(F.sum("revenue_cents").alias("revenue_cents"), F.sum("n_payments").alias("n_payments"))
    )


def monthly_revenue(spark: SparkSession, table_dir: str) -> DataFrame:
    """The monthly revenue analysis over the ingested table."""
    m = M.rollup_customer_months(customer_months(spark, table_dir))
    return m.select(
        "month", F.col("revenue").cast("double").alias("monthly_revenue"), "paying_customers", "total_payments"
    ).transform(S.ordered, F.col("month").desc())
