"""Incremental ingestion: two landings processed by two runs of the
stream give the same monthly revenue as the batch analysis."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.plans import ANALYSES
from tidemark.schema import PAYMENTS
from tidemark.sources import fixtures
from tidemark.streaming import monthly_revenue, start_ingest


def land(df, path):
    df.toPandas().to_csv(path, index=False)


def test_incremental_ingest_matches_batch(spark):
    root = tempfile.mkdtemp(prefix="tidemark-stream-")
    landing, table, ckpt = (os.path.join(root, d) for d in ("landing", "table", "ckpt"))
    os.makedirs(landing)
    t = fixtures.tables(spark, SF_SMALL)
    pay = t.payments.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in PAYMENTS.fields])

    land(pay.where("payment_date < date'1998-01-01'"), os.path.join(landing, "payments-1.csv"))
    q = start_ingest(spark, landing, table, ckpt)
    q.awaitTermination(120)
    first = {r.month: r.total_payments for r in monthly_revenue(spark, table).collect()}
    assert first and max(first) < __import__("datetime").date(1998, 1, 1)

    land(pay.where("payment_date >= date'1998-01-01'"), os.path.join(landing, "payments-2.csv"))
    q = start_ingest(spark, landing, table, ckpt)
    q.awaitTermination(120)

    got = sorted(tuple(r) for r in monthly_revenue(spark, table).collect())
    want = sorted(tuple(r) for r in ANALYSES["monthly_revenue"](t).collect())
    assert got == want
    assert len([d for d in os.listdir(table) if d.startswith("batch_id=")]) == 2


def test_replayed_batch_is_not_counted_twice(spark):
    """A micro-batch replayed after a failure rewrites its own folder."""
    from tidemark.params import DEFAULT
    from tidemark.streaming.ingest import _writer

    table = os.path.join(tempfile.mkdtemp(prefix="tidemark-replay-"), "table")
    t = fixtures.tables(spark, SF_SMALL)
    pay = t.payments.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in PAYMENTS.fields])
    write = _writer(table, DEFAULT)
    write(pay, 0)
    once = sorted(tuple(r) for r in monthly_revenue(spark, table).collect())
    write(pay, 0)  # replay
    again = sorted(tuple(r) for r in monthly_revenue(spark, table).collect())
    assert once == again
    assert once == sorted(tuple(r) for r in ANALYSES["monthly_revenue"](t).collect())
