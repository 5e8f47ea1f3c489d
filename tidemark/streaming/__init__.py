"""Structured Streaming: incremental ingestion of payment files into the
(customer, month) table the monthly analyses read (:mod:`.ingest`), and into
a payments table that holds each payment once (:mod:`.settle`)."""

from tidemark.streaming.ingest import customer_months, monthly_revenue, payment_stream, start_ingest
from tidemark.streaming.settle import compact, settled_payments, start_settling

__all__ = [
    "compact", "customer_months", "monthly_revenue", "payment_stream", "settled_payments", "start_ingest", "start_settling",
]
