"""The dashboard export (L5): the reference's nine exported outputs, as
CSV with header, computed in one job.

The fact tables are scanned once per monthly base table: each base table
(one row per month) is checkpointed into the cluster's shared
``spark.checkpoint.dir``, which cuts its lineage, so the five outputs
built on monthly revenue do not re-read payments, and a lost executor
does not send the exports back to the fact scans.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.model import Tables
from tidemark.operators import monthly as M
from tidemark.operators import series as S
from tidemark.params import DEFAULT, Params
from tidemark.plans import anomaly, forecast, metrics
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources import export_csv

EXPORTS = (
    "monthly_revenue",
    "revenue_by_segment",
    "churn_rate",
    "churn_spike_detection",
    "conversion_rate",
    "mom_growth",
    "gross_margin",
    "revenue_anomalies",
    "revenue_forecast",
)


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared checkpoint folder (never a
    local checkpoint: those die with the executor)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def dashboard_frames(t: Tables, p: Params = DEFAULT) -> dict[str, DataFrame]:
    monthly = materialize(M.revenue_by_month(t.payments, p))
    subs_monthly = materialize(M.starts_and_churn_by_month(t.subscriptions))
    churned = subs_monthly.where(F.col("churned_customers") > 0).select("month", "churned_customers")
    conv = materialize(M.conversions_by_month(t.customers, t.subscriptions))
    mom = metrics.mom_growth_of(monthly)
    return {
        "monthly_revenue": monthly.select(
            "month", F.col("revenue").cast("double").alias("monthly_revenue"), "paying_customers"
        ).transform(S.ordered, F.col("month").desc()),
        "revenue_by_segment": metrics.revenue_by_segment_total(t, p),
        "churn_rate": metrics.churn_rate_of(monthly, subs_monthly),
        "churn_spike_detection": anomaly.churn_spikes_export_of(churned, p),
        "conversion_rate": metrics.conversion_rate_of(conv),
        "mom_growth": mom.select(
            "month",
            F.col("revenue").cast("double").alias("revenue"),
            F.col("_prev").cast("double").alias("previous_month_revenue"),
            "mom_growth_pct",
        ).transform(S.ordered, F.col("month").desc()),
        "gross_margin": metrics.gross_margin_of(t.costs, monthly),
        "revenue_anomalies": anomaly.revenue_anomalies_of(monthly, p).select(
            "month", "revenue", "prev_month_revenue", "mom_change_pct", "anomaly_flag"
        ),
        "revenue_forecast": forecast.combined_forecast_of(monthly, p).select("data_type", "period", "value"),
    }


def export_dashboard(t: Tables, out_dir: str, p: Params = DEFAULT) -> dict[str, str]:
    """Write each output as one CSV file with header under ``out_dir/<name>``.

    All nine are month- or segment-level (bounded, a few hundred rows), so
    each is written from a single partition to give one file per output.
    """
    paths = {}
    for name, df in dashboard_frames(t, p).items():
        path = os.path.join(out_dir, name)
        export_csv(df.coalesce(1), path)
        paths[name] = path
    return paths
