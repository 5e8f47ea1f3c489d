"""The analyses, by key.

``ANALYSES[key](tables, params)`` returns a lazy DataFrame; keys are the
names used by ``queries()`` / ``oracle_sql()`` in ``__spark_entry__``.
"""

from __future__ import annotations

from tidemark.plans import anomaly, cohorts, data_jobs, forecast, matching, metrics, raw_load, rollups

ANALYSES = {
    # KPIs
    "monthly_revenue": metrics.monthly_revenue,
    "revenue_by_segment": metrics.revenue_by_segment,
    "revenue_by_segment_total": metrics.revenue_by_segment_total,
    "revenue_by_plan": metrics.revenue_by_plan,
    "churn_rate": metrics.churn_rate,
    "churn_by_segment": metrics.churn_by_segment,
    "churn_by_segment_corrected": metrics.churn_by_segment_corrected,
    "retention_rate": metrics.retention_rate,
    "conversion_rate": metrics.conversion_rate,
    "conversion_by_channel": metrics.conversion_by_channel,
    "mom_growth": metrics.mom_growth,
    "customer_mom_growth": metrics.customer_mom_growth,
    "yoy_growth": metrics.yoy_growth,
    "gross_margin": metrics.gross_margin,
    "cost_vs_revenue": metrics.cost_vs_revenue,
    "ltv_by_segment": metrics.ltv_by_segment,
    "ltv_by_segment_corrected": metrics.ltv_by_segment_corrected,
    "executive_summary": metrics.executive_summary,
    # forecasts
    "revenue_moving_averages": forecast.revenue_moving_averages,
    "linear_forecast": forecast.linear_forecast,
    "moving_average_forecast": forecast.moving_average_forecast,
    "seasonal_forecast": forecast.seasonal_forecast,
    "combined_forecast": forecast.combined_forecast,
    "combined_forecast_corrected": forecast.combined_forecast_corrected,
    # anomalies
    "revenue_anomalies": anomaly.revenue_anomalies,
    "churn_spikes": anomaly.churn_spikes,
    "churn_spikes_export": anomaly.churn_spikes_export,
    "segment_churn_spikes": anomaly.segment_churn_spikes,
    "conversion_drops": anomaly.conversion_drops,
    "anomaly_report": anomaly.anomaly_report,
    "revenue_churn_insights": anomaly.revenue_churn_insights,
    # data jobs
    "table_row_counts": data_jobs.table_row_counts,
    "load_checks": data_jobs.load_checks,
    "integrity_report": data_jobs.integrity_report,
    "active_status": data_jobs.active_status,
    "month_spine": data_jobs.month_spine,
    "billing_schedule": data_jobs.billing_schedule,
    # announced analyses
    "conversion_by_country": cohorts.conversion_by_country,
    "retention_cohorts": cohorts.retention_cohorts,
    "retention_month_over_month": cohorts.retention_month_over_month,
    # raw loads and the file round trip
    "raw_load_report": raw_load.raw_load_report,
    "csv_round_trip": raw_load.csv_round_trip,
    # matching by date
    "revenue_by_plan_corrected": matching.revenue_by_plan_corrected,
    "billing_reconciliation": matching.billing_reconciliation,
    # several levels, ranks, sets, sketches
    "revenue_rollup": rollups.revenue_rollup,
    "top_customers_by_segment": rollups.top_customers_by_segment,
    "revenue_deciles": rollups.revenue_deciles,
    "customer_movements": rollups.customer_movements,
    "retention_matrix": rollups.retention_matrix,
    "payers_by_period": rollups.payers_by_period,
}

__all__ = ["ANALYSES", "anomaly", "cohorts", "data_jobs", "forecast", "matching", "metrics", "raw_load", "rollups"]
