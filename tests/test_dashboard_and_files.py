"""Sources and sinks: typed CSV round trip (L1/L5), partitioned Parquet,
and the dashboard export."""

import glob
import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.plans import ANALYSES
from tidemark.plans.dashboard import EXPORTS, export_dashboard
from tidemark.schema import TABLES
from tidemark.sources import export_csv, fixtures, load_tables, read_parquet, write_parquet


def scratch():
    return tempfile.mkdtemp(prefix="tidemark-test-")


def model_tables(spark):
    """The mapped test tables cast to the declared model schema."""
    t = fixtures.tables(spark, SF_SMALL)
    out = {}
    for name, df in t.as_dict().items():
        out[name] = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLES[name].fields])
    return out


def test_csv_round_trip(spark):
    root = scratch()
    frames = model_tables(spark)
    for name, df in frames.items():
        export_csv(df, os.path.join(root, f"{name}.csv"))
    loaded = load_tables(spark, root)
    for name, df in frames.items():
        back = loaded.as_dict()[name]
        assert back.schema.simpleString() == TABLES[name].simpleString()
        assert sorted(back.collect()) == sorted(df.collect())
    a = ANALYSES["churn_rate"](loaded).collect()
    b = ANALYSES["churn_rate"](fixtures.tables(spark, SF_SMALL)).collect()
    assert sorted(map(tuple, a), key=str) == sorted(map(tuple, b), key=str)


def test_parquet_round_trip_partitioned(spark):
    root = scratch()
    frames = model_tables(spark)
    from tidemark.model import Tables

    write_parquet(Tables(**frames), root)
    assert glob.glob(os.path.join(root, "payments", "payment_month=*"))
    back = read_parquet(spark, root)
    assert back.payments.count() == frames["payments"].count()
    plan = back.payments.where("payment_date >= date'2001-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan


def test_dashboard_export(spark):
    out = scratch()
    t = fixtures.tables(spark, SF_SMALL)
    paths = export_dashboard(t, out)
    assert tuple(paths) == EXPORTS
    for name, path in paths.items():
        files = glob.glob(os.path.join(path, "part-*.csv"))
        assert len(files) == 1, name
    monthly = spark.read.option("header", True).csv(paths["monthly_revenue"])
    assert monthly.columns == ["month", "monthly_revenue", "paying_customers"]
    assert monthly.count() == ANALYSES["monthly_revenue"](t).count()
    fc = spark.read.option("header", True).csv(paths["revenue_forecast"])
    assert fc.columns == ["data_type", "period", "value"] and fc.count() == 19


def test_command_line_runs_on_csv_tables(spark):
    from tidemark.__main__ import main

    root, out = scratch(), scratch()
    for name, df in model_tables(spark).items():
        export_csv(df, os.path.join(root, f"{name}.csv"))
    assert main(["--input", root, "--output", out, "--analyses", "monthly_revenue,churn_rate", "--out-format", "csv"]) == 0
    got = spark.read.option("header", True).csv(os.path.join(out, "churn_rate"))
    assert got.count() == ANALYSES["churn_rate"](fixtures.tables(spark, SF_SMALL)).count()


def test_dashboard_frames_match_queries(spark):
    """The exports reuse checkpointed monthly tables; their rows must equal
    the stand-alone analyses on the shared columns."""
    from tidemark.plans.dashboard import dashboard_frames

    t = fixtures.tables(spark, SF_SMALL)
    frames = dashboard_frames(t)

    def rows(df, cols):
        return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)

    pairs = {
        "churn_rate": ("churn_rate", ["month", "active_customers", "churned_customers", "churn_rate_pct"]),
        "churn_spike_detection": ("churn_spikes_export", ["month", "churned_customers", "avg_prev_6months", "anomaly_flag"]),
        "conversion_rate": ("conversion_rate", ["month", "total_signups", "converted_customers", "conversion_rate_pct"]),
        "gross_margin": ("gross_margin", ["month", "revenue", "total_costs", "gross_profit", "gross_margin_pct"]),
        "revenue_anomalies": ("revenue_anomalies", ["month", "revenue", "prev_month_revenue", "mom_change_pct", "anomaly_flag"]),
        "revenue_by_segment": ("revenue_by_segment_total", ["segment", "total_revenue", "customers"]),
    }
    for export, (key, cols) in pairs.items():
        assert rows(frames[export], cols) == rows(ANALYSES[key](t), cols), export
