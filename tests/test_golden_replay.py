"""Replay the reference's exported outputs: an upstream golden series is
fed into the downstream operator and compared with the downstream golden
row for row (shared columns)."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import COSTS_CSV, GOLDEN_DIR
from tidemark.functions import pct
from tidemark.plans import anomaly, forecast, metrics
from tidemark.sources import read_csv

pytestmark = pytest.mark.skipif(
    not (GOLDEN_DIR and os.path.isdir(GOLDEN_DIR)), reason="set TIDEMARK_GOLDEN_DIR to the exported outputs"
)


def golden(spark, name, fields, parse_month=True):
    schema = T.StructType([T.StructField(n, t, True) for n, t in fields])
    df = spark.read.schema(schema).option("header", True).csv(os.path.join(GOLDEN_DIR, name + ".csv"))
    if parse_month and "month" in df.columns and isinstance(df.schema["month"].dataType, T.StringType):
        df = df.withColumn("month", F.to_date(F.substring("month", 1, 10)))
    return df


@pytest.fixture(scope="module")
def monthly(spark):
    g = golden(spark, "monthly_revenue", [("month", T.StringType()), ("monthly_revenue", T.DecimalType(20, 2)),
                                          ("paying_customers", T.LongType())])
    return g.select("month", F.col("monthly_revenue").alias("revenue"), "paying_customers")


def rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_monthly_total(monthly):
    total = monthly.agg(F.sum("revenue")).first()[0]
    assert str(total) == "11429630.89"


def test_mom_growth(spark, monthly):
    exp = golden(spark, "mom_growth", [("month", T.StringType()), ("revenue", T.DoubleType()),
                                       ("previous_month_revenue", T.DoubleType()), ("mom_growth_pct", T.DoubleType())])
    got = metrics.mom_growth_of(monthly).select(
        "month", F.col("revenue").cast("double").alias("revenue"),
        F.col("_prev").cast("double").alias("previous_month_revenue"), "mom_growth_pct")
    cols = ["month", "revenue", "previous_month_revenue", "mom_growth_pct"]
    assert rows(got, cols) == rows(exp, cols)


def test_revenue_anomalies(spark, monthly):
    exp = golden(spark, "revenue_anomalies", [("month", T.StringType()), ("revenue", T.DoubleType()),
                                              ("prev_month_revenue", T.DoubleType()), ("mom_change_pct", T.DoubleType()),
                                              ("anomaly_flag", T.StringType())])
    got = anomaly.revenue_anomalies_of(monthly)
    cols = ["month", "revenue", "prev_month_revenue", "mom_change_pct", "anomaly_flag"]
    assert len(rows(got, cols)) == 35
    assert rows(got, cols) == rows(exp, cols)


def test_statistical_outliers(monthly):
    got = anomaly.revenue_anomalies_of(monthly).groupBy("statistical_anomaly").count()
    counts = {r[0]: r[1] for r in got.collect()}
    assert counts == {"Statistical Outlier (2+ std devs above mean)": 15, None: 20}


def test_combined_forecast_literal(spark, monthly):
    exp = golden(spark, "revenue_forecast", [("data_type", T.StringType()), ("period", T.StringType()),
                                             ("value", T.DoubleType())])
    exp = exp.withColumn("period", F.to_date(F.substring("period", 1, 10)))
    got = forecast.combined_forecast_of(monthly)
    cols = ["data_type", "period", "value"]
    assert rows(got, cols) == rows(exp, cols)


def test_combined_forecast_corrected(monthly):
    got = forecast.combined_forecast_of(monthly, corrected=True).where("data_type = 'Forecast'").orderBy("period")
    assert [r.value for r in got.collect()] == [609977.75, 627050.485, 644123.22, 661195.955, 678268.69, 695341.425]


@pytest.mark.skipif(not (COSTS_CSV and os.path.exists(COSTS_CSV)), reason="set TIDEMARK_COSTS_CSV")
def test_gross_margin(spark, monthly):
    costs = read_csv(spark, COSTS_CSV, "costs")
    exp = golden(spark, "gross_margin", [("month", T.StringType()), ("revenue", T.DoubleType()),
                                         ("total_costs", T.DoubleType()), ("gross_profit", T.DoubleType()),
                                         ("gross_margin_pct", T.DoubleType())], parse_month=False)
    got = metrics.gross_margin_of(costs, monthly)
    cols = ["month", "revenue", "total_costs", "gross_profit", "gross_margin_pct"]
    assert rows(got, cols) == rows(exp, cols)


def test_churn_spike_export(spark):
    churn = golden(spark, "churn_rate", [("month", T.StringType()), ("active_customers", T.LongType()),
                                         ("churned_customers", T.LongType()), ("churn_rate_pct", T.DoubleType())])
    churn = churn.where("churned_customers > 0").select("month", "churned_customers")
    exp = golden(spark, "churn_spike_detection", [("month", T.StringType()), ("churned_customers", T.LongType()),
                                                  ("avg_prev_6months", T.DoubleType()), ("anomaly_flag", T.StringType())])
    got = anomaly.churn_spikes_export_of(churn)
    cols = ["month", "churned_customers", "avg_prev_6months", "anomaly_flag"]
    assert rows(got, cols) == rows(exp, cols)


def test_churn_rate_formula(spark):
    g = golden(spark, "churn_rate", [("month", T.StringType()), ("active_customers", T.LongType()),
                                     ("churned_customers", T.LongType()), ("churn_rate_pct", T.DoubleType())])
    a, c = F.col("active_customers"), F.col("churned_customers")
    got = g.select(F.when(a > 0, pct(c, a + c)).otherwise(F.lit(0)).cast("double").alias("x"), "churn_rate_pct")
    assert all(r.x == r.churn_rate_pct for r in got.collect())


def _conversions(spark):
    return golden(spark, "conversion_rate", [("month", T.StringType()), ("total_signups", T.LongType()),
                                             ("converted_customers", T.LongType()),
                                             ("conversion_rate_pct", T.DoubleType())])


def test_conversion_formula(spark):
    g = _conversions(spark)
    got = g.select(pct("converted_customers", "total_signups").cast("double").alias("x"), "conversion_rate_pct")
    assert all(r.x == r.conversion_rate_pct for r in got.collect())


def test_conversion_drops(spark):
    got = anomaly.conversion_drops_of(_conversions(spark))
    flags = {r.month.isoformat()[:7]: r.anomaly_flag for r in got.collect()}
    significant = sorted(m for m, f in flags.items() if f == "CONVERSION DROP: Significant decrease detected")
    assert significant == ["2022-05", "2023-04", "2023-05", "2024-02"]
    assert all(f in ("Normal", "CONVERSION DROP: Significant decrease detected") for f in flags.values())


def test_linear_forecast(monthly):
    r = forecast.linear_forecast_of(monthly).first()
    assert (r.forecast_month_1, r.forecast_month_2, r.forecast_month_3) == (621927.7233, 640228.5267, 658529.33)
    assert r.historical_month.isoformat() == "2024-12-01"


def test_moving_average_forecast(monthly):
    got = forecast.moving_average_forecast_of(monthly).collect()
    assert [r.period_type for r in got] == ["Historical"] + ["Forecast"] * 6
    assert [r.value for r in got[1:]] == [603883.37, 625583.63, 647283.89, 668984.15, 690684.41, 712384.67]


def test_seasonal_forecast(monthly):
    got = forecast.seasonal_forecast_of(monthly).collect()
    assert [r.forecast_month.isoformat() for r in got] == [f"2025-0{i}-01" for i in range(1, 7)]
    assert [round(r.forecasted_revenue, 2) for r in got] == [721310.62, 778049.58, 821204.65, 850059.84, 870784.72,
                                                             895222.51]
    assert [r.yoy_growth_rate for r in got] == [747.705, 358.5979, 242.5557, 179.2818, 140.958, 119.9504]


def test_yoy_growth(monthly):
    got = metrics.yoy_growth_of(monthly).where("month = date'2024-12-01'").first()
    assert got.yoy_growth_pct == 45.99


def test_segment_total_golden_sum(spark):
    g = golden(spark, "revenue_by_segment", [("segment", T.StringType()), ("total_revenue", T.DecimalType(20, 2)),
                                             ("customers", T.LongType())])
    assert str(g.agg(F.sum("total_revenue")).first()[0]) == "11429630.89"
