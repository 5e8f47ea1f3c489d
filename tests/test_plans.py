"""Physical-plan properties that must hold for every registered query at
any scale: no cartesian product or nested-loop join, no Python in the
plan, no window over unaggregated fact rows, pruned scans."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

KEYS = sorted(k for k in E.queries() if k not in E.LLM_QUERIES)


def plan_text(spark, key):
    df = E.queries()[key](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", KEYS)
def test_no_cross_product_no_python(spark, key):
    plan = plan_text(spark, key)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, f"{key}: {bad}"


def children(node):
    if node.nodeName() == "AdaptiveSparkPlan":
        return [node.executedPlan()]
    return [node.children().apply(i) for i in range(node.children().size())]


def has_agg(node):
    return "Aggregate" in node.nodeName() or any(has_agg(k) for k in children(node))


def windows(node):
    found = [node] if node.nodeName() == "Window" else []
    for k in children(node):
        found += windows(k)
    return found


@pytest.mark.parametrize("key", KEYS)
def test_windows_only_after_aggregation(spark, key):
    """A window needs all rows of its partition in one task: every Window
    in a plan must sit above an aggregation (monthly tables), never directly
    on the rows of a fact table."""
    phys = E.queries()[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan()
    for w in windows(phys):
        assert has_agg(w), f"{key}: window over raw rows"


def test_window_walk_sees_windows(spark):
    phys = E.queries()["anomaly_report"](spark, SF_SMALL)._jdf.queryExecution().executedPlan()
    assert len(windows(phys)) >= 3


def test_monthly_revenue_scan_is_pruned(spark):
    plan = plan_text(spark, "monthly_revenue")
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan) or re.search(r"Scan parquet [^\[]*\[([^\]]*)\]", plan)
    assert schema is not None
    cols = schema.group(1)
    assert "o_orderpriority" not in cols and "o_orderkey" not in cols


@pytest.mark.parametrize("key", [k for k in KEYS if k not in ("integrity_report", "raw_load_report")])
def test_payments_scanned_at_most_once(spark, key):
    """Each analysis reads the payment facts once: a monthly series used
    twice (self-joins, union branches) would otherwise rescan them."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_text(spark, key)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    scans = re.findall(r"FileScan parquet [^\n]*\[([^\]]*)\]", plan)
    assert sum("o_totalprice" in s or "o_orderstatus" in s for s in scans) <= 1, key
