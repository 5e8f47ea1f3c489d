"""Every registered query against its DuckDB oracle at sf0.01: same
columns, same row count, identical values (order-insensitive)."""

import pytest

import __spark_entry__ as E
from conftest import SF_ORACLE
from oracle_compare import compare

KEYS = sorted(k for k in E.queries() if k not in E.LLM_QUERIES)


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, oracle_con, key):
    df = E.queries()[key](spark, SF_ORACLE)
    ok, msg = compare(df, oracle_con, E.oracle_sql()[key])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == [
        "month", "revenue", "revenue_anomaly", "churned", "churn_anomaly", "conversion_rate", "conversion_anomaly",
    ]
    assert len(rows) == 13
