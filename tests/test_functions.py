"""Column helpers against the DuckDB fragments used by the oracle, on
awkward values: exact halves, negatives, zero denominators, long month
names."""

import datetime as dt
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import cents, from_cents, month_label, month_start, pct, rounded, text_1dp
from tidemark.oracle.sql import MONTH, PCT, R, TXT1

PAIRS = [(1, 8), (7, 97), (1443, 20000), (-1, 8), (0, 5), (5, 0), (2, 3), (-2, 3), (1, 40), (10**9 + 7, 3), (None, 4)]


def duck(expr, rows, cols):
    con = duckdb.connect()
    con.execute(f"CREATE TABLE t ({', '.join(f'{c} {typ}' for c, typ in cols)})")
    con.executemany(f"INSERT INTO t VALUES ({', '.join('?' * len(cols))})", rows)
    return [r[0] for r in con.execute(f"SELECT {expr} FROM t ORDER BY rowid").fetchall()]


def test_pct_matches_sql(spark):
    df = spark.createDataFrame(PAIRS, "a long, b long")
    got = [r[0] for r in df.select(pct("a", "b").cast("double")).collect()]
    want = duck(f"CAST({PCT('a', 'b')} AS DOUBLE)", PAIRS, [("a", "BIGINT"), ("b", "BIGINT")])
    assert got == want
    assert got[0] == 12.5 and got[2] == 7.22 and got[3] == -12.5 and got[5] is None  # half away from zero


@pytest.mark.parametrize("digits", [0, 1, 2, 4])
def test_rounding_matches_sql(spark, digits):
    vals = [(v,) for v in [0.125, -0.125, 2.5, -2.5, 1.005, 1234567.12345, 59.0, 0.0, None, 7.2149999999999]]
    df = spark.createDataFrame(vals, "x double")
    got = [r[0] for r in df.select(rounded("x", digits).cast("double")).collect()]
    assert got == duck(f"CAST({R('x', digits)} AS DOUBLE)", vals, [("x", "DOUBLE")])


def test_one_decimal_text_matches_sql(spark):
    vals = [(v,) for v in [45.0, 45.05, -3.25, 955.5555, 0.04, None]]
    df = spark.createDataFrame(vals, "x double")
    got = [r[0] for r in df.select(text_1dp("x")).collect()]
    assert got == duck(TXT1("x"), vals, [("x", "DOUBLE")])
    assert got[0] == "45.0" and got[2] == "-3.3"


def test_month_helpers(spark):
    days = [(dt.date(2024, m, d),) for m, d in [(1, 31), (3, 1), (5, 15), (9, 30), (12, 31)]]
    df = spark.createDataFrame(days, "d date")
    got = [(r[0], r[1]) for r in df.select(month_start("d"), month_label("d")).collect()]
    want_m = duck(MONTH("d"), days, [("d", "DATE")])
    want_l = duck("rpad(strftime(d, '%B'), 9, ' ') || ' ' || strftime(d, '%Y')", days, [("d", "DATE")])
    assert [g[0] for g in got] == want_m
    assert [g[1] for g in got] == want_l
    assert got[1][1] == "March     2024" and got[3][1] == "September 2024"


def test_cents_round_trip_is_exact(spark):
    amounts = [Decimal("0.01"), Decimal("29.99"), Decimal("99999999.99"), Decimal("-12.34"), Decimal("0.00")]
    df = spark.createDataFrame([(a,) for a in amounts], T.StructType([T.StructField("a", T.DecimalType(10, 2))]))
    got = df.select(from_cents(cents("a")).alias("b")).collect()
    assert [r.b for r in got] == amounts
    total = df.agg(from_cents(F.sum(cents("a")))).first()[0]
    assert total == sum(amounts)
