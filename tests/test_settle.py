"""Stateful ingestion: late, duplicated and replayed payments give the batch
result, before, during and after compaction."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.model import Tables
from tidemark.plans import ANALYSES
from tidemark.schema import PAYMENTS
from tidemark.sources import fixtures
from tidemark.streaming import compact, settle, settled_payments, start_settling


@pytest.fixture
def dirs():
    root = tempfile.mkdtemp(prefix="tidemark-settle-")
    out = [os.path.join(root, d) for d in ("landing", "table", "ckpt")]
    os.makedirs(out[0])
    return out


def payments_of(spark):
    t = fixtures.tables(spark, SF_SMALL)
    return t, t.payments.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in PAYMENTS.fields])


def land(df, landing, name):
    df.toPandas().to_csv(os.path.join(landing, name), index=False)


def run(spark, dirs, **kw):
    start_settling(spark, *dirs, **kw).awaitTermination(120)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def batches(table):
    return sorted(d for d in os.listdir(os.path.join(table, "arrivals")) if d.startswith("batch_id="))


def arrived(spark, table):
    return spark.read.parquet(os.path.join(table, "arrivals")).count()


def test_late_and_repeated_payments_give_the_batch_result(spark, dirs):
    landing, table, _ = dirs
    t, pay = payments_of(spark)
    late = pay.where("payment_date < date'1994-01-01'")
    rest = pay.where("payment_date >= date'1994-01-01'")
    land(rest, landing, "a.csv")
    run(spark, dirs)
    n = arrived(spark, table)
    land(rest.where("payment_date >= date'1997-01-01'"), landing, "b.csv")  # sent again
    run(spark, dirs)
    assert arrived(spark, table) == n == rest.count()  # state has dropped them
    land(late.unionByName(late), landing, "c.csv")  # years late, twice
    run(spark, dirs)
    got = settled_payments(spark, table)
    assert rows(got) == rows(pay)
    again = Tables(**{**t.as_dict(), "payments": got})
    for key in ("monthly_revenue", "churn_rate"):
        assert rows(ANALYSES[key](again)) == rows(ANALYSES[key](t))


def test_repeats_beyond_the_state_are_found_by_compaction(spark, dirs):
    landing, table, _ = dirs
    _, pay = payments_of(spark)
    some = pay.where("payment_date between date'1996-01-15' and date'1996-03-20'")
    write = settle._writer(table)
    settle.create(spark, table)
    write(pay, 0)
    write(some, 1)  # as if the state had forgotten them
    write(some.limit(0), 2)
    assert rows(settled_payments(spark, table)) == rows(pay)
    assert compact(spark, table) == [0]  # batch 1 is the newest with rows
    assert rows(settled_payments(spark, table)) == rows(pay)
    write(some, 3)
    write(some, 4)
    assert rows(settled_payments(spark, table)) == rows(pay)
    assert compact(spark, table, stopped=True) == [1, 3, 4] and not {"batch_id=1", "batch_id=3", "batch_id=4"} & set(batches(table))
    assert rows(settled_payments(spark, table)) == rows(pay)
    write(some, 4)  # a replay of a batch that is compacted
    assert rows(settled_payments(spark, table)) == rows(pay)
    assert compact(spark, table, stopped=True) == [] and "batch_id=4" not in batches(table)


def test_compaction_that_dies_is_run_again(spark, dirs, monkeypatch):
    _, table, _ = dirs
    _, pay = payments_of(spark)
    none = pay.limit(2).withColumn("payment_id", F.lit(None).cast("string"))  # no key: all stay
    undated = pay.limit(1).withColumn("payment_date", F.lit(None).cast("date"))
    old, new = pay.where("payment_date < date'1995-01-01'"), pay.where("payment_date >= date'1994-06-01'")
    want = rows(pay.unionByName(none).unionByName(undated))
    write = settle._writer(table)
    settle.create(spark, table)
    write(old.unionByName(none), 0)
    assert compact(spark, table, stopped=True) == [0]
    write(new.unionByName(undated), 1)

    def dies(*_):
        raise RuntimeError("lost")

    # after the months were replaced, before the batch is entered
    real = settle.refresh_months
    monkeypatch.setattr(settle, "refresh_months", lambda *a: (real(*a), dies()))
    with pytest.raises(RuntimeError, match="lost"):
        compact(spark, table, stopped=True)
    assert rows(settled_payments(spark, table)) == want
    monkeypatch.setattr(settle, "refresh_months", real)
    # before its folder is removed
    remove = settle._remove_compacted
    monkeypatch.setattr(settle, "_remove_compacted", dies)
    with pytest.raises(RuntimeError, match="lost"):
        compact(spark, table, stopped=True)
    assert rows(settled_payments(spark, table)) == want
    monkeypatch.setattr(settle, "_remove_compacted", remove)
    assert compact(spark, table, stopped=True) == [] and batches(table) == []
    assert rows(settled_payments(spark, table)) == want


def test_only_touched_months_are_rewritten(spark, dirs):
    _, table, _ = dirs
    _, pay = payments_of(spark)
    write = settle._writer(table)
    settle.create(spark, table)
    write(pay, 0)
    compact(spark, table, stopped=True)
    base = os.path.join(table, "payments")
    files = lambda: {d: sorted(os.listdir(os.path.join(base, d))) for d in os.listdir(base) if "=" in d}
    before = files()
    assert all(len([f for f in fs if f.endswith(".parquet")]) == 1 for fs in before.values())
    one = pay.where("payment_date between date'1996-02-01' and date'1996-02-28'").limit(3)
    write(one.withColumn("payment_id", F.concat("payment_id", F.lit("-x"))), 1)
    compact(spark, table, stopped=True)
    after = files()
    assert [d for d in before if before[d] != after[d]] == ["payment_month=1996-02-01"]
    assert settled_payments(spark, table).count() == pay.count() + one.count()


def test_no_files_give_no_rows(spark, dirs):
    run(spark, dirs)
    assert settled_payments(spark, dirs[1]).count() == 0 and compact(spark, dirs[1]) == []
