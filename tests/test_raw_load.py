"""Raw loads: bad rows are counted and captured, the load does not abort."""

import os
import tempfile

import pytest

from tidemark.plans import raw_load
from tidemark.sources import load_accepted, load_raw
from tidemark.sources.raw import accepted, rejects

FILES = {
    "customers": """customer_id,signup_date,segment,country,acquisition_channel,is_active
C1,2000-01-05,SMB,US,Organic,true
C2,2000-01-05,SMB,TOOLONG,Organic,true
C3,2000-13-05,SMB,US,Organic,true
C4,2000-01-05,,US,Organic,maybe
C1,2000-01-06,SMB,DE,Partner,false
""",
    "subscriptions": """subscription_id,customer_id,plan_type,start_date,end_date,monthly_price
S1,C1,Basic,2000-01-05,,29.99
S2,C9,Pro,2000-02-05,2000-01-01,59.99
S3,C1,Pro,2000-02-05,2000-03-01
S4,C1,Pro,2000-02-05,soon,100000000.00
""",
    "payments": """payment_id,customer_id,payment_date,amount,payment_status
P1,C1,2000-01-05,29.99,Success
P2,C1,2000-01-05,123456789.00,Success
P3,C1,2000-01-05,1e300,Success
P4,C1,2000-01-05,free,Success
P5,C1,2000-01-05,29.99,Success,extra
P6,"C,1",2000-01-05,0.005,Success
P7,,,,
this line is broken
""",
    "costs": """month,infra_cost,marketing_cost,support_cost
2000-01,1.00,2.00,3.00
2000-01-01,1.00,2.00,3.00
""",
}


@pytest.fixture(scope="module")
def root():
    folder = tempfile.mkdtemp(prefix="tidemark-raw-")
    for name, text in FILES.items():
        with open(os.path.join(folder, f"{name}.csv"), "w") as f:
            f.write(text)
    return folder


def test_report_counts_before_any_cast(spark, root):
    got = {(r.table_name, r.check_name, r.column_name): r.violations for r in raw_load.report(load_raw(spark, root)).collect()}
    want = {
        ("customers", "varchar_length", "country"): 1, ("customers", "bad_type", "signup_date"): 1, ("customers", "bad_type", "is_active"): 1,
        ("customers", "not_null", "segment"): 1, ("customers", "primary_key", "customer_id"): 1,
        ("customers", "accepted_rows", "*"): 2, ("customers", "rejected_rows", "*"): 3,
        ("subscriptions", "broken_line", "*"): 1, ("subscriptions", "decimal_range", "monthly_price"): 1, ("subscriptions", "bad_type", "end_date"): 1,
        ("subscriptions", "end_before_start", "end_date"): 1, ("subscriptions", "foreign_key", "customer_id"): 1,
        ("subscriptions", "accepted_rows", "*"): 2, ("subscriptions", "rejected_rows", "*"): 2,
        ("payments", "broken_line", "*"): 2, ("payments", "decimal_range", "amount"): 2, ("payments", "bad_type", "amount"): 1,
        ("payments", "not_null", "customer_id"): 1, ("payments", "not_null", "payment_date"): 1, ("payments", "not_null", "amount"): 1,
        ("payments", "not_null", "payment_status"): 1, ("payments", "accepted_rows", "*"): 2, ("payments", "rejected_rows", "*"): 6,
        ("costs", "varchar_length", "month"): 1, ("costs", "accepted_rows", "*"): 1, ("costs", "rejected_rows", "*"): 1,
    }
    # "C,1" is a customer of its own; the broken payment line's first field is a payment_id only
    want["payments", "foreign_key", "customer_id"] = 1
    assert {k: v for k, v in got.items() if v} == want


def test_good_rows_load_and_bad_ones_are_kept(spark, root):
    tables, bad = load_accepted(spark, root)
    assert [tuple(map(str, r)) for r in tables.payments.orderBy("payment_id").collect()] == [
        ("P1", "C1", "2000-01-05", "29.99", "Success"), ("P6", "C,1", "2000-01-05", "0.01", "Success"),
    ]
    assert sorted(r.subscription_id for r in tables.subscriptions.collect()) == ["S1", "S2"]
    rows = {(r.table_name, r.check_name, r.column_name, r.value): r.line for r in bad.collect()}
    assert rows["payments", "decimal_range", "amount", "1e300"] == "P3,C1,2000-01-05,1e300,Success"
    assert rows["payments", "broken_line", "*", None] in ("this line is broken", "P5,C1,2000-01-05,29.99,Success,extra")
    assert rows["customers", "varchar_length", "country", "TOOLONG"].startswith("C2,")
    assert rows["subscriptions", "broken_line", "*", None] == "S3,C1,Pro,2000-02-05,2000-03-01"
    # every rejected row is there, also after column pruning
    assert bad.where("table_name = 'payments'").select("line").distinct().count() == 6


def test_one_scan_per_table_and_no_shuffle_of_rows(spark, root):
    plan = rejects(load_raw(spark, root).payments, "payments")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    plan = accepted(load_raw(spark, root).payments, "payments")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
