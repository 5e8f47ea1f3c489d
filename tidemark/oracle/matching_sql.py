"""Oracle SQL of the raw-load, matching, multi-level and set analyses."""

from __future__ import annotations

from tidemark.oracle.sql import ADD_MONTHS, MONTH, ORACLE_SQL, D, PCT, _q
from tidemark.schema import DECIMAL_COLUMNS, FOREIGN_KEYS, PRIMARY_KEYS, TABLES, VARCHAR, not_null_columns


# L4 on text: typed columns cannot hold broken lines or wrong types
def _raw_report() -> str:
    parts = []

    def add(t: str, check: str, column: str, count: str) -> None:
        parts.append(f"SELECT '{t}' AS table_name, '{check}' AS check_name, '{column}' AS column_name, CAST(({count}) AS BIGINT) AS violations")

    for t, schema in TABLES.items():
        faults = []
        add(t, "broken_line", "*", "SELECT 0")
        for c in not_null_columns(t):
            faults.append(f"{c} IS NULL")
            add(t, "not_null", c, f"SELECT COUNT(*) FROM {t} WHERE {c} IS NULL")
        for f in schema.fields:
            if f.dataType.typeName() != "string":
                add(t, "bad_type", f.name, "SELECT 0")
            if f.name in DECIMAL_COLUMNS.get(t, ()):
                over = f"{f.name} IS NOT NULL AND TRY_CAST({f.name} AS DECIMAL(10,2)) IS NULL"
                faults.append(f"({over})")
                add(t, "decimal_range", f.name, f"SELECT COUNT(*) FROM {t} WHERE {over}")
        for c, n in VARCHAR[t].items():
            faults.append(f"COALESCE(LENGTH(CAST({c} AS VARCHAR)) > {n}, FALSE)")
            add(t, "varchar_length", c, f"SELECT COUNT(*) FROM {t} WHERE LENGTH(CAST({c} AS VARCHAR)) > {n}")
        add(t, "rejected_rows", "*", f"SELECT COUNT(*) FROM {t} WHERE {' OR '.join(faults)}")
        add(t, "accepted_rows", "*", f"SELECT COUNT(*) FROM {t} WHERE NOT ({' OR '.join(faults)})")
    add("subscriptions", "end_before_start", "end_date", "SELECT COUNT(*) FROM subscriptions WHERE end_date < start_date")
    for t, key in PRIMARY_KEYS.items():
        add(t, "primary_key", key, f"SELECT COUNT(*) FROM (SELECT {key} FROM {t} GROUP BY {key} HAVING COUNT(*) > 1)")
    for child, (col, parent, pcol) in FOREIGN_KEYS.items():
        add(child, "foreign_key", col, f"SELECT COUNT(*) FROM {child} x WHERE x.{col} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} y WHERE y.{pcol} = x.{col})")
    return _q("\nUNION ALL\n".join(parts))


ORACLE_SQL["raw_load_report"] = _raw_report()

# L1/L5: what comes back from the files equals the tables
ORACLE_SQL["csv_round_trip"] = _q(f"""
SELECT 'customers' AS table_name, COUNT(*) AS row_count, 0.0::DOUBLE AS money, MIN(signup_date) AS first_date, MAX(signup_date) AS last_date FROM customers
UNION ALL
SELECT 'subscriptions', COUNT(*), {D('COALESCE(SUM(monthly_price), 0)')}, LEAST(MIN(start_date), MIN(end_date)), GREATEST(MAX(start_date), MAX(end_date)) FROM subscriptions
UNION ALL
SELECT 'payments', COUNT(*), {D('COALESCE(SUM(amount), 0)')}, MIN(payment_date), MAX(payment_date) FROM payments
UNION ALL
SELECT 'costs', COUNT(*), {D('COALESCE(SUM(infra_cost + marketing_cost + support_cost), 0)')}, NULL, NULL FROM costs
""")

# payments with the plan open on their day
_OPEN = f"""
opened AS (
    SELECT y.customer_id, y.amount, {MONTH('y.payment_date')} AS m,
           (SELECT MAX(struct_pack(a := s.start_date, b := s.subscription_id, c := s.plan_type))
            FROM subscriptions s
            WHERE s.customer_id = y.customer_id AND s.start_date <= y.payment_date
              AND COALESCE(s.end_date, y.payment_date) >= y.payment_date).c AS plan_type
    FROM payments y
    WHERE y.payment_status = 'Success' AND y.payment_date IS NOT NULL
)"""

ORACLE_SQL["revenue_by_plan_corrected"] = _q(
    f"""
SELECT plan_type, m AS month, {D('SUM(amount)')} AS plan_revenue, COUNT(DISTINCT customer_id) AS customers, COUNT(*) AS payments
FROM opened
GROUP BY plan_type, m
""",
    _OPEN,
)

ORACLE_SQL["billing_reconciliation"] = _q(
    """
SELECT subscription_id, customer_id, installment, due_date, amount, paid_date,
       CAST(paid_date - due_date AS INTEGER) AS days_to_payment,
       CASE WHEN paid_date IS NULL THEN 'open' WHEN paid_date - due_date < 30 THEN 'on time' ELSE 'late' END AS status
FROM (
    SELECT due.*, (SELECT MIN(y.payment_date) FROM payments y
                   WHERE y.payment_status = 'Success' AND y.customer_id = due.customer_id AND y.payment_date >= due.due_date) AS paid_date
    FROM due
)
""",
    """
due AS (
    SELECT subscription_id, customer_id, CAST(k AS BIGINT) AS installment, start_date + CAST(30 * k AS INTEGER) AS due_date,
           CAST(monthly_price AS DOUBLE) AS amount
    FROM (
        SELECT *, UNNEST(generate_series(0, (stop_date - start_date) // 30)) AS k
        FROM (SELECT *, LEAST(COALESCE(end_date, h), h) AS stop_date FROM subscriptions, (SELECT MAX(payment_date) AS h FROM payments))
        WHERE start_date <= stop_date
    )
)""",
)

_SEGMENTS = "seg AS (SELECT DISTINCT customer_id, segment FROM customers)"

ORACLE_SQL["revenue_rollup"] = _q(
    f"""
SELECT CAST(GROUPING(segment) + GROUPING(plan_type) + GROUPING(m) AS INTEGER) AS level,
       segment, plan_type, m AS month, {D('SUM(amount)')} AS revenue, COUNT(DISTINCT customer_id) AS customers
FROM (SELECT seg.segment, o.plan_type, o.m, o.amount, o.customer_id FROM opened o JOIN seg ON seg.customer_id = o.customer_id)
GROUP BY ROLLUP (segment, plan_type, m)
""",
    _OPEN + ",\n" + _SEGMENTS,
)

_TOTALS = f"""
{_SEGMENTS},
tot AS (
    SELECT seg.segment, seg.customer_id, COALESCE(SUM(p.amount), 0) AS revenue, COUNT(p.m) AS payments
    FROM seg LEFT JOIN (SELECT customer_id, amount, 1 AS m FROM payments WHERE payment_status = 'Success') p ON p.customer_id = seg.customer_id
    GROUP BY 1, 2
)"""

ORACLE_SQL["top_customers_by_segment"] = _q(
    f"""
SELECT segment, CAST(r AS INTEGER) AS rank, customer_id, {D('revenue')} AS revenue, payments
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY segment ORDER BY revenue DESC, customer_id) AS r FROM tot)
WHERE r <= 10
""",
    _TOTALS,
)

ORACLE_SQL["revenue_deciles"] = _q(
    f"""
SELECT segment, CAST(t AS INTEGER) AS decile, COUNT(*) AS customers, {D('SUM(revenue)')} AS revenue,
       {D('MIN(revenue)')} AS least, {D('MAX(revenue)')} AS most
FROM (SELECT *, NTILE(10) OVER (PARTITION BY segment ORDER BY revenue DESC, customer_id) AS t FROM tot)
GROUP BY segment, t
""",
    _TOTALS,
)

_CM = "cm AS (SELECT DISTINCT customer_id, m FROM paid WHERE customer_id IS NOT NULL AND m IS NOT NULL)"
ORACLE_SQL["customer_movements"] = _q(
    f"""
SELECT k.m AS month,
       (SELECT COUNT(*) FROM cm a WHERE a.m = k.m AND EXISTS (SELECT 1 FROM cm b WHERE b.customer_id = a.customer_id AND b.m = {ADD_MONTHS('a.m', '-1')})) AS kept_customers,
       (SELECT COUNT(*) FROM cm a WHERE a.m = k.m AND NOT EXISTS (SELECT 1 FROM cm b WHERE b.customer_id = a.customer_id AND b.m < a.m)) AS new_customers,
       (SELECT COUNT(*) FROM cm a WHERE a.m = k.m AND EXISTS (SELECT 1 FROM cm b WHERE b.customer_id = a.customer_id AND b.m < a.m)
          AND NOT EXISTS (SELECT 1 FROM cm b WHERE b.customer_id = a.customer_id AND b.m = {ADD_MONTHS('a.m', '-1')})) AS returned_customers,
       (SELECT COUNT(*) FROM cm a WHERE a.m = {ADD_MONTHS('k.m', '-1')} AND NOT EXISTS (SELECT 1 FROM cm b WHERE b.customer_id = a.customer_id AND b.m = k.m)) AS lost_customers
FROM (SELECT m FROM cm UNION SELECT {ADD_MONTHS('m', '1')} FROM cm) k
WHERE k.m <= (SELECT MAX(m) FROM cm)
""",
    _CM,
)


def _matrix(months: int = 12) -> str:
    cells = []
    for i in range(months + 1):
        then = ADD_MONTHS("co.m", str(i))
        share = PCT(f"COUNT(DISTINCT met.customer_id) FILTER (WHERE met.m = {then})", "MAX(sz.n)")
        cells.append(f"CASE WHEN {then} <= (SELECT MAX(m) FROM met) THEN {D(share)} END AS month_{i}")
    cells = ",\n       ".join(cells)
    return _q(
        f"""
SELECT co.m AS cohort_month, MAX(sz.n) AS cohort_size,
       {cells}
FROM co JOIN sz ON sz.m IS NOT DISTINCT FROM co.m LEFT JOIN met ON met.customer_id = co.customer_id
GROUP BY co.m
""",
        f"""
co AS (SELECT DISTINCT customer_id, {MONTH('signup_date')} AS m FROM customers),
sz AS (SELECT m, COUNT(customer_id) AS n FROM co GROUP BY m),
met AS (SELECT DISTINCT customer_id, m FROM paid WHERE customer_id IN (SELECT customer_id FROM customers))""",
    )


ORACLE_SQL["retention_matrix"] = _matrix()

ORACLE_SQL["payers_by_period"] = _q(
    """
SELECT period, CAST(date_trunc(period, m) AS DATE) AS period_start, COUNT(DISTINCT customer_id) AS payers, TRUE AS estimate_within_bound
FROM cm, (VALUES ('month'), ('quarter'), ('year')) k(period)
GROUP BY 1, 2
""",
    _CM,
)
