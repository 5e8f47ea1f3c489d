"""Multi-level, ranked and set analyses of customers and their payments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import as_money, from_cents, month_start, pct
from tidemark.model import Tables
from tidemark.operators import monthly as M
from tidemark.operators import series as S
from tidemark.params import DEFAULT, Params
from tidemark.plans.dashboard import materialize
from tidemark.plans.matching import plan_days

TOP = 10
TILES = 10
COHORT_MONTHS = 12
SKETCH_LG = 14  # registers of a distinct sketch, as a power of two
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_LG / 2)  # three standard errors


def segments(t: Tables) -> DataFrame:
    return t.customers.select("customer_id", "segment").distinct()


def revenue_rollup(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """Revenue and exact distinct payers by segment, plan open on the day and
    month, with all subtotals; ``level`` counts the columns rolled up (0: none,
    3: the grand total).

    Facts are first reduced to (customer, segment, plan, month): only those
    rows are expanded to the four levels."""
    cm = plan_days(t, p).groupBy("customer_id", "plan_type", month_start("day").alias("month")).agg(F.sum("revenue_cents").alias("revenue_cents"))
    base = cm.join(segments(t), "customer_id")
    rolled = base.rollup("segment", "plan_type", "month").agg(
        from_cents(F.sum("revenue_cents")).alias("revenue"),
        F.count_distinct("customer_id").alias("customers"),
        F.bit_count(F.grouping_id()).cast("int").alias("level"),
    )
    return rolled.select("level", "segment", "plan_type", "month", as_money("revenue").alias("revenue"), "customers")


def customer_revenue(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """(segment, customer_id) -> cents of all successful payments, 0 without any."""
    totals = M.customer_totals(t.payments, p)
    return segments(t).join(totals, "customer_id", "left").select(
        "segment", "customer_id", F.coalesce("revenue_cents", F.lit(0)).alias("cents"), F.coalesce("n_payments", F.lit(0)).alias("payments")
    )


def top_customers_by_segment(t: Tables, p: Params = DEFAULT, k: int = TOP) -> DataFrame:
    """The ``k`` customers of each segment with the most revenue, ties to the
    smaller id.  The filter on the rank is a limit inside every map task
    (``WindowGroupLimit``), so a segment's shuffle is k rows a task."""
    order = Window.partitionBy("segment").orderBy(F.col("cents").desc(), "customer_id")
    ranked = customer_revenue(t, p).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("segment", "rank", "customer_id", as_money(from_cents("cents")).alias("revenue"), "payments")


def revenue_deciles(t: Tables, p: Params = DEFAULT, tiles: int = TILES) -> DataFrame:
    """Customers of each segment cut into ten tiles by revenue, highest first,
    sized as NTILE does: (segment, decile, customers, revenue, least, most).

    No task sorts a segment: customers become (segment, value, number), values
    fall into buckets of about 1 % width, and a value's place is the sum of
    the buckets ahead plus the values ahead inside its bucket."""
    values = customer_revenue(t, p).groupBy("segment", "cents").agg(F.count(F.lit(1)).alias("n"))
    bucket = F.when(F.col("cents") > 0, F.floor(F.log2(F.col("cents").cast("double")) * 64)).otherwise(F.lit(-1)).cast("int")
    values = values.withColumn("bucket", bucket)
    sizes = values.groupBy("segment", "bucket").agg(F.sum("n").alias("size"))
    ahead = Window.partitionBy("segment").orderBy(F.col("bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("segment")
    sizes = sizes.select(
        F.col("segment").alias("_s"), F.col("bucket").alias("_b"),
        F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("before"), F.sum("size").over(whole).alias("total"),
    )
    inside = Window.partitionBy("segment", "bucket").orderBy(F.col("cents").desc()).rowsBetween(Window.unboundedPreceding, -1)
    placed = values.join(sizes, values.segment.eqNullSafe(F.col("_s")) & (values.bucket == F.col("_b")))
    placed = placed.withColumn("lo", F.col("before") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
    # tile of a place, counted from 0: the first (total mod tiles) tiles have one more
    q, r = F.floor(F.col("total") / tiles), F.col("total") % tiles
    large = r * (q + 1)
    tile = lambda x: F.when(x < large, F.floor(x / (q + 1))).otherwise(r + F.floor((x - large) / F.greatest(q, F.lit(1)))).cast("int")
    begin = lambda d: F.least(d, r) * (q + 1) + F.greatest(d - r, F.lit(0)) * q
    first, last = tile(F.col("lo")), tile(F.col("lo") + F.col("n") - 1)
    spread = placed.withColumn("d", F.explode(F.sequence(first, last)))
    share = F.least(begin(F.col("d") + 1), F.col("lo") + F.col("n")) - F.greatest(begin(F.col("d")), F.col("lo"))
    return spread.withColumn("share", share.cast("long")).groupBy("segment", "d").agg(
        F.sum("share").alias("customers"), F.sum(F.col("share") * F.col("cents")).alias("cents"), F.min("cents").alias("lo"), F.max("cents").alias("hi")
    ).select(
        "segment", (F.col("d") + 1).cast("int").alias("decile"), "customers", as_money(from_cents("cents")).alias("revenue"),
        as_money(from_cents("lo")).alias("least"), as_money(from_cents("hi")).alias("most"),
    )


def customer_movements(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """Per month: customers that paid in it and the month before (kept), paid
    for the first time (new), paid again after a gap (returned), and paid in
    the month before but not in it (lost; not counted after the last month).

    Set operations on the distinct (customer, month) pairs, written once."""
    cm = materialize(M.customer_months(t.payments, p).where("customer_id is not null and month is not null").select("customer_id", "month"))
    shifted = cm.select("customer_id", F.add_months("month", 1).alias("month"))
    first = cm.groupBy("customer_id").agg(F.min("month").alias("month"))
    kept = cm.intersect(shifted)
    arrived = cm.exceptAll(kept)
    new = arrived.intersect(first)
    parts = {"kept": kept, "new": new, "returned": arrived.exceptAll(new), "lost": shifted.exceptAll(kept)}
    rows = None
    for name, df in parts.items():
        one = df.groupBy("month").agg(F.count("customer_id").alias("n")).withColumn("kind", F.lit(name))
        rows = one if rows is None else rows.unionByName(one)
    count = lambda k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).alias(f"{k}_customers")
    wide = rows.groupBy("month").agg(*[count(k) for k in parts])
    last = cm.agg(F.max("month").alias("last")).scalar()
    return wide.where(F.col("month") <= last).transform(S.ordered, "month")


def retention_matrix(t: Tables, p: Params = DEFAULT, months: int = COHORT_MONTHS) -> DataFrame:
    """One row per signup month: its size and the share of it that paid k
    months later, k = 0 to ``months``, one column each (NULL beyond the last
    payment month, 0 where nobody paid)."""
    cohort = t.customers.select("customer_id", month_start("signup_date").alias("cohort_month")).distinct()
    sizes = cohort.groupBy("cohort_month").agg(F.count("customer_id").alias("cohort_size"))
    cm = M.customer_months(t.payments, p).select("customer_id", "month")
    # calendar-bounded from here on: one row per cohort and month
    active = cm.join(cohort, "customer_id").groupBy("cohort_month", "month").agg(F.count("customer_id").alias("n"))
    k = F.months_between("month", "cohort_month").cast("int")
    counts = active.groupBy("cohort_month").agg(
        F.max("month").alias("_seen"), *[F.coalesce(F.sum(F.when(k == i, F.col("n"))), F.lit(0)).alias(f"_{i}") for i in range(months + 1)]
    )
    rows = S.with_latest(sizes.join(counts, "cohort_month", "left"), "_last", "_seen")
    cell = lambda i: F.when(
        F.add_months("cohort_month", i) <= F.col("_last"), pct(F.coalesce(F.col(f"_{i}"), F.lit(0)), "cohort_size").cast("double")
    ).alias(f"month_{i}")
    return rows.select("cohort_month", "cohort_size", *[cell(i) for i in range(months + 1)]).transform(S.ordered, "cohort_month")


def payers_by_period(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """Distinct payers of months, quarters and years: exact, and whether the
    estimate from merged monthly sketches lies within three standard errors.

    The sketches are partial aggregates: a month's are merged to quarters and
    years without going back to the customers, unlike the exact counts."""
    cm = M.customer_months(t.payments, p).where("customer_id is not null and month is not null")
    monthly = materialize(cm.groupBy("month").agg(F.hll_sketch_agg(F.col("customer_id").cast("string"), F.lit(SKETCH_LG)).alias("sketch")))
    kinds = ("month", "quarter", "year")
    period = lambda kind: F.struct(F.lit(kind).alias("period"), F.trunc("month", kind).alias("period_start"))
    periods = F.explode(F.array(*[period(k) for k in kinds])).alias("k")
    exact = cm.select("customer_id", periods).distinct().groupBy("k").agg(F.count("customer_id").alias("payers"))
    merged = monthly.select("sketch", periods).groupBy("k").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))
    near = F.abs(F.col("estimate") - F.col("payers")) <= F.greatest(F.lit(1.0), F.col("payers") * SKETCH_ERROR)
    return exact.join(merged, "k").select("k.period", "k.period_start", "payers", near.alias("estimate_within_bound"))
