"""Operator 5: mixing sources to target weights (DataFrame functions only).

A source's weight is its share of all tokens to the power ``alpha``,
normalised.  ``alpha`` is bisected (many points a round, each round one
aggregation over the sources): the largest one whose weights reach
``entropy`` (a part of the largest possible entropy), raised again if
otherwise a source would repeat more than ``repeat`` times.

The budget in tokens is, unless given, the smallest that shows every source
whole at least once, so nothing is lost; a smaller one leaves texts out.  A
source of t tokens with budget b is read floor(b / t) times whole, and then
up to the rest.  Each reading (epoch) is its own permutation: the source is
dealt into ``BLOCKS`` blocks by hash, blocks are ordered by a hash of epoch
and block, texts in a block by a hash of epoch and text.  The last, partial
epoch takes whole blocks in that order and ends inside one block, with the
text that reaches the budget.

The result has one row per text with its ``draws``: (epoch, block_key,
text_key); sorting draws by them gives each source's reading order.

How the work is spread: only sums per source and block are shuffled, the
cut is found in sums over at most ``BLOCKS`` blocks a source and then among
the texts of one block; a source with a third of all rows is never in one
task.  The sources' figures are joined by broadcast below a checked number.

Defined results: a null source is the source ''; tokens are words between
ASCII blanks; texts without tokens have no weight and are drawn in each
whole epoch; with one source or no tokens alpha is 1; repeated rows are
drawn alike; an empty table gives no rows; columns of the input stay (own
columns replace clashing names).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_small, materialise, read, text_key

BLOCKS = 1024
ENTROPY = 0.95
REPEAT = 4.0
POINTS = 16
ROUNDS = 7
SEED = 17
BROADCAST_ROWS = 200_000
WORD = r"[^\x20\x09-\x0D]+"


def token_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def exponent(sources: DataFrame, entropy: float, repeat: float, budget: float | None) -> tuple[float, dict]:
    """The exponent, and the figures that give the weights:
    ``(alpha, {total, z, budget})`` from ``sources(src, tokens)``."""
    s = sources.filter("tokens > 0")
    first = s.agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("t"), F.min("tokens").alias("lo"), F.max("tokens").alias("hi")).first()
    if not first["n"]:
        return 1.0, {"total": 0, "z": 1.0, "budget": 0.0}
    n, total = first["n"], float(first["t"])
    p = F.col("tokens") / F.lit(total)

    def figures(alphas):
        """Entropy, and most repeats of a source, at each exponent."""
        cols = [F.sum(F.pow(p, F.lit(a))) for a in alphas] + [F.sum(F.pow(p, F.lit(a)) * F.log(p)) for a in alphas]
        got = s.agg(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()
        out = []
        for i, a in enumerate(alphas):
            z, e = got[i], got[len(alphas) + i]
            # a source's repeats go with share ** (alpha - 1): most for the smallest
            least = first["lo"] / total if a <= 1 else first["hi"] / total
            asked = budget if budget is not None else total / (first["hi"] / total) ** (a - 1) * z
            out.append((z, math.log(z) - a * e / z, asked, asked * least ** (a - 1) / z / total))
        return out

    def last_true(test):
        """Largest exponent in [0, 1] up to which ``test(figures)`` holds."""
        lo, hi = 0.0, 1.0
        a, b = figures([lo, hi])
        if test(b):
            return hi
        if not test(a):
            return lo
        for _ in range(ROUNDS):
            points = [lo + (hi - lo) * (i + 1) / (POINTS + 1) for i in range(POINTS)]
            ok = [test(f) for f in figures(points)] + [False]
            k = ok.index(False)
            lo, hi = (points[k - 1] if k else lo), (points[k] if k < POINTS else hi)
        return lo

    goal = entropy * math.log(n)
    alpha = last_true(lambda f: f[1] >= goal - 1e-12) if n > 1 else 1.0
    if figures([alpha])[0][3] > repeat:
        alpha = max(alpha, last_true(lambda f: f[3] > repeat))
    z, _, asked, _ = figures([alpha])[0]
    return alpha, {"total": total, "z": z, "budget": asked}


def mix(docs: DataFrame, entropy: float = ENTROPY, repeat: float = REPEAT, budget: float | None = None, seed: int = SEED) -> DataFrame:
    """``docs`` with ``n_tokens``, ``weight`` of its source, ``epochs`` and ``draws``."""
    src = F.coalesce("source", F.lit(""))
    key = text_key(F.col("text"))
    block = F.pmod(F.xxhash64("doc_id", key, F.lit(seed)), F.lit(BLOCKS)).cast("int")
    dealt = materialise(docs.select("doc_id", src.alias("src"), key.alias("tk"), block.alias("block"), token_count(F.col("text")).alias("tokens")), "dealt")
    blocks = materialise(dealt.groupBy("src", "block").agg(F.sum("tokens").alias("tokens")), "blocks")
    sources = materialise(blocks.groupBy("src").agg(F.sum("tokens").alias("tokens")), "sources")
    alpha, f = exponent(sources, entropy, repeat, budget)
    weight = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(f["total"] or 1.0), F.lit(alpha)) / F.lit(f["z"])).otherwise(0.0)
    # the largest source is read exactly once under the default budget: keep rounding from cutting it
    reads = F.when(F.col("tokens") > 0, F.round(weight * F.lit(float(f["budget"])) / F.col("tokens"), 9)).otherwise(1.0)
    plan = sources.select("src", "tokens", weight.alias("weight"), reads.alias("reads")).select(
        "src", "weight", F.floor("reads").cast("int").alias("whole"),
        ((F.col("reads") - F.floor("reads")) * F.col("tokens")).alias("rest"),
    )
    plan = materialise(plan, "plan")
    n_sources = plan.count()
    small = lambda df: broadcast_if_small(df, n_sources, BROADCAST_ROWS)
    block_key = lambda epoch: F.xxhash64(F.lit(seed), epoch, F.col("src"), F.col("block"))
    doc_key = lambda epoch: F.xxhash64(F.lit(seed), epoch, F.col("doc_id"), F.col("tk"))

    # where the partial epoch ends: its block, then the text in that block
    order = Window.partitionBy("src").orderBy("block_key", "block").rowsBetween(Window.unboundedPreceding, -1)
    partial = blocks.join(small(plan.filter("rest > 0")), "src").withColumn("block_key", block_key(F.col("whole")))
    cut = partial.withColumn("before", F.coalesce(F.sum("tokens").over(order), F.lit(0))).filter(
        "before < rest and before + tokens >= rest"
    ).select("src", "block", "block_key", "whole", (F.col("rest") - F.col("before")).alias("rest"))
    cut = materialise(cut, "cut")
    inside = dealt.join(small(cut), ["src", "block"]).withColumn("text_key", doc_key(F.col("whole")))
    ahead = Window.partitionBy("src").orderBy("text_key").rangeBetween(Window.unboundedPreceding, -1)
    last = inside.withColumn("before", F.coalesce(F.sum("tokens").over(ahead), F.lit(0))).filter("before < rest").groupBy("src").agg(
        F.max("text_key").alias("cut_text"), F.first("block_key").alias("cut_block")
    )
    plan = materialise(plan.join(last, "src", "left"), "plan")

    # the input goes through as one struct, so that none of its names can clash
    kept = [c for c in docs.columns if c not in ("n_tokens", "weight", "epochs", "draws")]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col("doc_id").alias("doc_id"), src.alias("src"), key.alias("tk"),
        block.alias("block"), token_count(F.col("text")).alias("n_tokens"),
    )
    rows = rows.join(small(plan), "src")
    draw = lambda e: F.struct(e.cast("int").alias("epoch"), block_key(e).alias("block_key"), doc_key(e).alias("text_key"))
    whole = F.when(F.col("whole") > 0, F.transform(F.sequence(F.lit(0), F.greatest("whole", F.lit(1)) - 1), draw)).otherwise(
        F.array().cast("array<struct<epoch:int,block_key:bigint,text_key:bigint>>")
    )
    late = draw(F.col("whole"))
    reached = (late["block_key"] < F.col("cut_block")) | ((late["block_key"] == F.col("cut_block")) & (late["text_key"] <= F.col("cut_text")))
    draws = F.when(F.coalesce(reached, F.lit(False)), F.concat(whole, F.array(late))).otherwise(whole)
    return rows.withColumn("draws", draws).select("row.*", "n_tokens", "weight", F.size("draws").alias("epochs"), "draws")


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("text")
