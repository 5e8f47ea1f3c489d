"""Operator 2: approximate nearest neighbours on stable projections.

All vectors are scaled to length one and projected to ``PROJECTED``
dimensions by a Gaussian (2-stable) matrix, so a squared projected distance
is the true one times a chi-square variable.  A kd-tree over a bounded sample
of projected vectors (``SAMPLE`` rows) splits the space into cells; every row
is indexed: it lies in one cell, and a cell with many rows is divided into
blocks of about ``BLOCK`` rows, each with a kd-tree of its own.

A query first searches its own cell, which bounds its k-th distance, and is
then sent to each further cell that the stopping test does not rule out.
Inside a block its projected neighbours are taken leaf by leaf, nearest leaf
first, and verified on the original vectors until the chi-square test says
that a better one stands ahead with a probability below 1 - ``CONFIDENCE``.

How the work is spread: equal vectors are indexed and searched once, under
their smallest vec_id, by aggregations with a map-side part; their k + 1
smallest ids stand for all of them, since no query's k nearest can need more.
So one vector's share of the table adds neither pairs nor a large task.
Distinct vectors move by block, distinct query vectors by the cells they
visit.  The queries that visit a cell are dealt into lots of about ``ASKED``,
and each lot meets its own copy of a block, so a task's group holds about
``BLOCK`` rows and ``ASKED`` queries however many there are; a block that no
query visits does not move.  The cells (at most ``CELLS``) and the sample are
bounded.

Defined results: vectors that are null, zero, of a length other than the
table's commonest, or hold null or non-finite parts take no part, nor do
rows with a null vec_id; repeated rows count once; ties go to the smaller
vec_id; queries with fewer candidates return them all; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, read, ship

ship(__name__)

PROJECTED = 12
SAMPLE = 40_000
CELLS = 4096
CELL_ROWS = 2000
BLOCK = 1000
ASKED = 2000
LEAF = 32
CONFIDENCE = 0.97
EVERY = 50
TOP = 5


def projection(dim: int, m: int = PROJECTED, seed: int = 5) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(dim, m))


def unit(x: np.ndarray) -> np.ndarray:
    big = np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    x = x / big
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def chi_square(x: np.ndarray, m: int = PROJECTED) -> np.ndarray:
    """Distribution function for an even number of degrees of freedom."""
    h = np.minimum(x, 1e4) / 2
    term, total = np.ones_like(h), np.ones_like(h)
    for i in range(1, m // 2):
        term = term * h / i
        total = total + term
    return 1 - np.exp(-h) * total


def critical(confidence: float, m: int = PROJECTED) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square(np.array(mid), m) < confidence else (lo, mid)
    return hi


class Tree:
    """kd-tree: median splits on the widest dimension; leaves with tight boxes."""

    def __init__(self, points: np.ndarray, leaf_rows: int):
        self.splits, self.leaves = {}, []  # node -> (dimension, value); rows of each leaf
        self.leaf_of = {}
        todo = [(1, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            box = points[rows]
            width = box.max(0) - box.min(0) if len(rows) else np.zeros(1)
            if len(rows) <= leaf_rows or width.max() == 0:
                self.leaf_of[node] = len(self.leaves)
                self.leaves.append(rows)
                continue
            d = int(width.argmax())
            mid = len(rows) // 2
            value = np.partition(box[:, d], mid)[mid]
            left = box[:, d] < value
            if not left.any():  # many rows share the median
                left = box[:, d] <= value
            value = float(np.nextafter(box[left, d].max(), np.inf))
            self.splits[node] = (d, value)
            todo += [(2 * node, rows[left]), (2 * node + 1, rows[~left])]

    def locate(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int64)
        todo = [(1, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if node in self.leaf_of:
                out[rows] = self.leaf_of[node]
                continue
            d, value = self.splits[node]
            left = points[rows, d] < value
            todo += [(2 * node, rows[left]), (2 * node + 1, rows[~left])]
        return out

    def regions(self, m: int):
        """Lower and upper corners of the leaves' regions (unbounded outside)."""
        lo, hi = np.full((len(self.leaves), m), -np.inf), np.full((len(self.leaves), m), np.inf)
        todo = [(1, lo[0].copy(), hi[0].copy())]
        while todo:
            node, a, b = todo.pop()
            if node in self.leaf_of:
                lo[self.leaf_of[node]], hi[self.leaf_of[node]] = a, b
                continue
            d, value = self.splits[node]
            b2, a2 = b.copy(), a.copy()
            b2[d], a2[d] = value, value
            todo += [(2 * node, a, b2), (2 * node + 1, a2, b)]
        return lo, hi


def box_distance(q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Squared distances of points to boxes."""
    out = np.zeros((len(q), len(lo)))
    for d in range(q.shape[1]):
        x = q[:, d, None]
        gap = np.maximum(np.maximum(lo[None, :, d] - x, x - hi[None, :, d]), 0)
        out += gap * gap
    return out


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of pairs of rows, on the given vectors; equal pairs give equal results."""
    dot = (a * b).sum(axis=-1)
    return dot / (np.sqrt((a * a).sum(axis=-1)) * np.sqrt((b * b).sum(axis=-1)))


def search_block(ids, vectors, queries, bound, k: int, limit: float, matrix):
    """The verified k best of one block for each query: (query row, id, cosine).

    ``bound``: a squared true distance (on unit vectors) that the query's k-th
    neighbour is known not to exceed.
    """
    points, qpoints = unit(vectors) @ matrix, unit(queries) @ matrix
    tree = Tree(points, LEAF)
    lo = np.array([points[r].min(0) for r in tree.leaves])
    hi = np.array([points[r].max(0) for r in tree.leaves])
    gap = box_distance(qpoints, lo, hi)
    order = np.argsort(gap, axis=1, kind="stable")
    width = max(len(r) for r in tree.leaves)
    at_once = max(1, 16_384 // width)  # a leaf of equal points may be wide
    member = np.full((len(tree.leaves), width), -1)
    for i, r in enumerate(tree.leaves):
        member[i, : len(r)] = r
    best = np.full((len(queries), k), -np.inf)
    best_id = np.full((len(queries), k), np.iinfo(np.int64).max)
    active, wave = np.arange(len(queries)), 0
    while len(active) and wave < len(tree.leaves):
        leaf = order[active, wave]
        kth = np.minimum(bound[active], 2 - 2 * best[active, -1])  # squared distance of unit vectors
        go = gap[active, leaf] <= limit * np.maximum(kth, 0) * (1 + 1e-9) + 1e-9
        active, leaf = active[go], leaf[go]
        for part in range(0, len(active), at_once):
            a, rows = active[part : part + at_once], member[leaf[part : part + at_once]]
            score = cosine(queries[a][:, None, :], vectors[np.maximum(rows, 0)])
            rid = ids[np.maximum(rows, 0)]
            score = np.where(rows < 0, -np.inf, score)
            rid = np.where(np.isneginf(score), np.iinfo(np.int64).max, rid)
            s, r = np.concatenate([best[a], score], 1), np.concatenate([best_id[a], rid], 1)
            pick = np.lexsort((r, -s), axis=1)[:, :k]
            best[a], best_id[a] = np.take_along_axis(s, pick, 1), np.take_along_axis(r, pick, 1)
        wave += 1
    row, col = np.nonzero(~np.isneginf(best))
    return row, best_id[row, col], best[row, col]


def usable(embeddings: DataFrame) -> DataFrame:
    """Rows that take part, ``(vec_id, v)`` with v of floats as given, or doubles."""
    kind = embeddings.schema["embedding"].dataType.simpleString()
    e = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind if kind == "array<float>" else "array<double>").alias("v")
    )
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x).cast("double").isin(float("inf"))))
    e = e.filter("vec_id is not null and v is not null").filter(~bad).filter(F.exists("v", lambda x: x != 0))
    common = e.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return e.filter(F.size("v") == (common[0]["n"] if common else -1))


def stack(column) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def first_ids(ids: DataFrame, k: int) -> DataFrame:
    """``(h1, h2, rep, ids)``: the ``k`` smallest ids of every distinct vector."""
    order = Window.partitionBy("h1", "h2").orderBy("vec_id")
    few = ids.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)
    return few.groupBy("h1", "h2").agg(F.min("vec_id").alias("rep"), F.array_sort(F.collect_list("vec_id")).alias("ids"))


def nearest(embeddings: DataFrame, is_query, k: int = TOP, confidence: float = CONFIDENCE) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for the rows that ``is_query`` (a
    condition on vec_id) marks, against all rows."""
    spark = embeddings.sparkSession
    out_schema = "query_id long, rank int, vec_id long, score double"
    rows = usable(embeddings).withColumn("h1", F.xxhash64("v")).withColumn("h2", F.xxhash64(F.lit("second"), "v"))
    ids = materialise(rows.select("vec_id", "h1", "h2").distinct(), "ids")
    members = materialise(first_ids(ids, k + 1), "members")
    points = materialise(rows.groupBy("h1", "h2").agg(F.min("vec_id").alias("vec_id"), F.first("v").alias("v")), "points")
    asked = ids.filter(is_query).select(F.col("vec_id").alias("query_id"), "h1", "h2")
    total = points.count()
    if not total:
        return spark.createDataFrame([], out_schema)
    kind = points.schema["v"].dataType.simpleString()
    sampled = points.orderBy("h1", "h2").limit(SAMPLE).select("v").toPandas()
    first = stack(sampled["v"])
    matrix = projection(first.shape[1])
    cells = min(CELLS, max(1, -(-total // CELL_ROWS)))
    top = Tree(unit(first) @ matrix, -(-len(first) // cells))
    lo, hi = top.regions(PROJECTED)
    limit = critical(confidence)

    def place(frames):
        for f in frames:
            if len(f):
                f["cell"] = top.locate(unit(stack(f["v"])) @ matrix)
                yield f

    placed = materialise(points.mapInPandas(place, f"h1 long, h2 long, vec_id long, v {kind}, cell long"), "cells")
    # blocks of a cell: at most CELLS rows, so small enough for every task
    sizes = placed.groupBy("cell").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / BLOCK)).cast("int").alias("blocks"))
    sizes = F.broadcast(materialise(sizes, "sizes"))
    base = placed.join(sizes, "cell").select(
        "cell", F.pmod(F.xxhash64("vec_id", "h1"), F.col("blocks")).cast("int").alias("block"), "vec_id", "h1", "h2", "v"
    )
    queries = materialise(placed.join(asked.select("h1", "h2").distinct(), ["h1", "h2"], "left_semi"), "queries")

    def to_blocks(q: DataFrame, lots: DataFrame) -> DataFrame:
        return q.join(sizes, "cell").join(lots, "cell").select(
            F.col("cell").alias("qcell"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("qblock"),
            F.pmod(F.xxhash64("h2", "h1"), F.col("lots")).cast("int").alias("qlot"),
            F.col("h1").alias("q1"), F.col("h2").alias("q2"), F.col("v").alias("qv"), "bound",
        )

    found_schema = "q1 long, q2 long, rep long, h1 long, h2 long, score double"

    def search(key, data, wanted):
        if not len(data) or not len(wanted):
            none = {"q1": "int64", "q2": "int64", "rep": "int64", "h1": "int64", "h2": "int64", "score": "float64"}
            return pd.DataFrame({c: [] for c in none}).astype(none)
        # ids ascend in the order of (vec_id, h1, h2): a row's place stands for it
        data = data.sort_values(["vec_id", "h1", "h2"]).reset_index(drop=True)
        bound = wanted["bound"].to_numpy(dtype=float, na_value=np.inf)
        row, at, score = search_block(
            np.arange(len(data)), stack(data["v"]), stack(wanted["qv"]), np.where(np.isnan(bound), np.inf, bound), k + 1, limit, matrix
        )
        q, d = wanted.iloc[row], data.iloc[at]
        return pd.DataFrame({
            "q1": q["q1"].to_numpy(), "q2": q["q2"].to_numpy(), "rep": d["vec_id"].to_numpy(), "h1": d["h1"].to_numpy(), "h2": d["h2"].to_numpy(), "score": score,
        })

    def run(q: DataFrame) -> DataFrame:
        # one row a cell that is visited: small enough for every task
        lots = q.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / ASKED).cast("int").alias("lots"))
        lots = F.broadcast(materialise(lots, "lots"))
        data = base.join(lots, "cell").withColumn("lot", F.explode(F.sequence(F.lit(0), F.col("lots") - 1))).drop("lots")
        found = data.groupBy("cell", "block", "lot").cogroup(to_blocks(q, lots).groupBy("qcell", "qblock", "qlot")).applyInPandas(search, found_schema)
        return materialise(found, "found")

    def best(found: DataFrame) -> DataFrame:
        # each block gives a query k + 1 rows at most
        ordered = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "rep", "h1", "h2")))
        return found.groupBy("q1", "q2").agg(F.slice(ordered, 1, k + 1).alias("top"))

    home = run(queries.withColumn("bound", F.lit(None).cast("double")))
    kth = best(home).filter(F.size("top") == k + 1).select("q1", "q2", (F.lit(2.0) + 2 * F.element_at("top", -1)["s"]).alias("bound"))

    def route(frames):
        for f in frames:
            if not len(f):
                continue
            bound = f["bound"].to_numpy(dtype=float, na_value=np.inf)
            bound = np.where(np.isnan(bound), np.inf, bound)
            gap = box_distance(unit(stack(f["v"])) @ matrix, lo, hi)
            go = gap <= limit * np.maximum(bound, 0)[:, None] * (1 + 1e-9) + 1e-9
            go[np.arange(len(f)), f["cell"].to_numpy()] = False
            r, c = np.nonzero(go)
            for part in range(0, len(r), 20_000):
                out = f.iloc[r[part : part + 20_000]][["h1", "h2", "v"]].copy()
                out["bound"] = np.where(np.isinf(bound[r[part : part + 20_000]]), np.nan, bound[r[part : part + 20_000]])
                out["cell"] = c[part : part + 20_000]
                yield out

    away = queries.join(kth, (F.col("h1") == F.col("q1")) & (F.col("h2") == F.col("q2")), "left").select("h1", "h2", "v", "cell", "bound")
    away = materialise(away.mapInPandas(route, f"h1 long, h2 long, v {kind}, bound double, cell long"), "away")
    found = best(home.unionByName(run(away))).select("q1", "q2", F.explode("top").alias("x")).select("q1", "q2", "x.s", "x.h1", "x.h2")
    # distinct vectors to their ids: the k + 1 best ids of every distinct query vector
    near = found.join(members, ["h1", "h2"]).select("q1", "q2", "s", F.explode("ids").alias("vec_id"))
    listed = near.groupBy("q1", "q2").agg(F.slice(F.array_sort(F.collect_list(F.struct("s", "vec_id"))), 1, k + 1).alias("near"))
    listed = materialise(listed, "listed")
    pairs = asked.join(listed, (F.col("h1") == F.col("q1")) & (F.col("h2") == F.col("q2"))).select("query_id", F.explode("near").alias("x"))
    pairs = pairs.select("query_id", "x.s", "x.vec_id").filter("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy("s", "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", (-F.col("s")).alias("score")
    )


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)
