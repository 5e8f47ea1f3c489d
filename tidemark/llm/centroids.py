"""Operator 12: centroid clustering with a bisector tournament.

Vectors are integers, ``floor(256 * x)`` of every component, so that nothing
depends on the order of a sum.  Of two centroids i < j the nearer one is told
by one linear sign test against their bisector,

    2 (c_j - c_i) . v - (|c_j|^2 - |c_i|^2) > 0:  j is nearer, else i stays,

with integer normals and thresholds that are computed once a round for all
pairs.  The centroids meet in a knock-out tournament: each of the k - 1 tests
eliminates one of them, the left opponent always has the smaller number, and
zero favours it.  Only the distance to the winner is computed, exactly.

A batch runs in doubles where all components are so small that every sum is
an exact integer (``EXACT``), and in Python's integers otherwise: same rows.

How the work is spread: the kept vectors are written once as integers.  Every
round reads them, each task adds up its vectors by cluster and hands on one
sum per cluster and component, in limbs of 32 bits, so that sums of any size
stay exact; Spark adds up the limbs.  The driver sees k centroids and their
sums, whatever the number of vectors; a cluster with most of the rows is
added up in every task.

Defined results: vectors that are null, have another number of components or
hold a null or non-finite one are left out; a row with a null vec_id is
clustered but starts no centroid; repeated rows count each (and may start
several equal centroids, of which the smallest number wins; rows that share a
vec_id start in the order of their vectors, those beyond 64 bits as text); with fewer
vectors than centroids all of them start one; a distance or a sum of distances
beyond 64 bits is null; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, read, ship

ship(__name__)

DIM = 64
CLUSTERS = 40
ROUNDS = 5
SALT = 2
SCALE = 256
EXACT = 1 << 21  # components up to this size: 64 products of two doubles add up exactly
WIDE = 1 << 62  # integers up to this size are written as numbers, others as text
LIMB = 32
ROWS = 8192  # vectors in one tournament


def floors(x: np.ndarray) -> list:
    """``floor(SCALE * x)`` of doubles of any size, as Python integers."""
    return [int(v) * SCALE if abs(v) >= 2.0**53 else math.floor(v * SCALE) for v in x.tolist()]


def kept(embeddings: DataFrame, dim: int = DIM) -> DataFrame:
    """``(vec_id, v, big)``: integer vectors; ``big`` holds those of components beyond 64 bits."""
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.filter(F.size("v") == dim).filter(~bad)

    def run(batches):
        for batch in batches:
            col = batch.column("v")
            x = col.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            wide = np.abs(x).max(axis=1, initial=0) * SCALE >= WIDE
            small = np.floor(np.where(wide[:, None], 0, x) * SCALE).astype(np.int64)
            big = [",".join(map(str, floors(x[i]))) if w else None for i, w in enumerate(wide.tolist())]
            at = np.arange(0, len(x) * dim + 1, dim, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.ListArray.from_arrays(pa.array(at), pa.array(small.ravel())), pa.array(big, pa.string())],
                names=["vec_id", "v", "big"],
            )

    return rows.mapInArrow(run, "vec_id long, v array<long>, big string")


def vectors(batch, dim: int) -> np.ndarray:
    """The integer vectors of a batch: doubles if exact, else objects."""
    x = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    big = batch.column("big")
    if big.null_count < len(big):
        x = x.astype(object)
        for i, text in enumerate(big.to_pylist()):
            if text is not None:
                x[i] = [int(c) for c in text.split(",")]
    if np.abs(x).max(initial=0) <= EXACT:
        return x.astype(np.float64)
    return x.astype(object)


class Bisectors:
    """Normals and thresholds of all pairs of centroids, and the tournament."""

    def __init__(self, centroids: list):
        k = self.k = len(centroids)
        c = np.array(centroids, dtype=object).reshape(k, -1)
        norm = (c * c).sum(axis=1)
        pairs = [(i, j) for i in range(k) for j in range(i + 1, k)]
        self.at = np.zeros((k, k), np.int64)
        for n, (i, j) in enumerate(pairs):
            self.at[i, j] = n
        first, second = [i for i, _ in pairs], [j for _, j in pairs]
        self.centroids = c
        self.normals = 2 * (c[second] - c[first])
        self.thresholds = norm[second] - norm[first]
        self.exact = np.abs(c).max(initial=0) <= EXACT
        if self.exact:
            self.small = self.centroids.astype(np.float64), self.normals.astype(np.float64), self.thresholds.astype(np.float64)

    def figures(self, kind):
        return self.small if kind != object and self.exact else (self.centroids, self.normals, self.thresholds)

    def nearest(self, v: np.ndarray):
        """Number of the nearest centroid of each vector, and the squared distance."""
        if not self.exact:
            v = v.astype(object)
        c, normals, thresholds = self.figures(v.dtype)
        # the first matches are the same for all vectors: one matrix product
        left = np.arange(0, self.k - 1, 2)
        n = self.at[left, left + 1]
        side = v @ normals[n].T - thresholds[n] > 0
        field = [left[m] + side[:, m] for m in range(len(left))]
        if self.k % 2:
            field.append(np.full(len(v), self.k - 1))
        while len(field) > 1:
            after = []
            for m in range(0, len(field) - 1, 2):
                n = self.at[field[m], field[m + 1]]
                test = (v * normals[n]).sum(axis=1) - thresholds[n] > 0
                after.append(np.where(test, field[m + 1], field[m]))
            field = after + field[len(field) - len(field) % 2 :]
        off = v - c[field[0]]
        return field[0], (off * off).sum(axis=1)


def parts(batches, dim: int):
    for batch in batches:
        for k in range(0, batch.num_rows, ROWS):
            part = batch.slice(k, ROWS)
            yield part, vectors(part, dim)


def limbs(x: int):
    """A signed integer as limbs of ``LIMB`` bits; the last one holds the sign."""
    at = 0
    while True:
        if -(1 << LIMB) <= x < 1 << LIMB:
            yield at, x
            return
        yield at, x & ((1 << LIMB) - 1)
        x >>= LIMB
        at += 1


def moved(vecs: DataFrame, centroids: list, dim: int) -> list:
    """The centroids after one round: exact floors of means, empty ones stay."""
    b, k = Bisectors(centroids), len(centroids)

    def run(batches):
        count, total = np.zeros(k, np.int64), np.zeros((k, dim), dtype=object)
        for _, v in parts(batches, dim):
            won = b.nearest(v)[0]
            count += np.bincount(won, minlength=k)
            order = np.argsort(won, kind="stable")
            begin = np.flatnonzero(np.diff(won[order], prepend=-1))
            sums = np.add.reduceat(v[order], begin, axis=0)
            total[won[order][begin]] += np.array([[int(x) for x in row] for row in sums.tolist()], dtype=object)
        rows = [(c, d, at, x) for c in range(k) if count[c] for d in range(dim) for at, x in limbs(int(total[c, d])) if x]
        rows += [(c, -1, 0, int(count[c])) for c in range(k) if count[c]]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.int64()))],
                names=["c", "d", "limb", "x"],
            )

    got = vecs.mapInArrow(run, "c int, d int, limb int, x long").groupBy("c", "d", "limb").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    count, total = [0] * k, [[0] * dim for _ in range(k)]
    for r in got.collect():  # at most k * (dim + 1) sums of a few limbs
        if r["d"] < 0:
            count[r["c"]] = int(r["x"])
        else:
            total[r["c"]][r["d"]] += int(r["x"]) << (LIMB * r["limb"])
    return [[s // n for s in sums] if n else old for sums, n, old in zip(total, count, centroids)]


def cluster(embeddings: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, salt: int = SALT) -> DataFrame:
    """One row per kept vector: its cluster, distance, inertias and centroid digest."""
    spark = embeddings.sparkSession
    vecs = materialise(kept(embeddings, dim), "vectors")
    key = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    start = vecs.filter("vec_id is not null").orderBy(key, "v", "big").limit(clusters).collect()
    centroids = [[int(c) for c in r["big"].split(",")] if r["big"] else list(r["v"]) for r in start]
    schema = "vec_id long, cluster int, d decimal(38,0)"
    if not centroids:
        out = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], out)
    for _ in range(rounds):
        centroids = moved(vecs, centroids, dim)
    b = Bisectors(centroids)

    def run(batches):
        for part, v in parts(batches, dim):
            won, d = b.nearest(v)
            d = [int(x) if x < 10**37 else None for x in d.tolist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id"), pa.array(won, pa.int32()), pa.array(d, pa.decimal128(38, 0))], names=["vec_id", "cluster", "d"]
            )

    placed = materialise(vecs.mapInArrow(run, schema), "placed")
    lost = F.count_if(F.col("d").isNull())
    sums = {r["cluster"]: r["d"] for r in placed.groupBy("cluster").agg(F.when(lost == 0, F.try_sum("d")).alias("d")).collect()}
    whole = None if None in sums.values() else sum(sums.values())
    fits = lambda x: None if x is None or x >= 1 << 63 else int(x)
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    figures = spark.createDataFrame(
        [(c, fits(sums.get(c)), fits(whole), name[c]) for c in range(len(centroids))],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return placed.join(F.broadcast(figures), "cluster").select(
        "vec_id", "cluster", F.expr("try_cast(d as bigint)").alias("distance"), "cluster_inertia", "inertia", "centroid_sha256"
    )


def op12_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(read(spark, sf_dir, "embeddings"))


def sql(clusters: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, salt: int = SALT) -> str:
    """The rounds spelled out, every vector against every centroid."""
    steps = [f"""k AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
)""", f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS m
  FROM (SELECT sha256('{salt}:' || CAST(vec_id AS VARCHAR)) AS h, v FROM k WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT {clusters})
)"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT rid, min(struct_pack(d := list_sum(list_transform(list_zip(v, m), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), c := c)) AS best
  FROM k CROSS JOIN c{r} GROUP BY rid
)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c{r}.c, coalesce(list(f ORDER BY i) FILTER (f IS NOT NULL), any_value(m)) AS m
  FROM c{r} LEFT JOIN (
    SELECT c, i, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS f
    FROM (SELECT best.c AS c, unnest(v) AS x, unnest(range(1, {dim + 1})) AS i FROM k JOIN a{r} USING (rid)) GROUP BY c, i
  ) s ON s.c = c{r}.c
  GROUP BY c{r}.c
)""")
    return "WITH " + ", ".join(steps) + f""", t AS (
  SELECT best.c AS c, sum(best.d) AS s FROM a{rounds} GROUP BY best.c
)
SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance, CAST(t.s AS BIGINT) AS cluster_inertia,
  CAST((SELECT sum(s) FROM t) AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{rounds} JOIN k USING (rid) JOIN t ON t.c = best.c JOIN c{rounds} ON c{rounds}.c = best.c
"""


OP12_SQL = sql()
