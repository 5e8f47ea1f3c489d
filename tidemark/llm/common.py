"""Helpers shared by the operators of this subpackage.

Tables that are used twice, or whose lineage is cut, are written as Parquet
into the shared folder that the cluster names in ``spark.checkpoint.dir``
(:func:`materialise`), so a lost executor never loses them.
"""

from __future__ import annotations

import itertools
import sys
import tempfile
import uuid

import pyspark.cloudpickle as cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def ship(module_name: str) -> None:
    """Let Python workers get a module's functions by value, so that
    executors need no copy of this package on their path."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


ship(__name__)


#: Rows that Spark hands to a Python worker at once: texts may be long, and a
#: worker holds a batch and what it makes of it.
ARROW_ROWS = 1000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of the data folder; also bounds the session's Arrow batches."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a scratch folder only
    for a local master that names none (tests)."""
    sc = spark.sparkContext
    named = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="tidemark-llm-")
        sc.setCheckpointDir(named)
    return named


def materialise(df: DataFrame, name: str = "t") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and
    fixes non-deterministic columns."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null becomes the empty string."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def text_key(text: Column) -> Column:
    """Key of a text beside its doc_id, so that rows which repeat a doc_id
    keep their own results (equal rows get equal results)."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def fold(doc_id: Column, modulus: int) -> Column:
    """``crc32(doc_id as text) mod modulus``; 0 for a null doc_id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus, F.lit(0))


def broadcast_if_small(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """Broadcast hint only below a checked number of rows; beyond it Spark
    shuffles both sides."""
    return F.broadcast(df) if rows <= limit else df


def components(edges: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """Connected components of ``edges(a, b)`` (longs): one row per node
    that has an edge, ``(node, root)`` with root the smallest node reachable.

    Alternating large-star and small-star steps: every step groups by one
    node with a map-side minimum and joins it back, so no component is ever
    held in one task.  Each round is written to the shared folder.
    Self-loops and nulls are ignored.  Rounds go on until nothing changes;
    a run that reaches ``max_rounds`` before raises.
    """
    e = edges.select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).filter("u is not null and v is not null and u <> v").distinct()
    e = materialise(e, "cc")
    last = None
    for done in itertools.count():
        state = e.agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")
        ).first()
        if (state["n"], state["h"]) == last or state["n"] == 0:
            break
        if done == max_rounds:
            raise RuntimeError(f"components changed still after {max_rounds} rounds")
        last = (state["n"], state["h"])
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m")
        )
        # large star: larger neighbours of u hang on u's smallest neighbour
        # (with e's orientation u > v, the larger neighbours of v are its u)
        large = e.select(F.col("u").alias("x"), F.col("v").alias("u")).join(low, "u").select(
            F.col("x").alias("u"), F.col("m").alias("v")
        ).filter("u <> v").distinct()
        # small star: u and its smaller neighbours hang on the smallest one
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low2, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("p"))
            .select("p.u", "p.v").filter("u <> v").distinct()
        )
        e = materialise(small, "cc")
    return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    ).groupBy("node").agg(F.min("root").alias("root"))
