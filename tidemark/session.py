"""Spark session set-up shared by tests, bench and jobs.

On a cluster the session is built by the platform; :func:`configure` only
sets what the analyses rely on (UTC dates, AQE) and never overrides a
checkpoint directory the cluster already names.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    # sums raise on overflow instead of wrapping
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split skewed partitions of rebalanced writes
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "tidemark", **conf) -> SparkSession:
    """Local session for tests and the bench (UI off, no server)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    for k, v in SESSION_DEFAULTS.items():
        spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    Only a local session that names none (tests) gets a scratch folder; on
    a cluster ``spark.checkpoint.dir`` must point at shared storage.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        sc.setCheckpointDir(current)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current
