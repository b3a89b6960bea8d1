"""Spark session helpers.

Cluster settings (executor sizing, ``spark.checkpoint.dir``) belong to the
deployment.  These helpers only fill in what is unset, so the same code runs
on a laptop (tests, bench) and on a large cluster.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.  ``session.timeZone`` pins the meaning of
# ingestion timestamps; AQE re-plans joins/aggregates with runtime sizes
# (broadcast only when the measured side is small, skew-join splitting,
# partition coalescing).
_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "panelspark") -> SparkSession:
    """Local session for tests and benchmarks (UI off, no extra ports)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("PANELSPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in _REQUIRED.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the required SQL settings to an existing (cluster) session."""
    for k, v in _REQUIRED.items():
        spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory.

    On a cluster ``spark.checkpoint.dir`` must name a folder that every executor shares; it is used as is, and a
    missing setting is an error.  Only a local master, where driver and tasks share one machine, gets a scratch
    folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="panelspark-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def stage_table(df, name: str = "stage"):
    """Write ``df`` as Parquet under the checkpoint directory and read it back.

    Cuts the lineage (later stages and retries start from shared storage)
    and computes ``df`` exactly once — ``Dataset.checkpoint()`` evaluates an
    uncached input twice.
    """
    import uuid

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
