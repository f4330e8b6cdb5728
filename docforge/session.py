"""Spark session defaults for the engine.

The library itself never creates a session behind the caller's back: every
operator takes DataFrames.  ``get_spark`` is a convenience for tests, the
bench and command-line use, with the settings the operators are tuned for:
adaptive execution (runtime broadcast of measured-small sides, skew-join
splitting, partition coalescing), UTC session time, Arrow transfer for the
few grouped-map operators, and no web UI.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A partition is skewed when it is 4x the median and above 64 MB; AQE then
    # splits it and replicates the matching side of the join.
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "docforge", extra: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (SparkSession.builder
               .master(master or f"local[{cpus}]")
               .appName(app_name)
               .config("spark.driver.memory", os.environ.get("DOCFORGE_DRIVER_MEM", "16g"))
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus)))
    for k, v in {**ADAPTIVE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared file system folder and is used as
    is.  Only when it is unset (local tests) do we create a private one.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="docforge-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", current)
        except Exception:  # noqa: BLE001 - some deployments reject core confs at runtime
            pass
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


def checkpoint_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for written stage tables)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])


def reliable_checkpoint(df):
    """``df.checkpoint()`` into the shared checkpoint folder (cuts lineage;
    survives executor loss), making sure the folder is configured first."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
