"""Spark session settings shared by jobs, tests and the bench.

Everything here is ordinary SparkSession configuration: UTC session zone (so
``DATE(ts)`` and offset literals mean the same thing on every executor), ANSI
casts (Spark 4 default; validation uses ``try_cast`` explicitly), AQE for
runtime re-planning (partition coalescing, broadcast conversion from measured
sizes, skew-join splitting) and runtime bloom filters for selective star joins.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of this library should carry. They only steer the
# optimizer; none changes query results.
BASE_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Target size of a shuffle partition after AQE coalescing; large shuffles
    # keep ~128 MB per task, small ones collapse to a few partitions.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # A selective side of up to 256 MB filters a fact scan of 1 GB or more before
    # its shuffle, where nothing is small enough to broadcast.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256m",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1g",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "ledgerflow",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with :data:`BASE_CONF` applied.

    ``master`` is left to spark-submit on a cluster; tests pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in conf.items():
        # getOrCreate ignores builder settings on an existing session; the SQL
        # ones can still be applied at runtime.
        if key.startswith("spark.sql.") and key != "spark.sql.ansi.enabled":
            try:
                spark.conf.set(key, value)
            except Exception:  # static conf of an already running session
                pass
    ensure_checkpoint_dir(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Apply the SQL settings of :data:`BASE_CONF` to an existing session."""
    for key, value in BASE_CONF.items():
        if key.startswith("spark.sql."):
            try:
                spark.conf.set(key, value)
            except Exception:
                pass


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/object store)
    folder and is used as given. Only when nothing is configured and the
    master is local (tests, local runs) a fresh folder under the system temp
    dir is created; on a cluster a missing setting is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set on the server session")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: configure a shared folder (HDFS/object store) "
                "for checkpoints and intermediate tables"
            )
        configured = tempfile.mkdtemp(prefix="ledgerflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint dir.

    Used for written intermediate tables, stream checkpoints and sinks, so
    that every byte a job leaves behind lives on shared storage.
    """
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")
