"""Run ids claimed on shared storage (S11, M5), so that two loads never share one.

``max(run_id) + 1`` alone gives two loads that start together the same id, and each
would overwrite the other's partitions. A claim is an empty file named after the id,
made by create-if-absent; who finds it there tries the next id. Claims are never
removed: the id of a load that died before its first event is skipped.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder and those above it, if absent, on any file system Spark writes to."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(target)


def create_if_absent(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if another caller has created it before.

    Stores used through Hadoop create without overwriting in one step. Hadoop's
    local file system checks first and creates then, so for local paths the JVM's
    own one-step call is used.
    """
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    make_folder(spark, os.path.dirname(path))
    if fs.getUri().getScheme() == "file":
        return bool(jvm.java.io.File(fs.makeQualified(target).toUri().getPath()).createNewFile())
    from py4j.protocol import Py4JJavaError

    try:
        fs.create(target, False).close()
        return True
    except Py4JJavaError as exc:
        if fs.exists(target):
            return False
        raise exc


def claim_run_id(spark: SparkSession, root: str, first: int = 1) -> int:
    """The smallest unclaimed id from ``first`` on; it is the caller's alone."""
    run_id = first
    while not create_if_absent(spark, os.path.join(root, "run_claims", f"{run_id:019d}")):
        run_id += 1
    return run_id
