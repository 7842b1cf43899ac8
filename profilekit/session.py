"""Session helpers.

The library never creates a cluster session on its own behalf; callers own
the session. ``local_session`` is for tests and the benchmark only.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "profilekit") -> SparkSession:
    """A local session with the settings the library is designed for.

    AQE is on so that shuffle partitions coalesce, sort-merge joins whose small
    side turns out small at run time become broadcast joins, and skewed join
    partitions are split (built-in salting). The UI is off: no server is opened.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("PROFILEKIT_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared checkpoint folder; make a local one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS/S3/...).
    Only a local test or benchmark session, where it is unset, gets a fresh
    folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="profilekit-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


_SCOPES: list[list[str]] = []


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table under the shared checkpoint folder.

    Inside ``scratch`` the path is removed when the scope ends; outside, its
    table stays for as long as the caller may still read it.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Scope of a job's intermediate tables (join sides, key lists, written steps): deleted when it ends.

    Frames made inside read those tables lazily, so their results must be
    written or collected before the scope ends.
    """
    _SCOPES.append([])
    try:
        yield
    finally:
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in _SCOPES.pop():
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Scope in which a query's shuffle files go when it ends (Spark 4.1 on), not when the driver next collects its garbage.

    For queries that run once and whose results are written or collected.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP_CONF, None)
    spark.conf.set(SHUFFLE_CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP_CONF)
        else:
            spark.conf.set(SHUFFLE_CLEANUP_CONF, before)
