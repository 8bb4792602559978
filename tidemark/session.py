"""Session helpers: the settings every job here relies on, and the shared
checkpoint folder.

Jobs never build their own session in library code; they take the caller's and
only pin the few settings whose defaults would change results (session time
zone) or hurt at scale (AQE off, skew handling off).
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Settings that are safe to set at runtime on any session.
RUNTIME_CONF = {
    # Every timestamp in the change log is zone-less; decode and day bucketing
    # must not depend on the machine's zone.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffle partitions, split skewed join
    # partitions, and switch sort-merge joins to broadcast when a side turns out
    # small at runtime (the size is measured, not guessed).
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the engine depends on; returns the session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and materialised intermediates: what
    ``spark.checkpoint.dir`` names (a shared, fault-tolerant filesystem on a
    cluster).  Where it is unset, a local session gets a folder of its own;
    any other session must set it.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a shared, fault-tolerant folder")
        current = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (never used before:
    drivers on different machines may share a pid, so the name is random)."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Queries that run inside remove their shuffle files when they end, not when the
    driver next collects garbage: many passes in a row hold the disk of one.  For
    results that are collected; a DataFrame kept for later would shuffle again."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def local_session(app: str = "tidemark", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Remove reliable-checkpoint files once their DataFrame is garbage.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    if not SparkConf().get("spark.checkpoint.dir", None):
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidemark-ckpt-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


SPREAD_ROWS = 100_000


def spread(df, min_partitions: int | None = None, rows: int | None = SPREAD_ROWS):
    """Round-robin ``df`` over at least ``min_partitions`` partitions (default:
    the cluster's parallelism), and over as many as hold ``rows`` rows each, when it
    has fewer -- for CPU-heavy per-row work (JSON parsing) on inputs that arrive in
    few files.  Small rows of a compact file can become long ones: a task that sorts
    them holds its share, which must not grow with the input.  Without ``rows``
    they are not counted.  A no-op when the input is already split finer."""
    n = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    n = max(n, -(-df.count() // rows)) if rows else n
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df
