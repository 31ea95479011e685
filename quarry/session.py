"""Session construction and shared scratch locations.

Scratch data (snapshots, stream checkpoints, re-encoded fixtures) always lives
under the cluster's shared checkpoint directory (``spark.checkpoint.dir``), never
under a machine-local temp folder.  Only when the session has no checkpoint
directory at all (unit tests, local runs) do we create one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults tuned for a large cluster; local runs override shuffle partitions.
_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Broadcast only what Spark has measured below this size (AQE re-checks
    # at runtime from shuffle statistics).
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.forceDeleteTempCheckpointLocation": "true",
}


def build_session(master: str | None = None, app: str = "quarry",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with AQE, skew handling and UTC time."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in _DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Return the shared checkpoint directory, creating one only if unset."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if root:
            sc.setCheckpointDir(root)
    if not root:
        # Unset: make our own, but only where one machine runs everything.
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="quarry-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique directory under the shared checkpoint root.

    Each call returns a new path, so a re-run (or a retried job) never
    collides with an earlier one and nothing has to be cleared first.
    """
    root = checkpoint_root(spark)
    # Not created here: Spark writers create it (and refuse an existing one).
    return f"{root.rstrip('/')}/quarry/{label}-{uuid.uuid4().hex[:12]}"
