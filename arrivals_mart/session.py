"""Session options and the shared scratch location.

Scratch data that belongs to no table (round-trip files, stream
checkpoints when none is given, ``DataFrame.checkpoint()``) goes below the
folder the cluster names in ``spark.checkpoint.dir``; staged table versions
go below the run's own output root. Only a local-mode session without that
setting gets a private temporary folder (registered as the checkpoint folder
too); a cluster session without it is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Options the plans rely on. AQE re-plans joins from runtime sizes, coalesces
# small shuffle partitions and splits skewed ones (joins and REBALANCE).
SESSION_DEFAULTS: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A join side is broadcast up to this size, by its files or as measured.
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    # Pieces of a split partition, and so files, are of this size in the shuffle.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # Past 2000 partitions Spark reports average sizes; a skewed one keeps its own.
    "spark.shuffle.accurateBlockSkewedFactor": "5",
    "spark.sql.session.timeZone": "UTC",
    # Partition directory values such as "001" must stay strings.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def build_session(
    app_name: str = "arrivals_mart",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create or reuse a session with :data:`SESSION_DEFAULTS` applied.

    On a cluster, pass no ``master`` and let ``spark-submit`` decide; size
    ``spark.sql.shuffle.partitions`` for the data (AQE coalesces down).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (set it if unset)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        # Local runs and tests only: no shared folder is configured.
        root = tempfile.mkdtemp(prefix="arrivals_mart-")
        spark.sparkContext.setCheckpointDir(root)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared root."""
    return f"{shared_root(spark)}/arrivals_mart/{name}-{uuid.uuid4().hex}"
