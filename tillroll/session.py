"""Session construction and the shared checkpoint folder.

On a cluster the session is created by the platform; ``configure`` only sets
what the library relies on (AQE, skew-join splitting, UTC) and never
overrides ``spark.checkpoint.dir`` when the cluster already names one.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators are designed around.  AQE re-plans joins with
# runtime sizes (broadcast only what is measured small), splits skewed
# shuffle partitions, and coalesces the many tiny partitions of small
# aggregates.  On a cluster, also start shuffles wide enough for the input
# (``spark.sql.shuffle.partitions`` or
# ``spark.sql.adaptive.coalescePartitions.initialPartitionNum`` around
# shuffle bytes / 128 MB); AQE then coalesces what turns out small.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # target size of a post-shuffle partition after AQE coalescing/splitting
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}
# Only for sessions built here: results do not depend on the session time
# zone (all timestamps are zone-less), so an existing session keeps its own.
OWN_SESSION_CONF = {"spark.sql.session.timeZone": "UTC"}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tillroll") -> SparkSession:
    """Create (or reuse) a session.  ``master`` is only for local runs/tests."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = (builder.master(master)
                   .config("spark.ui.enabled", "false")
                   .config("spark.ui.showConsoleProgress", "false")
                   .config("spark.driver.memory", os.environ.get("TILLROLL_DRIVER_MEMORY", "16g")))
    for key, value in {**RUNTIME_CONF, **OWN_SESSION_CONF}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply runtime settings to an existing session (idempotent)."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession, required: bool = True) -> str | None:
    """The shared folder for lineage cuts and materialised tables.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir).  Only a local-mode session without one (tests) gets a
    fresh scratch folder; a cluster must name a shared folder itself
    (``required=False`` returns None instead of raising).
    """
    sc = spark.sparkContext
    # the configured folder itself (stable across sessions, so tables written
    # by one job are found by the next); the context's own checkpoint dir is
    # a per-application subfolder of it
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not (configured or sc.getCheckpointDir()):
        if sc.master != "local" and not sc.master.startswith("local["):
            if not required:
                return None
            raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for this cluster")
        configured = tempfile.mkdtemp(prefix="tillroll-ckpt-")  # one process: its own folder is shared by all
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured or sc.getCheckpointDir()
