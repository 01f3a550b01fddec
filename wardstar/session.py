"""Session settings and the shared folder that written tables go to."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# By how much Spark takes the rows of a table to be larger than its files.
COMPRESSION = "spark.sql.sources.fileCompressionFactor"
# Run-time settings every job relies on. Broadcasts are left to Spark: a side is
# broadcast only when its planned or measured size is under
# spark.sql.autoBroadcastJoinThreshold, and a shuffle join is used beyond it. A planned
# broadcast is not taken back if the side turns out large, so it must not be planned by the
# size of compressed files: an id among its neighbours takes one byte in a file, 16 in a row
# and 45 in the driver's hash table. With the factor, 10 MB planned are up to 100 MB there.
RUNTIME_CONF = {
    COMPRESSION: "6.0",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

_local_dirs: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "wardstar", cores: str | int | None = None) -> SparkSession:
    """A local session for tests and the bench."""
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", os.environ.get("WARDSTAR_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, one per application.

    The cluster names it in spark.checkpoint.dir. Only a local session without that
    setting gets a temporary folder; on a cluster its absence is an error, because
    a machine-local folder is lost with its executor.
    """
    app_id = spark.sparkContext.applicationId
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if app_id not in _local_dirs:
            _local_dirs[app_id] = tempfile.mkdtemp(prefix="wardstar-")
        base = _local_dirs[app_id]
    return f"{base.rstrip('/')}/wardstar/{app_id}"
