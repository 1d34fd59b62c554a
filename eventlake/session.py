"""Session settings the event tables rely on.

* Session time zone UTC: day boundaries, display of timestamps.
* ``nanosAsLong``: pandas writes ``datetime64[ns]`` as Parquet
  TIMESTAMP(NANOS), which Spark refuses unless it may read it as a long.
* AQE on, with skew handling, so that hot keys and hot days are split at
  run time.

``configure`` sets what the jobs' results depend on, and the preferences only
where the caller has not set them. ``scoped`` leaves the caller's session
alone: it gives a session of its own with the caller's settings and these.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    # Spark 4's default; strict parsing (an impossible day in a file name
    # raises) depends on it
    "spark.sql.ansi.enabled": "true",
}

PREFERRED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings every job of this package needs."""
    for key, value in REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    for key, value in PREFERRED.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def scoped(spark: SparkSession) -> SparkSession:
    """A session of its own on the same application, with the caller's settings
    and those of this package."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    return configure(own)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "eventlake") -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("EVENTLAKE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**REQUIRED, **PREFERRED}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def staging_root(spark: SparkSession) -> str:
    """Shared folder for staged intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir``; on a cluster it must be set.
    Only a local master (tests) gets a fresh local folder, which is then
    registered as the checkpoint directory.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="eventlake-ckpt-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")
