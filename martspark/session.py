"""Spark session settings the marts rely on.

The library never creates a session on its own inside an operator; callers
(tests, bench, the driver) pass one in.  ``prepare`` only fills in settings the
operators need for deterministic results (UTC clock, AQE); it never overrides a
value a cluster operator has already set, except the time zone, which the
month/day arithmetic depends on.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Bytes in the hash table of a broadcast for each byte of its compressed files.
EXPANSION = 40

# Settings applied when they are not already present in the session.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Catalyst estimates scans from compressed files, in which a million keys are 1 MB
    # and a hash table of 43 MB, which the driver builds: it is told to expect so much
    # more, whatever threshold the session has.  The two limits below then mean bytes
    # in memory; explicit broadcasts go through plans.broadcast.small()
    "spark.sql.sources.fileCompressionFactor": str(EXPANSION),
    "spark.sql.autoBroadcastJoinThreshold": str(EXPANSION * 256 * 1024),
    # joins planned anew at run time know the sizes shuffled; several such hash tables
    # may be in the driver at once
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(256 * 1024),
}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session clock to UTC and enable AQE where unset."""
    conf = spark.conf
    conf.set("spark.sql.session.timeZone", "UTC")
    for key, value in _DEFAULTS.items():
        try:
            current = conf.get(key, None)
        except Exception:  # pragma: no cover - conf lookups on remote sessions
            current = None
        if current is None:
            conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the operator sets this to a shared file system; without it
    nothing can be staged safely, so that is an error.  Only a local session
    (one machine) gets a scratch folder of its own where the setting is unset.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "local")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="martspark-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    return configured


def session_key(spark: SparkSession) -> str:
    """Identity of the application behind a session (caches are keyed by it)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # Spark Connect: no SparkContext on the client
        return f"session-{id(spark)}"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "martspark", event_log_dir: str | None = None) -> SparkSession:
    """Session for tests and the local benchmark (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("MARTSPARK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if event_log_dir:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)
