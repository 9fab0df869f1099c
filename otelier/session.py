"""Session set-up shared by jobs, tests and the benchmark."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators rely on for right results; all can be changed on a running session.
REQUIRED = {
    # nanoseconds are UTC instants; partitions and timestamps must not depend on the driver's zone
    "spark.sql.session.timeZone": "UTC",
    # attribute lists may repeat a key: the last one wins
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}

# Settings that matter for speed at scale; defaults of a current Spark, stated so that nobody turns them off by habit.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # splits a hot (trace, span) key of a join into several tasks
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # plans here hold thousands of expressions; recording the Python line of each takes half the time to build them
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators need to an existing session and return it."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "otelier", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session. `conf` keys use `__` for dots: spark__sql__shuffle__partitions="8"."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **REQUIRED}.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh directory in the cluster's shared checkpoint folder, for tables that cut lineage.

    The folder is the session's `spark.checkpoint.dir`. Only a local session without that setting (tests)
    falls back to a temporary folder; on a cluster such a folder would be invisible to the other machines.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="otelier-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
