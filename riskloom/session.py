"""Session settings the operators are written for, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings: they can be set on a session somebody else has started.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # A hot key in a join is split by map output, also where the split costs an
    # extra shuffle afterwards (for example a join followed by a group-by on the key).
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Copies of one row compress well, so a hot partition looks smaller than it is.
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3.0",
    # Sessions of a stream are merged in every task before they are shuffled by key.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # The state of a stream may outgrow the memory of the executors; tests run the same provider.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def is_local(spark: SparkSession) -> bool:
    return spark.conf.get("spark.master", "").startswith("local")


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def build_session(app: str = "riskloom", master: str | None = None, **settings: str) -> SparkSession:
    """Start a session; on a cluster ``master`` comes from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name that every executor can reach.

    The parent is ``spark.checkpoint.dir``. Only a local session may go without
    that setting, because only there driver and executors share one disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster")
        base = tempfile.mkdtemp(prefix="riskloom-")
    return f"{base.rstrip('/')}/riskloom/{spark.conf.get('spark.app.id', 'app')}/{label}-{uuid.uuid4().hex}"
