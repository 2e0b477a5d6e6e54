"""Session settings and the shared scratch location.

Everything here is a plain Spark configuration: AQE re-plans joins and
coalesces partitions at runtime, splits skewed shuffle partitions, and the
broadcast threshold is the only size-checked broadcast path besides the
explicit hints on structurally bounded tables (class lists, weight grids).
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # commit only the state changes each batch (large state, frequent commits)
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "callscore") -> SparkSession:
    """Return the active session, or build a local one with DEFAULT_CONF."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app)
    master = master or os.environ.get("CALLSCORE_MASTER", "local[*]")
    b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions or _is_local(master):
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
    b = b.config("spark.driver.memory", os.environ.get("CALLSCORE_DRIVER_MEMORY", "16g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(master: str) -> bool:
    """One JVM: the driver's folders are the executors' folders."""
    return master == "local" or master.startswith("local[")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and materialised intermediates.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    filesystem), and it must be set. Only a local session gets a folder of
    this machine when it is unset (tests); the folder goes with the process.
    """
    conf = spark.sparkContext.getConf()
    d = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not _is_local(spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="callscore-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        atexit.register(shutil.rmtree, d, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared scratch root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
