"""Session helper: the settings every pulsegrid job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# All epoch arithmetic is done on ts_ns BIGINT; timestamps shown to users are UTC.
_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Sizing for the large-cluster target (~100 TB input, ~1000 executors). Shuffle partitions
# are an upper bound that AQE coalesces to ~256 MB; scans split files at 512 MB; a shuffle
# partition 5x the median and above 512 MB counts as skewed and is split by AQE; broadcast
# is decided on runtime sizes below 64 MB; stateful streaming keeps state in RocksDB.
CLUSTER_PROFILE = {
    "spark.sql.shuffle.partitions": "16000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(app: str = "pulsegrid", master: str | None = None,
                shuffle_partitions: int | None = None, extra: dict | None = None,
                profile: str | None = None) -> SparkSession:
    """Session with pulsegrid's defaults; ``profile="cluster"`` adds CLUSTER_PROFILE."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**_DEFAULTS, **(CLUSTER_PROFILE if profile == "cluster" else {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    let_workers_import(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Timestamps are derived from epoch nanoseconds; pin the session zone."""
    if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def is_local(spark: SparkSession) -> bool:
    """Driver and workers share this machine (``local[...]``, ``local-cluster[...]``)."""
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment must set it (a shared file system): each machine would see only
    its own files of a local folder, so none is made up there. In local mode a private one is."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="pulsegrid-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    d = checkpoint_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def let_workers_import(spark: SparkSession) -> None:
    """In local masters, Python workers find this source tree as the driver does.

    On a cluster the package is installed, or submitted with ``--py-files``; nothing is shipped here."""
    if not is_local(spark):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
