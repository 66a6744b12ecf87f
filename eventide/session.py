"""Spark session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every query in this package relies on. Timestamps are compared with an oracle that
# has no zone, so the session zone is pinned to UTC; AQE re-plans joins and coalesces
# shuffle partitions at run time; RocksDB is the state store the stateful processors need.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "eventide") -> SparkSession:
    """Return the active session, or build one with the package defaults.

    On a cluster the session already exists and its settings win; locally (tests, bench) we
    build a ``local[N]`` session.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("EVENTIDE_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def cluster_cores(spark: SparkSession) -> int:
    """Task slots of the cluster (``defaultParallelism``); where the session exposes no
    SparkContext, the configured shuffle partitions stand in."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # sessions without a local SparkContext
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def tune_for_input(spark: SparkSession, input_bytes: int,
                   target_partition_bytes: int = 256 << 20) -> None:
    """Size shuffles for an input of ``input_bytes``: enough initial shuffle partitions that
    each holds ~``target_partition_bytes`` (AQE then coalesces small ones; it cannot split
    big ones), and scan splits of the same size. E.g. 100 TB -> ~400k partitions."""
    parts = max(cluster_cores(spark), input_bytes // target_partition_bytes)
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(parts))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_partition_bytes))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(target_partition_bytes))


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the per-session SQL settings the queries rely on, on a session built elsewhere:
    UTC session time (event times are zone-less; epoch arithmetic must not shift). Queries that
    write intermediate tables ask for the checkpoint folder themselves."""
    if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keyed-state processors (transformWithState) need the RocksDB state store; set it for
    queries started from now on unless the session already chose a provider."""
    current = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    if not current or "HDFSBackedStateStoreProvider" in current:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and materialised intermediate tables.

    Read ``spark.checkpoint.dir`` from the session (the cluster names a shared folder there).
    Only when it is unset -- local tests and the bench -- do we create one of our own.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster "
                             "(a machine-local folder does not survive a lost executor)")
        # local mode only (tests, bench): the driver's disk is the whole cluster
        conf = tempfile.mkdtemp(prefix="eventide-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(conf)
    return conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one job's outputs."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
