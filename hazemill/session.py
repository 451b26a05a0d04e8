"""Session settings and the shared folder for files that jobs hand to each other."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A side whose partitions all turn out small is hashed, not sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.parquet.compression.codec": "snappy",
    # Open windows of many stations live outside the JVM heap; a checkpoint holds changes.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# On a cluster shuffles start from many partitions and are merged to the advised size
# once their real sizes are known; scans read in larger pieces.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4000",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def build_session(app: str = "hazemill", **extra: str) -> SparkSession:
    """Session with the settings the operators expect (UTC, adaptive execution).

    Whatever ``spark-submit`` or ``extra`` sets wins (underscores stand for dots:
    ``spark_master="local[8]"``).
    """
    given = SparkConf()
    chosen = {key.replace("_", "."): value for key, value in extra.items()}
    master = chosen.get("spark.master", given.get("spark.master", "local"))
    defaults = SETTINGS if master.startswith("local") else {**SETTINGS, **CLUSTER_SETTINGS}
    builder = SparkSession.builder.appName(app)
    for key, value in defaults.items():
        if not given.contains(key):
            builder = builder.config(key, value)
    for key, value in chosen.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under ``spark.checkpoint.dir``, readable by every executor.

    Only a local session without that setting falls back to a temporary folder; on
    a cluster the setting is required, since a machine's own disk is not shared.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="hazemill-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
