"""Session set-up and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_local_base: str | None = None


def build_session(
    master: str | None = None, app: str = "lotflow", shuffle_partitions: int | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with the settings the engine expects; on a cluster leave ``master`` unset."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for name, value in (conf or {}).items():
        builder = builder.config(name, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session time zone: event text is read and written in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def streaming_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A sister session for stateful queries.

    The number of state partitions is fixed for the life of a checkpoint, so it is set here
    (default: the cores of the cluster) and not left to the batch setting.
    """
    session = prepare(spark.newSession())
    partitions = state_partitions or spark.sparkContext.defaultParallelism
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return session


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``.

    Only a local master, where driver and executors share one disk, may fall back on a
    temporary folder.
    """
    global _local_base
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        _local_base = _local_base or tempfile.mkdtemp(prefix="lotflow-")
        base = _local_base
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
