"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job wants, whatever the cluster. Memory is left to the cluster;
# partition counts follow the input (:func:`sized_for`) and AQE.
BASE_CONF = {
    # Event timestamps without an offset are read as UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Windowed state beyond executor memory: keep it in RocksDB and upload only
# the changes of each micro-batch.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str, conf: dict[str, str] | None = None) -> SparkSession:
    """Session with :data:`BASE_CONF`; the master comes from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Where it is unset a local session gets a temporary folder; on a cluster a
    folder of one machine would lose data with that machine, so that is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    # "local" or "local[...]"; "local-cluster[...]" has executors of its own.
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError(
            "spark.checkpoint.dir is not set: name a folder shared by all executors"
        )
    return tempfile.mkdtemp(prefix="rateweave-")


def new_scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below :func:`shared_dir`; it is not created here."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let iterative jobs cut their lineage in the shared folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))


MB = 1 << 20
# Input per shuffle partition and per scan task, unless the job says otherwise.
PARTITION_BYTES = 128 * MB
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"


def scan_bytes(scan: DataFrame) -> int:
    """Size of the files behind a frame that only reads, from their metadata."""
    return int(str(scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def partition_plan(
    size: int, shuffle_partitions: int, partition_bytes: int = PARTITION_BYTES
) -> dict[str, str]:
    """Settings for an input of ``size`` bytes.

    AQE merges shuffle partitions that turn out small but cannot split those of
    an aggregation, so it must start with enough of them: one per
    ``partition_bytes``, whatever the size, and not fewer than
    ``shuffle_partitions``. A larger value trades memory for fewer shuffle blocks.
    """
    return {
        INITIAL_PARTITIONS: str(max(shuffle_partitions, -(-size // partition_bytes))),
        SPLIT_BYTES: str(partition_bytes),
    }


@contextmanager
def sized_for(
    *scans: DataFrame, partition_bytes: int = PARTITION_BYTES, size: int | None = None
) -> Iterator[None]:
    """Partition what runs inside for the size of ``scans``; restores the settings.

    Give ``size`` in bytes where the plan's statistics cannot be asked, such as
    through a remote session.
    """
    conf = scans[0].sparkSession.conf
    total = sum(map(scan_bytes, scans)) if size is None else size
    shuffle_partitions = int(conf.get("spark.sql.shuffle.partitions"))
    plan = partition_plan(total, shuffle_partitions, partition_bytes)
    before = {key: conf.get(key, None) for key in plan}
    for key, value in plan.items():
        conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                conf.unset(key)
            else:
                conf.set(key, value)
