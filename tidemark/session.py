"""Session settings and the shared working folder used by streaming jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings every job relies on. Broadcasts are left to the planner, which only
# broadcasts below spark.sql.autoBroadcastJoinThreshold, and to AQE.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Merge sessions before the shuffle, so a busy key ships sessions, not rows.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # State of all streams on local disk with changelog checkpoints instead of the JVM heap.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the session defaults and return the session."""
    for name, value in DEFAULTS.items():
        spark.conf.set(name, value)
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one job below the shared folder of ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder is used, which only a
    local master can see on every worker; anything else is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
    return f"{base.rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where several results need one parse or one expensive shuffle. The
    table outlives executor loss, unlike a cache or a local checkpoint.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def size_shuffles(spark: SparkSession, shuffled_bytes: int, target_bytes: int = 128 << 20) -> int:
    """Shuffle partitions for an amount of shuffled data, so that one fits into a task's memory.

    Call it before a large job. AQE merges partitions that turn out small but
    never makes more of them, so the starting number has to be high enough.
    """
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(current, -(-shuffled_bytes // target_bytes))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))
    return wanted


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores where the input has fewer splits than there are.

    For work that is heavy per byte on a small input, such as one file with one
    row group. An input with enough splits stays as it is and is not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
