"""A current-state table that every batch merges into: hash buckets, and a manifest that names the version of each.

A batch rewrites the buckets it touches into a folder of its own and then writes a manifest, one row per bucket. Readers
take the newest complete manifest, so a batch that fails between the two shows nothing and its folder is replaced when
it runs again. Folders that neither the newest manifest nor the one before it names are removed, so neither the table
nor the cost of reading it grows with the number of batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.joins import last_per_key
from .runner import batch_table


def _folder(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _versions(spark: SparkSession, path: str, part: str, complete: bool = False) -> list[int]:
    """Version numbers below a part of the table, oldest first; ``complete`` leaves out folders without a success mark."""
    fs, where = _folder(spark, f"{path}/{part}")
    if not fs.exists(where):
        return []
    out = []
    for status in fs.listStatus(where):
        name = status.getPath().getName()
        if name.startswith("version="):
            done = not complete or fs.exists(_folder(spark, f"{path}/{part}/{name}/_SUCCESS")[1])
            if done:
                out.append(int(name.split("=")[1]))
    return sorted(out)


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict[int, int]:
    """Version of every bucket that holds rows, by the newest complete manifest or a given one. One row per bucket."""
    if version is None:
        versions = _versions(spark, path, "manifest", complete=True)
        if not versions:
            return {}
        version = versions[-1]
    rows = spark.read.schema("bucket int, holds long").parquet(f"{path}/manifest/version={version}")
    return {r.bucket: r.holds for r in rows.collect()}


def read_merged(spark: SparkSession, path: str, schema: T.StructType, buckets: list[int] | None = None) -> DataFrame:
    """Last row of every key, tombstones included, in some buckets or all."""
    held = manifest(spark, path)
    folders = [f"{path}/data/version={v}/bucket={b}" for b, v in sorted(held.items()) if buckets is None or b in buckets]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def merge_batch(path: str, schema: T.StructType, key: str, order: str, buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """Batch writer that merges the last row per key into the table.

    The later row by ``order`` wins, also against what the table holds, so a batch that runs twice changes nothing.
    Tombstones stay as rows, so that an older row that comes late does not bring its key back.
    """
    bucket_of = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        keyed = df.filter(F.col(key).isNotNull()).select(*schema.fieldNames())
        # The latest version before this one; on a rerun that of this batch may be there already.
        earlier = [v for v in _versions(spark, path, "manifest", complete=True) if v < batch_id]
        held = manifest(spark, path, earlier[-1]) if earlier else {}
        new = last_per_key(keyed, [key], [order])
        touched = [r.b for r in new.select(bucket_of.alias("b")).distinct().collect()]  # at most one per bucket
        old = [f"{path}/data/version={held[b]}/bucket={b}" for b in sorted(touched) if b in held]
        if old:
            new = new.unionByName(spark.read.schema(schema).parquet(*old))
        # One task per bucket, and no further shuffle for the grouping.
        rows = new.withColumn("bucket", bucket_of).repartition("bucket")
        rest = [c for c in schema.fieldNames() if c != key]
        last = rows.groupBy("bucket", key).agg(F.max_by(F.struct(*rest), F.struct(order)).alias("r"))
        last.select("bucket", key, "r.*").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/data/version={batch_id}")
        now = held | dict.fromkeys(touched, batch_id)
        listed = spark.createDataFrame(sorted(now.items()), "bucket int, holds long").coalesce(1)
        listed.write.mode("overwrite").parquet(f"{path}/manifest/version={batch_id}")
        clean(spark, path)

    return write


def clean(spark: SparkSession, path: str) -> None:
    """Remove what neither of the two newest manifests names; readers that began on the one before can finish."""
    versions = _versions(spark, path, "manifest", complete=True)
    keep = versions[-2:]
    named = {(v, b) for m in keep for b, v in manifest(spark, path, m).items()}
    last = keep[-1] if keep else -1
    for v in _versions(spark, path, "data"):
        if v > last:
            continue  # a batch that has not finished
        fs, where = _folder(spark, f"{path}/data/version={v}")
        for status in fs.listStatus(where):
            name = status.getPath().getName()
            if name.startswith("bucket=") and (v, int(name.split("=")[1])) not in named:
                fs.delete(status.getPath(), True)
        if not any(held == v for held, _ in named):
            fs.delete(where, True)
    for v in versions[:-2]:
        fs, where = _folder(spark, f"{path}/manifest/version={v}")
        fs.delete(where, True)


def merged_table(stream: DataFrame, path: str, checkpoint: str, key: str, order: str, buckets: int = 64) -> StreamingQuery:
    """Current-state table from a keyed log, merged by every batch; read it with :func:`read_merged`."""
    return batch_table(stream, merge_batch(path, stream.schema, key, order, buckets), checkpoint)
