"""Starting streams and reading what they wrote."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.joins import last_per_key
from ..session import work_dir


@contextmanager
def state_partitions(spark: SparkSession) -> Iterator[None]:
    """On a local master, start a query with no more state partitions than cores.

    Their number is fixed by the first start of a checkpoint. On a cluster the
    session's setting stands, since cores may still be joining.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    if spark.sparkContext.master.startswith("local"):
        spark.conf.set(name, str(min(int(before), spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def append_table(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append-mode stream into a parquet table; the sink's own log makes it exactly once."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    with state_partitions(stream.sparkSession):
        return writer.start()


def write_batch(path: str) -> Callable[[DataFrame, int], None]:
    """Batch writer keyed by batch id: a batch that runs again replaces its own folder."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def batch_table(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    writer = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    with state_partitions(stream.sparkSession):
        return writer.start()


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for an available-now query; a failure raises."""
    query.awaitTermination()
    return query


def appended(stream: DataFrame, name: str) -> DataFrame:
    """Run an append stream over what is there and return the table it wrote."""
    spark = stream.sparkSession
    path, schema = work_dir(spark, name), stream.schema
    finish(append_table(stream, path, work_dir(spark, f"{name}-checkpoint")))
    return spark.read.schema(schema).parquet(path)


def read_batches(spark: SparkSession, path: str, schema) -> DataFrame:
    """All batches below ``path`` with their ``batch_id``."""
    with_id = schema.add("batch_id", "long") if "batch_id" not in schema.fieldNames() else schema
    return spark.read.schema(with_id).parquet(path)


def updated(stream: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """Run an update stream and return the last row per key; the table itself is the changelog."""
    spark = stream.sparkSession
    path, columns, schema = work_dir(spark, name), stream.columns, stream.schema
    finish(batch_table(stream, write_batch(path), work_dir(spark, f"{name}-checkpoint"), "update"))
    return last_per_key(read_batches(spark, path, schema), keys, ["batch_id"]).select(*columns)


def last_snapshot(spark: SparkSession, path: str, schema) -> DataFrame:
    """The newest batch of a table of snapshots."""
    rows = read_batches(spark, path, schema)
    newest = rows.agg(F.max("batch_id")).scalar()
    return rows.filter(F.col("batch_id") == newest).drop("batch_id")
