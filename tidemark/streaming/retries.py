"""The retry chain as streams: one per stage, each with its own state, timers, checkpoint and table.

A stage reads what the stages before it sent to its topic, keeps every record until its delay is over, calls the handler
with the record's retry count and appends the outcome to its table. Records to be tried again are the next stage's
input, so the handler runs once per stage and each stage can be stopped and started on its own. Tables are written by
the file sink and read through its log, so a batch that runs again is seen once by the next stage.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.headers import header
from ..operators.reliability import Handler, Stage, handle_stage
from ..schema import RECORD
from .runner import finish, state_partitions

ARRIVED = T.StructType([*RECORD.fields, T.StructField("at", T.TimestampType())])
HANDLED = T.StructType([
    *ARRIVED.fields, T.StructField("cls", T.StringType()), T.StructField("message", T.StringType()),
    T.StructField("target", T.StringType()), T.StructField("outcome", T.StringType())])


class Hold(StatefulProcessor):
    """Keeps the records of one due time and shard, and gives them out when its timer rings.

    Grouping by due time makes one timer and one list per group instead of per record. The list is read as an iterator
    and never held whole; shards bound what one group gets.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.records = handle.getListState("records", ARRIVED)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        first = not self.records.exists()
        part: list[tuple] = []
        for row in rows:
            part.append(tuple(row[name] for name in ARRIVED.fieldNames()))
            if len(part) == 1000:
                self.records.appendList(part)
                part = []
        if part:
            self.records.appendList(part)
        if first:
            self.handle.registerTimer(key[0])
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        for record in self.records.get():
            yield Row(**dict(zip(ARRIVED.fieldNames(), record, strict=True)))
        self.records.clear()

    def close(self) -> None:
        pass


def when_due(arrived: DataFrame, stage: Stage, shards: int = 64) -> DataFrame:
    """Records once their stage delay is over by the clock of the trigger; those already due pass without state."""
    if not stage.delay_s:
        return arrived
    due_ms = (F.unix_timestamp("at") + stage.delay_s) * 1000
    waiting = due_ms > F.unix_millis(F.current_timestamp())
    shard = F.pmod(F.xxhash64("topic", "partition", "offset"), F.lit(shards))
    grouped = arrived.filter(waiting).withColumns({"due_ms": due_ms, "shard": shard}).groupBy("due_ms", "shard")
    held = grouped.transformWithState(
        statefulProcessor=Hold(), outputStructType=ARRIVED, outputMode="Append", timeMode="ProcessingTime")
    return arrived.filter(~waiting).unionByName(held)


def _table(path: str, k: int) -> str:
    return f"{path}/stage-{k}"


def _prepare(spark: SparkSession, folder: str) -> None:
    """Make a folder, so that a later stage can start on a table nothing was written to yet."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(where)


@contextmanager
def clocked(spark: SparkSession) -> Iterator[None]:
    """Start a query that ends when its input ends; otherwise one with timers goes on with empty batches for ever."""
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def tick(spark: SparkSession, path: str) -> None:
    """One row that no stage takes: it makes every stage run a batch, and so look at its timers, without new records."""
    spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in ARRIVED.fields]).write.mode("append").parquet(f"{path}/ticks")


def start_stage(
    source: DataFrame, stages: list[Stage], k: int, path: str, dlq: str, handler: str | Handler, trigger: dict
) -> StreamingQuery:
    """Start stage ``k``: records of ``source`` on its topic and what earlier stages sent to it."""
    spark, stage = source.sparkSession, stages[k]
    columns = ARRIVED.fieldNames()
    _prepare(spark, f"{path}/ticks")
    arrived = source.withColumn("at", F.col("timestamp")).select(*columns)
    arrived = arrived.unionByName(spark.readStream.schema(ARRIVED).parquet(f"{path}/ticks")).filter(F.col("topic") == stage.topic)
    for j, earlier in enumerate(stages[:k]):
        if earlier.next_topic == stage.topic:
            sent = spark.readStream.schema(HANDLED).parquet(_table(path, j)).filter("outcome = 'retry'")
            arrived = arrived.unionByName(sent.withColumn("topic", F.col("target")).select(*columns))
    out = handle_stage(when_due(arrived, stage), stages, dlq, handler).select(*HANDLED.fieldNames())
    _prepare(spark, _table(path, k))
    writer = out.writeStream.format("parquet").outputMode("append").partitionBy("outcome").option("path", _table(path, k))
    with state_partitions(spark):
        return writer.option("checkpointLocation", f"{path}/checkpoint-{k}").trigger(**trigger).start()


def run_stages(
    source: DataFrame, stages: list[Stage], path: str, dlq: str, handler: str | Handler = "payment",
    only: range | None = None,
) -> None:
    """Run the stages in order over what is there; what is not due yet waits in their state for the next run.

    ``stages`` are in chain order, a record never goes back to an earlier one. ``only`` runs some of them. For a
    service start every stage with :func:`start_stage` and a processing-time trigger instead.
    """
    tick(source.sparkSession, path)
    with clocked(source.sparkSession):
        for k in range(len(stages)) if only is None else only:
            finish(start_stage(source, stages, k, path, dlq, handler, {"availableNow": True}))


def retried(spark: SparkSession, stages: list[Stage], path: str, dlq: str) -> DataFrame:
    """Records that reached an end, in the columns of ``operators.reliability.retry_pipeline``."""
    parts = [spark.read.schema(HANDLED).parquet(_table(path, k)).filter("outcome <> 'retry'") for k in range(len(stages))]
    done = parts[0]
    for p in parts[1:]:
        done = done.unionByName(p)
    return done.select(
        *[c for c in RECORD.fieldNames() if c not in ("topic", "headers")],
        F.coalesce(header("headers", "original.topic"), F.col("topic")).alias("source_topic"),
        F.when(F.col("outcome") == "dlq", F.lit(dlq)).otherwise(F.col("topic")).alias("final_topic"),
        "outcome", "headers", "cls", "message", "at")
