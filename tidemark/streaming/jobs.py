"""The streaming jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import cdc, records, sagas
from ..operators.joins import last_per_key
from ..operators.words import top_n_words, word_count
from ..schema import USER_IMAGE
from ..sources.rules import RuleSet
from ..sources.sinks import append_versioned
from .runner import batch_table, read_batches, write_batch


def stream_dedup(stream: DataFrame, keys: list[str], time: str, horizon: str) -> DataFrame:
    """Drop repeats of an id within a horizon of event time."""
    return stream.withWatermark(time, horizon).dropDuplicatesWithinWatermark(keys)


def periodic_top_n(stream: DataFrame, n: int, path: str, checkpoint: str) -> StreamingQuery:
    """Snapshot of the top n words per trigger; a lost snapshot is replaced by the next one."""
    write = write_batch(path)
    return batch_table(word_count(stream), lambda df, i: write(top_n_words(df, n), i), checkpoint, "complete")


def exactly_once_pipeline(
    stream: DataFrame, path: str, checkpoint: str, fail_after: int | None = None
) -> StreamingQuery:
    """Enrich records so that each input row has one visible output row after a crash.

    The checkpoint fixes the rows of a batch and the batch folder is replaced
    as a whole. ``fail_after`` raises once a batch of that number is written.
    """
    write = write_batch(path)

    def run(df: DataFrame, batch_id: int) -> None:
        write(df, batch_id)
        if batch_id == fail_after:
            raise RuntimeError(f"stopped after writing batch {batch_id}")

    return batch_table(stream, run, checkpoint)


def materialize_table(stream: DataFrame, path: str, checkpoint: str, key: str, order: str) -> StreamingQuery:
    """Current-state table from a keyed log, merged on read.

    Each batch appends its last row per key; :func:`read_materialized`
    collapses the batches, so no batch rewrites the table.
    """
    write = write_batch(path)
    keyed = stream.filter(F.col(key).isNotNull())
    return batch_table(keyed, lambda df, i: write(last_per_key(df, [key], [order]), i), checkpoint)


def read_materialized(spark: SparkSession, path: str, schema, key: str, order: str, value: str) -> DataFrame:
    """Rows alive in a materialized table: the last per key, tombstoned keys left out."""
    rows = read_batches(spark, path, schema).drop("batch_id")
    return last_per_key(rows, [key], [order]).filter(F.col(value).isNotNull())


def cdc_anonymize_stream(
    changes: DataFrame, rules: RuleSet, table: str, path: str, side: str, checkpoint: str
) -> StreamingQuery:
    """Anonymize change rows and append all versions per target; malformed rows go to a side table.

    Stateless, so a batch is one pass over its rows. Unlike the rows the rules
    skip on purpose, malformed ones are kept with their cause.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        parsed = cdc.split_malformed(cdc.parse_cdc(df, USER_IMAGE))
        good = cdc.anonymize(cdc.cdc_row_image(parsed), rules, table, USER_IMAGE)
        append_versioned(good, path, batch_id)
        write_batch(side)(parsed.filter("cause IS NOT NULL").select("topic", "partition", "key", "value", "cause"), batch_id)

    return batch_table(changes, write, checkpoint)


def cdc_anonymize_all_stream(
    changes: DataFrame, rules: RuleSet, images: dict[str, T.StructType], path: str, checkpoint: str
) -> StreamingQuery:
    """Anonymize the change rows of all tables: one read, one parse and one write per batch.

    The write is partitioned by outcome and target; a batch that runs again replaces its own folders.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        rows = cdc.anonymize_tables(df, rules, images).withColumn("batch_id", F.lit(batch_id).cast("long"))
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("outcome", "target_topic", "batch_id").parquet(path)

    return batch_table(changes, write, checkpoint)


def read_target(
    spark: SparkSession, path: str, rules: RuleSet, images: dict[str, T.StructType], table: str
) -> DataFrame:
    """Anonymized rows of one table, all versions, with the columns its rules keep; reads that target's folders only."""
    stored = spark.read.parquet(path).filter((F.col("outcome") == "row") & (F.col("target_topic") == rules.tables[table].target_topic))
    return stored.select("topic", "partition", "offset", "key", *cdc.kept_fields(rules, table, images[table]), "cdc_lsn", "_deleted")


def router_stream(notifications: DataFrame, node: str) -> DataFrame:
    """Routed notifications with the counters ``routed`` and ``dead_lettered`` as observed metrics."""
    routed = records.route_by_channel(notifications, node)
    dead = F.col("destination") == records.ROUTER_DLQ
    return routed.observe("router", F.count_if(~dead).alias("routed"), F.count_if(dead).alias("dead_lettered"))


def late_side_output(
    stream: DataFrame, size_s: int, tolerance_s: int, path: str, marks: str, checkpoint: str
) -> StreamingQuery:
    """Split off rows whose window was final before their batch, in one write partitioned by ``late_arrival``.

    A row is late against the batches before its own. The highest event time of a batch is an observed metric of its
    write; it is kept in a table of one row per batch, of which a batch reads the one before its own.
    """
    size, tolerance = size_s * 1_000_000, tolerance_s * 1_000_000

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        us = F.unix_micros("event_ts")
        before = spark.read.schema("mark long").parquet(f"{marks}/batch_id={batch_id - 1}").first().mark if batch_id else None
        mark = F.lit(before).cast("long")
        late = F.coalesce(us - F.pmod(us, F.lit(size)) + size <= mark - tolerance, F.lit(False))
        highest = Observation(f"highest-{batch_id}")
        flagged = df.withColumn("late_arrival", late).observe(highest, F.max(us).alias("mark"))
        flagged.write.mode("overwrite").partitionBy("late_arrival").parquet(f"{path}/batch_id={batch_id}")
        found = [m for m in (before, highest.get["mark"]) if m is not None]
        own = spark.range(1).select(F.lit(max(found) if found else None).cast("long").alias("mark"))
        own.write.mode("overwrite").parquet(f"{marks}/batch_id={batch_id}")

    return batch_table(stream, write, checkpoint)


def read_late_output(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows that :func:`late_side_output` wrote, with ``late_arrival``; a filter on it reads one side only."""
    own = T.StructType([*schema.fields, T.StructField("late_arrival", T.BooleanType()), T.StructField("batch_id", T.LongType())])
    return spark.read.schema(own).parquet(path).drop("batch_id")


def progress_lag(query: StreamingQuery, total: int) -> list[tuple[int, int, int, int]]:
    """Batch, input rows, processed rows so far and backlog per trigger of a query over ``total`` rows."""
    rows, processed = [], 0
    for p in query.recentProgress:
        if p.numInputRows:
            processed += p.numInputRows
            rows.append((p.batchId, p.numInputRows, processed, max(total - processed, 0)))
    return rows


SAGA_STATE = T.StructType(
    [
        T.StructField(n, T.LongType() if n in ("amount_cents", "commands") else T.StringType())
        for n in (
            "customer_id", "amount_cents", "step", "status", "last_event", "payment_id", "reservation_id",
            "shipment_id", "failure_reason", "commands", "last_command",
        )
    ]
)


def apply_message(current: dict | None, m) -> dict | None:
    """State after one message; the first place-order opens a saga, replies before it are skipped.

    The rules one by one, as a service applies them; :func:`saga_orchestrator_stream` gives the same state by aggregates.
    """
    opening = m.kind == "place-order"
    if opening == (current is not None):
        return current
    effect = sagas.EFFECTS.get((m.kind, m.action, bool(m.ok)))
    if effect is None:
        return current
    if opening:
        current = dict.fromkeys(SAGA_STATE.fieldNames())
        current |= {"customer_id": m.customer_id, "amount_cents": int(m.amount_cents), "commands": 0}
    step, status, event, command = effect
    current |= {"step": step, "status": status, "last_event": event}
    for name, action in sagas.ID_OF.items():
        if m.action == action and m.ok:
            current[name] = m.id
    prefix = sagas.FAILURE_PREFIX.get((m.kind, m.action))
    if prefix is not None and not m.ok:
        current["failure_reason"] = prefix + m.reason
    elif m.action == "REFUND" and current["failure_reason"] is None:
        current["failure_reason"] = ""
    if command:
        current |= {"commands": current["commands"] + 1, "last_command": command}
    return current


def saga_orchestrator_stream(messages: DataFrame) -> DataFrame:
    """Keyed state per saga in the RocksDB store; emits the state row of every saga a batch touches."""
    return sagas.saga_orchestrator_running(messages)
