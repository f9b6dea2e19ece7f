"""Outbox tables: reading, publishing and routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.headers import header_list

EVENT_PREFIX = "events."


def read_unpublished(outbox: DataFrame, limit: int) -> DataFrame:
    """First ``limit`` unpublished rows by id; the filter reaches the scan, the limit is a top-k."""
    return outbox.filter(F.col("published_at").isNull()).orderBy("id").limit(limit)


def mark_published(outbox: DataFrame, ids: DataFrame, now: Column) -> DataFrame:
    """Outbox with ``published_at`` set for the batch; fails unless the batch touches as many rows as it has ids.

    So an id that is not in the table, or is given twice, fails the job, and no row is doubled. The counts are compared
    by a scalar subquery on every row that leaves it.
    """
    marks = ids.groupBy("id").agg(F.count("*").alias("__given"))
    joined = outbox.join(marks, "id", "left")
    counts = marks.join(outbox.groupBy("id").agg(F.count("*").alias("__rows")), "id", "left").agg(
        F.sum("__given") - F.sum(F.coalesce("__rows", F.lit(0)))
    )
    apart = F.coalesce(counts.scalar(), F.lit(0))
    stamp = F.when(F.col("__given") > 0, now).otherwise(F.col("published_at"))
    text = F.concat(F.lit("ids given and rows touched differ by "), apart.cast("string"))
    checked = F.when(apart != 0, F.raise_error(text))
    return joined.withColumn("published_at", F.coalesce(checked.cast("timestamp"), stamp)).select(*outbox.columns)


def outbox_to_records(outbox: DataFrame, node: str) -> DataFrame:
    """Outbox rows as log records with their headers."""
    body = F.from_json("payload", "struct<trace_id:string,tenant_id:string>")
    rows = outbox.withColumn("__body", body)
    return rows.select(
        "topic",
        F.col("aggregate_id").alias("key"),
        F.col("payload").alias("value"),
        header_list(
            {
                "outbox-id": F.col("id"),
                "aggregate-id": F.col("aggregate_id"),
                "publisher-node": F.lit(node),
                "trace-id": F.col("__body.trace_id"),
                "tenant-id": F.col("__body.tenant_id"),
                "event-type": F.lit("order.created"),
                "content-type": F.lit("application/json"),
            }
        ).alias("headers"),
    )


def outbox_event_router(changes: DataFrame) -> DataFrame:
    """Inserted outbox rows as domain events on ``events.<aggregate type>``; deletes give nothing."""
    return changes.filter(F.col("op").isin("c", "r")).select(
        F.concat(F.lit(EVENT_PREFIX), "aggregate_type").alias("topic"),
        F.col("aggregate_id").alias("key"),
        F.col("payload").alias("value"),
        header_list({"eventType": F.col("type"), "aggregateType": F.col("aggregate_type")}).alias("headers"),
    )
