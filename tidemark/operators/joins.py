"""Joins and keyed merges: dedup gates, read views, reconciliation and table lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key in order; combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("r")
    return df.groupBy(*keys).agg(first).select(*keys, "r.*").select(*df.columns)


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("r")
    return df.groupBy(*keys).agg(last).select(*keys, "r.*").select(*df.columns)


def dedup_gate(
    batch: DataFrame, processed: DataFrame, ident: str = "outbox_id", consumer: str = "consumer", order: str = "offset"
) -> DataFrame:
    """Rows whose id the consumer sees for the first time, within the batch and against the processed set."""
    first = first_per_key(batch, [consumer, ident], [order])
    return first.join(processed.select(consumer, ident), [consumer, ident], "left_anti")


def gate_counts(batch: DataFrame, passed: DataFrame, consumer: str = "consumer") -> DataFrame:
    """Processed, inserted and skipped per consumer."""
    total = batch.groupBy(consumer).agg(F.count("*").alias("processed"))
    new = passed.groupBy(consumer).agg(F.count("*").alias("inserted"))
    inserted = F.coalesce("inserted", F.lit(0))
    return total.join(new, consumer, "left").select(
        consumer, "processed", inserted.alias("inserted"), (F.col("processed") - inserted).alias("skipped")
    )


def merge_upsert(target: DataFrame, batch: DataFrame, pk: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Target after an insert-or-update by primary key; ``keep`` columns are not touched on conflict.

    The batch holds one row per key. One union and one aggregation replace the
    full outer join: rank 1 is the stored row, rank 2 the new one.
    """
    columns = target.columns
    both = target.withColumn("__rank", F.lit(1)).unionByName(batch.select(*columns).withColumn("__rank", F.lit(2)))
    picks = []
    for name in columns:
        if name == pk:
            continue
        pick = F.min_by if name in keep else F.max_by
        picks.append(pick(F.struct(name), "__rank")[name].alias(name))
    return both.groupBy(pk).agg(*picks).select(*columns)


def upsert_sink(target: DataFrame, batch: DataFrame, pk: str, order: str = "offset") -> DataFrame:
    """Insert or overwrite by primary key; of two rows of one key in the batch the later one wins."""
    return merge_upsert(target, last_per_key(batch, [pk], [order]).drop(order), pk)


def upsert_delete_sink(target: DataFrame, batch: DataFrame, pk: str, deleted: Column, order: str = "offset") -> DataFrame:
    """As :func:`upsert_sink`, and a key whose last batch row is a deletion leaves the target."""
    last = last_per_key(batch.withColumn("__del", deleted), [pk], [order])
    rest = target.join(last.select(pk), pk, "left_anti")
    return rest.unionByName(last.filter("NOT __del").select(*target.columns))


def parse_instant(text: Column) -> Column:
    """RFC 3339 text as a timestamp, null when it does not parse."""
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ssX"))


def project_read_view(events: DataFrame, processed: DataFrame, view: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Read table after the events and the rows whose creation time does not parse.

    Rows pass the dedup gate first; ``created_at`` of an existing row stays.
    """
    parsed = events.withColumn("created_ts", parse_instant(F.col("created_at")))
    errors = parsed.filter("created_ts IS NULL").drop("created_ts")
    good = parsed.filter("created_ts IS NOT NULL").drop("created_at").withColumnRenamed("created_ts", "created_at")
    passed = dedup_gate(good, processed)
    batch = last_per_key(
        passed.select("id", "customer_id", "amount_cents", "currency", "status", "created_at", "outbox_id"),
        ["id"],
        ["outbox_id"],
    )
    return merge_upsert(view, batch.drop("outbox_id"), "id", keep=("created_at",)), errors


def reserve_inventory(events: DataFrame, existing: DataFrame) -> DataFrame:
    """One reservation per order however often its event is delivered; the node of the first delivery stays."""
    first = first_per_key(events.select("order_id", "node", "offset"), ["order_id"], ["offset"])
    return first.join(existing.select("order_id"), "order_id", "left_anti")


def reconcile(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Row counts of both sides, whether they match, and the keys missing on each side.

    One union and one grouping give all five numbers.
    """
    tagged = source.select(F.col(key).alias("k"), F.lit(1).alias("s"), F.lit(0).alias("t")).union(
        target.select(F.col(key).alias("k"), F.lit(0).alias("s"), F.lit(1).alias("t"))
    )
    per_key = tagged.groupBy("k").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    out = per_key.agg(
        F.coalesce(F.sum("s"), F.lit(0)).alias("source_rows"),
        F.coalesce(F.sum("t"), F.lit(0)).alias("target_rows"),
        F.count_if((F.col("s") > 0) & (F.col("t") == 0)).alias("missing_in_target"),
        F.count_if((F.col("t") > 0) & (F.col("s") == 0)).alias("missing_in_source"),
    )
    return out.withColumn("match", F.col("source_rows") == F.col("target_rows"))


def row_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """Rows of one side beyond those of the other, with multiplicity: one grouping for both directions."""
    columns = source.columns
    tagged = source.withColumn("__d", F.lit(1)).unionByName(target.select(*columns).withColumn("__d", F.lit(-1)))
    diff = tagged.groupBy(*columns).agg(F.sum("__d").alias("d")).filter("d <> 0")
    side = F.when(F.col("d") > 0, "source").otherwise("target")
    return diff.select(*columns, side.alias("side"), F.abs("d").alias("copies"))


def outbox_gaps(orders: DataFrame, outbox: DataFrame) -> DataFrame:
    """Business rows without an outbox row and the reverse; both are empty when the write is atomic."""
    a = orders.select(F.col("id").alias("order_id"), F.lit(1).alias("__a"), F.lit(0).alias("__b"))
    b = outbox.select(F.col("aggregate_id").alias("order_id"), F.lit(0).alias("__a"), F.lit(1).alias("__b"))
    per_id = a.union(b).groupBy("order_id").agg(F.sum("__a").alias("__a"), F.sum("__b").alias("__b"))
    # One union and one grouping; a missing id equals no other, and repeated rows stay repeated.
    alone = per_id.filter("__a = 0 OR __b = 0 OR order_id IS NULL")
    copies = F.concat(F.array_repeat(F.lit("outbox"), F.col("__a").cast("int")), F.array_repeat(F.lit("orders"), F.col("__b").cast("int")))
    return alone.select("order_id", F.explode(copies).alias("missing_in"))


def stream_table_join(events: DataFrame, table: DataFrame, key: str, table_key: str) -> DataFrame:
    """Enrich events with the current row of a keyed table; works on a stream and on a table.

    No broadcast hint: the planner broadcasts a table below its threshold, and
    splits hot keys of a shuffled join otherwise.
    """
    return events.join(table.withColumnRenamed(table_key, key), key, "left")
