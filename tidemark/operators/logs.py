"""State of a log: latest values, compaction, retention, offsets and skew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import key_partition, worker_for
from ..functions.names import PREMIUM_PREFIX, premium_partition
from ..sources.log import salted_key
from .running import PLACES, row_numbers, running

MICROS = 1_000_000


def latest_by_key(log: DataFrame, key: str = "key", order: str = "offset", value: str = "value") -> DataFrame:
    """Last record per key without the keys whose last value is a tombstone.

    ``max_by`` is combined before the shuffle, so a hot key costs one row per task.
    """
    rest = [c for c in log.columns if c != key]
    last = log.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("r"))
    return last.filter(F.col(f"r.{value}").isNotNull()).select(key, "r.*")


def compaction_stats(log: DataFrame) -> DataFrame:
    """Records, live keys, tombstoned keys and heartbeat records of a compacted log."""
    beat = F.col("key").startswith("__") & (F.length("key") > 2)
    per_key = (
        log.withColumn("beat", F.coalesce(beat, F.lit(False)))
        .groupBy("key", "beat")
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.col("value").isNull() & F.col("key").isNotNull()).alias("dead"),
            F.max_by(F.struct(F.col("value").isNotNull().alias("live")), "offset").alias("last"),
        )
    )
    counted = F.col("key").isNotNull() & ~F.col("beat")
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("records"),
        F.count_if(counted & F.col("last.live")).alias("live_keys"),
        F.coalesce(F.sum(F.when(counted, F.col("dead"))), F.lit(0)).alias("tombstones"),
        F.coalesce(F.sum(F.when(F.col("beat"), F.col("n"))), F.lit(0)).alias("heartbeats"),
    )


def dirty_ratio(log: DataFrame, size: Column, threshold: float = 0.5) -> DataFrame:
    """Share of records and bytes per topic that are not the last of their key."""
    per_key = (
        log.filter("key IS NOT NULL")
        .select("topic", "key", "offset", size.cast("long").alias("size"))
        .groupBy("topic", "key")
        .agg(F.count("*").alias("n"), F.sum("size").alias("size"), F.max_by("size", "offset").alias("kept"))
    )
    out = per_key.groupBy("topic").agg(
        F.sum("n").alias("records"),
        F.count("*").alias("kept_records"),
        F.sum("size").alias("bytes"),
        F.sum("kept").alias("kept_bytes"),
    )
    return out.withColumn("dirty_records", F.round(1 - F.col("kept_records") / F.col("records"), 6)).withColumn(
        "dirty_bytes", F.round(1 - F.col("kept_bytes") / F.col("bytes"), 6)
    ).withColumn("cleanable", F.col("dirty_bytes") >= threshold)


def compact(log: DataFrame, now: Column, min_lag_s: int, delete_retention_s: int) -> DataFrame:
    """Log after compaction.

    Records younger than ``min_lag_s`` all stay. Of the older ones the last per
    key stays, as a tombstone only while younger than ``delete_retention_s``.
    The last offsets come from an aggregate and are joined back on the record
    coordinates, which are unique, so no key gathers in one task.
    """
    aged = log.withColumn("age_s", F.unix_timestamp(now) - F.unix_timestamp("ts"))
    young = aged.filter(F.col("age_s") < min_lag_s)
    old = aged.filter((F.col("age_s") >= min_lag_s) & F.col("key").isNotNull())
    last = old.groupBy("topic", "partition", "key").agg(F.max("offset").alias("offset")).drop("key")
    kept = old.join(last, ["topic", "partition", "offset"], "left_semi")
    kept = kept.filter(F.col("value").isNotNull() | (F.col("age_s") < delete_retention_s))
    return young.unionByName(kept).drop("age_s")


def retain(log: DataFrame, now: Column, max_age_s: int, max_bytes: int) -> DataFrame:
    """Records newer than ``max_age_s`` that are among the newest ``max_bytes`` of their partition."""
    sized = running(
        log, ["topic", "partition"], ["offset"], {"newest_bytes": ("sum", F.col("bytes"))}, descending=True, span=PLACES
    )
    fresh = F.unix_timestamp(now) - F.unix_timestamp("timestamp") <= max_age_s
    return sized.filter(fresh & (F.col("newest_bytes") <= max_bytes))


def assign_offsets(df: DataFrame, n: int, order: str = "seq") -> DataFrame:
    """Partition by key hash, then dense offsets per partition in arrival order."""
    placed = df.withColumn("partition", key_partition("key", n))
    return row_numbers(placed, ["partition"], [order]).withColumn("offset", F.col("rn") - 1).drop("rn")


def round_robin(df: DataFrame, n: int, order: str = "seq") -> DataFrame:
    """Premium keys to partition 0, regular rows in turn to partitions 1 and 2."""
    regular = F.when(F.col("key").startswith(PREMIUM_PREFIX), F.lit(0)).otherwise(F.lit(1)).cast("long")
    ranked = running(df, [], [order], {"regular_rank": ("sum", regular)})
    return ranked.withColumn("partition", premium_partition("key", "regular_rank", n)).drop("regular_rank")


def partition_distribution(log: DataFrame) -> DataFrame:
    return log.groupBy("topic", "partition").agg(F.count("*").alias("records"))


def key_partition_check(log: DataFrame) -> DataFrame:
    """Partitions each key was written to and whether it is exactly one."""
    per_pair = log.groupBy("key", "partition").agg(F.count("*").alias("n"))
    return per_pair.groupBy("key").agg(
        F.sum("n").alias("records"),
        F.count("*").alias("partitions"),
        F.array_join(F.array_sort(F.collect_set("partition")).cast("array<string>"), ",").alias("partition_list"),
        (F.count("*") == 1).alias("one_partition"),
    )


def priority_partition_check(df: DataFrame, order: str = "seq") -> DataFrame:
    """One-row verdict on the priority rule: premium only in 0, no regular in 0, 1 and 2 balanced."""
    premium = F.col("key").startswith(PREMIUM_PREFIX)
    p = F.col("partition")
    counts = round_robin(df, 3, order).agg(
        F.count("*").alias("total"),
        F.count_if(premium).alias("premium"),
        F.count_if(~premium).alias("regular"),
        F.count_if(premium & (p != 0)).alias("premium_elsewhere"),
        F.count_if(~premium & (p == 0)).alias("regular_in_0"),
        F.count_if(~premium & (p == 1)).alias("regular_in_1"),
        F.count_if(~premium & (p == 2)).alias("regular_in_2"),
    )
    both = F.col("regular_in_1") + F.col("regular_in_2")
    bound = F.greatest(F.lit(5), F.floor(both / 20))
    return counts.withColumn("premium_ok", F.col("premium_elsewhere") == 0).withColumn(
        "regular_ok", F.col("regular_in_0") == 0
    ).withColumn("balanced", F.abs(F.col("regular_in_1") - F.col("regular_in_2")) <= bound)


def skew_report(deltas: DataFrame, group: list[str], part: str, hot_share: float = 80.0) -> DataFrame:
    """Share and bar length per partition; the input is one row per partition, not the log."""
    w = Window.partitionBy(*group)
    total, most = F.sum("delta").over(w), F.max("delta").over(w)
    share = F.when(total > 0, F.col("delta") / total * 100).otherwise(F.lit(0.0))
    bar = F.when(most > 0, F.floor(F.col("delta") / most * 40)).otherwise(F.lit(0)).cast("long")
    return deltas.select(
        *group, part, "delta", F.round(share, 6).alias("share_pct"), bar.alias("bar"), (share >= hot_share).alias("hot")
    )


def offset_table(log: DataFrame) -> DataFrame:
    """Earliest, latest and retained per partition with a TOTAL row per topic."""
    per = log.groupBy("topic", "partition").agg(
        F.min("offset").alias("lo"), (F.max("offset") + 1).alias("hi")
    )
    total = F.grouping("partition") == 1
    return (
        per.groupingSets([["topic", "partition"], ["topic"]], "topic", "partition")
        .agg(
            F.when(total, F.lit("TOTAL")).otherwise(F.first("partition").cast("string")).alias("label"),
            F.when(~total, F.min("lo")).alias("earliest"),
            F.when(~total, F.max("hi")).alias("latest"),
            F.sum(F.col("hi") - F.col("lo")).alias("retained"),
        )
        .drop("partition")
    )


def hot_keys(log: DataFrame, k: int) -> DataFrame:
    """The k heaviest keys with their share of their partition and of the topic."""
    per_key = log.groupBy("topic", "partition", "key").agg(F.count("*").alias("records"))
    # Taken from the same grouping, whose shuffle is then reused: the log is read once.
    per_part = per_key.groupBy("topic", "partition").agg(F.sum("records").alias("part_records"))
    per_topic = per_part.groupBy("topic").agg(F.sum("part_records").alias("topic_records"))
    # Top k first: the shares need k rows only.
    top = per_key.orderBy(F.desc("records"), "topic", "partition", "key").limit(k)
    same = lambda other, *names: [F.col(f"k.{n}").eqNullSafe(F.col(f"{other}.{n}")) for n in names]
    # Null-safe, since a filter on missing values would make the reused plans differ.
    joined = top.alias("k").join(per_part.alias("p"), same("p", "topic", "partition")).join(per_topic.alias("t"), same("t", "topic"))
    return joined.select(
        "k.topic",
        "k.partition",
        "key",
        "records",
        F.round(F.col("records") / F.col("part_records") * 100, 6).alias("partition_pct"),
        F.round(F.col("records") / F.col("topic_records") * 100, 6).alias("topic_pct"),
    )


def salt_hot_keys(log: DataFrame, hot: list[str], buckets: int, ident: str) -> DataFrame:
    """Spread each hot key over buckets by the hash of the payload id; other keys stay."""
    bucket = worker_for(f"cast({ident} AS string)", buckets)
    return log.withColumn("key", salted_key(F.col("key"), hot, bucket))


def remap_impact(keys: DataFrame, n_old: int, n_new: int) -> DataFrame:
    """Share of keys and records that change partition when the partition count grows."""
    per_key = keys.groupBy("key").agg(F.count("*").alias("n"))
    moved = key_partition("key", n_old) != key_partition("key", n_new)
    return per_key.select("n", moved.cast("long").alias("moved")).agg(
        F.count("*").alias("keys"),
        F.sum("moved").alias("moved_keys"),
        F.sum("n").alias("records"),
        F.sum(F.col("n") * F.col("moved")).alias("moved_records"),
        F.round(F.sum("moved") / F.count("*"), 6).alias("key_share"),
        F.round(F.sum(F.col("n") * F.col("moved")) / F.sum("n"), 6).alias("record_share"),
    )


def consumer_lag(committed: DataFrame) -> DataFrame:
    """Lag per group, topic and partition; a group without commits has no rows."""
    return committed.withColumn("lag", F.col("end_offset") - F.col("committed"))


def total_lag(lag: DataFrame) -> DataFrame:
    """Positive lag per group; a committed offset past the end adds nothing."""
    return lag.groupBy("group_id").agg(F.sum(F.greatest("lag", F.lit(0))).alias("lag"))


def lag_by_group(lag: DataFrame, yellow: int = 1000, red: int = 10000) -> DataFrame:
    out = lag.groupBy("group_id", "topic").agg(F.sum(F.greatest("lag", F.lit(0))).alias("lag"))
    level = F.when(F.col("lag") >= red, "red").when(F.col("lag") >= yellow, "yellow").otherwise("green")
    return out.withColumn("severity", level)


def pending_records(log: DataFrame, committed: DataFrame) -> DataFrame:
    """Every group's own copy of the records at or above its committed offset."""
    starts = committed.select("group_id", "topic", "partition", "committed")
    return log.join(starts, ["topic", "partition"]).filter(F.col("offset") >= F.col("committed")).drop("committed")


def commit_frontier(done: DataFrame) -> DataFrame:
    """First offset per partition not done in the unbroken run from the first one seen.

    The frontier is the smallest done offset plus one that is not done itself:
    an anti join on unique coordinates instead of an ordered scan of a partition.
    """
    after = done.select("partition", (F.col("offset") + 1).alias("offset"))
    gaps = after.join(done, ["partition", "offset"], "left_anti").groupBy("partition").agg(
        F.min("offset").alias("commit_offset")
    )
    seen = done.groupBy("partition").agg(
        F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"), F.count("*").alias("done")
    )
    return seen.join(gaps, "partition").withColumn(
        "held_back", F.col("done") - (F.col("commit_offset") - F.col("first_offset"))
    )


def offset_delta(snapshots: DataFrame) -> DataFrame:
    """End offset change between snapshots per partition and the duplicates beyond what was sent.

    Snapshots are one row per partition and sampling time.
    """
    w = Window.partitionBy("group_id", "topic", "partition").orderBy("day")
    delta = F.greatest(F.col("end_offset") - F.coalesce(F.lag("end_offset").over(w), F.lit(0)), F.lit(0))
    return snapshots.withColumn("delta", delta).withColumn(
        "duplicates", F.greatest(F.col("delta") - F.col("sent"), F.lit(0))
    )


def lag_trend(snapshots: DataFrame, last: int, hot_share: float = 0.6) -> DataFrame:
    """Per group whether lag grows, falls or is flat over the last snapshots and whether one partition holds it."""
    lag = F.greatest(F.col("end_offset") - F.col("committed"), F.lit(0))
    per_part = snapshots.withColumn("lag", lag).groupBy("group_id", "topic", "partition", "day").agg(
        F.sum("lag").alias("lag")
    )
    per_day = per_part.groupBy("group_id", "day").agg(F.sum("lag").alias("lag"), F.max("lag").alias("most"))
    by_day = Window.partitionBy("group_id").orderBy("day")
    back = Window.partitionBy("group_id").orderBy(F.desc("day"))
    steps = (
        per_day.withColumn("step", F.signum(F.col("lag") - F.lag("lag").over(by_day)))
        .withColumn("rn", F.row_number().over(back))
        .filter(F.col("rn") <= last)
    )
    out = steps.groupBy("group_id").agg(
        F.count_if(F.col("step") > 0).alias("ups"),
        F.count_if(F.col("step") < 0).alias("downs"),
        F.max_by("lag", "day").alias("lag"),
        F.max_by("most", "day").alias("most"),
    )
    trend = F.when(F.col("ups") > F.col("downs"), "growing").when(F.col("ups") < F.col("downs"), "falling")
    share = F.when(F.col("lag") > 0, F.col("most") / F.col("lag")).otherwise(F.lit(0.0))
    return out.select(
        "group_id",
        "lag",
        trend.otherwise("flat").alias("trend"),
        F.round(share, 6).alias("top_share"),
        F.when(share >= hot_share, "hot partition").otherwise("even").alias("shape"),
    )
