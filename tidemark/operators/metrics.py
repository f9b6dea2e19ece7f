"""Reports over producer results, metrics, metadata and topic settings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.headers import header
from .records import lookup
from .windows import index_percentiles, seconds_between

# Error classes a writer may retry.
RETRIABLE = ["NOT_ENOUGH_REPLICAS", "DEADLINE_EXCEEDED"]

# Topic settings per workload profile.
PROFILES = {
    "cdc": {
        "cleanup.policy": "compact",
        "retention.ms": "-1",
        "min.insync.replicas": "2",
        "compression.type": "zstd",
        "max.message.bytes": "2097152",
        "min.cleanable.dirty.ratio": "0.1",
        "unclean.leader.election.enable": "false",
        "message.timestamp.type": "CreateTime",
    },
    "metrics": {
        "cleanup.policy": "delete",
        "retention.ms": "86400000",
        "segment.ms": "600000",
        "segment.bytes": "134217728",
        "min.insync.replicas": "2",
        "compression.type": "lz4",
        "max.message.bytes": "1048576",
        "unclean.leader.election.enable": "false",
        "message.timestamp.type": "LogAppendTime",
    },
    "events": {
        "cleanup.policy": "delete",
        "retention.ms": "604800000",
        "segment.ms": "86400000",
        "min.insync.replicas": "2",
        "compression.type": "lz4",
        "max.message.bytes": "1048576",
        "unclean.leader.election.enable": "false",
        "message.timestamp.type": "CreateTime",
    },
}


def latency_summary(df: DataFrame) -> DataFrame:
    """Sent, failed, elapsed, throughput and exact latency percentiles per scenario."""
    base = df.groupBy("scenario").agg(
        F.count_if("ok").alias("sent"),
        F.count_if(~F.col("ok")).alias("failed"),
        F.round(seconds_between(F.min("ts"), F.max("ts")), 6).alias("elapsed_s"),
        F.max(F.when(F.col("ok"), F.col("latency_us"))).alias("max_us"),
    )
    points = {"p50_us": 0.5, "p99_us": 0.99, "p999_us": 0.999}
    exact = index_percentiles(df.filter("ok"), ["scenario"], "latency_us", points)
    rate = F.when(F.col("elapsed_s") > 0, F.round(F.col("sent") / F.col("elapsed_s"), 6)).otherwise(F.lit(0.0))
    return base.join(exact, "scenario", "left").withColumn("throughput", rate)


def latency_summary_approx(df: DataFrame, accuracy: int = 10000) -> DataFrame:
    """The same percentiles as mergeable sketches, one shuffle for any value range."""
    return df.filter("ok").groupBy("scenario").agg(
        F.percentile_approx("latency_us", [0.5, 0.99, 0.999], accuracy).alias("percentiles_us")
    )


def error_class_counts(df: DataFrame) -> DataFrame:
    """Failures per class, sorted by class, and whether a writer may retry them."""
    return (
        df.filter(~F.col("ok"))
        .groupBy("error")
        .agg(F.count("*").alias("n"))
        .withColumn("retriable", F.col("error").isin(RETRIABLE))
        .orderBy("error")
    )


def topic_bytes(dirs: DataFrame, mode: str = "one") -> DataFrame:
    """Bytes per topic: ``one`` counts the first replica of each partition, ``all`` every replica."""
    if mode == "all":
        return dirs.groupBy("topic").agg(F.sum("bytes").alias("bytes"))
    first = dirs.groupBy("topic", "partition").agg(F.min_by("bytes", "broker").alias("bytes"))
    return first.groupBy("topic").agg(F.sum("bytes").alias("bytes"))


def cluster_summary(meta: DataFrame) -> DataFrame:
    return meta.agg(
        F.countDistinct("topic").alias("topics"),
        F.count("*").alias("partitions"),
        F.count_if(F.size("isr") < F.size("replicas")).alias("under_replicated"),
    )


def missing_replicas(meta: DataFrame) -> DataFrame:
    """Replicas outside the in-sync set, sorted, for under-replicated partitions."""
    missing = F.array_sort(F.array_except("replicas", "isr"))
    return meta.filter(F.size("isr") < F.size("replicas")).select(
        "topic", "partition", F.array_join(missing.cast("array<string>"), ",").alias("missing")
    )


def inventory_counts(metrics: DataFrame, committed: DataFrame) -> DataFrame:
    """Number of topics and groups, total bytes and bytes per topic at the last sample."""
    last = metrics.groupBy("topic").agg(F.max_by("bytes", "ts").alias("bytes"))
    topics = last.agg(F.count("*").alias("topics"), F.sum("bytes").alias("log_bytes"))
    wide = topics.select(F.expr("stack(2, 'topics', topics, 'log_bytes', log_bytes) AS (metric, value)"))
    groups = committed.agg(F.countDistinct("group_id").alias("value")).select(F.lit("groups").alias("metric"), "value")
    per_topic = last.select(F.concat(F.lit("bytes:"), "topic").alias("metric"), F.col("bytes").alias("value"))
    return wide.unionByName(groups).unionByName(per_topic)


def retained_records(metrics: DataFrame) -> DataFrame:
    """High minus low water mark per topic at the last sample."""
    last = metrics.groupBy("topic").agg(F.max_by(F.struct("high_water", "low_water"), "ts").alias("m"))
    return last.select("topic", (F.col("m.high_water") - F.col("m.low_water")).alias("retained"))


def capacity_plan(load: DataFrame, nodes: int) -> DataFrame:
    """Partitions for the peak rate with 30 and 50 % headroom and disk per cluster and node."""
    need = F.ceil(F.col("msgs_per_s") / F.col("worker_rate"))
    disk = (
        F.col("msgs_per_s") * F.col("bytes_per_msg") * F.col("retention_s") * F.col("rf") / F.col("ratio")
    )
    return load.select(
        "topic",
        need.cast("long").alias("partitions"),
        F.ceil(need * 13 / 10).cast("long").alias("partitions_30"),
        F.ceil(need * 15 / 10).cast("long").alias("partitions_50"),
        F.round(disk / 1e9, 6).alias("disk_gb"),
        F.round(disk / 1e9 / nodes, 6).alias("node_gb"),
    )


# How settings read for people: kind, text, units in it, and whether only whole multiples use it. The first that fits counts.
UNITS = [
    ("time", "%.0fd", 86_400_000, True),
    ("time", "%.0fh", 3_600_000, True),
    ("time", "%.0fm", 60_000, True),
    ("time", "%.0fs", 1_000, True),
    ("time", "%.0fms", 1, False),
    ("bytes", "%.1f GB", 1 << 30, False),
    ("bytes", "%.0f MB", 1 << 20, False),
    ("bytes", "%.0f KB", 1 << 10, False),
    ("bytes", "%.0f B", 1, False),
]
KINDS = {"retention.ms": "time", "segment.ms": "time", "retention.bytes": "bytes", "segment.bytes": "bytes", "max.message.bytes": "bytes"}
ENDLESS = ["retention.ms", "segment.ms", "retention.bytes"]


def setting_text(setting: Column, value: Column) -> Column:
    """A setting for people: durations as ``7d`` or ``10m``, sizes as ``128 MB``, -1 as no limit."""
    kind, number = lookup(setting, KINDS, F.lit(None).cast("string")), value.try_cast("bigint")
    units = F.array(*[
        F.struct(F.lit(k).alias("kind"), F.lit(t).alias("text"), F.lit(n).cast("long").alias("n"), F.lit(w).alias("whole"))
        for k, t, n, w in UNITS
    ])

    def fits(unit: Column) -> Column:
        enough = (number >= unit["n"]) | ((unit["n"] == 1) & (number == 0))
        return (unit["kind"] == kind) & enough & (~unit["whole"] | (number % unit["n"] == 0))

    unit = F.get(F.filter(units, fits), F.lit(0))
    text = F.call_function("format_string", unit["text"], number.cast("double") / unit["n"])
    return F.when((value == "-1") & setting.isin(ENDLESS), "no limit").otherwise(F.when(unit.isNotNull(), text).otherwise(value))


def profile_rows(spark: SparkSession) -> DataFrame:
    """The profiles as rows; their number is fixed above."""
    rows = ", ".join(f"('{p}', '{s}', '{v}')" for p, settings in PROFILES.items() for s, v in settings.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS v(profile, setting, value)")


def profile_table(profiles: DataFrame) -> DataFrame:
    """Settings side by side, one column per profile."""
    return profiles.groupBy("setting").pivot("profile", sorted(PROFILES)).agg(F.first("value"))


def profile_value(profile: Column, setting: Column) -> Column:
    """The value a profile asks for, as an expression over the fixed table."""
    table = {f"{p}/{s}": v for p, settings in PROFILES.items() for s, v in settings.items()}
    return lookup(F.concat(profile, F.lit("/"), setting), table, F.lit(None).cast("string"))


def profile_check(configs: DataFrame) -> DataFrame:
    """Settings of topics that differ from their profile, with both values as text."""
    expected = profile_value(F.col("profile"), F.col("setting"))
    compared = configs.withColumn("expected", expected).filter(~F.col("value").eqNullSafe(F.col("expected")))
    return compared.select(
        "topic",
        "profile",
        "setting",
        setting_text(F.col("setting"), F.col("expected")).alias("expected"),
        setting_text(F.col("setting"), F.col("value")).alias("actual"),
    )


TRACEPARENT = "^[0-9a-f]{2}-([0-9a-f]{32})-[0-9a-f]{16}-[0-9a-f]{2}$"


def trace_header_audit(log: DataFrame) -> DataFrame:
    """Valid, invalid and missing trace headers per topic, distinct trace ids, missing correlation ids.

    Trace ids are counted through one row per id, not by collecting a set.
    """
    parent = header("headers", "traceparent")
    trace_id = F.nullif(F.regexp_extract(parent, TRACEPARENT, 1), F.lit(""))
    rows = log.select(
        "topic",
        parent.alias("parent"),
        trace_id.alias("trace_id"),
        header("headers", "correlation-id").isNull().cast("long").alias("no_corr"),
    )
    per_id = rows.groupBy("topic", "trace_id").agg(
        F.count("*").alias("n"), F.count_if(F.col("parent").isNull()).alias("absent"), F.sum("no_corr").alias("no_corr")
    )
    known = F.col("trace_id").isNotNull()
    return per_id.groupBy("topic").agg(
        F.sum("n").alias("records"),
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("valid"),
        F.coalesce(F.sum(F.when(~known, F.col("n") - F.col("absent"))), F.lit(0)).alias("invalid"),
        F.sum("absent").alias("missing"),
        F.count_if(known).alias("trace_ids"),
        F.sum("no_corr").alias("missing_correlation"),
    )
