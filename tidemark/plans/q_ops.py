"""Queries for operations: latency, errors, metrics, capacity and settings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.names import timestamp_text
from ..operators import metrics, windows
from .registry import query


@query(
    "a14_latency_summary",
    """WITH o AS (SELECT scenario, list_sort(list(latency_us)) AS xs FROM v_prod WHERE ok GROUP BY scenario),
            b AS (SELECT scenario, count(*) FILTER (ok) AS sent, count(*) FILTER (NOT ok) AS failed,
                    round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000, 6) AS elapsed_s, max(latency_us) FILTER (ok) AS max_us
                  FROM v_prod GROUP BY scenario)
       SELECT b.*, xs[floor((len(xs) - 1) * 0.5)::INT + 1] AS p50_us, xs[floor((len(xs) - 1) * 0.99)::INT + 1] AS p99_us,
              xs[floor((len(xs) - 1) * 0.999)::INT + 1] AS p999_us,
              CASE WHEN elapsed_s > 0 THEN round(sent / elapsed_s, 6) ELSE 0 END AS throughput
       FROM b LEFT JOIN o ON b.scenario = o.scenario""",
)
def _(t):
    return metrics.latency_summary(t.prod)


@query(
    "a15_error_class_counts",
    """SELECT error, count(*) AS n, error IN ('NOT_ENOUGH_REPLICAS', 'DEADLINE_EXCEEDED') AS retriable
       FROM v_prod WHERE NOT ok GROUP BY error""",
)
def _(t):
    return metrics.error_class_counts(t.prod)


@query(
    "a17_topic_bytes",
    """SELECT topic, 'one' AS mode, sum(b)::BIGINT AS bytes FROM (SELECT topic, "partition", arg_min(bytes, broker) AS b FROM v_dirs GROUP BY ALL) GROUP BY topic
       UNION ALL SELECT topic, 'all', sum(bytes)::BIGINT FROM v_dirs GROUP BY topic""",
)
def _(t):
    one = metrics.topic_bytes(t.dirs).withColumn("mode", F.lit("one"))
    return one.unionByName(metrics.topic_bytes(t.dirs, "all").withColumn("mode", F.lit("all")))


@query(
    "a18_cluster_summary",
    """SELECT count(DISTINCT topic) AS topics, count(*) AS partitions, count(*) FILTER (len(isr) < len(replicas)) AS under_replicated FROM v_meta""",
)
def _(t):
    return metrics.cluster_summary(t.meta)


@query(
    "u03_missing_replicas",
    """SELECT topic, "partition", array_to_string(list_sort(list_filter(replicas, lambda r: NOT list_contains(isr, r))), ',') AS missing
       FROM v_meta WHERE len(isr) < len(replicas)""",
)
def _(t):
    return metrics.missing_replicas(t.meta)


@query(
    "a20_inventory_counts",
    """WITH l AS (SELECT topic, arg_max(bytes, ts) AS bytes FROM v_metr GROUP BY topic)
       SELECT 'topics' AS metric, count(*) AS value FROM l
       UNION ALL SELECT 'log_bytes', sum(bytes)::BIGINT FROM l
       UNION ALL SELECT 'groups', count(DISTINCT group_id) FROM v_offs
       UNION ALL SELECT 'bytes:' || topic, bytes FROM l""",
)
def _(t):
    return metrics.inventory_counts(t.metr, t.offs)


@query(
    "a21_retained_records",
    "SELECT topic, arg_max(high_water - low_water, ts) AS retained FROM v_metr GROUP BY topic",
)
def _(t):
    return metrics.retained_records(t.metr)


LOAD_SQL = """SELECT topic, max(n) * 1000 / 3600 AS msgs_per_s, sum(b)::DOUBLE / sum(n) AS bytes_per_msg FROM (
                  SELECT topic, date_trunc('hour', timestamp) AS hour, count(*) AS n, sum(bytes) AS b FROM v_log GROUP BY ALL) GROUP BY topic"""


@query(
    "a26_capacity_plan",
    f"""SELECT topic, ceil(msgs_per_s / 800)::BIGINT AS partitions, ceil(ceil(msgs_per_s / 800) * 13 / 10)::BIGINT AS partitions_30,
               ceil(ceil(msgs_per_s / 800) * 15 / 10)::BIGINT AS partitions_50,
               round(msgs_per_s * bytes_per_msg * 604800 * 3 / 2.5 / 1e9, 6) AS disk_gb,
               round(msgs_per_s * bytes_per_msg * 604800 * 3 / 2.5 / 1e9 / 3, 6) AS node_gb
        FROM ({LOAD_SQL})""",
)
def _(t):
    hourly = t.log_rows.groupBy("topic", F.date_trunc("hour", "timestamp").alias("hour")).agg(
        F.count("*").alias("n"), F.sum("bytes").alias("b")
    )
    load = hourly.groupBy("topic").agg(
        (F.max("n") * 1000 / 3600).alias("msgs_per_s"), (F.sum("b").cast("double") / F.sum("n")).alias("bytes_per_msg")
    )
    sized = load.selectExpr("*", "800 AS worker_rate", "604800 AS retention_s", "3 AS rf", "2.5D AS ratio")
    return metrics.capacity_plan(sized, nodes=3)


PROFILE_VALUES = ", ".join(f"('{p}', '{s}', '{v}')" for p, d in metrics.PROFILES.items() for s, v in d.items())


def _text_sql(value: str) -> str:
    ms, size = f"({value})::BIGINT", f"({value})::BIGINT"
    return f"""CASE WHEN setting IN ('retention.ms', 'segment.ms', 'retention.bytes') AND {value} = '-1' THEN 'no limit'
        WHEN setting IN ('retention.ms', 'segment.ms') THEN
            CASE WHEN {ms} >= 86400000 AND {ms} % 86400000 = 0 THEN ({ms} // 86400000) || 'd'
                 WHEN {ms} >= 3600000 AND {ms} % 3600000 = 0 THEN ({ms} // 3600000) || 'h'
                 WHEN {ms} >= 60000 AND {ms} % 60000 = 0 THEN ({ms} // 60000) || 'm'
                 WHEN {ms} >= 1000 AND {ms} % 1000 = 0 THEN ({ms} // 1000) || 's' ELSE {value} || 'ms' END
        WHEN setting IN ('segment.bytes', 'max.message.bytes') THEN
            CASE WHEN {size} >= 1073741824 THEN printf('%.1f GB', {size} / 1073741824.0)
                 WHEN {size} >= 1048576 THEN printf('%.0f MB', {size} / 1048576.0)
                 WHEN {size} >= 1024 THEN printf('%.0f KB', {size} / 1024.0) ELSE {value} || ' B' END
        ELSE {value} END"""


@query(
    "a28_profile_check",
    f"""WITH t AS (SELECT topic, datediff('day', min(timestamp), max(timestamp)) AS days, max(bytes) AS biggest FROM v_log GROUP BY topic),
             p AS (SELECT * FROM (VALUES {PROFILE_VALUES}) v(profile, setting, expected)),
             a AS (SELECT topic, p.profile, setting, expected,
                     CASE WHEN setting = 'retention.ms' THEN (days * 86400000)::VARCHAR
                          WHEN setting = 'max.message.bytes' THEN (biggest * 65536)::VARCHAR
                          WHEN setting = 'compression.type' AND topic = 'events.error' THEN 'gzip' ELSE expected END AS value
                   FROM t JOIN p ON p.profile = CASE length(topic) % 3 WHEN 0 THEN 'cdc' WHEN 1 THEN 'metrics' ELSE 'events' END)
        SELECT topic, profile, setting, {_text_sql("expected")} AS expected, {_text_sql("value")} AS actual FROM a WHERE value <> expected""",
)
def _(t):
    observed = t.log_rows.groupBy("topic").agg(
        F.datediff(F.max("timestamp"), F.min("timestamp")).cast("long").alias("days"), F.max("bytes").alias("biggest")
    )
    profile = (
        F.when(F.length("topic") % 3 == 0, "cdc").when(F.length("topic") % 3 == 1, "metrics").otherwise("events")
    )
    settings = sorted({s for d in metrics.PROFILES.values() for s in d})
    configs = (
        observed.withColumn("profile", profile)
        .withColumn("setting", F.explode(F.array(*[F.lit(s) for s in settings])))
        .withColumn("asked", metrics.profile_value(F.col("profile"), F.col("setting")))
        .filter("asked IS NOT NULL")
        .withColumn(
            "value",
            F.when(F.col("setting") == "retention.ms", (F.col("days") * 86400000).cast("string"))
            .when(F.col("setting") == "max.message.bytes", (F.col("biggest") * 65536).cast("string"))
            .when((F.col("setting") == "compression.type") & (F.col("topic") == "events.error"), "gzip")
            .otherwise(F.col("asked")),
        )
    )
    return metrics.profile_check(configs)


@query(
    "a29_trace_header_audit",
    r"""WITH r AS (SELECT topic, traceparent, correlation_id,
                     nullif(regexp_extract(traceparent, '^[0-9a-f]{2}-([0-9a-f]{32})-[0-9a-f]{16}-[0-9a-f]{2}$', 1), '') AS tid FROM v_hdr)
        SELECT topic, count(*) AS records, count(tid) AS valid, count(*) FILTER (traceparent IS NOT NULL AND tid IS NULL) AS invalid,
               count(*) FILTER (traceparent IS NULL) AS missing, count(DISTINCT tid) AS trace_ids,
               count(*) FILTER (correlation_id IS NULL) AS missing_correlation FROM r GROUP BY topic""",
)
def _(t):
    return metrics.trace_header_audit(t.hdr)


@query(
    "w13_counter_rate",
    """WITH s AS (SELECT topic, ts, high_water, lag(high_water) OVER (PARTITION BY topic ORDER BY ts) AS p FROM v_metr),
            i AS (SELECT topic, ts, CASE WHEN p IS NULL THEN 0 WHEN high_water < p THEN high_water ELSE high_water - p END AS step FROM s)
       SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, topic,
              round(sum(step) OVER (PARTITION BY topic ORDER BY epoch(ts)::BIGINT RANGE BETWEEN 21599 PRECEDING AND CURRENT ROW) / 21600, 6) AS rate FROM i""",
)
def _(t):
    return windows.counter_rate(t.metr, 6 * 3600).withColumn("ts", timestamp_text("ts"))
