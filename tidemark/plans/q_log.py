"""Queries over the record log and keyed logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hashing import key_partition, worker_for
from ..functions.names import record_coord, short_id, timestamp_text
from ..operators import logs
from ..session import work_dir
from ..sources import log as source
from .oracle_fn import fnv_mod, murmur_partition
from .registry import query

HOT = ["vip-0", "user-1"]


@query(
    "s01_read_log",
    r"""SELECT topic, "partition", "offset", key, value, strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS ts
        FROM v_log WHERE regexp_matches(topic, '^events\.(click|error)$')""",
)
def _(t):
    picked = source.select_topics(t.log, pattern=r"^events\.(click|error)$")
    return picked.select("topic", "partition", "offset", "key", "value", timestamp_text("timestamp").alias("ts"))


@query(
    "s02_starting_offsets",
    """WITH c AS (SELECT * FROM v_offs WHERE group_id = 'g2')
       SELECT p AS policy, l.topic, l."partition", count(*) AS records, min(l."offset") AS first_offset
       FROM v_log l CROSS JOIN (VALUES ('earliest'), ('latest')) p(p)
       LEFT JOIN c ON l.topic = c.topic AND l."partition" = c."partition"
       WHERE l."offset" >= coalesce(c.committed, CASE WHEN p = 'earliest' THEN 0 END)
       GROUP BY ALL""",
)
def _(t):
    committed = t.offs.filter("group_id = 'g2'")
    parts = [
        source.starting_offsets(t.log, p, committed).withColumn("policy", F.lit(p)) for p in ("earliest", "latest")
    ]
    return (
        parts[0].unionByName(parts[1]).groupBy("policy", "topic", "partition")
        .agg(F.count("*").alias("records"), F.min("offset").alias("first_offset"))
    )


@query(
    "s03_bounded_read",
    """SELECT l.topic, l."partition", l."offset", l.key FROM v_log l
       JOIN (SELECT topic, "partition", committed AS e FROM v_offs WHERE group_id = 'g1') o
         ON l.topic = o.topic AND l."partition" = o."partition" WHERE l."offset" < o.e""",
)
def _(t):
    ends = t.offs.filter("group_id = 'g1'").selectExpr("topic", "partition", "committed AS end_offset")
    return source.bounded_read(t.log, ends).select("topic", "partition", "offset", "key")


@query(
    "s09_write_log",
    'SELECT topic, "partition", count(*) AS records FROM v_log GROUP BY ALL',
)
def _(t):
    return source.write_log(t.log, work_dir(t.spark, "log"))


@query(
    "p11_enrich_vip",
    """SELECT key, value AS src_value, starts_with(key, 'vip-') AS vip, topic AS src_topic, "partition" AS src_partition,
              "offset" AS src_offset,
              'source.offset=' || "offset" || ' source.partition=' || "partition" || ' source.topic=' || topic AS headers
       FROM v_log""",
)
def _(t):
    from ..functions.headers import format_headers
    from ..operators.records import enrich_vip

    out = enrich_vip(t.log)
    return out.select(
        "key", "src_value", "vip", "src_topic", "src_partition", "src_offset", format_headers("headers").alias("headers")
    )


@query(
    "p26_salt_hot_keys",
    f"""SELECT CASE WHEN key IN ('vip-0', 'user-1') THEN key || ':bucket-' || {fnv_mod("event_id::VARCHAR", 8)} ELSE key END AS key,
               count(*) AS records FROM v_log GROUP BY 1""",
)
def _(t):
    return logs.salt_hot_keys(t.log_rows, HOT, 8, "event_id").groupBy("key").agg(F.count("*").alias("records"))


@query("a02_partition_distribution", 'SELECT topic, "partition", count(*) AS records FROM v_log GROUP BY ALL')
def _(t):
    return logs.partition_distribution(t.log_rows)


@query(
    "a03_key_partition_check",
    """SELECT key, count(*) AS records, count(DISTINCT "partition") AS partitions,
              array_to_string(list_sort(list(DISTINCT "partition")), ',') AS partition_list,
              count(DISTINCT "partition") = 1 AS one_partition
       FROM v_log GROUP BY key""",
)
def _(t):
    return logs.key_partition_check(t.log_rows)


@query(
    "a04_priority_partition_check",
    """WITH r AS (SELECT *, starts_with(key, 'prem-') AS prem,
                    sum(CASE WHEN starts_with(key, 'prem-') THEN 0 ELSE 1 END) OVER (ORDER BY seq) AS rk FROM v_keys),
            p AS (SELECT *, CASE WHEN prem THEN 0 WHEN (rk - 1) % 2 = 0 THEN 1 ELSE 2 END AS part FROM r),
            c AS (SELECT count(*) AS total, count(*) FILTER (prem) AS premium, count(*) FILTER (NOT prem) AS regular,
                    count(*) FILTER (prem AND part <> 0) AS premium_elsewhere,
                    count(*) FILTER (NOT prem AND part = 0) AS regular_in_0,
                    count(*) FILTER (NOT prem AND part = 1) AS regular_in_1,
                    count(*) FILTER (NOT prem AND part = 2) AS regular_in_2 FROM p)
       SELECT *, premium_elsewhere = 0 AS premium_ok, regular_in_0 = 0 AS regular_ok,
              abs(regular_in_1 - regular_in_2) <= greatest(5, (regular_in_1 + regular_in_2) // 20) AS balanced FROM c""",
)
def _(t):
    return logs.priority_partition_check(t.keys)


@query(
    "a05_skew_report",
    """SELECT topic, "partition", n AS delta, round(n / sum(n) OVER w * 100, 6) AS share_pct,
              floor(n / max(n) OVER w * 40)::BIGINT AS bar, n / sum(n) OVER w * 100 >= 80 AS hot
       FROM (SELECT topic, "partition", count(*) AS n FROM v_log GROUP BY ALL) WINDOW w AS (PARTITION BY topic)""",
)
def _(t):
    deltas = logs.partition_distribution(t.log_rows).withColumnRenamed("records", "delta")
    return logs.skew_report(deltas, ["topic"], "partition")


@query(
    "a06_offset_table",
    """WITH p AS (SELECT topic, "partition", min("offset") AS lo, max("offset") + 1 AS hi FROM v_log GROUP BY ALL)
       SELECT topic, "partition"::VARCHAR AS label, lo AS earliest, hi AS latest, hi - lo AS retained FROM p
       UNION ALL SELECT topic, 'TOTAL', NULL, NULL, sum(hi - lo)::BIGINT FROM p GROUP BY topic""",
)
def _(t):
    return logs.offset_table(t.log)


@query(
    "a07_compaction_stats",
    """WITH r AS (SELECT *, coalesce(starts_with(key, '__') AND length(key) > 2, false) AS beat FROM v_klog),
            l AS (SELECT key, arg_max(CASE WHEN value IS NULL THEN 0 ELSE 1 END, "offset") AS live FROM r
                  WHERE key IS NOT NULL AND NOT beat GROUP BY key)
       SELECT (SELECT count(*) FROM r) AS records, (SELECT count(*) FROM l WHERE live = 1) AS live_keys,
              (SELECT count(*) FROM r WHERE key IS NOT NULL AND NOT beat AND value IS NULL) AS tombstones,
              (SELECT count(*) FROM r WHERE beat) AS heartbeats""",
)
def _(t):
    return logs.compaction_stats(t.klog)


@query(
    "a08_dirty_ratio",
    """WITH k AS (SELECT topic, key, count(*) AS n, sum(20 + coalesce(strlen(value), 0)) AS size,
                    arg_max(20 + coalesce(strlen(value), 0), "offset") AS kept FROM v_klog WHERE key IS NOT NULL GROUP BY ALL),
            s AS (SELECT topic, sum(n)::BIGINT AS records, count(*) AS kept_records, sum(size)::BIGINT AS bytes,
                    sum(kept)::BIGINT AS kept_bytes FROM k GROUP BY topic)
       SELECT *, round(1 - kept_records / records, 6) AS dirty_records, round(1 - kept_bytes / bytes, 6) AS dirty_bytes,
              round(1 - kept_bytes / bytes, 6) >= 0.5 AS cleanable FROM s""",
)
def _(t):
    return logs.dirty_ratio(t.klog, 20 + F.coalesce(F.octet_length("value"), F.lit(0)))


@query(
    "a30_remap_impact",
    f"""WITH k AS (SELECT key, count(*) AS n, {murmur_partition("key", 6)} <> {murmur_partition("key", 8)} AS m FROM v_keys GROUP BY key)
        SELECT count(*) AS keys, count(*) FILTER (m) AS moved_keys, sum(n)::BIGINT AS records,
               sum(CASE WHEN m THEN n ELSE 0 END)::BIGINT AS moved_records,
               round(count(*) FILTER (m) / count(*), 6) AS key_share,
               round(sum(CASE WHEN m THEN n ELSE 0 END) / sum(n), 6) AS record_share FROM k""",
)
def _(t):
    return logs.remap_impact(t.keys, 6, 8)


@query(
    "w02_latest_by_key",
    """SELECT key, "partition", "offset", value FROM (
           SELECT *, row_number() OVER (PARTITION BY key ORDER BY "offset" DESC) AS rn FROM v_klog WHERE key IS NOT NULL)
       WHERE rn = 1 AND value IS NOT NULL""",
)
def _(t):
    return logs.latest_by_key(t.klog).select("key", "partition", "offset", "value")


@query(
    "w04_compact",
    """WITH a AS (SELECT *, epoch(date_trunc('second', (SELECT max(ts) FROM v_klog)))::BIGINT - epoch(date_trunc('second', ts))::BIGINT AS age FROM v_klog),
            r AS (SELECT *, row_number() OVER (PARTITION BY "partition", key, age >= 172800 ORDER BY "offset" DESC) AS rn FROM a)
       SELECT topic, "partition", "offset", key, value FROM r
       WHERE age < 172800 OR (key IS NOT NULL AND rn = 1 AND (value IS NOT NULL OR age < 345600))""",
)
def _(t):
    now = t.klog_rows.agg(F.max("ts")).scalar()
    out = logs.compact(t.klog, now, min_lag_s=2 * 86400, delete_retention_s=4 * 86400)
    return out.select("topic", "partition", "offset", "key", "value")


@query(
    "w05_retain",
    """WITH a AS (SELECT *, epoch(date_trunc('second', (SELECT max(timestamp) FROM v_log)))::BIGINT - epoch(date_trunc('second', timestamp))::BIGINT AS age,
                    sum(bytes) OVER (PARTITION BY topic, "partition" ORDER BY "offset" DESC)::BIGINT AS newest_bytes FROM v_log)
       SELECT topic, "partition", "offset", newest_bytes FROM a WHERE age <= 604800 AND newest_bytes <= 5000""",
)
def _(t):
    now = t.log_rows.agg(F.max("timestamp")).scalar()
    out = logs.retain(t.log, now, max_age_s=7 * 86400, max_bytes=5000)
    return out.select("topic", "partition", "offset", "newest_bytes")


@query(
    "w06_assign_offsets",
    f"""WITH p AS (SELECT seq, key, {murmur_partition("key", 6)} AS "partition" FROM v_keys)
        SELECT *, row_number() OVER (PARTITION BY "partition" ORDER BY seq) - 1 AS "offset" FROM p""",
)
def _(t):
    return logs.assign_offsets(t.keys, 6).select("seq", "key", "partition", "offset")


@query(
    "w07_round_robin",
    """SELECT seq, key, CASE WHEN starts_with(key, 'prem-') THEN 0 WHEN (rk - 1) % 2 = 0 THEN 1 ELSE 2 END AS "partition"
       FROM (SELECT *, sum(CASE WHEN starts_with(key, 'prem-') THEN 0 ELSE 1 END) OVER (ORDER BY seq) AS rk FROM v_keys)""",
)
def _(t):
    return logs.round_robin(t.keys, 3).select("seq", "key", "partition")


@query(
    "w08_commit_frontier",
    """WITH s AS (SELECT "partition", "offset", "offset" - row_number() OVER (PARTITION BY "partition" ORDER BY "offset") AS isl FROM v_done),
            i AS (SELECT "partition", isl, min("offset") AS lo, max("offset") AS hi FROM s GROUP BY ALL),
            f AS (SELECT "partition", arg_min(hi, lo) + 1 AS commit_offset FROM i GROUP BY "partition")
       SELECT d."partition", min("offset") AS first_offset, max("offset") AS last_offset, count(*) AS done, f.commit_offset,
              count(*) - (f.commit_offset - min("offset")) AS held_back
       FROM v_done d JOIN f ON d."partition" = f."partition" GROUP BY d."partition", f.commit_offset""",
)
def _(t):
    return logs.commit_frontier(t.done)


@query(
    "w11_offset_delta",
    """SELECT strftime(day, '%Y-%m-%d') AS day, topic, "partition", end_offset, delta, greatest(delta - sent, 0) AS duplicates FROM (
           SELECT *, greatest(end_offset - coalesce(lag(end_offset) OVER (PARTITION BY topic, "partition" ORDER BY day), 0), 0) AS delta
           FROM v_snap WHERE group_id = 'g1')""",
)
def _(t):
    out = logs.offset_delta(t.snap.filter("group_id = 'g1'"))
    return out.select(F.col("day").cast("string").alias("day"), "topic", "partition", "end_offset", "delta", "duplicates")


@query(
    "w15_lag_trend",
    """WITH p AS (SELECT group_id, day, topic, "partition", greatest(end_offset - committed, 0) AS lag FROM v_snap),
            d AS (SELECT group_id, day, sum(lag)::BIGINT AS lag, max(lag) AS most FROM p GROUP BY ALL),
            s AS (SELECT *, sign(lag - lag(lag) OVER (PARTITION BY group_id ORDER BY day)) AS step,
                    row_number() OVER (PARTITION BY group_id ORDER BY day DESC) AS rn FROM d),
            g AS (SELECT group_id, count(*) FILTER (step > 0) AS ups, count(*) FILTER (step < 0) AS downs,
                    arg_max(lag, day) AS lag, arg_max(most, day) AS most FROM s WHERE rn <= 7 GROUP BY group_id)
       SELECT group_id, lag, CASE WHEN ups > downs THEN 'growing' WHEN ups < downs THEN 'falling' ELSE 'flat' END AS trend,
              round(CASE WHEN lag > 0 THEN most / lag ELSE 0 END, 6) AS top_share,
              CASE WHEN lag > 0 AND most / lag >= 0.6 THEN 'hot partition' ELSE 'even' END AS shape FROM g""",
)
def _(t):
    return logs.lag_trend(t.snap, last=7)


@query(
    "t04_hot_keys",
    """WITH k AS (SELECT topic, "partition", key, count(*) AS records FROM v_log GROUP BY ALL)
       SELECT topic, "partition", key, records,
              round(records / sum(records) OVER (PARTITION BY topic, "partition") * 100, 6) AS partition_pct,
              round(records / sum(records) OVER (PARTITION BY topic) * 100, 6) AS topic_pct
       FROM k ORDER BY records DESC, topic, "partition", key LIMIT 20""",
)
def _(t):
    return logs.hot_keys(t.log_rows, 20)


@query(
    "j04_consumer_lag",
    """SELECT group_id, topic, "partition", end_offset, committed, end_offset - committed AS lag FROM v_offs
       UNION ALL SELECT group_id, 'TOTAL', NULL, NULL, NULL, sum(greatest(end_offset - committed, 0))::BIGINT FROM v_offs GROUP BY group_id""",
)
def _(t):
    lag = logs.consumer_lag(t.offs)
    total = logs.total_lag(lag).withColumn("topic", F.lit("TOTAL"))
    return lag.unionByName(total, allowMissingColumns=True)


@query(
    "j05_pending_records",
    """SELECT o.group_id, l.topic, l."partition", l."offset", l.key FROM v_log l
       JOIN v_offs o ON l.topic = o.topic AND l."partition" = o."partition" AND l."offset" >= o.committed""",
)
def _(t):
    return logs.pending_records(t.log, t.offs).select("group_id", "topic", "partition", "offset", "key")


@query(
    "a19_lag_by_group",
    """SELECT *, CASE WHEN lag >= 10000 THEN 'red' WHEN lag >= 1000 THEN 'yellow' ELSE 'green' END AS severity FROM (
           SELECT group_id, topic, sum(greatest(end_offset - committed, 0))::BIGINT AS lag FROM v_offs GROUP BY ALL)""",
)
def _(t):
    return logs.lag_by_group(logs.consumer_lag(t.offs))


@query(
    "n01_key_partition",
    f"""SELECT {murmur_partition("key", 6)} AS "partition", count(*) AS records, count(DISTINCT key) AS keys FROM v_log GROUP BY 1""",
)
def _(t):
    per_key = t.log_rows.groupBy("key").agg(F.count("*").alias("n"))
    return (
        per_key.select(key_partition("key", 6).alias("partition"), "n")
        .groupBy("partition")
        .agg(F.sum("n").alias("records"), F.count("*").alias("keys"))
    )


@query(
    "n02_premium_partition",
    """SELECT CASE WHEN starts_with(key, 'prem-') THEN 0 WHEN (rk - 1) % 2 = 0 THEN 1 ELSE 2 END AS "partition", count(*) AS records,
              count(DISTINCT key) AS keys
       FROM (SELECT *, sum(CASE WHEN starts_with(key, 'prem-') THEN 0 ELSE 1 END) OVER (ORDER BY seq) AS rk FROM v_keys) GROUP BY 1""",
)
def _(t):
    per_key = logs.round_robin(t.keys, 3).groupBy("partition", "key").agg(F.count("*").alias("n"))
    return per_key.groupBy("partition").agg(F.sum("n").alias("records"), F.count("*").alias("keys"))


@query(
    "n04_worker_load",
    f"""SELECT worker, n AS delta, round(n / sum(n) OVER () * 100, 6) AS share_pct, floor(n / max(n) OVER () * 40)::BIGINT AS bar,
               n / sum(n) OVER () * 100 >= 80 AS hot
        FROM (SELECT {fnv_mod("key", 8)} AS worker, count(*) AS n FROM v_keys GROUP BY 1)""",
)
def _(t):
    loads = t.keys.groupBy(worker_for("key", 8).alias("worker")).agg(F.count("*").alias("delta"))
    return logs.skew_report(loads, [], "worker")


@query(
    "n11_record_coord",
    """SELECT topic || '/' || "partition" || '/' || "offset" AS replay_coord, topic || ':' || "partition" || ':' || "offset" AS idempotency_key,
              left('saga-' || event_id, 8) AS short FROM v_log""",
)
def _(t):
    return t.log.select(
        record_coord("topic", "partition", "offset").alias("replay_coord"),
        record_coord("topic", "partition", "offset", ":").alias("idempotency_key"),
        short_id(F.concat(F.lit("saga-"), F.col("event_id"))).alias("short"),
    )
