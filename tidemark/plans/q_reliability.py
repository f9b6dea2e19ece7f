"""Queries over payments, retries, dead letters and deliveries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names
from ..functions.binding import bound
from ..functions.hashing import hmac_pads
from ..functions.headers import format_headers, header, headers_map, set_header
from ..functions.names import timestamp_text
from ..operators import records
from ..operators import reliability as rel
from ..session import work_dir
from ..sources import sinks
from .oracle_fn import fnv_mod, murmur_partition
from .registry import query

FMT = "strftime({0}, '%Y-%m-%d %H:%M:%S')"
ISO = "strftime({0}, '%Y-%m-%dT%H:%M:%SZ')"
SECRET = "delivery-secret"


def finished(t):
    return rel.retry_pipeline(t.pay, rel.PAYMENT_STAGES, rel.DLQ_TOPIC)


def dlq(t):
    return rel.dead_letters(finished(t), rel.DLQ_TOPIC)


def cutoff():
    return F.lit("1997-01-01 00:00:00").cast("timestamp")


@query("p14_classify_payment", 'SELECT "offset", cls, message FROM v_paycls')
def _(t):
    return rel.handled(t.pay).select("offset", "cls", "message")


@query(
    "p15_classify_http",
    """SELECT channel, CASE WHEN status IS NULL THEN 'retriable' WHEN status BETWEEN 200 AND 299 THEN 'delivered'
                            WHEN status IN (408, 429) OR status >= 500 THEN 'retriable' ELSE 'permanent' END AS kind, count(*) AS n
       FROM v_deliv GROUP BY ALL""",
)
def _(t):
    return t.deliv.groupBy("channel", records.classify_http("status").alias("kind")).agg(F.count("*").alias("n"))


HOP = """'error.class=' || cls || ' error.message=' || message || ' error.timestamp=' || """ + ISO.format("timestamp")


@query(
    "p16_escalate_once",
    f"""SELECT 'payment' AS form, "offset", CASE WHEN cls = 'permanent' THEN 'payments-dlq' ELSE 'payments-retry-30s' END AS target,
               CASE WHEN cls = 'permanent' THEN 'permanent' ELSE 'next-retry' END AS reason,
               {HOP} || ' original.offset=' || "offset" || ' original.partition=' || "partition"
                 || ' original.topic=payments previous.topic=payments retry.count=1' AS headers FROM v_paycls WHERE cls <> 'ok'
        UNION ALL
        SELECT 'notification', "offset", 'payments-dlq', CASE WHEN cls = 'permanent' THEN 'permanent' ELSE 'exhausted' END,
               {HOP} || ' forward.reason=' || (CASE WHEN cls = 'permanent' THEN 'permanent' ELSE 'exhausted' END)
                 || ' original.topic=payments previous.topic=payments-retry-5m retry.count=3' FROM v_paycls WHERE cls <> 'ok'""",
)
def _(t):
    failed = rel.handled(t.pay).filter("cls <> 'ok'")
    first = rel.escalate_once(failed, rel.PAYMENT_STAGES, rel.DLQ_TOPIC, F.col("timestamp"))
    # The same records as they fail at the last notification stage, after two earlier hops.
    seen = set_header(set_header("headers", "original.topic", F.lit("payments")), "retry.count", F.lit("2"))
    late = failed.withColumn("topic", F.lit("payments-retry-5m")).withColumn("headers", seen)
    last = rel.escalate_once(late, rel.NOTIFY_STAGES, rel.DLQ_TOPIC, F.col("timestamp"), coordinates=False)
    both = first.withColumn("form", F.lit("payment")).unionByName(last.withColumn("form", F.lit("notification")))
    return both.select("form", "offset", "target", "reason", format_headers("headers").alias("headers"))


STAGE_VALUES = ", ".join(f"({i}, '{s.topic}', {s.delay_s})" for i, s in enumerate(rel.PAYMENT_STAGES))


@query(
    "p17_due_records",
    f"""SELECT "offset", s.topic, {FMT.format("timestamp + to_seconds(delay)")} AS due,
               timestamp + to_seconds(delay) <= TIMESTAMP '1998-01-01 00:05:00' AS eligible,
               greatest(epoch(timestamp + to_seconds(delay))::BIGINT - epoch(TIMESTAMP '1998-01-01 00:05:00')::BIGINT, 0) AS wait_s
        FROM v_pay JOIN (VALUES {STAGE_VALUES}) s(i, topic, delay) ON "offset" % 4 = s.i""",
)
def _(t):
    topics = records.lookup(
        F.col("offset") % 4, {i: s.topic for i, s in enumerate(rel.PAYMENT_STAGES)}, F.lit(None).cast("string")
    )
    now = F.lit("1998-01-01 00:05:00").cast("timestamp")
    out = rel.due_records(t.pay.withColumn("topic", topics), rel.PAYMENT_STAGES, now)
    return out.select("offset", "topic", timestamp_text("due").alias("due"), "eligible", "wait_s")


INCIDENT_SQL = f"""SELECT topic AS dlq_topic, "partition" AS dlq_partition, "offset" AS dlq_offset, key, original_topic,
    "partition"::VARCHAR AS original_partition, "offset"::VARCHAR AS original_offset, previous_topic, retry_count::VARCHAR AS retry_count,
    error_class, error_message, {ISO.format("error_timestamp")} AS error_timestamp, {FMT.format("timestamp")} AS dlq_record_time,
    strlen(value)::BIGINT AS payload_bytes FROM v_dlq"""


@query("p18_dlq_incidents", INCIDENT_SQL)
def _(t):
    return sinks.dlq_incidents(dlq(t))


@query("s13_write_incidents", INCIDENT_SQL)
def _(t):
    path = work_dir(t.spark, "incidents")
    dead = dlq(t)
    sinks.write_incidents(dead, path)
    return sinks.read_incidents(t.spark, path, sinks.dlq_incidents(dead).schema)


@query(
    "p19_in_place_retry",
    """SELECT r AS max_retries, "offset",
              CASE WHEN cls = 'permanent' THEN 'dlq permanent' WHEN cls = 'transient' AND r < 2 THEN 'dlq exhausted' ELSE 'ok' END AS outcome,
              CASE WHEN cls = 'transient' THEN least(r, 2) ELSE 0 END AS retried,
              CASE WHEN cls = 'transient' THEN least(r, 2) + 1 ELSE 0 END AS attempts,
              (CASE WHEN cls = 'transient' THEN 100 * (2 ** least(r, 2) - 1) ELSE 0 END)::BIGINT AS backoff_ms
       FROM v_paycls, (VALUES (1), (3)) v(r)""",
)
def _(t):
    parts = [rel.in_place_retry(t.pay, r, 100).withColumn("max_retries", F.lit(r)) for r in (1, 3)]
    both = parts[0].unionByName(parts[1])
    return both.select("max_retries", "offset", "outcome", "retried", "attempts", "backoff_ms")


@query(
    "n12_backoff",
    """SELECT "offset", (least(200 * 2 ** ("offset" % 8), 5000))::BIGINT AS delay_ms, (200 * 2 ** ("offset" % 8))::BIGINT AS uncapped_ms FROM v_pay""",
)
def _(t):
    attempt = F.col("offset") % 8 + 1
    return t.pay.select(
        "offset",
        names.backoff(attempt, 200, 5000).alias("delay_ms"),
        names.backoff(attempt, 200).alias("uncapped_ms"),
    )


@query(
    "p20_replay_select",
    f"""SELECT 'payments' AS topic, key, 'error.class=' || error_class || ' error.message=' || error_message
                 || ' error.timestamp=' || {ISO.format("error_timestamp")} || ' original.offset=' || "offset" || ' original.partition=' || "partition"
                 || ' original.topic=payments previous.topic=' || previous_topic || ' replay.from-dlq=payments-dlq/' || "partition" || '/' || "offset"
                 || ' retry.count=0' AS headers
        FROM v_dlq WHERE timestamp >= TIMESTAMP '1997-01-01 00:00:00' AND error_class = 'transient'""",
)
def _(t):
    out = rel.replay_select(dlq(t), "payments", cutoff(), "transient")
    return out.select("topic", "key", format_headers("headers").alias("headers"))


@query(
    "p20_replay_notifications",
    """SELECT 'replay-' || notification_id AS id, 'notifications-' || lower(substr(channel, 9)) AS topic, channel
       FROM v_nlog WHERE status = 'dlq'""",
)
def _(t):
    return rel.replay_notifications(t.nlog.filter("status = 'dlq'"))


@query(
    "a25_replay_summary",
    """SELECT count(*) AS read, count(*) - count(*) FILTER (timestamp >= TIMESTAMP '1997-01-01 00:00:00' AND error_class = 'permanent') AS skipped,
              count(*) FILTER (timestamp >= TIMESTAMP '1997-01-01 00:00:00' AND error_class = 'permanent') AS matched,
              count(*) FILTER (timestamp >= TIMESTAMP '1997-01-01 00:00:00' AND error_class = 'permanent') AS replayed FROM v_dlq""",
)
def _(t):
    return rel.replay_summary(dlq(t), cutoff(), "permanent")


@query(
    "a24_retry_outcome_counts",
    """SELECT count(*) AS processed, count(*) FILTER (cls IN ('ok', 'transient')) AS ok, (2 * count(*) FILTER (cls = 'transient')) AS retried,
              count(*) FILTER (cls = 'permanent') AS dlq_permanent, 0::BIGINT AS dlq_exhausted FROM v_paycls""",
)
def _(t):
    return rel.retry_outcome_counts(rel.in_place_retry(t.pay, 3, 100))


@query(
    "a24_escalation_counts",
    """SELECT count(*) FILTER (cls = 'transient') AS escalated, count(*) FILTER (cls = 'permanent') AS dead_lettered FROM v_paycls""",
)
def _(t):
    failed = rel.handled(t.pay).filter("cls <> 'ok'")
    hops = rel.escalate_once(failed, rel.PAYMENT_STAGES, rel.DLQ_TOPIC, F.col("timestamp"))
    return rel.escalation_counts(hops, rel.DLQ_TOPIC)


Z11_SQL = """SELECT p."offset", CASE WHEN p.cls = 'ok' THEN 'ok' ELSE 'dlq' END AS outcome,
        CASE WHEN p.cls = 'ok' THEN 'payments' ELSE 'payments-dlq' END AS final_topic, d.retry_count::VARCHAR AS retry_count,
        d.previous_topic, d.error_class, strftime(coalesce(d.error_timestamp, p.timestamp), '%Y-%m-%d %H:%M:%S') AS at
    FROM v_paycls p LEFT JOIN v_dlq d ON p."offset" = d."offset" """


def z11_columns(done):
    return done.select(
        "offset",
        "outcome",
        "final_topic",
        header("headers", "retry.count").alias("retry_count"),
        header("headers", "previous.topic").alias("previous_topic"),
        header("headers", "error.class").alias("error_class"),
        timestamp_text("at").alias("at"),
    )


@query("z11_retry_pipeline_batch", Z11_SQL)
def _(t):
    return z11_columns(finished(t))


def settling_payment(value, retries):
    """A payment that is transient settles at call 2 to 6, by the number in its id; others as usual."""
    number = F.regexp_extract(value, r'"id":"pay-(\d+)"', 1).try_cast("long")

    def judge(h):
        settled = (h["cls"] == "transient") & (retries + 1 >= 2 + number % 5)
        return F.struct(F.when(settled, "ok").otherwise(h["cls"]).alias("cls"), F.when(~settled, h["message"]).alias("message"))

    return bound(rel.classify_payment(value), judge)


STAGE_TOPICS = "[" + ", ".join(f"'{s.topic}'" for s in rel.PAYMENT_STAGES) + "]"
STAGE_WAITS = "[" + ", ".join(str(sum(s.delay_s for s in rel.PAYMENT_STAGES[: i + 1])) for i in range(len(rel.PAYMENT_STAGES))) + "]"
SETTLING_SQL = f"""SELECT p."offset", CASE WHEN p.cls = 'ok' OR settles THEN 'ok' ELSE 'dlq' END AS outcome,
        CASE WHEN p.cls = 'ok' THEN 'payments' WHEN settles THEN {STAGE_TOPICS}[calls] ELSE 'payments-dlq' END AS final_topic,
        CASE WHEN settles THEN calls - 1 ELSE d.retry_count END::VARCHAR AS retry_count,
        CASE WHEN settles THEN {STAGE_TOPICS}[calls - 1] ELSE d.previous_topic END AS previous_topic, d.error_class,
        strftime(CASE WHEN settles THEN p.timestamp + to_seconds({STAGE_WAITS}[calls]) ELSE coalesce(d.error_timestamp, p.timestamp) END,
                 '%Y-%m-%d %H:%M:%S') AS at
    FROM (SELECT *, (2 + "offset" % 5)::INT AS calls, cls = 'transient' AND 2 + "offset" % 5 <= {len(rel.PAYMENT_STAGES)} AS settles FROM v_paycls) p
    LEFT JOIN v_dlq d ON p."offset" = d."offset" """


@query("z11_settling_pipeline_batch", SETTLING_SQL)
def _(t):
    return z11_columns(rel.staged_retry(t.pay, rel.PAYMENT_STAGES, rel.DLQ_TOPIC, settling_payment))


@query(
    "u01_merge_topics",
    """SELECT topic, count(*) AS records FROM (SELECT topic FROM v_pay UNION ALL SELECT topic FROM v_dlq
           UNION ALL SELECT 'payments-retry-30s' FROM v_paycls WHERE cls = 'transient') GROUP BY topic""",
)
def _(t):
    columns = ["topic", "partition", "offset", "key", "value", "headers", "timestamp"]
    failed = rel.handled(t.pay).filter("cls = 'transient'")
    hop = rel.escalate_once(failed, rel.PAYMENT_STAGES, rel.DLQ_TOPIC, F.col("timestamp"))
    stage = hop.withColumn("topic", F.col("target"))
    merged = rel.merge_topics(t.pay.select(*columns), stage.select(*columns), dlq(t).select(*columns))
    return merged.groupBy("topic").agg(F.count("*").alias("records"))


@query(
    "n06_headers",
    """SELECT "offset", retry_count::VARCHAR AS retry_count, error_class AS class, 8::INT AS size,
              '-' AS none, 'retry.count=9 tag=x' AS replaced FROM v_dlq""",
)
def _(t):
    empty = F.lit(None).cast("array<struct<key:string,value:binary>>")
    only = F.filter("headers", lambda h: h["key"] == "retry.count")
    as_map = headers_map("headers")
    return dlq(t).select(
        "offset",
        as_map["retry.count"].alias("retry_count"),
        as_map["error.class"].alias("class"),
        F.size(as_map).alias("size"),
        format_headers(F.coalesce(empty, F.array().cast("array<struct<key:string,value:binary>>"))).alias("none"),
        format_headers(set_header(set_header(only, "retry.count", F.lit("9")), "tag", F.lit("x"))).alias("replaced"),
    )


ROUTE_SQL = """CASE channel WHEN 'CHANNEL_FIREBASE' THEN 'notifications-firebase' WHEN 'CHANNEL_APNS' THEN 'notifications-apns'
    WHEN 'CHANNEL_WEBHOOK' THEN 'notifications-webhook' ELSE 'notifications-router-dlq' END"""
P12_SQL = f"""SELECT id, channel, {ROUTE_SQL} AS destination, 'channel=' || channel || ' router-node=router-1' AS headers FROM v_notif"""


@query("p12_route_by_channel", P12_SQL)
def _(t):
    return records.route_by_channel(t.notif, "router-1").select(
        "id", "channel", "destination", format_headers("headers").alias("headers")
    )


_INNER, _OUTER = (p.hex() for p in hmac_pads(SECRET.encode()))
BODY_SQL = """'{"id":"' || id || '","title":"' || title || '","trace_id":"' || trace_id || '"}'"""


@query(
    "p23_prepare_deliveries",
    f"""SELECT id, topic || ':' || "partition" || ':' || "offset" AS idempotency_key,
               sha256(unhex('{_OUTER}') || unhex(sha256(unhex('{_INNER}') || encode({BODY_SQL})))) AS signature,
               user_id AS origin_key FROM v_notif""",
)
def _(t):
    body = F.concat(
        F.lit('{"id":"'), "id", F.lit('","title":"'), "title", F.lit('","trace_id":"'), "trace_id", F.lit('"}')
    )
    out = records.prepare_deliveries(t.notif, body, SECRET)
    return out.select("id", "idempotency_key", "signature", header("headers", "X-Origin-Key").alias("origin_key"))


@query(
    "a31_delivery_outcomes",
    """SELECT channel, count(*) FILTER (status BETWEEN 200 AND 299) AS delivered,
              count(*) FILTER (status IS NULL OR status IN (408, 429) OR status >= 500) AS escalated,
              count(*) FILTER (status = 400) AS dead_lettered, sum(attempts)::BIGINT AS attempts FROM v_deliv GROUP BY channel""",
)
def _(t):
    return rel.delivery_outcomes(t.deliv)


def _runs_sql(rule: str, ok: str) -> str:
    return f"""SELECT '{rule}' AS rule, channel, count(*) AS length, min(seq) AS first_seq, max(seq) AS last_seq, count(*) >= 5 AS tripped
        FROM (SELECT channel, seq, {ok} AS ok, sum(CASE WHEN {ok} THEN 1 ELSE 0 END) OVER (PARTITION BY channel ORDER BY seq) AS run FROM v_deliv)
        WHERE NOT ok GROUP BY channel, run"""


@query(
    "w09_failure_runs",
    _runs_sql("breaker", "coalesce(status BETWEEN 200 AND 299 OR status = 400, false)")
    + " UNION ALL "
    + _runs_sql("courier", "coalesce(status BETWEEN 200 AND 299, false)"),
)
def _(t):
    breaker = rel.failure_runs(t.deliv, 5, permanent_fails=False).withColumn("rule", F.lit("breaker"))
    courier = rel.failure_runs(t.deliv, 5, permanent_fails=True).withColumn("rule", F.lit("courier"))
    return breaker.unionByName(courier)


Z19_SQL = """SELECT notification_id, channel, arg_min(status, seq) AS status, arg_min(attempts, seq) AS attempts,
                    arg_min(coalesce(last_error, ''), seq) AS last_error, min(seq) AS seq FROM v_nlog GROUP BY ALL"""


@query("z19_delivery_history_batch", Z19_SQL)
def _(t):
    out = rel.delivery_history(t.nlog.filter("status = 'delivered'"), t.nlog.filter("status = 'dlq'"))
    return out.withColumn("last_error", F.coalesce("last_error", F.lit("")))


@query(
    "x03_register_handler",
    """SELECT CASE WHEN bad THEN 'permanent' WHEN (value::JSON->>'$.amount')::BIGINT > 30000000 THEN 'permanent' ELSE 'ok' END AS cls, count(*) AS n
       FROM (SELECT bad, CASE WHEN bad THEN '{}' ELSE value END AS value FROM v_pay) GROUP BY 1""",
)
def _(t):
    def amount_limit(value):
        amount = F.try_to_number(F.regexp_extract(value, '"amount":([0-9]+)', 1), F.lit("9999999999999999"))
        cls = F.when(amount.isNull() | (amount > 30000000), "permanent").otherwise("ok")
        return F.struct(cls.alias("cls"), F.lit(None).cast("string").alias("message"))

    rel.register_handler("amount-limit", amount_limit)
    return rel.handled(t.pay, "amount-limit").groupBy("cls").agg(F.count("*").alias("n"))


@query(
    "x01_register_partitioner",
    f"""SELECT 'key_hash' AS name, {murmur_partition("key", 6)} AS "partition", count(*) AS records, true AS deterministic FROM v_keys GROUP BY ALL
        UNION ALL SELECT 'worker', {fnv_mod("key", 6)}, count(*), true FROM v_keys GROUP BY ALL
        UNION ALL SELECT 'by_length', (length(key) % 6)::INT, count(*), true FROM v_keys GROUP BY ALL""",
)
def _(t):
    from ..functions import partitioners as reg

    reg.register_partitioner("by_length", lambda key, n: (F.length(key) % n).cast("int"))
    out = None
    for name in ("key_hash", "worker", "by_length"):
        placed = reg.place(t.keys, name, 6).groupBy("partition").agg(F.count("*").alias("records"))
        part = placed.withColumn("name", F.lit(name)).withColumn("deterministic", F.lit(reg.is_deterministic(name)))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "x05_sql_functions",
    f"""SELECT key, {murmur_partition("key", 6)} AS part, {fnv_mod("key", 8)} AS worker, sha256('s:' || key) AS hashed,
               'keys/0/' || seq AS coord, array_to_string(list_filter(regexp_extract_all(lower(key), '[\\p{{L}}\\p{{Nd}}]+'), lambda w: strlen(w) >= 2), ',') AS tokens
        FROM v_keys""",
)
def _(t):
    names.sql_functions(t.spark)
    t.keys.createOrReplaceTempView("tidemark_keys")
    return t.spark.sql(
        """SELECT key, key_partition(key, 6) AS part, worker_for(key, 8) AS worker, hash_field(key, 's') AS hashed,
                  record_coord('keys', 0, seq) AS coord, array_join(tokenize(key), ',') AS tokens FROM tidemark_keys"""
    )
