"""The views of ``views`` as SQL for the oracle."""

from __future__ import annotations

from .formulas import (
    CDC_STEPS,
    CDCP_STEPS,
    PAY_MODE,
    SAGA_EVENTS,
    SAGA_ID_PREFIX,
    SAGA_MESSAGES,
    cdc_value,
    cdcp_value,
    conn_value,
    delivery_status,
    image_user,
    notification_channel,
    ordv_payload,
)


def _sagacmd() -> str:
    rows = []
    for step, kind, action, ok, condition in SAGA_MESSAGES:
        prefix = SAGA_ID_PREFIX.get(kind)
        ident = f"'{prefix}-' || o_orderkey" if prefix and ok and action not in ("REFUND", "RELEASE") else "''"
        reason = "''" if ok else f"'{action.lower()} declined'"
        rows.append(
            f"SELECT 's-' || o_orderkey AS saga_id, {step}::BIGINT AS seq, '{kind}' AS kind, '{action}' AS action, "
            f"{str(ok).lower()} AS ok, {ident} AS id, {reason} AS reason, 'cus-' || o_custkey AS customer_id, "
            f"cast(round(o_totalprice * 100) AS bigint) AS amount_cents FROM orders WHERE {condition}"
        )
    return "\nUNION ALL ".join(rows)


_TRACE = (
    "'00-' || left(sha256(event_id::VARCHAR), 32) || '-' || left(sha256((event_id + 1)::VARCHAR), 16) || '-01'"
)

SQL_VIEWS = {
    "v_evt": """
        SELECT event_id, user_id, event_type, cast(round(value * 100) AS bigint) AS cents, ts AS arrival_ts,
               CASE WHEN event_id % 97 = 0 THEN ts
                    WHEN event_id % 10 = 0 THEN ts - to_minutes(cast(90 + (event_id * 53) % 151 AS int))
                    ELSE ts - to_minutes(cast((event_id * 37) % 61 AS int)) END AS event_ts,
               event_id % 10 = 0 AS late, event_id % 97 = 0 AS missing, cast(user_id % 4 AS int) AS part
        FROM events""",
    "v_log": """
        SELECT event_id, 'events.' || event_type AS topic, cast(user_id % 4 AS int) AS "partition",
               row_number() OVER (PARTITION BY event_type, user_id % 4 ORDER BY event_id) - 1 AS "offset",
               (CASE WHEN user_id % 25 = 0 THEN 'vip-' ELSE 'user-' END) || user_id AS key, props AS value,
               ts AS timestamp, cast(40 + strlen(props) AS bigint) AS bytes
        FROM events""",
    "v_logdup": """
        SELECT event_id AS outbox_id, consumer, topic, "partition", "offset" + shift AS "offset", key, value
        FROM v_log, (VALUES ('inventory'), ('notifications')) c(consumer), (VALUES (0), (1000000)) s(shift)
        WHERE shift = 0 OR event_id % 7 = 0""",
    "v_processed": "SELECT 'inventory' AS consumer, event_id AS outbox_id FROM events WHERE event_id % 11 = 0",
    "v_ends": 'SELECT topic, "partition", max("offset") + 1 AS end_offset FROM v_log GROUP BY ALL',
    "v_offs": """
        SELECT group_id, topic, "partition",
               CASE WHEN group_id = 'g1' AND topic = 'events.view' AND "partition" = 3 THEN end_offset + 1
                    WHEN group_id = 'g1' THEN end_offset - end_offset % 13
                    ELSE end_offset - end_offset % 29 END AS committed, end_offset
        FROM v_ends, (VALUES ('g1'), ('g2')) g(group_id) WHERE group_id = 'g1' OR "partition" < 3""",
    "v_daily": """
        SELECT topic, "partition", timestamp::DATE AS day, count(*) AS n FROM v_log GROUP BY ALL""",
    "v_grid": """
        SELECT topic, "partition", unnest(range(min(day)::TIMESTAMP, max(day)::TIMESTAMP + INTERVAL 1 DAY, INTERVAL 1 DAY))::DATE AS day
        FROM v_daily GROUP BY topic, "partition" """,
    "v_snapbase": """
        SELECT g.topic, g."partition", g.day, coalesce(d.n, 0)::BIGINT AS n,
               (sum(coalesce(d.n, 0)) OVER w)::BIGINT AS end_offset, row_number() OVER w AS day_no
        FROM v_grid g LEFT JOIN v_daily d ON g.topic = d.topic AND g."partition" = d."partition" AND g.day = d.day
        WINDOW w AS (PARTITION BY g.topic, g."partition" ORDER BY g.day)""",
    "v_snap": """
        SELECT day, group_id, topic, "partition", end_offset,
               greatest(end_offset - day_no * ("partition" + 1) * (CASE WHEN group_id = 'g1' THEN 1 ELSE 0 END), 0) AS committed,
               greatest(n - (CASE WHEN "partition" = 3 THEN 2 ELSE 0 END), 0) AS sent
        FROM v_snapbase, (VALUES ('g1'), ('g2')) g(group_id)""",
    "v_klog": """
        SELECT event_id, 'state.users' AS topic, cast(user_id % 4 AS int) AS "partition",
               row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1 AS "offset",
               CASE WHEN event_id % 101 = 0 THEN '__heartbeat-' || event_id WHEN event_id % 89 = 0 THEN NULL
                    ELSE 'user-' || lpad(user_id::VARCHAR, 5, '0') END AS key,
               CASE WHEN event_id % 101 = 0 THEN props WHEN event_id % 89 = 0 THEN props
                    WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 43 = 0 THEN '' ELSE props END AS value,
               ts
        FROM events""",
    "v_notif": f"""
        SELECT event_id, 'notif-' || event_id AS id, 'user-' || user_id AS user_id,
               {notification_channel("event_id")} AS channel, 'Title ' || event_type AS title, props AS body,
               'trace-' || event_id AS trace_id, ts AS created_at, 'notifications' AS topic,
               cast(user_id % 4 AS int) AS "partition", event_id AS "offset"
        FROM events""",
    "v_deliv": f"""
        SELECT channel, event_id AS seq, id AS notification_id, {delivery_status("event_id")} AS status,
               event_id % 3 + 1 AS attempts, created_at AS ts
        FROM v_notif WHERE channel IN ('CHANNEL_FIREBASE', 'CHANNEL_APNS', 'CHANNEL_WEBHOOK')""",
    "v_nlog": """
        SELECT notification_id, channel, CASE WHEN status = 400 THEN 'dlq' ELSE 'delivered' END AS status, attempts,
               CASE WHEN status = 400 THEN 'status 400' END AS last_error, ts + to_minutes(copy) AS sent_at,
               seq * 2 + copy AS seq
        FROM v_deliv, (VALUES (0), (1)) c(copy)
        WHERE (status BETWEEN 200 AND 299 OR status = 400) AND (copy = 0 OR seq % 13 = 0)""",
    "v_done": """SELECT "partition", "offset" FROM v_log WHERE topic = 'events.click' AND event_id % 211 <> 5""",
    "v_prod": """
        SELECT event_type AS scenario, event_id AS seq, cents AS latency_us, event_id % 40 <> 0 AS ok,
               CASE WHEN event_id % 40 <> 0 THEN NULL WHEN event_id % 160 = 0 THEN 'MESSAGE_TOO_LARGE'
                    WHEN event_id % 160 = 40 THEN 'NOT_ENOUGH_REPLICAS'
                    WHEN event_id % 160 = 80 THEN 'DEADLINE_EXCEEDED' ELSE 'CONTEXT_CANCELED' END AS error,
               arrival_ts AS ts
        FROM v_evt""",
    "v_hdr": f"""
        SELECT 'events.' || event_type AS topic, 'user-' || user_id AS key,
               CASE WHEN event_id % 23 = 0 THEN NULL WHEN event_id % 19 = 0 THEN left({_TRACE}, 20)
                    ELSE {_TRACE} END AS traceparent,
               CASE WHEN event_id % 29 = 0 THEN NULL ELSE 'corr-' || event_id END AS correlation_id
        FROM events""",
    "v_dirs": """
        SELECT broker, topic, "partition", bytes + broker AS bytes
        FROM (SELECT topic, "partition", sum(bytes)::BIGINT AS bytes FROM v_log GROUP BY ALL), (VALUES (1), (2), (3)) b(broker)""",
    "v_meta": """
        SELECT topic, "partition", [3, 1, 2] AS replicas,
               CASE WHEN ("partition" + length(topic)) % 3 = 0 THEN [1, 3] ELSE [1, 3, 2] END AS isr, count(*) AS records
        FROM v_log GROUP BY topic, "partition" """,
    "v_metr": """
        SELECT hour + INTERVAL 1 HOUR AS ts, topic, (sum(n) OVER w)::BIGINT AS high_water,
               (sum(n) OVER w)::BIGINT // 10 AS low_water, (sum(b) OVER w)::BIGINT AS bytes
        FROM (SELECT topic, date_trunc('hour', timestamp) AS hour, count(*) AS n, sum(bytes) AS b,
                     CASE WHEN topic = 'events.error' AND date_trunc('hour', timestamp) >= TIMESTAMP '2024-01-15 00:00:00' THEN 1 ELSE 0 END AS era
              FROM v_log GROUP BY ALL)
        WINDOW w AS (PARTITION BY topic, era ORDER BY hour)""",
    "v_keys": """
        SELECT c_custkey AS seq, strlen(key)::BIGINT AS bytes, key FROM (
            SELECT c_custkey, CASE WHEN c_custkey % 10 < 3 THEN 'prem-' || (c_custkey % 50) ELSE 'reg-' || (c_custkey % 500) END AS key
            FROM customer)""",
    "v_cust": f"SELECT {', '.join(image_user())} FROM (SELECT c_custkey AS c FROM customer)",
    "v_cdcsteps": f"""
        SELECT c, step, {", ".join(image_user(with_id=False))}
        FROM (SELECT c_custkey AS c, unnest([1, 2, 3, 4, 5, 6, 7, 8, 9]) AS step FROM customer) WHERE {CDC_STEPS}""",
    "v_cdcrows": f"""
        SELECT c * 10 + step AS seq,
               CASE step WHEN 8 THEN 'cdc.public.secrets' WHEN 9 THEN 'other.users' ELSE 'cdc.public.users' END AS topic,
               cast(c % 3 AS int) AS "partition", cast(c AS string) AS key, {cdc_value()} AS value
        FROM v_cdcsteps""",
    "v_cdc": """
        SELECT *, row_number() OVER (PARTITION BY topic, "partition" ORDER BY seq) - 1 AS "offset" FROM v_cdcrows""",
    # Parsed envelopes; bad JSON gives no row here.
    "v_cdcp1": """
        SELECT topic, "partition", "offset", key, value, value::JSON AS j FROM v_cdc
        WHERE value IS NOT NULL AND json_valid(value)""",
    "v_cdcimg": """
        SELECT topic, "partition", "offset", key, j->>'$.op' AS op,
               CASE WHEN j->>'$.op' = 'd' THEN 1 ELSE 0 END AS deleted,
               CASE WHEN j->>'$.op' = 'd' THEN j->'$.before' ELSE j->'$.after' END AS img,
               coalesce(try_cast(j->>'$.source.lsn' AS BIGINT), try_cast(j->>'$.source.ts_ms' AS BIGINT), 0) AS cdc_lsn
        FROM v_cdcp1
        WHERE j->>'$.op' IN ('c', 'u', 'r', 'd')
          AND json_type(CASE WHEN j->>'$.op' = 'd' THEN j->'$.before' ELSE j->'$.after' END) = 'OBJECT'""",
    "v_cdcp": f"""
        SELECT 'search.public.products' AS topic, cast(p_partkey % 3 AS int) AS "partition", p_partkey * 10 + step AS "offset",
               '{{"id":' || p_partkey || '}}' AS key, {cdcp_value()} AS value
        FROM (SELECT *, unnest([1, 2, 3, 4]) AS step FROM part) WHERE {CDCP_STEPS}""",
    "v_ord": """
        SELECT o_orderkey AS k, 'ord-' || o_orderkey AS id, 'cus-' || o_custkey AS customer_id,
               cast(round(o_totalprice * 100) AS bigint) AS amount_cents, 'EUR' AS currency,
               CASE o_orderstatus WHEN 'O' THEN 'ORDER_STATUS_NEW' WHEN 'P' THEN 'ORDER_STATUS_PAID'
                    ELSE 'ORDER_STATUS_SHIPPED' END AS status, o_orderdate AS created_at
        FROM orders""",
    "v_outbox": """
        SELECT k + 1 AS id, id AS aggregate_id, 'orders' AS topic,
               '{"order_id":"' || id || '","customer_id":"' || customer_id || '","amount_cents":' || amount_cents
                 || ',"trace_id":"trace-' || k || '","tenant_id":"t' || (k % 3) || '"}' AS payload,
               created_at, CASE WHEN k % 5 = 0 THEN NULL ELSE created_at + INTERVAL 1 MINUTE END AS published_at
        FROM v_ord WHERE k % 997 <> 0""",
    "v_outcdc": """
        SELECT CASE (id - 1) % 10 WHEN 1 THEN 'd' WHEN 2 THEN 'r' ELSE 'c' END AS op, id,
               CASE (id - 1) % 3 WHEN 0 THEN 'order' WHEN 1 THEN 'user' ELSE 'payment' END AS aggregate_type,
               aggregate_id, 'created' AS type, payload
        FROM v_outbox""",
    "v_ordev": """
        SELECT k + 1 AS outbox_id, cast(k % 6 AS int) AS "partition", k * 2 + copy AS "offset",
               CASE WHEN (k % 6 + copy) % 2 = 0 THEN 'inventory-1' ELSE 'inventory-2' END AS node, id AS order_id,
               customer_id, amount_cents, currency, status,
               CASE WHEN k % 1009 = 0 THEN 'not-a-date' ELSE strftime(created_at, '%Y-%m-%dT%H:%M:%SZ') END AS created_at
        FROM v_ord, (VALUES (0), (1)) c(copy)
        WHERE k % 997 <> 0 AND k % 5 <> 0 AND (copy = 0 OR k % 7 = 0)""",
    "v_conn": f"""
        SELECT 'orders-json' AS topic, cast(k % 3 AS int) AS "partition", k * 2 + copy AS "offset", {conn_value()} AS value
        FROM v_ord, (VALUES (0), (1)) c(copy) WHERE copy = 0 OR k % 6 = 0""",
    "v_view": """
        SELECT k AS id, customer_id, amount_cents // 2 AS amount_cents, currency, 'OLD' AS status, created_at
        FROM v_ord WHERE k % 3 = 0""",
    "v_ordv": f"""
        SELECT id AS order_id, cast(1 + k % 3 AS int) AS version, {ordv_payload()} AS payload, k FROM v_ord""",
    # Registry-framed values as upper-case hex text.
    "v_wire": """
        SELECT 'orders-wire' AS topic, cast(k % 3 AS int) AS "partition", k AS "offset",
               CASE WHEN k % 53 = 0 THEN '000000'
                    ELSE (CASE WHEN k % 59 = 0 THEN '01' ELSE '00' END) || lpad(to_hex(1 + k % 4), 8, '0')
                      || (CASE WHEN k % 61 = 0 THEN '0206' ELSE '00' END) || hex(payload) END AS hx
        FROM v_ordv""",
    "v_pay": f"""
        SELECT 'payments' AS topic, cast(o_orderkey % 3 AS int) AS "partition", o_orderkey AS "offset",
               'ord-' || o_orderkey AS key, {PAY_MODE} AS mode, o_orderkey % 10 = 0 AS bad,
               CASE WHEN o_orderkey % 10 = 0 THEN 'not json ' || o_orderkey
                    ELSE '{{"id":"pay-' || o_orderkey || '","amount":' || cast(round(o_totalprice * 100) AS bigint)
                      || ',"mode":"' || {PAY_MODE} || '"}}' END AS value,
               o_orderdate AS timestamp
        FROM orders""",
    # Outcome class and message of each payment.
    "v_paycls": """
        SELECT *, CASE WHEN bad THEN 'permanent' WHEN mode = 'ok' THEN 'ok' WHEN mode = 'transient' THEN 'transient' ELSE 'permanent' END AS cls,
               CASE WHEN bad THEN 'invalid json'
                    WHEN mode = 'ok' THEN NULL
                    WHEN mode = 'transient' THEN 'payment not settled for now, id="pay-' || "offset" || '"'
                    WHEN mode = 'permanent' THEN 'payment refused for good, id="pay-' || "offset" || '"'
                    ELSE 'no such mode: "' || mode || '"' END AS message
        FROM v_pay""",
    # Dead letters of the staged pipeline as flat columns.
    "v_dlq": """
        SELECT 'payments-dlq' AS topic, "partition", "offset", key, value, timestamp + INTERVAL 1 DAY AS timestamp,
               'payments' AS original_topic, CASE WHEN cls = 'permanent' THEN 'payments' ELSE 'payments-retry-1h' END AS previous_topic,
               CASE WHEN cls = 'permanent' THEN 1 ELSE 4 END AS retry_count, cls AS error_class, message AS error_message,
               timestamp + (CASE WHEN cls = 'permanent' THEN INTERVAL 0 SECOND ELSE INTERVAL 3930 SECOND END) AS error_timestamp
        FROM v_paycls WHERE cls <> 'ok'""",
    "v_upload": """
        SELECT k AS seq, CASE WHEN k % 17 = 0 THEN '' ELSE customer_id END AS customer_id,
               CASE WHEN k % 19 = 0 THEN 0 WHEN k % 23 = 0 THEN -amount_cents ELSE amount_cents END AS amount_cents,
               CASE WHEN k % 29 = 0 THEN '' ELSE currency END AS currency
        FROM v_ord""",
    "v_txn": """
        SELECT topic, k AS "offset", CASE WHEN k % 37 = 0 THEN NULL ELSE 'producer-' || (k % 4) END AS txn_id,
               CASE WHEN k < 5000 OR k % 500 = 3 THEN 1 ELSE 2 END AS epoch,
               CASE WHEN k % 37 = 0 THEN NULL ELSE k END AS txn_no, id AS order_id
        FROM v_ord, (VALUES ('orders'), ('payments'), ('shipments')) t(topic)""",
    "v_markers": """
        SELECT 'producer-' || (k % 4) AS txn_id, k AS txn_no, CASE WHEN k % 10 < 7 THEN 'commit' ELSE 'abort' END AS outcome,
               created_at AS ts
        FROM v_ord WHERE k % 10 <> 9 AND k % 37 <> 0""",
    "v_saga": f"""
        SELECT 's-' || k AS saga_id, seq, event, start + to_minutes(cast(seq AS int)) AS ts FROM (
            SELECT o_orderkey AS k, o_orderdate AS start, unnest(chain) AS event, unnest(range(1, len(chain) + 1)) AS seq
            FROM (SELECT o_orderkey, o_orderdate, {SAGA_EVENTS.replace("array(", "list_value(")} AS chain FROM orders))""",
    "v_sagacmd": _sagacmd(),
    "v_ordn": """
        SELECT l_orderkey, 'sku-' || l_partkey AS sku, cast(l_quantity AS bigint) AS quantity,
               cast(round(l_extendedprice * 100) AS bigint) AS price_cents, l_shipdate AS shipped
        FROM lineitem""",
    "v_docs": 'SELECT doc_id, cast(doc_id % 3 AS int) AS "partition", doc_id AS "offset", text FROM documents',
    "v_tokens": r"""
        SELECT doc_id, "partition", "offset", pos, word FROM (
            SELECT doc_id, "partition", "offset", unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM (
                SELECT *, list_filter(regexp_extract_all(lower(text), '[\p{L}\p{Nd}]+'), lambda w: strlen(w) >= 2) AS ws FROM v_docs))""",
}
