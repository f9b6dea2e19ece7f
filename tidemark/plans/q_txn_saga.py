"""Queries over transactions and sagas."""

from __future__ import annotations

from ..functions.names import timestamp_text
from ..operators import sagas, transactions
from .registry import query

COMMITTED_SQL = """SELECT topic, "offset", txn_id, epoch, order_id FROM v_txn t
    WHERE txn_id IS NULL OR EXISTS (SELECT 1 FROM v_markers m WHERE m.txn_id = t.txn_id AND m.txn_no = t.txn_no AND m.outcome = 'commit')"""


@query("j03_read_committed", COMMITTED_SQL)
def _(t):
    return transactions.read_committed(t.txn, t.markers).drop("txn_no")


@query(
    "a22_isolation_counts",
    f"""WITH c AS (SELECT 'committed' AS level, topic FROM ({COMMITTED_SQL}) UNION ALL SELECT 'uncommitted', topic FROM v_txn)
        SELECT level, topic AS label, count(*) AS records FROM c GROUP BY ALL
        UNION ALL SELECT level, 'TOTAL', count(*) FROM c GROUP BY level""",
)
def _(t):
    return transactions.isolation_counts(t.txn, t.markers)


@query(
    "a23_txn_outcomes",
    """SELECT coalesce(m.outcome, 'open') AS outcome, count(DISTINCT t.txn_no) AS attempts, count(*) AS records
       FROM v_txn t LEFT JOIN v_markers m ON m.txn_no = t.txn_no WHERE t.txn_id IS NOT NULL GROUP BY 1""",
)
def _(t):
    return transactions.txn_outcomes(t.txn, t.markers)


@query(
    "w12_fence_stale_writers",
    """SELECT topic, "offset", txn_id, epoch, epoch < max(epoch) OVER (PARTITION BY txn_id ORDER BY txn_no) AS fenced
       FROM v_txn WHERE txn_id IS NOT NULL""",
)
def _(t):
    return transactions.fence_stale_writers(t.txn).select("topic", "offset", "txn_id", "epoch", "fenced")


TERMINAL = "('shipment.scheduled', 'payment.failed', 'payment.refunded')"


@query(
    "w10_saga_timeline",
    f"""WITH w AS (SELECT saga_id, arg_max(event, seq) AS last_event, count(*) AS events FROM v_saga GROUP BY saga_id)
        SELECT s.saga_id, s.seq >> 10 AS part, string_agg(s.event, ' → ' ORDER BY s.seq) AS chain, any_value(w.last_event) AS last_event,
               any_value(w.events) AS events, any_value(w.last_event) IN {TERMINAL} AS terminal
        FROM v_saga s JOIN w ON w.saga_id = s.saga_id GROUP BY s.saga_id, part""",
)
def _(t):
    return sagas.saga_timeline(t.saga)


@query(
    "j10_open_sagas",
    f"SELECT saga_id, count(*) AS events FROM v_saga GROUP BY saga_id HAVING count(*) FILTER (event IN {TERMINAL}) = 0",
)
def _(t):
    return sagas.open_sagas(t.saga)


Z10_SQL = f"""WITH p AS (SELECT saga_id, event, seq, coalesce(lag(event) OVER (PARTITION BY saga_id ORDER BY seq), '') AS before FROM v_saga),
        v AS (SELECT saga_id, count(*) FILTER (event <> 'order.requested' AND (before, event) NOT IN (
                ('order.requested', 'payment.completed'), ('order.requested', 'payment.failed'), ('payment.completed', 'inventory.reserved'),
                ('payment.completed', 'inventory.failed'), ('inventory.reserved', 'shipment.scheduled'), ('inventory.reserved', 'shipment.failed'),
                ('shipment.failed', 'inventory.released'), ('inventory.failed', 'payment.refunded'), ('inventory.released', 'payment.refunded'))) AS violations,
              list(event) AS es FROM p GROUP BY saga_id)
    SELECT saga_id, violations,
           (CASE WHEN list_contains(es, 'inventory.failed') AND NOT list_contains(es, 'payment.refunded') THEN 1 ELSE 0 END
            + CASE WHEN list_contains(es, 'shipment.failed') AND NOT list_contains(es, 'inventory.released') THEN 1 ELSE 0 END
            + CASE WHEN list_contains(es, 'inventory.released') AND NOT list_contains(es, 'payment.refunded') THEN 1 ELSE 0 END)::BIGINT AS missing_compensations,
           CASE WHEN list_contains(es, 'shipment.scheduled') THEN 'success'
                WHEN list_contains(es, 'payment.failed') OR list_contains(es, 'payment.refunded') THEN 'failed' ELSE 'open' END AS outcome FROM v"""


@query("z10_saga_conformance", Z10_SQL)
def _(t):
    return sagas.saga_conformance(t.saga)


Z09_SQL = """WITH m AS (SELECT s.* FROM v_sagacmd s WHERE saga_id IN (SELECT saga_id FROM v_sagacmd WHERE kind = 'place-order')),
    e AS (SELECT *,
            CASE action WHEN 'PLACE' THEN 'AWAITING_PAYMENT' WHEN 'AUTHORIZE' THEN (CASE WHEN ok THEN 'AWAITING_INVENTORY' ELSE 'DONE' END)
                WHEN 'REFUND' THEN 'DONE' WHEN 'RESERVE' THEN (CASE WHEN ok THEN 'AWAITING_SHIPMENT' ELSE 'COMPENSATING_PAYMENT' END)
                WHEN 'RELEASE' THEN 'COMPENSATING_PAYMENT' ELSE (CASE WHEN ok THEN 'DONE' ELSE 'COMPENSATING_INVENTORY' END) END AS step,
            CASE WHEN action = 'REFUND' OR (action = 'AUTHORIZE' AND NOT ok) THEN 'FAILED' WHEN action = 'SCHEDULE' AND ok THEN 'SUCCESS' ELSE 'RUNNING' END AS status,
            CASE action WHEN 'PLACE' THEN 'place-order' WHEN 'AUTHORIZE' THEN (CASE WHEN ok THEN 'payment.authorized' ELSE 'payment.failed' END)
                WHEN 'REFUND' THEN 'payment.refunded' WHEN 'RESERVE' THEN (CASE WHEN ok THEN 'inventory.reserved' ELSE 'inventory.failed' END)
                WHEN 'RELEASE' THEN 'inventory.released' ELSE (CASE WHEN ok THEN 'shipment.scheduled' ELSE 'shipment.failed' END) END AS event,
            CASE action WHEN 'PLACE' THEN 'payment:AUTHORIZE' WHEN 'AUTHORIZE' THEN (CASE WHEN ok THEN 'inventory:RESERVE' END)
                WHEN 'RESERVE' THEN (CASE WHEN ok THEN 'shipment:SCHEDULE' ELSE 'payment:REFUND' END) WHEN 'RELEASE' THEN 'payment:REFUND'
                WHEN 'SCHEDULE' THEN (CASE WHEN NOT ok THEN 'inventory:RELEASE' END) END AS command,
            CASE WHEN ok THEN NULL WHEN action = 'AUTHORIZE' THEN reason WHEN action = 'REFUND' THEN 'refund-failed: ' || reason
                WHEN action = 'RESERVE' THEN 'inventory-failed: ' || reason WHEN action = 'SCHEDULE' THEN 'shipment-failed: ' || reason END AS failure FROM m)
    SELECT saga_id, any_value(customer_id) AS customer_id, any_value(amount_cents) AS amount_cents, arg_max(step, seq) AS step,
           arg_max(status, seq) AS status, arg_max(event, seq) AS last_event,
           arg_max(id, seq) FILTER (action = 'AUTHORIZE' AND ok) AS payment_id, arg_max(id, seq) FILTER (action = 'RESERVE' AND ok) AS reservation_id,
           arg_max(id, seq) FILTER (action = 'SCHEDULE' AND ok) AS shipment_id,
           coalesce(arg_max(failure, seq) FILTER (failure IS NOT NULL), CASE WHEN bool_or(action = 'REFUND' AND ok) THEN '' END) AS failure_reason,
           count(command) AS commands, arg_max(command, seq) FILTER (command IS NOT NULL) AS last_command
    FROM e GROUP BY saga_id"""


@query("z09_saga_orchestrator_batch", Z09_SQL)
def _(t):
    return sagas.saga_orchestrator(t.sagacmd)


J13_SQL = """SELECT l.saga_id, strftime(l.ts, '%Y-%m-%d %H:%M:%S') AS requested_at, strftime(r.ts, '%Y-%m-%d %H:%M:%S') AS paid_at
    FROM v_saga l JOIN v_saga r ON l.saga_id = r.saga_id AND r.ts BETWEEN l.ts AND l.ts + INTERVAL 5 MINUTE
    WHERE l.event = 'order.requested' AND r.event = 'payment.completed'"""


@query("j13_stream_stream_join_batch", J13_SQL)
def _(t):
    out = sagas.request_payment_pairs(
        t.saga.filter("event = 'order.requested'"), t.saga.filter("event = 'payment.completed'"), 5
    )
    return out.select("saga_id", timestamp_text("requested_at").alias("requested_at"), timestamp_text("paid_at").alias("paid_at"))
