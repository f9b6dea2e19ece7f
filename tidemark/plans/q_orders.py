"""Queries over orders: outbox, read views, contracts and uploads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.headers import format_headers
from ..functions.names import timestamp_text
from ..operators import contracts, joins, quality, records
from ..sources import outbox as ob
from ..sources import sinks
from .registry import query

FMT = "strftime({0}, '%Y-%m-%d %H:%M:%S')"


@query(
    "s04_read_unpublished",
    "SELECT id, aggregate_id, topic, payload FROM v_outbox WHERE published_at IS NULL ORDER BY id LIMIT 500",
)
def _(t):
    return ob.read_unpublished(t.outbox, 500).select("id", "aggregate_id", "topic", "payload")


@query(
    "s05_mark_published",
    f"""SELECT id, {FMT.format("CASE WHEN id IN (SELECT id FROM v_outbox WHERE published_at IS NULL ORDER BY id LIMIT 500) THEN TIMESTAMP '2024-02-01 00:00:00' ELSE published_at END")} AS published_at
        FROM v_outbox""",
)
def _(t):
    batch = ob.read_unpublished(t.outbox, 500).select("id")
    marked = ob.mark_published(t.outbox, batch, F.lit("2024-02-01 00:00:00").cast("timestamp"))
    return marked.select("id", timestamp_text("published_at").alias("published_at"))


@query(
    "s06_outbox_to_records",
    """SELECT topic, aggregate_id AS key, payload AS value,
              'aggregate-id=' || aggregate_id || ' content-type=application/json event-type=order.created outbox-id=' || id
                || ' publisher-node=node-1 tenant-id=' || (payload::JSON->>'$.tenant_id') || ' trace-id=' || (payload::JSON->>'$.trace_id') AS headers
       FROM v_outbox""",
)
def _(t):
    return ob.outbox_to_records(t.outbox, "node-1").withColumn("headers", format_headers("headers"))


@query(
    "s07_outbox_event_router",
    """SELECT 'events.' || aggregate_type AS topic, aggregate_id AS key, payload AS value,
              'aggregateType=' || aggregate_type || ' eventType=' || type AS headers FROM v_outcdc WHERE op IN ('c', 'r')""",
)
def _(t):
    return ob.outbox_event_router(t.outcdc).withColumn("headers", format_headers("headers"))


@query(
    "s15_switch_version",
    """SELECT 'orders_current' AS alias, 'orders_v2' AS target, (SELECT count(*) FROM v_view) AS old_count,
              (SELECT count(*) FROM v_ord) AS new_count, true AS switched""",
)
def _(t):
    return sinks.switch_version(t.spark, "orders_current", t.view, t.ord, "orders_v2")


@query(
    "j01_dedup_gate",
    """SELECT consumer, outbox_id, min("offset") AS "offset" FROM v_logdup d
       WHERE NOT EXISTS (SELECT 1 FROM v_processed p WHERE p.consumer = d.consumer AND p.outbox_id = d.outbox_id) GROUP BY ALL""",
)
def _(t):
    return joins.dedup_gate(t.logdup, t.processed).select("consumer", "outbox_id", "offset")


@query(
    "j01_gate_counts",
    """SELECT consumer, count(*) AS processed,
              count(DISTINCT CASE WHEN NOT (consumer = 'inventory' AND outbox_id % 11 = 0) THEN outbox_id END) AS inserted,
              count(*) - count(DISTINCT CASE WHEN NOT (consumer = 'inventory' AND outbox_id % 11 = 0) THEN outbox_id END) AS skipped
       FROM v_logdup GROUP BY consumer""",
)
def _(t):
    return joins.gate_counts(t.logdup, joins.dedup_gate(t.logdup, t.processed))


@query(
    "j02_project_read_view",
    f"""WITH e AS (SELECT * FROM v_ordev WHERE created_at <> 'not-a-date'),
             g AS (SELECT DISTINCT ON (outbox_id) * FROM e WHERE outbox_id % 11 <> 0 ORDER BY outbox_id, "offset"),
             v AS (SELECT 'ord-' || id AS id, customer_id, amount_cents, currency, status, created_at FROM v_view)
        SELECT 'view' AS kind, coalesce(g.order_id, v.id) AS id, coalesce(g.customer_id, v.customer_id) AS customer_id,
               coalesce(g.amount_cents, v.amount_cents) AS amount_cents, coalesce(g.status, v.status) AS status,
               {FMT.format("coalesce(v.created_at, strptime(g.created_at, '%Y-%m-%dT%H:%M:%SZ'))")} AS created_at
        FROM g FULL JOIN v ON g.order_id = v.id
        UNION ALL SELECT 'error', order_id, customer_id, amount_cents, status, created_at FROM v_ordev WHERE created_at = 'not-a-date'""",
)
def _(t):
    events = t.ordev.withColumnRenamed("order_id", "id").withColumn("consumer", F.lit("order-query"))
    done = t.ordev.filter("outbox_id % 11 = 0").selectExpr("'order-query' AS consumer", "outbox_id").distinct()
    view = t.view.withColumn("id", F.concat(F.lit("ord-"), "id"))
    rows, errors = joins.project_read_view(events, done, view)
    out = rows.withColumn("created_at", timestamp_text("created_at")).withColumn("kind", F.lit("view"))
    columns = ["kind", "id", "customer_id", "amount_cents", "status", "created_at"]
    return out.select(*columns).unionByName(errors.withColumn("kind", F.lit("error")).select(*columns))


VERSION_VALUES = ", ".join(
    f"({v}, {n}, '{name}', '{kind}')" for v, fields in contracts.ORDER_VERSIONS.items() for n, name, kind in fields
)


@query(
    "j08_schema_compat",
    f"""WITH d AS (SELECT * FROM (VALUES {VERSION_VALUES}) v(version, number, name, type)),
             pairs AS (SELECT * FROM (VALUES (1, 2), (2, 3), (3, 4)) p(o, n)),
             f AS (SELECT o || '->' || n AS pair, num, coalesce(b.name, a.name) AS name,
                     CASE WHEN a.name IS NULL AND EXISTS (SELECT 1 FROM d x WHERE x.version = o AND x.name = b.name) THEN 'moved'
                          WHEN a.name IS NULL THEN 'added' WHEN b.name IS NULL THEN 'removed'
                          WHEN a.type <> b.type THEN 'type changed' WHEN a.name <> b.name THEN 'renamed' ELSE 'same' END AS change
                   FROM pairs CROSS JOIN (SELECT unnest(range(1, 8))::INT AS num)
                   LEFT JOIN d a ON a.version = o AND a.number = num LEFT JOIN d b ON b.version = n AND b.number = num
                   WHERE a.name IS NOT NULL OR b.name IS NOT NULL),
             seen AS (SELECT field, count(*) AS n FROM (SELECT unnest(json_keys(payload)) AS field FROM v_ordv) GROUP BY field)
        SELECT pair, num AS number, name, change, coalesce(seen.n, 0) AS observed,
               bool_and(change NOT IN ('type changed', 'moved')) OVER w AS backward,
               bool_and(change NOT IN ('type changed', 'moved', 'removed')) OVER w AS forward,
               bool_and(change NOT IN ('type changed', 'moved', 'removed')) OVER w AS full_mode
        FROM f LEFT JOIN seen ON seen.field = f.name WINDOW w AS (PARTITION BY pair)""",
)
def _(t):
    declared = contracts.schema_fields(t.spark)
    seen = t.ordv.select(F.explode(F.json_object_keys("payload")).alias("name")).groupBy("name").agg(
        F.count("*").alias("observed")
    )
    changes = None
    for old, new in ((1, 2), (2, 3), (3, 4)):
        versions = [declared.filter(F.col("version") == v) for v in (old, new)]
        one = contracts.schema_compat(*versions).withColumn("pair", F.lit(f"{old}->{new}"))
        changes = one if changes is None else changes.unionByName(one)
    verdicts = changes.groupBy("pair").agg(
        *[
            contracts.compat_verdict(mode).alias(name)
            for mode, name in (("BACKWARD", "backward"), ("FORWARD", "forward"), ("FULL", "full_mode"))
        ]
    )
    out = changes.join(verdicts, "pair")
    return out.join(seen, "name", "left").withColumn("observed", F.coalesce("observed", F.lit(0)))


@query(
    "j09_outbox_gaps",
    """SELECT o.id AS order_id, 'outbox' AS missing_in FROM v_ord o ANTI JOIN v_outbox b ON o.id = b.aggregate_id
       UNION ALL SELECT b.aggregate_id, 'orders' FROM v_outbox b ANTI JOIN v_ord o ON o.id = b.aggregate_id""",
)
def _(t):
    return joins.outbox_gaps(t.ord, t.outbox)


RESERVED_SQL = """SELECT order_id, arg_min(node, "offset") AS node, min("offset") AS "offset" FROM v_ordev
                  WHERE (outbox_id - 1) % 50 <> 1 GROUP BY order_id"""


def reservations(t):
    existing = t.ord.filter("k % 50 = 1").selectExpr("id AS order_id")
    return joins.reserve_inventory(t.ordev, existing)


@query("j11_reserve_inventory", RESERVED_SQL)
def _(t):
    return reservations(t)


@query("a12_reservations_by_node", f"SELECT node, count(*) AS reservations FROM ({RESERVED_SQL}) GROUP BY node")
def _(t):
    return quality.reservations_by_node(reservations(t))


@query(
    "a09_duplicate_summary",
    """SELECT count(*) AS total, count(DISTINCT outbox_id) AS unique_keys, count(*) - count(DISTINCT outbox_id) AS duplicates,
              CASE WHEN count(*) = count(DISTINCT outbox_id) THEN 'exactly once' ELSE 'duplicates' END AS verdict
       FROM v_logdup WHERE consumer = 'inventory'""",
)
def _(t):
    return quality.duplicate_summary(t.logdup.filter("consumer = 'inventory'"), "outbox_id")


@query(
    "a10_duplicates_by_key",
    "SELECT notification_id, channel, count(*) AS n FROM v_nlog GROUP BY ALL HAVING count(*) > 1",
)
def _(t):
    return quality.duplicates_by_key(t.nlog, ["notification_id", "channel"])


@query(
    "a11_history_by_channel",
    """SELECT channel, count(*) FILTER (status = 'delivered') AS delivered, count(*) FILTER (status = 'dlq') AS dlq, count(*) AS total
       FROM v_nlog GROUP BY channel""",
)
def _(t):
    return quality.history_by_channel(t.nlog)


@query(
    "p13_validate_orders",
    """SELECT seq, CASE WHEN customer_id = '' THEN 'no customer given' WHEN amount_cents <= 0 THEN 'amount is not above zero'
                        WHEN currency = '' THEN 'no currency given' END AS error FROM v_upload""",
)
def _(t):
    return records.validate_orders(t.upload).select("seq", "error")


@query(
    "a13_upload_summary",
    """SELECT count(*) AS received, count(*) FILTER (amount_cents > 0 AND customer_id <> '') AS accepted,
              count(*) FILTER (NOT (amount_cents > 0 AND customer_id <> '')) AS rejected,
              (sum(amount_cents) FILTER (amount_cents > 0 AND customer_id <> ''))::BIGINT AS total_cents FROM v_upload""",
)
def _(t):
    return records.upload_summary(t.upload)


@query(
    "p25_subscribe",
    f"""SELECT 'one' AS kind, id, customer_id, {FMT.format('created_at')} AS created_at FROM v_ord WHERE customer_id = 'cus-100'
        UNION ALL (SELECT 'first', id, customer_id, {FMT.format('created_at')} FROM v_ord ORDER BY v_ord.created_at, id LIMIT 50)""",
)
def _(t):
    one = records.subscribe(t.ord, "cus-100").withColumn("kind", F.lit("one"))
    first = records.subscribe(t.ord, limit=50).withColumn("kind", F.lit("first"))
    both = one.unionByName(first)
    return both.select("kind", "id", "customer_id", timestamp_text("created_at").alias("created_at"))


@query(
    "p21_project_schema",
    """SELECT order_id, version, payload::JSON->>'$.id' AS id, payload::JSON->>'$.customer_id' AS customer_id,
              (payload::JSON->>'$.amount_cents')::BIGINT AS amount_cents, coalesce(payload::JSON->>'$.currency', '') AS currency,
              CASE WHEN version = 3 THEN 'shipping_address' ELSE '' END AS unknown_fields FROM v_ordv""",
)
def _(t):
    fields = {"id": "string", "customer_id": "string", "amount_cents": "bigint", "currency": "string"}
    return contracts.project_schema(t.ordv.drop("k"), fields)


@query(
    "p22_wire_header_audit",
    """WITH w AS (SELECT hx, length(hx) // 2 AS size FROM v_wire),
            e AS (SELECT *, CASE WHEN size < 5 THEN 'short' WHEN left(hx, 2) <> '00' THEN 'bad magic'
                              WHEN substr(hx, 11, 2) <> '00' THEN 'bad index' END AS error FROM w)
       SELECT CASE WHEN error IS NULL THEN ('0x' || substr(hx, 3, 8))::BIGINT END AS schema_id, error, count(*) AS records,
              sum(size)::BIGINT AS bytes, sum(CASE WHEN error IS NULL THEN size - 6 END)::BIGINT AS payload_bytes
       FROM e GROUP BY ALL""",
)
def _(t):
    return contracts.wire_header_audit(t.wire)


def _varint(n: str) -> str:
    steps = " ".join(f"WHEN {n} < {1 << (7 * i)} THEN {i}" for i in range(1, 9))
    return f"(CASE WHEN {n} < 0 THEN 10 {steps} ELSE 9 END)"


def _avro_str(n: str) -> str:
    return f"({_varint(f'(2 * {n})')} + {n})"


def _proto_str(n: str) -> str:
    return f"(CASE WHEN {n} = 0 THEN 0 ELSE 1 + {_varint(n)} + {n} END)"


def _proto_int(n: str) -> str:
    return f"(CASE WHEN {n} = 0 THEN 0 ELSE 1 + {_varint(n)} END)"


_INNER = f"({_proto_str('strlen(sku)')} + {_proto_int('quantity')} + {_proto_int('price_cents')})"


@query(
    "a16_wire_size_report",
    f"""WITH i AS (SELECT l_orderkey, price_cents, shipped,
                     strlen('{{"sku":"' || sku || '","quantity":' || quantity || ',"price_cents":' || price_cents || '}}') AS j,
                     {_avro_str('strlen(sku)')} + {_varint('(2 * quantity)')} + {_varint('(2 * price_cents)')} AS a,
                     1 + {_varint(_INNER)} + {_INNER} AS p FROM v_ordn),
             o AS (SELECT count(*) AS n, sum(price_cents)::BIGINT AS amount, epoch(min(shipped))::BIGINT AS created,
                     'ord-' || l_orderkey AS id, 'cus-' || (l_orderkey % 1000) AS cus, sum(j) AS j, sum(a) AS a, sum(p) AS p FROM i GROUP BY l_orderkey),
             s AS (SELECT strlen('{{"id":"' || id || '","customer_id":"' || cus || '","amount_cents":' || amount
                            || ',"currency":"EUR","created_at_unix":' || created || ',"items":[]}}') + j + n - 1 AS json,
                     {_avro_str('strlen(id)')} + {_avro_str('strlen(cus)')} + {_varint('(2 * amount)')} + {_avro_str('3')}
                       + {_varint('(2 * created)')} + {_varint('(2 * n)')} + a + 1 AS avro,
                     {_proto_str('strlen(id)')} + {_proto_str('strlen(cus)')} + {_proto_int('amount')} + {_proto_str('3')}
                       + {_proto_int('created')} + p AS protobuf FROM o)
        SELECT f AS format, count(*) AS records, sum(CASE f WHEN 'json' THEN json WHEN 'avro' THEN avro ELSE protobuf END)::BIGINT AS bytes,
               round(sum(CASE f WHEN 'json' THEN json WHEN 'avro' THEN avro ELSE protobuf END) / count(*), 6) AS avg_bytes
        FROM s, (VALUES ('json'), ('avro'), ('protobuf')) v(f) GROUP BY f""",
)
def _(t):
    return contracts.wire_size_report(t.ordn_items)


@query(
    "z18_repartition_by_batch",
    "SELECT customer_id, count(*) AS orders, sum(amount_cents)::BIGINT AS amount_cents FROM v_ord GROUP BY customer_id",
)
def _(t):
    return quality.totals_by_key(t.ord, "customer_id")
