"""Expression texts of the views that read the same in Spark SQL and in the oracle."""

from __future__ import annotations

# Only the interval arithmetic differs between the engines, so EVT is stated per engine.
EVT_COLUMNS = [
    "event_id",
    "user_id",
    "event_type",
    "cast(round(value * 100) AS bigint) AS cents",
    "cast(ts AS timestamp) AS arrival_ts",
    """CASE WHEN event_id % 97 = 0 THEN cast(ts AS timestamp)
            WHEN event_id % 10 = 0 THEN cast(ts AS timestamp) - make_dt_interval(0, 0, cast(90 + (event_id * 53) % 151 AS int), 0)
            ELSE cast(ts AS timestamp) - make_dt_interval(0, 0, cast((event_id * 37) % 61 AS int), 0) END AS event_ts""",
    "event_id % 10 = 0 AS late",
    "event_id % 97 = 0 AS missing",
    "cast(user_id % 4 AS int) AS part",
]

CDC_STEPS = """CASE step WHEN 1 THEN true WHEN 2 THEN c % 2 = 0 WHEN 3 THEN c % 4 = 0 WHEN 4 THEN c % 4 = 0
    WHEN 5 THEN c % 7 = 0 WHEN 6 THEN c % 500 IN (2, 3) WHEN 7 THEN c % 101 = 0
    WHEN 8 THEN c % 300 = 10 ELSE c % 300 = 11 END"""

CDCP_STEPS = """CASE step WHEN 1 THEN true WHEN 2 THEN p_partkey % 2 = 0 WHEN 3 THEN p_partkey % 4 = 0
    ELSE p_partkey % 8 = 0 END"""


def image_user(with_id: bool = True) -> list[str]:
    """Columns of a user row by customer number ``c``."""
    first = ["c AS id"] if with_id else []
    return first + [
        "CASE WHEN c % 50 = 0 THEN NULL ELSE concat('user', c, '@example.com') END AS email",
        "concat('+7900', lpad(cast(c AS string), 7, '0')) AS phone",
        """CASE WHEN c = 1 THEN 'Иван Иванов' WHEN c % 9 = 0 THEN concat('First', c)
                WHEN c % 8 = 0 THEN concat('First', c, '  Last', c, '  Third')
                ELSE concat('First', c, ' Last', c) END AS full_name""",
        "'1990-01-01' AS birth_date",
        "CASE c % 3 WHEN 0 THEN 'RU' WHEN 1 THEN 'BY' ELSE 'KZ' END AS country",
        "concat('2024-01-01T00:00:00Z+', c, 'm') AS created_at",
    ]


def _image_text(status: str) -> str:
    return f"""concat('{{"id":', c, ',"email":', CASE WHEN email IS NULL THEN 'null' ELSE concat('"', email, '"') END, ',"phone":"', phone,
        '","full_name":"', full_name, '","birth_date":"', birth_date, '","country":"', country,
        '","status":"', {status}, '","created_at":"', created_at, '"}}')"""


def cdc_value() -> str:
    """Envelope text by customer ``c`` and ``step``; a repeat carries the last non-null record."""
    # The step that a repeat copies: the delete, the update or the first image.
    eff = "(CASE WHEN step <> 5 THEN step WHEN c % 4 = 0 THEN 3 WHEN c % 2 = 0 THEN 2 ELSE 1 END)"
    before = f"CASE WHEN {eff} = 2 THEN {_image_text(chr(39) + 'new' + chr(39))} WHEN {eff} = 3 THEN {_image_text(chr(39) + 'active' + chr(39))} ELSE 'null' END"
    after = f"CASE WHEN {eff} = 2 THEN {_image_text(chr(39) + 'active' + chr(39))} WHEN {eff} = 3 THEN 'null' ELSE {_image_text(chr(39) + 'new' + chr(39))} END"
    op = f"CASE WHEN {eff} = 2 THEN 'u' WHEN {eff} = 3 THEN 'd' WHEN {eff} = 6 THEN (CASE WHEN c % 500 = 2 THEN 't' ELSE 'x' END) WHEN c % 5 = 0 THEN 'r' ELSE 'c' END"
    lsn = f"(10 * c + {eff})"
    source = f"""CASE WHEN c % 31 = 0 THEN concat('{{"ts_ms":', 10 * c + 1, '}}')
        WHEN c % 33 = 0 THEN concat('{{"lsn":"', {lsn}, '","ts_ms":', 10 * c + 1, '}}')
        ELSE concat('{{"lsn":', {lsn}, ',"ts_ms":', 10 * c + 1, '}}') END"""
    return f"""CASE WHEN step = 4 THEN NULL WHEN step = 7 THEN concat('{{bad json ', c)
        ELSE concat('{{"before":', {before}, ',"after":', {after}, ',"op":"', {op}, '","source":', {source},
                    ',"ts_ms":', 10 * c + 1, '}}') END"""


# Change rows of orders and events: which steps there are, and their envelope.
ORDER_STEPS = "(step = 1 OR (step = 2 AND o % 3 = 0) OR (step = 3 AND o % 7 = 0) OR (step = 4 AND o % 50 = 1))"
EVENT_STEPS = "(step = 1 OR (step = 2 AND e % 40 = 3))"


def order_value() -> str:
    """Envelope text by order ``o``, ``user_id``, ``amount_cents`` and ``step``: insert, update, delete, bad text."""

    def image(status: str) -> str:
        return f"""concat('{{"id":', o, ',"user_id":', user_id, ',"amount_cents":', amount_cents, ',"status":"{status}","notes":"call ', user_id, '"}}')"""

    source = """concat('"source":{"lsn":', 10 * o + step, '}}')"""
    return f"""CASE step
        WHEN 1 THEN concat('{{"before":null,"after":', {image("new")}, ',"op":"c",', {source})
        WHEN 2 THEN concat('{{"before":', {image("new")}, ',"after":', {image("paid")}, ',"op":"u",', {source})
        WHEN 3 THEN concat('{{"before":', {image("paid")}, ',"after":null,"op":"d",', {source})
        ELSE concat('{{bad order ', o) END"""


def event_value() -> str:
    """Envelope text by event ``e``, ``user_id``, ``kind`` and ``step``; step 2 is bad text."""
    return """CASE step WHEN 1 THEN concat('{"before":null,"after":{"id":', e, ',"user_id":', user_id, ',"kind":"', kind,
        '","ip_address":"10.0.0.', e % 250, '","user_agent":"agent ', e % 9, '"},"op":"r","source":{"lsn":"', 10 * e + step, '"}}')
        ELSE concat('bad event ', e) END"""


def cdcp_value() -> str:
    def image(name: str) -> str:
        return f"""concat('{{"id":', p_partkey, ',"name":"', {name}, '","category":"', p_type, '","price_cents":',
            cast(round(p_retailprice * 100) AS bigint), '}}')"""

    old, new = image("p_name"), image("concat(p_name, ' (updated)')")
    return f"""CASE step
        WHEN 1 THEN concat('{{"before":null,"after":', {old}, ',"op":"c","source":{{"lsn":', 10 * p_partkey + 1, '}}}}')
        WHEN 2 THEN concat('{{"before":', {old}, ',"after":', {new}, ',"op":"u","source":{{"lsn":', 10 * p_partkey + 2, '}}}}')
        WHEN 3 THEN concat('{{"before":', {new}, ',"after":null,"op":"d","source":{{"lsn":', 10 * p_partkey + 3, '}}}}')
        ELSE NULL END"""


def conn_value() -> str:
    """Schema-carrying JSON by order ``k`` and ``copy``; some payloads lack a required field."""
    schema = (
        '{"schema":{"type":"struct","fields":[{"type":"int64","optional":false,"field":"id"},'
        '{"type":"string","optional":false,"field":"customer_id"},{"type":"double","optional":false,"field":"amount"},'
        '{"type":"string","optional":true,"field":"status"},{"type":"int64","optional":false,"field":"created_at"}]},"payload":'
    )
    return f"""concat('{schema}', '{{"id":', k, ',"customer_id":"', customer_id, '"',
        CASE WHEN k % 71 = 0 THEN '' ELSE concat(',"amount":', cast(cast(amount_cents AS decimal(18, 2)) / 100 AS decimal(18, 2))) END,
        CASE WHEN k % 13 = 0 THEN '' ELSE concat(',"status":"', CASE WHEN copy = 1 THEN 'updated' ELSE status END, '"') END,
        ',"created_at":', k * 1000, '}}}}')"""


def ordv_payload() -> str:
    """Order JSON by writer version 1 + k mod 3: version 2 adds the currency, 3 the address."""
    return """concat('{"id":"', id, '","customer_id":"', customer_id, '","amount_cents":', amount_cents,
        CASE WHEN k % 3 >= 1 THEN concat(',"currency":"', currency, '"') ELSE '' END,
        CASE WHEN k % 3 = 2 THEN ',"shipping_address":{"country":"DE","city":"Berlin","street":"Main 1"}' ELSE '' END, '}')"""


PAY_MODE = """CASE WHEN o_orderkey % 10 = 1 THEN 'permanent' WHEN o_orderkey % 10 = 2 THEN 'mystery'
    WHEN o_orderkey % 10 BETWEEN 3 AND 6 THEN 'transient' ELSE 'ok' END"""


def notification_channel(e: str) -> str:
    return f"""CASE WHEN {e} % 50 = 0 THEN 'CHANNEL_UNSPECIFIED' WHEN {e} % 51 = 0 THEN 'CHANNEL_SMS'
        WHEN {e} % 3 = 0 THEN 'CHANNEL_FIREBASE' WHEN {e} % 3 = 1 THEN 'CHANNEL_APNS' ELSE 'CHANNEL_WEBHOOK' END"""


def delivery_status(e: str) -> str:
    p = f"({e} * 31) % 100"
    return f"""CASE WHEN {e} % 400 < 24 THEN 503 WHEN {p} < 60 THEN 200 WHEN {p} < 70 THEN 503 WHEN {p} < 75 THEN 429
        WHEN {p} < 78 THEN 408 WHEN {p} < 84 THEN 400 WHEN {p} < 88 THEN NULL ELSE 202 END"""


# Choreography chains by order key modulo 8; every 250th failed shipment lacks its refund.
SAGA_CHAINS = {
    0: ["order.requested", "payment.completed", "inventory.reserved", "shipment.scheduled"],
    4: ["order.requested", "payment.failed"],
    5: ["order.requested", "payment.completed", "inventory.failed", "payment.refunded"],
    6: [
        "order.requested",
        "payment.completed",
        "inventory.reserved",
        "shipment.failed",
        "inventory.released",
        "payment.refunded",
    ],
    7: ["order.requested", "payment.completed"],
}


def _array(names: list[str]) -> str:
    return "array(" + ", ".join(f"'{n}'" for n in names) + ")"


SAGA_EVENTS = (
    f"CASE WHEN o_orderkey % 8 < 4 THEN {_array(SAGA_CHAINS[0])} WHEN o_orderkey % 8 = 4 THEN {_array(SAGA_CHAINS[4])} "
    f"WHEN o_orderkey % 8 = 5 THEN {_array(SAGA_CHAINS[5])} "
    f"WHEN o_orderkey % 8 = 6 AND o_orderkey % 250 = 6 THEN {_array(SAGA_CHAINS[6][:-1])} "
    f"WHEN o_orderkey % 8 = 6 THEN {_array(SAGA_CHAINS[6])} ELSE {_array(SAGA_CHAINS[7])} END"
)

# Orchestrated messages (step, kind, action, ok, condition on o_orderkey).
SAGA_MESSAGES = [
    (0, "place-order", "PLACE", True, "o_orderkey % 300 <> 1"),
    (1, "payment-reply", "AUTHORIZE", True, "o_orderkey % 8 <> 4"),
    (1, "payment-reply", "AUTHORIZE", False, "o_orderkey % 8 = 4"),
    (2, "payment-reply", "AUTHORIZE", True, "o_orderkey % 8 <> 4 AND o_orderkey % 40 = 0"),
    (3, "inventory-reply", "RESERVE", True, "o_orderkey % 8 IN (0, 1, 2, 3, 6)"),
    (3, "inventory-reply", "RESERVE", False, "o_orderkey % 8 = 5"),
    (4, "shipment-reply", "SCHEDULE", True, "o_orderkey % 8 < 4"),
    (4, "shipment-reply", "SCHEDULE", False, "o_orderkey % 8 = 6"),
    (5, "inventory-reply", "RELEASE", True, "o_orderkey % 8 = 6"),
    (6, "payment-reply", "REFUND", True, "o_orderkey % 8 = 5 OR (o_orderkey % 8 = 6 AND o_orderkey % 250 <> 6)"),
    (6, "payment-reply", "REFUND", False, "o_orderkey % 8 = 6 AND o_orderkey % 250 = 6"),
]
SAGA_ID_PREFIX = {"payment-reply": "pay", "inventory-reply": "res", "shipment-reply": "shp"}


def _message(step: int, kind: str, action: str, ok: bool, condition: str) -> str:
    prefix = SAGA_ID_PREFIX.get(kind)
    ident = f"concat('{prefix}-', o_orderkey)" if prefix and ok and action not in ("REFUND", "RELEASE") else "''"
    reason = "''" if ok else f"'{action.lower()} declined'"
    return (
        f"if({condition}, named_struct('seq', {step}L, 'kind', '{kind}', 'action', '{action}', 'ok', {str(ok).lower()}, "
        f"'id', {ident}, 'reason', {reason}), null)"
    )


SAGACMD_ROWS = "filter(array(" + ", ".join(_message(*m) for m in SAGA_MESSAGES) + "), m -> m IS NOT NULL)"
