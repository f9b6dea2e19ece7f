"""Queries over change capture, anonymization and the search feed."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hashing import hash_field
from ..functions.names import FIRST_WORD, SECOND_INITIAL, truncate_name
from ..operators import cdc, joins
from ..operators.records import chain
from ..schema import ANALYTICS_IMAGES, PRODUCT_IMAGE, USER_IMAGE
from ..session import work_dir
from ..sources import rules as rulesets
from ..sources import sinks
from ..sources.connect import unwrap_connect_json
from .formulas import ORDER_STEPS
from .registry import query

SALT = rulesets.ANALYTICS_SALT
CONN_FIELDS = {"id": "int64", "customer_id": "string", "amount": "double", "status": "string", "created_at": "int64"}
USERS = "topic = 'cdc.public.users'"


def truncate_sql(c: str) -> str:
    first, initial = (f"regexp_extract({c}, '{p}', 1)" for p in (FIRST_WORD, SECOND_INITIAL))
    return f"coalesce({first} || (CASE WHEN {initial} = '' THEN '' ELSE {initial} || '.' END), '')"


def hash_sql(c: str) -> str:
    return f"(CASE WHEN {c} IS NULL THEN '' ELSE sha256('{SALT}:' || {c}) END)"


def images(t):
    return cdc.cdc_row_image(cdc.parse_cdc(t.cdc, USER_IMAGE))


def narrow(df):
    """The versions of these rows are below 2**63."""
    return df.withColumn("cdc_lsn", F.col("cdc_lsn").cast("bigint"))


def anonymized(t):
    return narrow(cdc.anonymize(images(t), rulesets.ANALYTICS_RULES, "users", USER_IMAGE))


ANON_SQL = f"""
    SELECT topic, "partition", "offset", key, 'analytics.users' AS target_topic, (img->>'$.id')::BIGINT AS id,
           {hash_sql("(img->>'$.email')")} AS email, {hash_sql("(img->>'$.phone')")} AS phone,
           {truncate_sql("(img->>'$.full_name')")} AS full_name, img->>'$.country' AS country, img->>'$.status' AS status,
           img->>'$.created_at' AS created_at, cdc_lsn, deleted AS _deleted
    FROM v_cdcimg WHERE topic = 'cdc.public.users'"""
FINAL_SQL = f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY cdc_lsn DESC, "offset" DESC) AS rn
                FROM ({ANON_SQL})) WHERE rn = 1"""


@query(
    "p01_parse_cdc",
    """SELECT topic, "partition", "offset",
              CASE WHEN value IS NULL THEN 'tombstone' WHEN NOT json_valid(value) THEN 'error' ELSE 'record' END AS kind,
              CASE WHEN json_valid(value) THEN value->>'$.op' END AS op,
              CASE WHEN json_valid(value) THEN value->>'$.source.lsn' END AS lsn,
              CASE WHEN json_valid(value) THEN (value->>'$.ts_ms')::BIGINT END AS ts_ms,
              CASE WHEN json_valid(value) THEN (value->>'$.before.id')::BIGINT END AS before_id,
              CASE WHEN json_valid(value) THEN value->>'$.after.status' END AS after_status
       FROM v_cdc""",
)
def _(t):
    return cdc.parse_cdc(t.cdc, USER_IMAGE).selectExpr(
        "topic", "partition", "offset", "kind", "e.op AS op", "e.source.lsn AS lsn", "e.ts_ms AS ts_ms",
        "e.before.id AS before_id", "e.after.status AS after_status",
    )


@query(
    "p02_cdc_op_label",
    """SELECT CASE j->>'$.op' WHEN 'c' THEN 'INSERT' WHEN 'u' THEN 'UPDATE' WHEN 'd' THEN 'DELETE' WHEN 'r' THEN 'SNAPSHOT'
                   WHEN 't' THEN 'TRUNCATE' ELSE 'op=' || (j->>'$.op') END AS label, count(*) AS n FROM v_cdcp1 GROUP BY 1""",
)
def _(t):
    parsed = cdc.parse_cdc(t.cdc_rows, USER_IMAGE).filter("kind = 'record'")
    return parsed.groupBy(cdc.cdc_op_label(F.col("e.op")).alias("label")).agg(F.count("*").alias("n"))


@query(
    "p03_cdc_row_image",
    """SELECT topic, "partition", "offset", op, deleted AS _deleted, (img->>'$.id')::BIGINT AS id, img->>'$.email' AS email,
              img->>'$.status' AS status FROM v_cdcimg""",
)
def _(t):
    return images(t).selectExpr(
        "topic", "partition", "offset", "e.op AS op", "_deleted", "image.id AS id", "image.email AS email",
        "image.status AS status",
    )


@query(
    "p04_table_from_topic",
    """SELECT CASE WHEN starts_with(topic, 'cdc.public.') THEN substr(topic, 12) ELSE '' END AS tbl,
              NOT starts_with(topic, 'cdc.public.') AS error, count(*) AS n FROM v_cdcrows GROUP BY ALL""",
)
def _(t):
    name = cdc.table_from_topic(F.col("topic"))
    return (
        t.cdc_rows.groupBy(name.alias("tbl")).agg(F.count("*").alias("n")).withColumn("error", F.col("tbl") == "")
    )


@query(
    "p05_cdc_version",
    """SELECT topic, "partition", "offset", coalesce(try_cast(j->>'$.source.lsn' AS BIGINT), try_cast(j->>'$.source.ts_ms' AS BIGINT), 0) AS cdc_lsn,
              false AS too_large FROM v_cdcp1""",
)
def _(t):
    parsed = cdc.parse_cdc(t.cdc, USER_IMAGE).filter("kind = 'record'")
    return parsed.select(
        "topic",
        "partition",
        "offset",
        cdc.cdc_version(F.col("e.source")).cast("bigint").alias("cdc_lsn"),
        F.coalesce(cdc.version_error(F.col("e.source")), F.lit(False)).alias("too_large"),
    )


@query(
    "p06_cdc_changed_fields",
    """WITH u AS (SELECT topic, "partition", "offset", key, j FROM v_cdcp1 WHERE j->>'$.op' = 'u'),
            f AS (SELECT *, unnest(['id', 'email', 'phone', 'full_name', 'birth_date', 'country', 'status', 'created_at']) AS field FROM u),
            v AS (SELECT topic, "partition", "offset", key, field, j->'$.before'->>field AS before, j->'$.after'->>field AS after FROM f)
       SELECT * FROM v WHERE before IS DISTINCT FROM after""",
)
def _(t):
    return cdc.cdc_changed_fields(cdc.parse_cdc(t.cdc, USER_IMAGE), USER_IMAGE).drop("seq")


@query("p07_anonymize", ANON_SQL)
def _(t):
    return anonymized(t)


# Orders and events pass with their notes, addresses and agents cut out; malformed rows of all tables keep their text.
NO_USER = "NULL::VARCHAR AS email, NULL::VARCHAR AS phone, NULL::VARCHAR AS full_name, NULL::VARCHAR AS country"
ALL_SQL = f"""
    SELECT 'row' AS outcome, target_topic, id, email, phone, full_name, country, status, created_at, NULL::BIGINT AS user_id,
           NULL::BIGINT AS amount_cents, NULL::VARCHAR AS kind, cdc_lsn::VARCHAR AS cdc_lsn, _deleted, NULL::VARCHAR AS raw
    FROM ({ANON_SQL})
    UNION ALL BY NAME
    SELECT 'row' AS outcome, 'analytics.orders' AS target_topic, o_orderkey AS id, {NO_USER},
           CASE step WHEN 1 THEN 'new' ELSE 'paid' END AS status, o_custkey AS user_id,
           cast(round(o_totalprice * 100) AS bigint) AS amount_cents, (10 * o_orderkey + step)::VARCHAR AS cdc_lsn, (step = 3)::INT AS _deleted
    FROM (SELECT *, o_orderkey AS o FROM orders, (VALUES (1), (2), (3)) s(step)) WHERE {ORDER_STEPS}
    UNION ALL BY NAME
    SELECT 'row' AS outcome, 'analytics.events' AS target_topic, event_id AS id, user_id, event_type AS kind,
           (10 * event_id + 1)::VARCHAR AS cdc_lsn, 0 AS _deleted FROM events
    UNION ALL BY NAME
    SELECT 'malformed' AS outcome, CASE topic WHEN 'cdc.public.users' THEN 'analytics.users' ELSE 'none' END AS target_topic, value AS raw
    FROM v_cdcrows WHERE value IS NOT NULL AND NOT json_valid(value)
    UNION ALL BY NAME
    SELECT 'malformed' AS outcome, 'analytics.orders' AS target_topic, '{{bad order ' || o_orderkey AS raw FROM orders WHERE o_orderkey % 50 = 1
    UNION ALL BY NAME
    SELECT 'malformed' AS outcome, 'analytics.events' AS target_topic, 'bad event ' || event_id AS raw FROM events WHERE event_id % 40 = 3"""


def all_columns(rows):
    assert not {"notes", "ip_address", "user_agent", "birth_date"} & set(rows.columns)
    return rows.select(
        "outcome", "target_topic", "id", "email", "phone", "full_name", "country", "status", "created_at", "user_id", "amount_cents",
        "kind", F.col("cdc_lsn").cast("string").alias("cdc_lsn"), "_deleted", "raw")


@query("p07_anonymize_tables", ALL_SQL)
def _(t):
    changes = t.as_all_changes(t.table("customer"), t.table("orders"), t.table("events"))
    return all_columns(cdc.anonymize_tables(changes, rulesets.ANALYTICS_RULES, ANALYTICS_IMAGES))


@query("p08_hash_field", f"SELECT id, {hash_sql('email')} AS email_hash, {hash_sql('phone')} AS phone_hash FROM v_cust")
def _(t):
    return t.cust.select(
        "id",
        hash_field(F.col("email"), SALT).alias("email_hash"),
        hash_field(F.col("phone"), SALT).alias("phone_hash"),
    )


@query("p09_truncate_name", f"SELECT id, {truncate_sql('full_name')} AS short FROM v_cust")
def _(t):
    return t.cust.select("id", truncate_name("full_name").alias("short"))


P10_SQL = """SELECT regexp_replace(topic, 'search\\.public\\.(.*)', '\\1_v1') AS index, "partition", "offset", key::JSON->>'$.id' AS id,
                    nullif((value::JSON->'$.after')::VARCHAR, 'null') AS doc FROM v_cdcp"""


def flat(df):
    return df.selectExpr("index", "partition", "offset", "key AS id", "value AS doc")


@query("p10_search_flatten", P10_SQL)
def _(t):
    return flat(cdc.search_flatten(t.cdcp))


@query("x04_chain", P10_SQL)
def _(t):
    return flat(chain(t.cdcp, *cdc.transforms_by_name(cdc.SEARCH_CHAIN)))


@query(
    "p24_split_malformed",
    """SELECT topic, "partition", "offset",
              CASE WHEN value IS NOT NULL AND NOT json_valid(value) THEN 'malformed record of ' || strlen(value) || ' bytes' END AS cause FROM v_cdc""",
)
def _(t):
    return cdc.split_malformed(cdc.parse_cdc(t.cdc, USER_IMAGE)).select("topic", "partition", "offset", "cause")


# Versions around 2**63 and up to 2**64 - 1, as numbers and as texts; one in seven does not fit and falls back to the time.
U64_SQL = """
    SELECT c_custkey AS id, step, CASE (c_custkey + step) % 7
        WHEN 0 THEN 9223372036854775807::HUGEINT WHEN 1 THEN 9223372036854775808::HUGEINT + c_custkey WHEN 2 THEN 18446744073709551615::HUGEINT - step
        WHEN 3 THEN 18446744073709551616::HUGEINT + c_custkey WHEN 4 THEN c_custkey WHEN 5 THEN 18446744073709551615
        ELSE 9223372036854775808::HUGEINT - step END::VARCHAR AS lsn
    FROM customer, (VALUES (1), (2), (3)) s(step)"""


def wide_changes(t):
    """Three changes per customer, as change rows with unsigned versions."""
    big = lambda n: F.lit(str(n)).cast("decimal(38,0)")
    c, step = F.col("c_custkey").cast("decimal(38,0)"), F.col("step").cast("decimal(38,0)")
    case = (F.col("c_custkey") + F.col("step")) % 7
    lsn = (F.when(case == 0, big(2**63 - 1)).when(case == 1, big(2**63) + c).when(case == 2, big(2**64 - 1) - step)
           .when(case == 3, big(2**64) + c).when(case == 4, c).when(case == 5, big(2**64 - 1)).otherwise(big(2**63) - step))
    rows = t.table("customer").select("c_custkey", F.explode(F.array(*[F.lit(i) for i in (1, 2, 3)])).alias("step"))
    text = lsn.cast("decimal(38,0)").cast("string")
    text = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit('"'), text, F.lit('"'))).otherwise(text)
    value = F.concat(F.lit('{"op":"u","after":{"id":'), F.col("c_custkey"), F.lit(',"status":"s'), F.col("step"),
                     F.lit('"},"source":{"lsn":'), text, F.lit(',"ts_ms":7}}'))
    return rows.select(F.lit("cdc.public.users").alias("topic"), F.lit(0).alias("partition"),
                       (F.col("c_custkey") * 10 + F.col("step")).alias("offset"), F.col("c_custkey").cast("string").alias("key"), value.alias("value"))


@query(
    "p05_cdc_version_u64",
    f"""SELECT id, step, CASE WHEN lsn::HUGEINT < 18446744073709551616 THEN lsn ELSE '7' END AS cdc_lsn,
               lsn::HUGEINT >= 18446744073709551616 AS too_large FROM ({U64_SQL})""",
)
def _(t):
    parsed = cdc.parse_cdc(wide_changes(t), USER_IMAGE)
    return parsed.select(
        F.col("e.after.id").alias("id"), (F.col("offset") % 10).cast("int").alias("step"),
        cdc.cdc_version(F.col("e.source")).cast("string").alias("cdc_lsn"), cdc.version_error(F.col("e.source")).alias("too_large"),
    )


@query(
    "w03_replacing_final_u64",
    f"""SELECT id, status, cdc_lsn FROM (
            SELECT id, 's' || step AS status, v::VARCHAR AS cdc_lsn, row_number() OVER (PARTITION BY id ORDER BY v DESC, step DESC) AS rn
            FROM (SELECT id, step, CASE WHEN lsn::HUGEINT < 18446744073709551616 THEN lsn::HUGEINT ELSE 7 END AS v FROM ({U64_SQL})))
        WHERE rn = 1""",
)
def _(t):
    rows = cdc.cdc_row_image(cdc.parse_cdc(wide_changes(t), USER_IMAGE))
    flat_rows = rows.selectExpr("image.id AS id", "image.status AS status", "cdc_lsn", "offset", "_deleted")
    last = cdc.replacing_final(flat_rows, "id", "cdc_lsn", drop_deleted=True)
    return last.select("id", "status", F.col("cdc_lsn").cast("string").alias("cdc_lsn"))


@query("w03_replacing_final", FINAL_SQL)
def _(t):
    return cdc.replacing_final(anonymized(t), "id", "cdc_lsn")


@query("s12_append_versioned", f'SELECT * FROM ({FINAL_SQL}) WHERE _deleted = 0')
def _(t):
    path = work_dir(t.spark, "versions")
    rows = anonymized(t)
    # The batch is written twice under one id, as after a retry; one copy remains.
    sinks.append_versioned(rows, path, batch_id=0)
    sinks.append_versioned(rows, path, batch_id=0)
    stored = sinks.read_versioned(t.spark, path, "analytics.users").select(*rows.columns)
    return cdc.replacing_final(stored, "id", "cdc_lsn", drop_deleted=True)


@query(
    "j07_reconcile",
    f"""WITH s AS (SELECT id FROM v_cust), f AS (SELECT id FROM ({FINAL_SQL}) WHERE _deleted = 0)
        SELECT (SELECT count(*) FROM s) AS source_rows, (SELECT count(*) FROM f) AS target_rows,
               (SELECT count(*) FROM s WHERE id NOT IN (SELECT id FROM f)) AS missing_in_target,
               (SELECT count(*) FROM f WHERE id NOT IN (SELECT id FROM s)) AS missing_in_source,
               (SELECT count(*) FROM s) = (SELECT count(*) FROM f) AS match""",
)
def _(t):
    return joins.reconcile(t.cust, cdc.replacing_final(anonymized(t), "id", "cdc_lsn", drop_deleted=True), "id")


@query(
    "u04_row_diff",
    """WITH s AS (SELECT id, country, 'new' AS status FROM v_cust),
            g AS (SELECT (img->>'$.id')::BIGINT AS id, img->>'$.country' AS country, img->>'$.status' AS status, deleted, topic,
                    row_number() OVER (PARTITION BY img->>'$.id' ORDER BY cdc_lsn DESC, "offset" DESC) AS rn
                  FROM v_cdcimg WHERE topic = 'cdc.public.users'),
            f AS (SELECT id, country, status FROM g WHERE rn = 1 AND deleted = 0)
       SELECT *, 'source' AS side, 1::BIGINT AS copies FROM (SELECT * FROM s EXCEPT ALL SELECT * FROM f)
       UNION ALL SELECT *, 'target', 1 FROM (SELECT * FROM f EXCEPT ALL SELECT * FROM s)""",
)
def _(t):
    flat_images = images(t).filter(USERS).selectExpr(
        "image.id AS id", "image.country AS country", "image.status AS status", "cdc_lsn", "offset", "_deleted"
    )
    target = cdc.replacing_final(narrow(flat_images), "id", "cdc_lsn", drop_deleted=True)
    source = t.cust.selectExpr("id", "country", "'new' AS status")
    return joins.row_diff(source, target.select("id", "country", "status"))


@query(
    "s14_load_rules",
    """WITH f AS (SELECT CASE WHEN starts_with(topic, 'cdc.public.') THEN substr(topic, 12) ELSE '' END AS tbl,
                         unnest(json_keys(img)) AS field FROM v_cdcimg),
            r AS (SELECT * FROM (VALUES ('email', 'hash'), ('phone', 'hash'), ('full_name', 'truncate'), ('birth_date', 'drop')) v(field, rule))
       SELECT tbl, f.field, CASE WHEN tbl <> 'users' THEN 'skipped' ELSE coalesce(rule, 'passthrough') END AS rule,
              CASE WHEN tbl = 'users' THEN 'analytics.users' END AS target_topic, count(*) AS n
       FROM f LEFT JOIN r ON f.field = r.field GROUP BY ALL""",
)
def _(t):
    rules = rulesets.load_rules(rulesets.ANALYTICS_SALT, rulesets.ANALYTICS_ROWS)
    per_field = (
        cdc.parse_cdc(t.cdc_rows, USER_IMAGE)
        .transform(cdc.cdc_row_image)
        .select(
            cdc.table_from_topic(F.col("topic")).alias("tbl"),
            F.explode(F.array(*[F.lit(f.name) for f in USER_IMAGE.fields])).alias("field"),
        )
        .groupBy("tbl", "field")
        .agg(F.count("*").alias("n"))
    )
    rule, target = F.lit("skipped"), F.lit(None).cast("string")
    for name, spec in rules.tables.items():
        of_table = F.col("tbl") == name
        target = F.when(of_table, spec.target_topic).otherwise(target)
        rule = F.when(of_table, F.lit("passthrough")).otherwise(rule)
        for field, kind in spec.fields.items():
            rule = F.when(of_table & (F.col("field") == field), F.lit(kind)).otherwise(rule)
    return per_field.withColumn("rule", rule).withColumn("target_topic", target)


@query(
    "x02_register_rule",
    f"""SELECT id, left(phone, 5) || '***' AS phone, {hash_sql("email")} AS email FROM (
            SELECT DISTINCT ON (img->>'$.id') (img->>'$.id')::BIGINT AS id, img->>'$.phone' AS phone, img->>'$.email' AS email
            FROM v_cdcimg WHERE topic = 'cdc.public.users' ORDER BY img->>'$.id', cdc_lsn DESC, "offset" DESC)""",
)
def _(t):
    rulesets.register_rule("mask", lambda value, salt: F.concat(F.left(value, F.lit(5)), F.lit("***")))
    rules = rulesets.load_rules(
        SALT, [("users", "analytics.users", "phone", "mask"), ("users", "analytics.users", "email", "hash")]
    )
    rows = cdc.anonymize(images(t), rules, "users", USER_IMAGE)
    return cdc.replacing_final(rows, "id", "cdc_lsn").select("id", "phone", "email")


CONN_SQL = """SELECT topic, "partition", "offset", value::JSON->'$.payload' AS p FROM v_conn"""


@query(
    "s08_unwrap_connect_json",
    f"""SELECT topic, "partition", "offset", (p->>'$.id')::BIGINT AS id, p->>'$.customer_id' AS customer_id, (p->>'$.amount')::DOUBLE AS amount,
               p->>'$.status' AS status, (p->>'$.created_at')::BIGINT AS created_at,
               CASE WHEN p->>'$.amount' IS NULL THEN 'amount is missing' END AS error FROM ({CONN_SQL})""",
)
def _(t):
    return unwrap_connect_json(t.conn, CONN_FIELDS)


@query(
    "s10_upsert_sink",
    f"""WITH b AS (SELECT (p->>'$.id')::BIGINT AS id, p->>'$.customer_id' AS customer_id, round((p->>'$.amount')::DOUBLE * 100)::BIGINT AS amount_cents,
                     'EUR' AS currency, p->>'$.status' AS status, row_number() OVER (PARTITION BY (p->>'$.id')::BIGINT ORDER BY "offset" DESC) AS rn
                   FROM ({CONN_SQL}) WHERE p->>'$.amount' IS NOT NULL)
        SELECT id, customer_id, amount_cents, currency, status FROM b WHERE rn = 1
        UNION ALL SELECT id, customer_id, amount_cents, currency, status FROM v_view WHERE id NOT IN (SELECT id FROM b)""",
)
def _(t):
    batch = unwrap_connect_json(t.conn, CONN_FIELDS).filter("error IS NULL").selectExpr(
        "id", "customer_id", "cast(round(amount * 100) AS bigint) AS amount_cents", "'EUR' AS currency", "status", "offset"
    )
    target = t.view.select("id", "customer_id", "amount_cents", "currency", "status")
    return joins.upsert_sink(target, batch, "id")


@query(
    "s11_upsert_delete_sink",
    """WITH e AS (SELECT (key::JSON->>'$.id')::BIGINT AS id, "offset", value::JSON->'$.after' AS a FROM v_cdcp),
            l AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY "offset" DESC) AS rn FROM e)
       SELECT id, a->>'$.name' AS name, a->>'$.category' AS category, (a->>'$.price_cents')::BIGINT AS price_cents
       FROM l WHERE rn = 1 AND json_type(a) = 'OBJECT'""",
)
def _(t):
    flat_rows = cdc.search_flatten(t.cdcp).withColumn("doc", F.from_json("value", PRODUCT_IMAGE))
    batch = flat_rows.selectExpr(
        "cast(key AS bigint) AS id", "doc.name AS name", "doc.category AS category", "doc.price_cents AS price_cents",
        "offset", "value IS NULL AS gone",
    )
    target = t.table("part").selectExpr(
        "p_partkey AS id", "concat('old ', p_name) AS name", "p_type AS category", "0L AS price_cents"
    )
    return joins.upsert_delete_sink(target, batch, "id", F.col("gone"))
