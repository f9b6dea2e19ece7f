"""Event-log views over the given tables.

Every view derives all of its rows from whole tables; the formulas only decide
which rows are late, repeated, malformed and so on. ``views_sql`` states the
same views for the oracle.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.running import PLACES, row_numbers
from ..session import cut_lineage, spread
from .formulas import (
    CDC_STEPS,
    CDCP_STEPS,
    EVENT_STEPS,
    EVT_COLUMNS,
    ORDER_STEPS,
    PAY_MODE,
    SAGA_EVENTS,
    SAGACMD_ROWS,
    cdc_value,
    cdcp_value,
    conn_value,
    delivery_status,
    event_value,
    image_user,
    notification_channel,
    order_value,
    ordv_payload,
)


class Tables:
    """The given tables and the views on them for one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = str(sf_dir).rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def stream(self, name: str) -> DataFrame:
        """The table as a file stream."""
        schema = self.table(name).schema
        # A pattern matches the table as one file and as a folder of files.
        return self.spark.readStream.schema(schema).parquet(f"{self.sf_dir}/{name}.parque[t]")

    # events -----------------------------------------------------------------

    @staticmethod
    def as_evt(events: DataFrame) -> DataFrame:
        return events.selectExpr(*EVT_COLUMNS).selectExpr(
            "*", "if(missing, null, unhex(lpad(hex(unix_micros(event_ts) * 1000), 16, '0'))) AS event_time_header"
        )

    @cached_property
    def evt(self) -> DataFrame:
        return self.as_evt(self.table("events"))

    @staticmethod
    def as_log(events: DataFrame) -> DataFrame:
        """Log records without offsets; ``event_id`` is the arrival order."""
        return events.selectExpr(
            "event_id",
            "concat('events.', event_type) AS topic",
            "cast(user_id % 4 AS int) AS partition",
            "concat(if(user_id % 25 = 0, 'vip-', 'user-'), user_id) AS key",
            "props AS value",
            "array(named_struct('key', 'source-service', 'value', cast('source-service' AS binary))) AS headers",
            "cast(ts AS timestamp) AS timestamp",
            "cast(40 + octet_length(props) AS bigint) AS bytes",
        )

    @cached_property
    def log_rows(self) -> DataFrame:
        return self.as_log(self.table("events"))

    @cached_property
    def log(self) -> DataFrame:
        numbered = row_numbers(self.log_rows, ["topic", "partition"], ["event_id"], span=PLACES)
        return numbered.withColumn("offset", F.col("rn") - 1).drop("rn")

    @cached_property
    def logdup(self) -> DataFrame:
        """Every record delivered to two consumers, some of them twice."""
        consumers = F.explode(F.array(F.lit("inventory"), F.lit("notifications")))
        copies = F.explode(F.when(F.col("event_id") % 7 == 0, F.array(F.lit(0), F.lit(1000000))).otherwise(F.array(F.lit(0))))
        return (
            self.log.select("*", copies.alias("shift"))
            .select("*", consumers.alias("consumer"))
            .selectExpr(
                "event_id AS outbox_id", "consumer", "topic", "partition", "offset + shift AS offset", "key", "value"
            )
        )

    @cached_property
    def processed(self) -> DataFrame:
        """Ids the inventory consumer has handled before the run."""
        return self.table("events").filter("event_id % 11 = 0").selectExpr(
            "'inventory' AS consumer", "event_id AS outbox_id"
        )

    @cached_property
    def ends(self) -> DataFrame:
        """End offset per topic and partition. Offsets are dense, so a count gives it without a sort."""
        return self.log_rows.groupBy("topic", "partition").agg(F.count("*").alias("end_offset"))

    @cached_property
    def offs(self) -> DataFrame:
        """Group offsets, stored as the small table they are on a cluster.

        Read back, its size is known from the files, so the planner broadcasts
        it below its threshold and shuffles beyond.
        """
        return cut_lineage(self.offs_rows, "offsets")

    @cached_property
    def offs_rows(self) -> DataFrame:
        groups = self.ends.select(
            "*", F.explode(F.array(F.lit("g1"), F.lit("g2"))).alias("group_id")
        ).filter("group_id = 'g1' or partition < 3")
        return groups.selectExpr(
            "group_id",
            "topic",
            "partition",
            """CASE WHEN group_id = 'g1' AND topic = 'events.view' AND partition = 3 THEN end_offset + 1
                    WHEN group_id = 'g1' THEN end_offset - end_offset % 13
                    ELSE end_offset - end_offset % 29 END AS committed""",
            "end_offset",
        )

    @cached_property
    def snap(self) -> DataFrame:
        """End, committed and sent counts per day, group and partition."""
        daily = self.log_rows.groupBy(F.to_date("timestamp").alias("day"), "topic", "partition").agg(
            F.count("*").alias("n")
        )
        # One row per partition and day from its first to its last day.
        grid = (
            daily.groupBy("topic", "partition")
            .agg(F.min("day").alias("first"), F.max("day").alias("last"))
            .selectExpr("topic", "partition", "explode(sequence(first, last, interval 1 day)) AS day")
        )
        w = Window.partitionBy("topic", "partition").orderBy("day")
        counted = (
            grid.join(daily, ["topic", "partition", "day"], "left")
            .withColumn("n", F.coalesce("n", F.lit(0)))
            .withColumn("end_offset", F.sum("n").over(w))
            .withColumn("day_no", F.row_number().over(w).cast("long"))
        )
        return counted.select(
            "*", F.explode(F.array(F.lit("g1"), F.lit("g2"))).alias("group_id")
        ).selectExpr(
            "day",
            "group_id",
            "topic",
            "partition",
            "end_offset",
            "greatest(end_offset - day_no * (partition + 1) * if(group_id = 'g1', 1, 0), 0L) AS committed",
            "greatest(n - if(partition = 3, 2, 0), 0L) AS sent",
        )

    @cached_property
    def klog_rows(self) -> DataFrame:
        return self.as_klog(self.table("events"))

    @staticmethod
    def as_klog(events: DataFrame) -> DataFrame:
        return events.selectExpr(
            "event_id",
            "'state.users' AS topic",
            "cast(user_id % 4 AS int) AS partition",
            """CASE WHEN event_id % 101 = 0 THEN concat('__heartbeat-', event_id)
                    WHEN event_id % 89 = 0 THEN NULL
                    ELSE concat('user-', lpad(cast(user_id AS string), 5, '0')) END AS key""",
            """CASE WHEN event_id % 101 = 0 THEN props WHEN event_id % 89 = 0 THEN props
                    WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 43 = 0 THEN '' ELSE props END AS value""",
            "cast(ts AS timestamp) AS ts",
        )

    @cached_property
    def klog(self) -> DataFrame:
        numbered = row_numbers(self.klog_rows, ["topic", "partition"], ["event_id"])
        return numbered.withColumn("offset", F.col("rn") - 1).drop("rn")

    @cached_property
    def notif(self) -> DataFrame:
        return self.as_notif(self.table("events"))

    @staticmethod
    def as_notif(events: DataFrame) -> DataFrame:
        return events.selectExpr(
            "event_id",
            "concat('notif-', event_id) AS id",
            "concat('user-', user_id) AS user_id",
            f"{notification_channel('event_id')} AS channel",
            "concat('Title ', event_type) AS title",
            "props AS body",
            "concat('trace-', event_id) AS trace_id",
            "cast(ts AS timestamp) AS created_at",
            "'notifications' AS topic",
            "cast(user_id % 4 AS int) AS partition",
            "event_id AS offset",
        )

    @cached_property
    def deliv(self) -> DataFrame:
        return self.as_deliv(self.notif)

    @staticmethod
    def as_deliv(notif: DataFrame) -> DataFrame:
        return notif.filter("channel IN ('CHANNEL_FIREBASE', 'CHANNEL_APNS', 'CHANNEL_WEBHOOK')").selectExpr(
            "channel",
            "event_id AS seq",
            "id AS notification_id",
            f"{delivery_status('event_id')} AS status",
            "event_id % 3 + 1 AS attempts",
            "created_at AS ts",
        )

    @cached_property
    def nlog(self) -> DataFrame:
        return self.as_nlog(self.deliv)

    @staticmethod
    def as_nlog(deliv: DataFrame) -> DataFrame:
        """Delivered rows and dlq rows of permanent failures, some of them twice."""
        kept = deliv.filter("status between 200 and 299 or status = 400")
        copies = F.explode(F.when(F.col("seq") % 13 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
        return kept.select("*", copies.alias("copy")).selectExpr(
            "notification_id",
            "channel",
            "if(status = 400, 'dlq', 'delivered') AS status",
            "attempts",
            "if(status = 400, 'status 400', NULL) AS last_error",
            "ts + make_dt_interval(0, 0, copy, 0) AS sent_at",
            "seq * 2 + copy AS seq",
        )

    @cached_property
    def done(self) -> DataFrame:
        return (
            self.log.filter("topic = 'events.click'").filter("event_id % 211 <> 5").select("partition", "offset")
        )

    @cached_property
    def prod(self) -> DataFrame:
        return self.evt.selectExpr(
            "event_type AS scenario",
            "event_id AS seq",
            "cents AS latency_us",
            "event_id % 40 <> 0 AS ok",
            """CASE WHEN event_id % 40 <> 0 THEN NULL WHEN event_id % 160 = 0 THEN 'MESSAGE_TOO_LARGE'
                    WHEN event_id % 160 = 40 THEN 'NOT_ENOUGH_REPLICAS'
                    WHEN event_id % 160 = 80 THEN 'DEADLINE_EXCEEDED' ELSE 'CONTEXT_CANCELED' END AS error""",
            "arrival_ts AS ts",
        )

    @cached_property
    def hdr(self) -> DataFrame:
        trace = "concat('00-', left(sha2(cast(event_id AS string), 256), 32), '-', left(sha2(cast(event_id + 1 AS string), 256), 16), '-01')"
        return self.table("events").selectExpr(
            "concat('events.', event_type) AS topic",
            "concat('user-', user_id) AS key",
            f"""filter(array(
                named_struct('key', 'traceparent', 'value', cast(CASE WHEN event_id % 23 = 0 THEN NULL
                    WHEN event_id % 19 = 0 THEN left({trace}, 20) ELSE {trace} END AS binary)),
                named_struct('key', 'correlation-id', 'value',
                    cast(if(event_id % 29 = 0, NULL, concat('corr-', event_id)) AS binary))),
                h -> h.value IS NOT NULL) AS headers""",
        )

    @cached_property
    def dirs(self) -> DataFrame:
        """Log bytes of each of the three replicas of a partition."""
        sizes = self.log_rows.groupBy("topic", "partition").agg(F.sum("bytes").alias("bytes"))
        return sizes.select("*", F.explode(F.array(*[F.lit(b) for b in (1, 2, 3)])).alias("broker")).selectExpr(
            "broker", "topic", "partition", "bytes + broker AS bytes"
        )

    @cached_property
    def meta(self) -> DataFrame:
        return self.log_rows.groupBy("topic", "partition").agg(F.count("*").alias("records")).selectExpr(
            "topic",
            "partition",
            "1 + partition % 3 AS leader",
            "array(3, 1, 2) AS replicas",
            "if((partition + length(topic)) % 3 = 0, array(1, 3), array(1, 3, 2)) AS isr",
            "records",
        )

    @cached_property
    def metr(self) -> DataFrame:
        """Hourly high and low water marks per topic; one row per topic and full hour with records."""
        hourly = self.log_rows.groupBy("topic", F.date_trunc("hour", "timestamp").alias("hour")).agg(
            F.count("*").alias("n"), F.sum("bytes").alias("b")
        )
        reset = "topic = 'events.error' AND hour >= timestamp '2024-01-15 00:00:00'"
        w = Window.partitionBy("topic", "era").orderBy("hour")
        return (
            hourly.withColumn("era", F.expr(f"if({reset}, 1, 0)"))
            .withColumn("high_water", F.sum("n").over(w))
            .withColumn("bytes", F.sum("b").over(w))
            .selectExpr("hour + interval 1 hour AS ts", "topic", "high_water", "high_water div 10 AS low_water", "bytes")
        )

    # customer and part --------------------------------------------------------

    @cached_property
    def keys(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey AS seq",
            "if(c_custkey % 10 < 3, concat('prem-', c_custkey % 50), concat('reg-', c_custkey % 500)) AS key",
        ).withColumn("bytes", F.octet_length("key").cast("long"))

    @cached_property
    def cust(self) -> DataFrame:
        return self.table("customer").selectExpr("c_custkey AS c").selectExpr(*image_user())

    @cached_property
    def cdc_rows(self) -> DataFrame:
        return self.as_cdc(self.table("customer"))

    @staticmethod
    def as_cdc(customer: DataFrame) -> DataFrame:
        steps = customer.selectExpr("c_custkey AS c", "explode(array(1, 2, 3, 4, 5, 6, 7, 8, 9)) AS step")
        kept = steps.filter(CDC_STEPS)
        return kept.selectExpr("c", "step", *image_user(with_id=False)).selectExpr(
            "c * 10 + step AS seq",
            """CASE step WHEN 8 THEN 'cdc.public.secrets' WHEN 9 THEN 'other.users'
                    ELSE 'cdc.public.users' END AS topic""",
            "cast(c % 3 AS int) AS partition",
            "cast(c AS string) AS key",
            f"{cdc_value()} AS value",
        )

    @staticmethod
    def as_order_changes(orders: DataFrame) -> DataFrame:
        rows = orders.selectExpr("o_orderkey AS o", "o_custkey AS user_id", "cast(round(o_totalprice * 100) AS bigint) AS amount_cents",
                                 "explode(array(1, 2, 3, 4)) AS step").filter(ORDER_STEPS)
        return rows.selectExpr("o * 10 + step AS seq", "'cdc.public.orders' AS topic", "cast(o % 3 AS int) AS partition",
                               "cast(o AS string) AS key", f"{order_value()} AS value")

    @staticmethod
    def as_event_changes(events: DataFrame) -> DataFrame:
        rows = events.selectExpr("event_id AS e", "user_id", "event_type AS kind", "explode(array(1, 2)) AS step").filter(EVENT_STEPS)
        return rows.selectExpr("e * 10 + step AS seq", "'cdc.public.events' AS topic", "cast(e % 3 AS int) AS partition",
                               "cast(e AS string) AS key", f"{event_value()} AS value")

    @classmethod
    def as_all_changes(cls, customer: DataFrame, orders: DataFrame, events: DataFrame) -> DataFrame:
        """Change rows of three tables as one log; the sequence number stands for the offset."""
        parts = [cls.as_cdc(customer), cls.as_order_changes(orders), cls.as_event_changes(events)]
        columns = ["topic", "partition", "seq", "key", "value"]
        rows = parts[0].select(*columns)
        for p in parts[1:]:
            rows = rows.unionByName(p.select(*columns))
        return rows.withColumnRenamed("seq", "offset")

    @cached_property
    def cdc(self) -> DataFrame:
        numbered = row_numbers(self.cdc_rows, ["topic", "partition"], ["seq"])
        return numbered.withColumn("offset", F.col("rn") - 1).drop("rn")

    @cached_property
    def cdcp(self) -> DataFrame:
        steps = self.table("part").selectExpr("*", "explode(array(1, 2, 3, 4)) AS step").filter(CDCP_STEPS)
        return steps.selectExpr(
            "'search.public.products' AS topic",
            "cast(p_partkey % 3 AS int) AS partition",
            "p_partkey * 10 + step AS offset",
            "concat('{\"id\":', p_partkey, '}') AS key",
            f"{cdcp_value()} AS value",
        )

    # orders ---------------------------------------------------------------------

    @staticmethod
    def as_ord(orders: DataFrame) -> DataFrame:
        return orders.selectExpr(
            "o_orderkey AS k",
            "concat('ord-', o_orderkey) AS id",
            "concat('cus-', o_custkey) AS customer_id",
            "cast(round(o_totalprice * 100) AS bigint) AS amount_cents",
            "'EUR' AS currency",
            """CASE o_orderstatus WHEN 'O' THEN 'ORDER_STATUS_NEW' WHEN 'P' THEN 'ORDER_STATUS_PAID'
                    ELSE 'ORDER_STATUS_SHIPPED' END AS status""",
            "cast(o_orderdate AS timestamp) AS created_at",
        )

    @cached_property
    def spread_orders(self) -> DataFrame:
        """Orders for the views that build or parse a text per row."""
        return spread(self.table("orders"))

    @cached_property
    def ord(self) -> DataFrame:
        return self.as_ord(self.table("orders"))

    @cached_property
    def outbox(self) -> DataFrame:
        return self.ord.filter("k % 997 <> 0").selectExpr(
            "k + 1 AS id",
            "id AS aggregate_id",
            "'orders' AS topic",
            """concat('{"order_id":"', id, '","customer_id":"', customer_id, '","amount_cents":', amount_cents,
                ',"trace_id":"trace-', k, '","tenant_id":"t', k % 3, '"}') AS payload""",
            "created_at",
            "if(k % 5 = 0, NULL, created_at + interval 1 minute) AS published_at",
        )

    @cached_property
    def outcdc(self) -> DataFrame:
        return self.outbox.selectExpr(
            "CASE (id - 1) % 10 WHEN 1 THEN 'd' WHEN 2 THEN 'r' ELSE 'c' END AS op",
            "id",
            "CASE (id - 1) % 3 WHEN 0 THEN 'order' WHEN 1 THEN 'user' ELSE 'payment' END AS aggregate_type",
            "aggregate_id",
            "'created' AS type",
            "payload",
        )

    @cached_property
    def ordev(self) -> DataFrame:
        """Published events as consumed, some delivered again by the other node."""
        copies = F.explode(F.when(F.col("k") % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
        return (
            self.ord.filter("k % 997 <> 0 AND k % 5 <> 0")
            .select("*", copies.alias("copy"))
            .selectExpr(
                "k + 1 AS outbox_id",
                "cast(k % 6 AS int) AS partition",
                "k * 2 + copy AS offset",
                "if((k % 6 + copy) % 2 = 0, 'inventory-1', 'inventory-2') AS node",
                "id AS order_id",
                "customer_id",
                "amount_cents",
                "currency",
                "status",
                """if(k % 1009 = 0, 'not-a-date', date_format(created_at, "yyyy-MM-dd'T'HH:mm:ss'Z'")) AS created_at""",
            )
        )

    @cached_property
    def conn(self) -> DataFrame:
        copies = F.explode(F.when(F.col("k") % 6 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
        return (
            self.as_ord(self.spread_orders)
            .select("*", copies.alias("copy"))
            .selectExpr(
                "'orders-json' AS topic",
                "cast(k % 3 AS int) AS partition",
                "k * 2 + copy AS offset",
                f"{conn_value()} AS value",
            )
        )

    @cached_property
    def view(self) -> DataFrame:
        """The read table before the batch: a third of the orders with old values."""
        return self.ord.filter("k % 3 = 0").selectExpr(
            "k AS id", "customer_id", "amount_cents div 2 AS amount_cents", "currency", "'OLD' AS status", "created_at"
        )

    @cached_property
    def ordv(self) -> DataFrame:
        return self.ord.selectExpr("id AS order_id", "cast(1 + k % 3 AS int) AS version", f"{ordv_payload()} AS payload", "k")

    @cached_property
    def wire(self) -> DataFrame:
        return self.ordv.selectExpr(
            "'orders-wire' AS topic",
            "cast(k % 3 AS int) AS partition",
            "k AS offset",
            """CASE WHEN k % 53 = 0 THEN unhex('000000')
                    ELSE concat(unhex(if(k % 59 = 0, '01', '00')), unhex(lpad(hex(1 + k % 4), 8, '0')),
                                unhex(if(k % 61 = 0, '0206', '00')), cast(payload AS binary)) END AS value""",
        )

    @staticmethod
    def as_pay(orders: DataFrame) -> DataFrame:
        return orders.selectExpr(
            "'payments' AS topic",
            "cast(o_orderkey % 3 AS int) AS partition",
            "o_orderkey AS offset",
            "concat('ord-', o_orderkey) AS key",
            f"""if(o_orderkey % 10 = 0, concat('not json ', o_orderkey),
                   concat('{{"id":"pay-', o_orderkey, '","amount":', cast(round(o_totalprice * 100) AS bigint),
                          ',"mode":"', {PAY_MODE}, '"}}')) AS value""",
            "cast(array() AS array<struct<key:string,value:binary>>) AS headers",
            "cast(o_orderdate AS timestamp) AS timestamp",
        )

    @cached_property
    def pay(self) -> DataFrame:
        return self.as_pay(self.spread_orders)

    @cached_property
    def upload(self) -> DataFrame:
        return self.ord.selectExpr(
            "k AS seq",
            "if(k % 17 = 0, '', customer_id) AS customer_id",
            "CASE WHEN k % 19 = 0 THEN 0L WHEN k % 23 = 0 THEN -amount_cents ELSE amount_cents END AS amount_cents",
            "if(k % 29 = 0, '', currency) AS currency",
        )

    @cached_property
    def txn(self) -> DataFrame:
        return self.ord.selectExpr(
            "explode(array('orders', 'payments', 'shipments')) AS topic",
            "k AS offset",
            "if(k % 37 = 0, NULL, concat('producer-', k % 4)) AS txn_id",
            "if(k < 5000 OR k % 500 = 3, 1, 2) AS epoch",
            "if(k % 37 = 0, NULL, k) AS txn_no",
            "id AS order_id",
        )

    @cached_property
    def markers(self) -> DataFrame:
        return self.ord.filter("k % 10 <> 9 AND k % 37 <> 0").selectExpr(
            "concat('producer-', k % 4) AS txn_id",
            "k AS txn_no",
            "if(k % 10 < 7, 'commit', 'abort') AS outcome",
            "created_at AS ts",
        )

    @staticmethod
    def as_saga(orders: DataFrame) -> DataFrame:
        return orders.selectExpr(
            "o_orderkey AS k", "cast(o_orderdate AS timestamp) AS start", f"posexplode({SAGA_EVENTS}) AS (pos, event)"
        ).selectExpr(
            "concat('s-', k) AS saga_id",
            "cast(pos + 1 AS bigint) AS seq",
            "event",
            "start + make_dt_interval(0, 0, pos + 1, 0) AS ts",
        )

    @cached_property
    def saga(self) -> DataFrame:
        return self.as_saga(self.table("orders"))

    @staticmethod
    def as_sagacmd(orders: DataFrame) -> DataFrame:
        return orders.selectExpr(
            "o_orderkey AS k",
            "concat('cus-', o_custkey) AS customer_id",
            "cast(round(o_totalprice * 100) AS bigint) AS amount_cents",
            f"inline({SAGACMD_ROWS})",
        ).selectExpr(
            "concat('s-', k) AS saga_id", "seq", "kind", "action", "ok", "id", "reason", "customer_id", "amount_cents"
        )

    @cached_property
    def sagacmd(self) -> DataFrame:
        return self.as_sagacmd(self.spread_orders)

    @cached_property
    def ordn_items(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "l_orderkey",
            "concat('sku-', l_partkey) AS sku",
            "cast(l_quantity AS bigint) AS quantity",
            "cast(round(l_extendedprice * 100) AS bigint) AS price_cents",
            "cast(l_shipdate AS timestamp) AS shipped",
        )

    # documents --------------------------------------------------------------------

    @staticmethod
    def as_docs(documents: DataFrame) -> DataFrame:
        return documents.selectExpr("doc_id", "cast(doc_id % 3 AS int) AS partition", "doc_id AS offset", "text")

    @cached_property
    def docs(self) -> DataFrame:
        return self.as_docs(spread(self.table("documents").select("doc_id", "text")))
