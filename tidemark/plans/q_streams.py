"""Streaming queries. Each runs to the end of the given table and is read back."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ..functions.binary import encode_u64
from ..functions.headers import format_headers
from ..functions.names import timestamp_text
from ..operators import cdc, joins, quality, sagas, windows, words
from ..operators import reliability as rel
from ..operators.records import enrich_vip
from ..schema import ANALYTICS_IMAGES
from ..session import work_dir
from ..sources import rules as rulesets
from ..sources.log import write_log
from ..sources.sinks import read_versioned
from ..streaming import jobs, merged, retries, runner
from .q_cdc import ALL_SQL, FINAL_SQL, all_columns, narrow
from .q_reliability import P12_SQL, SETTLING_SQL, Z11_SQL, Z19_SQL, settling_payment, z11_columns
from .q_search import COUNT_SQL
from .q_txn_saga import J13_SQL, Z09_SQL, Z10_SQL
from .q_windows import HOUR, Z01_SQL, Z02_SQL, Z03_SQL, Z05_SQL, Z06_SQL, started
from .registry import query
from .views import Tables


def evt_of(events):
    return Tables.as_evt(events)


def evt(t):
    return evt_of(t.stream("events"))


@query("z01_event_time_counts", Z01_SQL)
def _(t):
    return started(runner.updated(windows.event_time_counts(evt(t), HOUR), "z01", ["window_start"]))


@query("z02_processing_time_counts", Z02_SQL)
def _(t):
    return started(runner.updated(windows.processing_time_counts(evt(t), HOUR), "z02", ["window_start"]))


@query("z03_watermarked_counts", Z03_SQL)
def _(t):
    return started(runner.appended(windows.watermarked_counts(evt(t), HOUR, "2 hours"), "z03"))


@query("z05_hopping_counts", Z05_SQL)
def _(t):
    return started(runner.updated(windows.hopping_counts(evt(t), HOUR, "30 minutes"), "z05", ["window_start"]))


@query("z06_session_counts", Z06_SQL)
def _(t):
    out = runner.appended(windows.session_counts(evt(t), "2 hours", "1 hour"), "z06")
    return started(started(out, "session_start"), "session_end")


@query("z07_streaming_word_count", COUNT_SQL)
def _(t):
    return runner.updated(words.word_count(Tables.as_docs(t.stream("documents"))), "z07", ["word"])


@query("z07_restored_word_count", COUNT_SQL)
def _(t):
    """Half of the documents are counted, the counters are rebuilt from the changelog, and the rest goes on from them."""
    path, seed = work_dir(t.spark, "z07-log"), work_dir(t.spark, "z07-seed")
    first = words.word_count(Tables.as_docs(t.stream("documents")).filter("doc_id % 2 = 0"))
    runner.finish(runner.batch_table(first, runner.write_batch(path), work_dir(t.spark, "z07-first"), "update"))
    log = runner.read_batches(t.spark, path, first.schema)
    changes = log.select(F.col("word").alias("key"), F.col("batch_id").alias("offset"), encode_u64("n").alias("value8"))
    words.restore_state(changes).select("key", "n").write.parquet(seed)
    counters = t.spark.readStream.schema("key string, n decimal(20,0)").parquet(seed)
    rest = Tables.as_docs(t.stream("documents")).filter("coalesce(doc_id % 2, 1) <> 0")
    return runner.updated(words.seeded_word_count(rest, counters), "z07-rest", ["word"])


@query("z09_saga_orchestrator", Z09_SQL)
def _(t):
    messages = Tables.as_sagacmd(t.stream("orders"))
    return runner.updated(jobs.saga_orchestrator_stream(messages), "z09", ["saga_id"])


@query("z10_saga_conformance_stream", Z10_SQL)
def _(t):
    return runner.updated(sagas.saga_conformance_running(Tables.as_saga(t.stream("orders"))), "z10", ["saga_id"])


def staged(t, handler, name):
    path = work_dir(t.spark, name)
    retries.run_stages(Tables.as_pay(t.stream("orders")), rel.PAYMENT_STAGES, path, rel.DLQ_TOPIC, handler)
    return z11_columns(retries.retried(t.spark, rel.PAYMENT_STAGES, path, rel.DLQ_TOPIC))


@query("z11_retry_pipeline", Z11_SQL)
def _(t):
    return staged(t, "payment", "z11")


@query("z11_settling_pipeline", SETTLING_SQL)
def _(t):
    return staged(t, settling_payment, "z11-settling")


@query(
    "z12_exactly_once_pipeline",
    "SELECT count(*) AS total, count(*) AS unique_keys, 0::BIGINT AS duplicates, 'exactly once' AS verdict FROM v_log",
)
def _(t):
    """The log in four files, one per batch; the job stops after it has written the second one and is started again."""
    path, checkpoint, source = (work_dir(t.spark, name) for name in ("z12", "z12-checkpoint", "z12-source"))
    in_quarters(t.table("events"), source)
    files = t.spark.readStream.schema(t.table("events").schema).option("maxFilesPerTrigger", 1).parquet(source)
    out = enrich_vip(Tables.as_log(files).withColumnRenamed("event_id", "offset")).drop("headers")
    try:
        runner.finish(jobs.exactly_once_pipeline(out, path, checkpoint, fail_after=1))
    except StreamingQueryException as stopped:
        if "stopped after writing batch 1" not in str(stopped):
            raise
    runner.finish(jobs.exactly_once_pipeline(out, path, checkpoint))
    return quality.duplicate_summary(runner.read_batches(t.spark, path, out.schema), "src_offset")


def in_quarters(events, path):
    """The events as four files in log order, so that a stream of one file per trigger has four batches."""
    last = events.agg(F.max("event_id")).scalar()
    marked = events.withColumn("__quarter", F.floor(F.col("event_id") * 4 / (last + 1)))
    for i in range(4):
        marked.filter(F.col("__quarter") == i).drop("__quarter").coalesce(1).write.mode("append").parquet(path)


@query(
    "z04_late_split_stream",
    """WITH q AS (SELECT event_id, event_ts, floor(event_id * 4 / (SELECT max(event_id) + 1 FROM v_evt)) AS part FROM v_evt),
            m AS (SELECT part, max(max(event_ts)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark FROM q GROUP BY part)
       SELECT event_id, coalesce(date_trunc('hour', event_ts) + INTERVAL 1 HOUR <= mark - INTERVAL 10 MINUTE, false) AS late_arrival
       FROM q JOIN m ON q.part = m.part""",
)
def _(t):
    source, path = work_dir(t.spark, "z04-source"), work_dir(t.spark, "z04")
    in_quarters(t.table("events"), source)
    files = t.spark.readStream.schema(t.table("events").schema).option("maxFilesPerTrigger", 1).parquet(source)
    rows = evt_of(files)
    runner.finish(jobs.late_side_output(rows, 3600, 600, path, work_dir(t.spark, "z04-marks"), work_dir(t.spark, "z04-checkpoint")))
    return jobs.read_late_output(t.spark, path, rows.schema).select("event_id", "late_arrival")


@query(
    "z13_materialize_table",
    """SELECT key, "partition", value FROM (
           SELECT *, row_number() OVER (PARTITION BY key ORDER BY event_id DESC) AS rn FROM v_klog WHERE key IS NOT NULL)
       WHERE rn = 1 AND value IS NOT NULL""",
)
def _(t):
    path = work_dir(t.spark, "z13")
    rows = Tables.as_klog(t.stream("events"))
    runner.finish(jobs.materialize_table(rows, path, work_dir(t.spark, "z13-checkpoint"), "key", "event_id"))
    out = jobs.read_materialized(t.spark, path, rows.schema, "key", "event_id", "value")
    return out.select("key", "partition", "value")


@query(
    "z13_merged_table",
    """SELECT key, "partition", value FROM (
           SELECT *, row_number() OVER (PARTITION BY key ORDER BY event_id DESC) AS rn FROM v_klog WHERE key IS NOT NULL)
       WHERE rn = 1 AND value IS NOT NULL""",
)
def _(t):
    """The log in four files, one per batch, merged into the buckets each batch touches."""
    source, path = work_dir(t.spark, "z13-source"), work_dir(t.spark, "z13-merged")
    t.klog.repartitionByRange(4, "event_id").write.parquet(source)
    rows = t.spark.readStream.schema(t.klog.schema).option("maxFilesPerTrigger", 1).parquet(source)
    runner.finish(merged.merged_table(rows, path, work_dir(t.spark, "z13-merged-checkpoint"), "key", "event_id", buckets=8))
    return merged.read_merged(t.spark, path, rows.schema).filter("value IS NOT NULL").select("key", "partition", "value")


@query("z14_cdc_anonymize_stream", f'SELECT * EXCLUDE ("offset", "partition") FROM ({FINAL_SQL})')
def _(t):
    path, side = work_dir(t.spark, "z14"), work_dir(t.spark, "z14-malformed")
    changes = Tables.as_cdc(t.stream("customer")).withColumnRenamed("seq", "offset")
    rules = rulesets.load_rules(rulesets.ANALYTICS_SALT, rulesets.ANALYTICS_ROWS)
    runner.finish(jobs.cdc_anonymize_stream(changes, rules, "users", path, side, work_dir(t.spark, "z14-checkpoint")))
    stored = read_versioned(t.spark, path, "analytics.users")
    return narrow(cdc.replacing_final(stored, "id", "cdc_lsn")).drop("offset", "partition")


@query("z14_cdc_anonymize_all_stream", ALL_SQL)
def _(t):
    """Users, orders and events from one log, one parse and one write."""
    path = work_dir(t.spark, "z14-all")
    changes = Tables.as_all_changes(t.stream("customer"), t.stream("orders"), t.stream("events"))
    runner.finish(jobs.cdc_anonymize_all_stream(
        changes, rulesets.ANALYTICS_RULES, ANALYTICS_IMAGES, path, work_dir(t.spark, "z14-all-checkpoint")))
    return all_columns(t.spark.read.parquet(path))


@query("z15_router_stream", P12_SQL)
def _(t):
    routed = jobs.router_stream(Tables.as_notif(t.stream("events")), "router-1")
    return runner.appended(
        routed.select("id", "channel", "destination", format_headers("headers").alias("headers")), "z15"
    )


@query(
    "z16_periodic_top_n",
    f"SELECT *, row_number() OVER (ORDER BY n DESC, word) AS rank FROM ({COUNT_SQL}) ORDER BY n DESC, word LIMIT 50",
)
def _(t):
    path = work_dir(t.spark, "z16")
    docs = Tables.as_docs(t.stream("documents"))
    runner.finish(jobs.periodic_top_n(docs, 50, path, work_dir(t.spark, "z16-checkpoint")))
    schema = words.top_n_words(words.word_count(t.docs), 50).schema
    return runner.last_snapshot(t.spark, path, schema)


@query("z17_stream_dedup", "SELECT DISTINCT consumer, outbox_id FROM v_logdup")
def _(t):
    copies = F.explode(F.when(F.col("event_id") % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    rows = (
        Tables.as_log(t.stream("events"))
        .select("*", copies.alias("copy"))
        .selectExpr("explode(array('inventory', 'notifications')) AS consumer", "event_id AS outbox_id", "timestamp")
    )
    return runner.appended(
        jobs.stream_dedup(rows, ["consumer", "outbox_id"], "timestamp", "1 day").select("consumer", "outbox_id"), "z17"
    )


@query(
    "z18_repartition_by",
    "SELECT customer_id, count(*) AS orders, sum(amount_cents)::BIGINT AS amount_cents FROM v_ord GROUP BY customer_id",
)
def _(t):
    return runner.updated(quality.totals_by_key(Tables.as_ord(t.stream("orders")), "customer_id"), "z18", ["customer_id"])


@query("z19_delivery_history", Z19_SQL)
def _(t):
    rows = Tables.as_nlog(Tables.as_deliv(Tables.as_notif(t.stream("events"))))
    out = rel.delivery_history(rows.filter("status = 'delivered'"), rows.filter("status = 'dlq'"))
    done = runner.updated(out, "z19", ["notification_id", "channel"])
    return done.withColumn("last_error", F.coalesce("last_error", F.lit("")))


def limited(t, name):
    """The log in eight files, streamed two files per trigger."""
    source, path = work_dir(t.spark, f"{name}-source"), work_dir(t.spark, name)
    log = t.log_rows.select("event_id", "topic", "partition", "key", "value")
    log.repartitionByRange(8, "event_id").write.parquet(source)
    stream = t.spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 2).parquet(source)
    return runner.finish(runner.append_table(stream, path, work_dir(t.spark, f"{name}-checkpoint"))), path, log


@query("z20_rate_limit", "SELECT 4::BIGINT AS triggers, count(*) AS records FROM v_log")
def _(t):
    done, path, log = limited(t, "z20")
    triggers = sum(1 for p in done.recentProgress if p.numInputRows)
    out = t.spark.read.schema(log.schema).parquet(path)
    return out.agg(F.count("*").alias("records")).select(F.lit(triggers).cast("long").alias("triggers"), "records")


@query("z21_progress_lag", "SELECT 4::BIGINT AS triggers, count(*) AS input_rows, 0::BIGINT AS backlog FROM v_log")
def _(t):
    done, _path, log = limited(t, "z21")
    rows = jobs.progress_lag(done, log.count())
    table = t.spark.createDataFrame(rows, "batch_id long, input_rows long, processed long, backlog long")
    return table.agg(
        F.count("*").alias("triggers"), F.sum("input_rows").alias("input_rows"), F.min("backlog").alias("backlog")
    )


@query(
    "j12_stream_table_join",
    "SELECT e.event_id, e.user_id, c.full_name, c.country, e.cents FROM v_evt e LEFT JOIN v_cust c ON e.user_id = c.id",
)
def _(t):
    out = joins.stream_table_join(evt(t), t.cust, "user_id", "id")
    return runner.appended(out.select("event_id", "user_id", "full_name", "country", "cents"), "j12")


@query("j13_stream_stream_join", J13_SQL)
def _(t):
    out = sagas.request_payment_pairs(
        Tables.as_saga(t.stream("orders")).filter("event = 'order.requested'"),
        Tables.as_saga(t.stream("orders")).filter("event = 'payment.completed'"),
        5,
    )
    done = runner.appended(out, "j13")
    return done.select(
        "saga_id", timestamp_text("requested_at").alias("requested_at"), timestamp_text("paid_at").alias("paid_at")
    )


@query("s01_stream_log", 'SELECT topic, "partition", count(*) AS records FROM v_log GROUP BY ALL')
def _(t):
    from ..sources.log import stream_log

    path = work_dir(t.spark, "s01")
    write_log(t.log, path)
    out = runner.appended(stream_log(t.spark, path, pattern="^events[.]").select("topic", "partition", "offset"), "s01-out")
    return out.groupBy("topic", "partition").agg(F.count("*").alias("records"))
