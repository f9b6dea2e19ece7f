"""Streams over several files and restarts against their batch twins."""

import random
import time
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.binary import encode_u64
from tidemark.functions.headers import headers_map
from tidemark.operators import cdc, quality, reliability, sagas, windows, words
from tidemark.operators.records import ROUTER_DLQ, enrich_vip
from tidemark.plans.views import Tables
from tidemark.schema import ANALYTICS_IMAGES, USER_IMAGE
from tidemark.sources import rules as rulesets
from tidemark.sources.log import read_log, stream_log, write_log
from tidemark.sources.sinks import read_versioned
from tidemark.streaming import jobs, merged, retries, runner

SF = "/root/testdata/sf0.001"
T0 = datetime(2024, 1, 1)


def same(a, b):
    columns = sorted(a.columns)
    return sorted(map(tuple, a.select(*columns).collect()), key=repr) == sorted(
        map(tuple, b.select(*columns).collect()), key=repr
    )


def in_files(df, path, order, n=4):
    """The rows as n files in order; one file is one batch."""
    marked = df.withColumn("__part", F.ntile(n).over(Window.orderBy(order)))
    for i in range(1, n + 1):
        marked.filter(F.col("__part") == i).drop("__part").coalesce(1).write.mode("append").parquet(path)
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.fixture()
def tables(spark):
    return Tables(spark, SF)


def test_event_time_counts(tables, tmp_path):
    stream = Tables.as_evt(in_files(tables.table("events"), str(tmp_path / "in"), "event_id"))
    got = runner.updated(windows.event_time_counts(stream, "1 hour"), "et", ["window_start"])
    assert same(got, windows.event_time_counts(tables.evt, "1 hour"))


def test_watermark_closes_windows_in_order(spark, tmp_path):
    """One file per batch: a window is written once, and a row of a written window is dropped."""
    minutes = [[0, 10, 130], [200, 20, 65], [400, 5]]
    rows = [(i, T0 + timedelta(minutes=m)) for i, batch in enumerate(minutes) for m in batch]
    df = spark.createDataFrame(rows, "b int, event_ts timestamp")
    path = str(tmp_path / "in")
    for i in range(3):
        df.filter(f"b = {i}").coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = runner.appended(windows.watermarked_counts(stream, "1 hour", "30 minutes"), "wm")
    start = {(r.window_start - T0).total_seconds() // 3600: r.n for r in got.collect()}
    # The mark of the first batch, minute 100, closes hour 0 in the second one together with its
    # minute 20; minute 5 of the third batch comes too late and does not reopen the hour.
    assert start == {0: 3, 1: 1, 2: 1, 3: 1}


def test_late_side_output(spark, tmp_path):
    rows = [(0, 0), (0, 130), (1, 20), (1, 125), (2, 64)]
    df = spark.createDataFrame([(b, T0 + timedelta(minutes=m)) for b, m in rows], "b int, event_ts timestamp")
    path = str(tmp_path / "in")
    for i in range(3):
        df.filter(f"b = {i}").coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
    out = str(tmp_path / "out")
    runner.finish(jobs.late_side_output(stream, 3600, 600, out, str(tmp_path / "marks"), str(tmp_path / "cp")))
    both = jobs.read_late_output(spark, out, df.schema)
    late = both.filter("late_arrival").collect()
    # Hour 0 ends at minute 60, hour 1 at 120; the mark is minute 130 less 10.
    assert {(r.b, r.event_ts) for r in late} == {(1, T0 + timedelta(minutes=20)), (2, T0 + timedelta(minutes=64))}
    assert both.filter("NOT late_arrival").count() == 3


def test_late_rows_of_a_batch_that_runs_again(spark, tables, tmp_path):
    """A batch is evaluated once, and the same rows are late when a crash makes it run twice."""
    stream = in_files(tables.evt.select("event_id", "event_ts"), str(tmp_path / "in"), "event_id")
    for cp in ("one", "two"):
        runner.finish(jobs.late_side_output(stream, 3600, 600, str(tmp_path / "out"), str(tmp_path / "marks"), str(tmp_path / cp)))
    rows = {(r.event_id, r.late_arrival) for r in jobs.read_late_output(spark, str(tmp_path / "out"), stream.schema).collect()}
    data = sorted((r.event_id, r.event_ts) for r in tables.evt.collect())
    n, want, mark = len(data), set(), None
    size = [n // 4 + (i < n % 4) for i in range(4)]
    for i in range(4):
        part = data[sum(size[:i]) : sum(size[: i + 1])]
        for event, at in part:
            start = at.replace(minute=0, second=0, microsecond=0)
            want.add((event, mark is not None and start + timedelta(hours=1) <= mark - timedelta(seconds=600)))
        mark = max([t for _, t in part] + ([mark] if mark else []))
    assert rows == want and any(late for _, late in rows)


def test_sessions(tables, tmp_path):
    stream = Tables.as_evt(in_files(tables.table("events"), str(tmp_path / "in"), "event_id"))
    # A tolerance above the largest delay, so that no row is late between batches.
    got = runner.appended(windows.session_counts(stream, "2 hours", "8 hours"), "se")
    assert same(got, windows.session_counts(tables.evt, "2 hours", "8 hours"))


def test_word_count_survives_a_restart(spark, tables, tmp_path):
    path, cp, source = str(tmp_path / "out"), str(tmp_path / "cp"), str(tmp_path / "in")
    docs = tables.docs
    first = docs.filter("doc_id % 2 = 0")
    first.coalesce(1).write.parquet(source)
    counts = words.word_count(spark.readStream.schema(docs.schema).parquet(source))
    runner.finish(runner.batch_table(counts, runner.write_batch(path), cp, "update"))
    # A new query on the same checkpoint goes on with the old state.
    docs.filter("doc_id % 2 = 1").coalesce(1).write.mode("append").parquet(source)
    counts = words.word_count(spark.readStream.schema(docs.schema).parquet(source))
    runner.finish(runner.batch_table(counts, runner.write_batch(path), cp, "update"))
    rows = runner.read_batches(spark, path, counts.schema)
    got = rows.groupBy("word").agg(F.max_by("n", "batch_id").alias("n"))
    assert same(got, words.word_count(docs))


def test_exactly_once_after_a_failure(spark, tables, tmp_path):
    path, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    rows = in_files(tables.log_rows.withColumnRenamed("event_id", "offset"), str(tmp_path / "in"), "offset")
    out = enrich_vip(rows).drop("headers")
    with pytest.raises(Exception, match="stopped after writing batch 1"):
        runner.finish(jobs.exactly_once_pipeline(out, path, cp, fail_after=1))
    runner.finish(jobs.exactly_once_pipeline(out, path, cp))
    r = quality.duplicate_summary(runner.read_batches(spark, path, out.schema), "src_offset").first()
    assert (r.total, r.duplicates) == (tables.table("events").count(), 0)


def test_materialized_table(spark, tables, tmp_path):
    path = str(tmp_path / "out")
    stream = in_files(tables.klog_rows, str(tmp_path / "in"), "event_id")
    runner.finish(jobs.materialize_table(stream, path, str(tmp_path / "cp"), "key", "event_id"))
    got = jobs.read_materialized(spark, path, stream.schema, "key", "event_id", "value")
    last = {}
    for r in tables.klog_rows.orderBy("event_id").collect():
        if r.key is not None:
            last[r.key] = r.value
    assert {(r.key, r.value) for r in got.collect()} == {(k, v) for k, v in last.items() if v is not None}


def test_saga_state_over_batches(tables, tmp_path):
    stream = in_files(tables.sagacmd, str(tmp_path / "in"), "seq")
    got = runner.updated(jobs.saga_orchestrator_stream(stream), "sg", ["saga_id"])
    assert same(got, sagas.saga_orchestrator(tables.sagacmd))


def test_saga_state_leaves_no_row_to_python(spark, tables):
    """A call per saga does not keep up with millions of them."""
    messages = Tables.as_sagacmd(tables.stream("orders"))
    plan = jobs.saga_orchestrator_stream(messages)._jdf.queryExecution().analyzed().toString()
    assert "Aggregate" in plan and "TransformWithState" not in plan and "InPandas" not in plan


def test_saga_messages_count_in_order_of_seq(spark, tmp_path):
    """A reply that arrives a batch before the opening it follows counts, one from before the opening does not."""
    rows = [
        ("late", 1, "payment-reply", "AUTHORIZE", True, "p1", "", 1), ("late", 0, "place-order", "PLACE", True, "", "", 2),
        ("late", 2, "inventory-reply", "RESERVE", False, "", "empty", 3), ("late", 3, "place-order", "PLACE", True, "", "", 4),
        ("early", 1, "payment-reply", "AUTHORIZE", True, "p2", "", 1), ("early", 2, "payment-reply", "REFUND", True, "", "", 1),
        ("early", 3, "place-order", "PLACE", True, "", "", 2), ("early", 4, "payment-reply", "AUTHORIZE", False, "", "no", 3),
        ("none", 1, "payment-reply", "AUTHORIZE", True, "p3", "", 1),
        ("twice", 0, "place-order", "PLACE", True, "", "", 1), ("twice", 1, "payment-reply", "AUTHORIZE", True, "p4", "", 2),
        ("twice", 1, "payment-reply", "AUTHORIZE", True, "p4", "", 3), ("twice", 2, "payment-reply", "REFUND", True, "", "", 4),
        (None, 0, "place-order", "PLACE", True, "", "", 4),
    ]
    df = spark.createDataFrame(rows, "saga_id string, seq long, kind string, action string, ok boolean, id string, reason string, part int")
    df = df.withColumns({"customer_id": F.lit("c"), "amount_cents": F.lit(5).cast("long")})
    stream = in_files(df, str(tmp_path / "in"), "part")
    got = runner.updated(jobs.saga_orchestrator_stream(stream), "sq", ["saga_id"])
    assert same(got, sagas.saga_orchestrator(df))
    assert {r.saga_id: (r.step, r.commands, r.failure_reason) for r in got.collect()} == {
        "late": ("COMPENSATING_PAYMENT", 3, "inventory-failed: empty"), "early": ("DONE", 1, "no"), "twice": ("DONE", 3, ""),
        None: ("AWAITING_PAYMENT", 1, None)}


def test_saga_messages_one_by_one():
    class M:
        def __init__(self, kind, action, ok, ident="", reason=""):
            self.kind, self.action, self.ok, self.id, self.reason = kind, action, ok, ident, reason
            self.customer_id, self.amount_cents = "c", 5

    assert jobs.apply_message(None, M("payment-reply", "AUTHORIZE", True, "p")) is None
    state = jobs.apply_message(None, M("place-order", "PLACE", True))
    state = jobs.apply_message(state, M("payment-reply", "AUTHORIZE", True, "p"))
    state = jobs.apply_message(state, M("inventory-reply", "RESERVE", False, "", "empty"))
    assert (state["step"], state["failure_reason"]) == ("COMPENSATING_PAYMENT", "inventory-failed: empty")
    state = jobs.apply_message(state, M("payment-reply", "REFUND", True))
    assert (state["step"], state["status"], state["failure_reason"], state["commands"]) == (
        "DONE", "FAILED", "inventory-failed: empty", 3
    )
    # A second place-order of an open saga changes nothing.
    assert jobs.apply_message(dict(state), M("place-order", "PLACE", True)) == state


def test_dedup_over_batches(spark, tmp_path):
    rnd = random.Random(3)
    rows = [(i % 40, T0 + timedelta(minutes=i + rnd.randrange(3))) for i in range(80)]
    df = spark.createDataFrame(rows, "id long, ts timestamp")
    out = runner.appended(jobs.stream_dedup(in_files(df, str(tmp_path / "in"), "ts"), ["id"], "ts", "1 day"), "dd")
    assert sorted(r.id for r in out.collect()) == list(range(40))


def test_router_counts(tables, tmp_path):
    stream = in_files(tables.notif, str(tmp_path / "in"), "event_id", n=2)
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    done = runner.finish(runner.append_table(jobs.router_stream(stream, "n1"), out, cp))
    seen = [p.observedMetrics["router"] for p in done.recentProgress if p.numInputRows]
    table = tables.spark.read.parquet(out)
    assert sum(m["dead_lettered"] for m in seen) == table.filter(F.col("destination") == ROUTER_DLQ).count() > 0
    assert sum(m["routed"] + m["dead_lettered"] for m in seen) == tables.notif.count()


def test_cdc_stream_keeps_malformed_rows_aside(spark, tables, tmp_path):
    path, side = str(tmp_path / "out"), str(tmp_path / "side")
    changes = in_files(tables.cdc_rows.withColumnRenamed("seq", "offset"), str(tmp_path / "in"), "offset", n=3)
    rules = rulesets.ANALYTICS_RULES
    runner.finish(jobs.cdc_anonymize_stream(changes, rules, "users", path, side, str(tmp_path / "cp")))
    bad = tables.cdc_rows.filter("value LIKE '{bad%'").count()
    assert runner.read_batches(spark, side, spark.read.parquet(side).schema).count() == bad > 0
    stored = read_versioned(spark, path, "analytics.users")
    assert "birth_date" not in stored.columns and stored.filter("_deleted = 1").count() > 0


def test_top_n_snapshots(spark, tables, tmp_path):
    stream = in_files(tables.docs, str(tmp_path / "in"), "doc_id", n=2)
    path = str(tmp_path / "out")
    runner.finish(jobs.periodic_top_n(stream, 10, path, str(tmp_path / "cp")))
    want = words.top_n_words(words.word_count(tables.docs), 10)
    assert same(runner.last_snapshot(spark, path, want.schema), want)


def test_pairs_of_two_streams(tables, tmp_path):
    asked = tables.saga.filter("event = 'order.requested'")
    paid = tables.saga.filter("event = 'payment.completed'")
    left = in_files(asked, str(tmp_path / "l"), "ts", n=2)
    right = in_files(paid, str(tmp_path / "r"), "ts", n=2)
    got = runner.appended(sagas.request_payment_pairs(left, right, 5), "pp")
    assert same(got, sagas.request_payment_pairs(asked, paid, 5))


def test_retry_stream(tables, tmp_path):
    stream = in_files(tables.pay, str(tmp_path / "in"), "offset", n=2)
    chain = (reliability.PAYMENT_STAGES, reliability.DLQ_TOPIC)
    got = runner.appended(reliability.retry_pipeline(stream, *chain).drop("headers"), "rt")
    assert same(got, reliability.retry_pipeline(tables.pay, *chain).drop("headers"))


def test_log_round_trip_and_rate_limit(spark, tables, tmp_path):
    path = str(tmp_path / "log")
    report = write_log(tables.log, path)
    assert report.agg(F.sum("records")).first()[0] == tables.log.count()
    one = read_log(spark, path, topics=["events.click"])
    assert one.select("topic").distinct().collect()[0].topic == "events.click"
    stream = stream_log(spark, path, pattern="^events[.](click|view)$", max_files=1)
    done = runner.finish(
        runner.append_table(stream.select("topic", "offset"), str(tmp_path / "o"), str(tmp_path / "c"))
    )
    rows = jobs.progress_lag(done, 10**6)
    assert len(rows) >= 2 and rows[-1][2] == spark.read.parquet(str(tmp_path / "o")).count()


def test_stream_of_a_table_in_many_files(spark, tables, tmp_path):
    tables.table("events").repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    out = runner.appended(Tables(spark, str(tmp_path)).stream("events").select("event_id"), "many")
    assert out.count() == tables.table("events").count()
    assert runner.appended(tables.stream("events").select("event_id"), "one").count() == out.count()


# Retry chain as staged streams


SHORT = [
    reliability.Stage("payments", 0, "payments-retry-30s"),
    reliability.Stage("payments-retry-30s", 30, "payments-retry-5m"),
    reliability.Stage("payments-retry-5m", 300, ""),
]


def settles(value, retries):
    """Transient until the call that the text asks for; 'bad' fails for good."""
    needed = F.coalesce(value.try_cast("int"), F.lit(0))
    cls = F.when(value == "bad", "permanent").when(retries + 1 >= needed, "ok").otherwise("transient")
    return F.struct(cls.alias("cls"), F.when(cls != "ok", F.concat(F.lit("call "), (retries + 1).cast("string"))).alias("message"))


def plain_retries(rows, stages):
    """Every record carried through the chain by a loop: offset -> outcome, topic, retry count, previous topic, time."""
    by, out = {s.topic: s for s in stages}, {}
    for offset, topic, value, at in rows:
        retries, previous = 0, None
        while True:
            stage = by[topic]
            at += timedelta(seconds=stage.delay_s)
            needed = int(value) if value.isdigit() else 0
            if value != "bad" and retries + 1 >= needed:
                out[offset] = ("ok", topic, str(retries) if retries else None, previous, at)
                break
            retries, previous = retries + 1, topic
            if value == "bad" or not stage.next_topic:
                out[offset] = ("dlq", "payments-dlq", str(retries), previous, at)
                break
            topic = stage.next_topic
    return out


def retry_records(spark, rows):
    data = [(t, o % 3, o, None if o % 5 == 0 else f"k{o}", v, [], at) for o, t, v, at in rows]
    return spark.createDataFrame(data, ARRIVING)


ARRIVING = "topic string, partition int, offset long, key string, value string, headers array<struct<key:string,value:binary>>, timestamp timestamp"


def ends(df):
    get = lambda n: F.col("m")[n]
    rows = df.withColumn("m", headers_map("headers")).select(
        "offset", "outcome", "final_topic", get("retry.count"), get("previous.topic"), "at", "source_topic").collect()
    assert len({r.offset for r in rows}) == len(rows)
    return {r[0]: tuple(r[1:6]) for r in rows}


def test_staged_retries_equal_a_plain_loop(spark, tmp_path):
    rnd = random.Random(4)
    rows = [(i, rnd.choice(["payments"] * 3 + ["payments-retry-30s"]), rnd.choice(["1", "2", "3", "4", "9", "bad", "x"]),
             T0 + timedelta(seconds=i)) for i in range(200)]
    df = retry_records(spark, rows)
    want = plain_retries(rows, SHORT)
    assert want[next(i for i, t, v, _ in rows if t == "payments" and v == "2")][:3] == ("ok", "payments-retry-30s", "1")
    assert ends(reliability.staged_retry(df, SHORT, "payments-dlq", settles)) == want
    stream, path = in_files(df, str(tmp_path / "in"), "offset", 3), str(tmp_path / "out")
    retries.run_stages(stream, SHORT, path, "payments-dlq", settles)
    assert ends(retries.retried(spark, SHORT, path, "payments-dlq")) == want


def test_handler_by_value_gives_the_closed_form(spark, tables, tmp_path):
    stages, dlq = reliability.PAYMENT_STAGES, reliability.DLQ_TOPIC
    closed = reliability.retry_pipeline(tables.pay, stages, dlq)
    assert same(reliability.staged_retry(tables.pay, stages, dlq).drop("key"), closed.drop("key"))


def test_records_wait_in_state_and_survive_a_restart(spark, tmp_path):
    """A record that is not due stays in state over runs of its stage, and is handled when it is."""
    stages = [reliability.Stage("payments", 0, "slow"), reliability.Stage("slow", 25, "slower"), reliability.Stage("slower", 1, "")]
    now = datetime.now(UTC).replace(tzinfo=None, microsecond=0)
    rows = [(1, "payments", "2", now), (2, "payments", "3", now), (3, "payments", "9", now - timedelta(days=1)), (4, "payments", "1", now)]
    df, path = retry_records(spark, rows), str(tmp_path / "out")
    stream = in_files(df, str(tmp_path / "in"), "offset", 2)
    retries.run_stages(stream, stages, path, "payments-dlq", settles)
    early = ends(retries.retried(spark, stages, path, "payments-dlq"))
    want = plain_retries(rows, stages)
    assert early == {i: want[i] for i in (3, 4)}
    # A restart between stages: only the first two run, then only the last, on the old checkpoints.
    while datetime.now(UTC).replace(tzinfo=None) < now + timedelta(seconds=27):
        time.sleep(1)
    retries.run_stages(stream, stages, path, "payments-dlq", settles, only=range(2))
    assert set(ends(retries.retried(spark, stages, path, "payments-dlq"))) == {1, 3, 4}
    retries.run_stages(stream, stages, path, "payments-dlq", settles, only=range(2, 3))
    assert ends(retries.retried(spark, stages, path, "payments-dlq")) == want


# Merged current-state table


def keyed(spark, n=600, seed=2):
    rnd = random.Random(seed)
    rows = [(i, None if rnd.random() < 0.05 else f"k{rnd.randrange(80)}", None if rnd.random() < 0.2 else f"v{i}") for i in range(n)]
    return rows, spark.createDataFrame(rows, "event_id long, key string, value string")


def last_rows(rows):
    return {k: v for i, (k, v) in enumerate((r[1], (r[0], r[2])) for r in rows) if k is not None}


def held_rows(spark, path, schema):
    got = merged.read_merged(spark, path, schema).collect()
    assert len({r.key for r in got}) == len(got)
    return {r.key: (r.event_id, r.value) for r in got}


def test_merged_table_over_batches(spark, tmp_path):
    rows, df = keyed(spark)
    path = str(tmp_path / "table")
    stream = in_files(df, str(tmp_path / "in"), "event_id", 6)
    runner.finish(merged.merged_table(stream, path, str(tmp_path / "cp"), "key", "event_id", buckets=5))
    assert held_rows(spark, path, df.schema) == last_rows(rows)
    # Neither the folders to read nor those that are kept grow with the batches.
    assert len(list((tmp_path / "table" / "manifest").glob("version=*"))) == 2
    assert len(list((tmp_path / "table" / "data").glob("version=*/bucket=*"))) <= 10


def test_a_batch_rewrites_only_buckets_it_touches(spark, tmp_path):
    rows, df = keyed(spark)
    path = str(tmp_path / "table")
    write = merged.merge_batch(path, df.schema, "key", "event_id", buckets=16)
    write(df, 0)
    write(spark.createDataFrame([(10_000, "k1", "new")], df.schema), 1)
    versions = sorted(merged.manifest(spark, path).values())
    assert versions.count(1) == 1 and set(versions) == {0, 1}
    assert held_rows(spark, path, df.schema) == last_rows(rows) | {"k1": (10_000, "new")}
    write(spark.createDataFrame([(3, "k1", "late")], df.schema), 2)  # an older row changes nothing
    assert held_rows(spark, path, df.schema)["k1"] == (10_000, "new")
    write(df.limit(0), 3)
    assert held_rows(spark, path, df.schema)["k1"] == (10_000, "new")


def test_a_failed_batch_shows_nothing_and_runs_again(spark, tmp_path):
    rows, df = keyed(spark)
    path, cp = str(tmp_path / "table"), str(tmp_path / "cp")
    stream = in_files(df, str(tmp_path / "in"), "event_id", 3)
    write = merged.merge_batch(path, df.schema, "key", "event_id", buckets=4)
    shown = {}

    def failing(part, batch_id):
        if batch_id == 1:
            shown["before"] = held_rows(spark, path, df.schema)
            # The data of the batch is written, its manifest is not.
            part.sparkSession.range(1).selectExpr("id AS event_id", "'zzz' AS key", "'half' AS value", "0 AS bucket").write.partitionBy(
                "bucket").parquet(f"{path}/data/version=1")
            raise RuntimeError("stopped between data and manifest")
        write(part, batch_id)

    with pytest.raises(Exception, match="stopped between data and manifest"):
        runner.finish(runner.batch_table(stream, failing, cp))
    assert held_rows(spark, path, df.schema) == shown["before"] == last_rows(rows[:200])
    runner.finish(runner.batch_table(stream, write, cp))
    assert held_rows(spark, path, df.schema) == last_rows(rows)


def test_empty_merged_table(spark, tmp_path):
    assert merged.read_merged(spark, str(tmp_path / "none"), keyed(spark, 1)[1].schema).collect() == []


def test_restored_counters_go_on(spark, tables, tmp_path):
    """Counts, changelog, rebuilt counters, new documents: equal to one uninterrupted run; a restart reads no seed twice."""
    docs, seed, source = tables.docs, str(tmp_path / "seed"), str(tmp_path / "in")
    first = words.word_count(docs.filter("doc_id % 3 = 0"))
    changes = first.selectExpr("word AS key", "1L AS offset").withColumn("n", F.lit(1)).unionByName(
        first.selectExpr("word AS key", "2L AS offset", "n"))
    changes = changes.select("key", "offset", encode_u64("n").alias("value8"))
    words.restore_state(changes).select("key", "n").write.parquet(seed)
    docs.filter("doc_id % 3 = 1").coalesce(1).write.parquet(source)

    def run():
        counts = words.seeded_word_count(
            spark.readStream.schema(docs.schema).parquet(source), spark.readStream.schema("key string, n decimal(20,0)").parquet(seed))
        runner.finish(runner.batch_table(counts, runner.write_batch(str(tmp_path / "out")), str(tmp_path / "cp"), "update"))
        return counts.schema

    run()
    docs.filter("doc_id % 3 = 2").coalesce(1).write.mode("append").parquet(source)
    schema = run()
    rows = runner.read_batches(spark, str(tmp_path / "out"), schema)
    assert same(rows.groupBy("word").agg(F.max_by("n", "batch_id").alias("n")), words.word_count(docs))


def test_all_tables_are_anonymized_from_one_read(spark, tables, tmp_path):
    """Rows per target over several batches, a batch that runs twice, and no dropped field anywhere in the files."""
    rules, path = rulesets.ANALYTICS_RULES, str(tmp_path / "out")
    changes = Tables.as_all_changes(tables.table("customer"), tables.table("orders"), tables.table("events"))
    stream = in_files(changes, str(tmp_path / "in"), "offset", 3)
    for cp in ("one", "two"):  # the second run writes the same batches again
        runner.finish(jobs.cdc_anonymize_all_stream(stream, rules, ANALYTICS_IMAGES, path, str(tmp_path / cp)))
    want = cdc.anonymize_tables(changes, rules, ANALYTICS_IMAGES)
    assert same(spark.read.parquet(path).select(*want.columns), want)
    assert not {"notes", "ip_address", "user_agent", "birth_date"} & set(spark.read.parquet(path).columns)
    users = jobs.read_target(spark, path, rules, ANALYTICS_IMAGES, "users")
    one = cdc.anonymize(cdc.cdc_row_image(cdc.parse_cdc(Tables.as_cdc(tables.table("customer")).withColumnRenamed("seq", "offset"), USER_IMAGE)),
                        rules, "users", USER_IMAGE)
    assert same(users, one.drop("target_topic"))
    events = jobs.read_target(spark, path, rules, ANALYTICS_IMAGES, "events")
    assert events.columns == ["topic", "partition", "offset", "key", "id", "user_id", "kind", "cdc_lsn", "_deleted"]
    assert events.count() == tables.table("events").count()
    plan = events._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(outcome" in plan and plan.count("Scan parquet") == 1
    assert want._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_images_of_several_tables_share_types():
    other = T.StructType([T.StructField("id", T.StringType())])
    with pytest.raises(ValueError, match="another type"):
        cdc.union_image({"users": USER_IMAGE, "odd": other})
