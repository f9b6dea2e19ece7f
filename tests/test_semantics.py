"""Corner cases of the operators on literal rows and against brute force."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cdc, contracts, joins, logs, metrics, quality, records, sagas, transactions, windows, words
from tidemark.operators import reliability as rel
from tidemark.schema import USER_IMAGE
from tidemark.sources import log as source
from tidemark.sources import outbox as ob
from tidemark.sources import rules as rulesets
from tidemark.sources import sinks

T0 = datetime(2024, 1, 1)


def ts(seconds):
    return T0 + timedelta(seconds=seconds)


def pairs(df, *columns):
    return {tuple(r[c] for c in columns) for r in df.collect()}


# --- logs -----------------------------------------------------------------------


def keyed_log(seed, n=600):
    rnd = random.Random(seed)
    out, offsets = [], {0: 0, 1: 0}
    for i in range(n):
        hot = rnd.random() < 0.4
        key = "hot" if hot else rnd.choice(["a", "b", "c", None, "__beat"])
        part = 0 if hot else 1
        value = rnd.choice(["v", "w", None])
        out.append(("t", part, offsets[part], key, value, ts(i * 60), 10 + i % 7))
        offsets[part] += 1 + (rnd.random() < 0.1)
    return out


LOG = "topic string, partition int, offset long, key string, value string, ts timestamp, bytes long"


def test_latest_by_key(spark):
    data = keyed_log(1)
    last = {}
    for r in data:
        if r[3] is not None:
            last[r[3]] = r
    want = {(k, r[2], r[4]) for k, r in last.items() if r[4] is not None}
    assert pairs(logs.latest_by_key(spark.createDataFrame(data, LOG)), "key", "offset", "value") == want


def test_compact(spark):
    data = keyed_log(2)
    now, lag, keep = ts(600 * 60), 6000, 20000
    age = {(r[1], r[2]): (now - r[5]).total_seconds() for r in data}
    last = {}
    for r in data:
        if r[3] is not None and age[(r[1], r[2])] >= lag:
            last[(r[1], r[3])] = r
    want = {(r[1], r[2]) for r in data if age[(r[1], r[2])] < lag}
    want |= {(r[1], r[2]) for r in last.values() if r[4] is not None or age[(r[1], r[2])] < keep}
    got = logs.compact(spark.createDataFrame(data, LOG), F.lit(now), lag, keep)
    assert pairs(got, "partition", "offset") == want


def test_retain(spark):
    data = keyed_log(3)
    now, max_age, max_bytes = ts(600 * 60), 30000, 900
    want = set()
    for part in (0, 1):
        total = 0
        for r in sorted((r for r in data if r[1] == part), key=lambda r: -r[2]):
            total += r[6]
            if total <= max_bytes and (now - r[5]).total_seconds() <= max_age:
                want.add((part, r[2]))
    df = spark.createDataFrame(data, LOG).withColumnRenamed("ts", "timestamp")
    assert pairs(logs.retain(df, F.lit(now), max_age, max_bytes), "partition", "offset") == want


def test_compaction_stats_ignore_heartbeats(spark):
    rows = [("__x", "v", 1), ("__", "v", 2), ("a", "v", 3), ("a", None, 4), ("b", None, 5), ("b", "v", 6)]
    df = spark.createDataFrame([("t", 0, o, k, v) for k, v, o in rows], "topic string, partition int, offset long, key string, value string")
    r = logs.compaction_stats(df).first()
    # The two characters __ alone are an ordinary key.
    assert (r.records, r.live_keys, r.tombstones, r.heartbeats) == (6, 2, 2, 1)


def test_commit_frontier(spark):
    done = [(0, o) for o in (5, 6, 7, 9, 10, 13)] + [(1, 0)]
    got = logs.commit_frontier(spark.createDataFrame(done, "partition int, offset long"))
    assert pairs(got, "partition", "commit_offset", "held_back") == {(0, 8, 3), (1, 1, 0)}


def test_starting_offsets(spark):
    df = spark.createDataFrame([("t", p, o) for p in (0, 1) for o in range(4)], "topic string, partition int, offset long")
    committed = spark.createDataFrame([("t", 0, 2)], "topic string, partition int, committed long")
    assert pairs(source.starting_offsets(df, "earliest", committed), "partition", "offset") == {
        (0, 2), (0, 3), (1, 0), (1, 1), (1, 2), (1, 3)
    }
    assert pairs(source.starting_offsets(df, "latest", committed), "partition", "offset") == {(0, 2), (0, 3)}
    assert source.starting_offsets(df, "latest").count() == 0
    with pytest.raises(ValueError):
        source.starting_offsets(df, "newest")


def test_bounded_read_leaves_out_empty_partitions(spark):
    df = spark.createDataFrame([("t", p, o) for p in (0, 1) for o in range(3)], "topic string, partition int, offset long")
    ends = spark.createDataFrame([("t", 0, 2), ("t", 1, 0)], "topic string, partition int, end_offset long")
    assert pairs(source.bounded_read(df, ends), "partition", "offset") == {(0, 0), (0, 1)}


def test_negative_lag_adds_nothing(spark):
    offs = spark.createDataFrame([("g", "t", 0, 10, 4), ("g", "t", 1, 5, 6)], "group_id string, topic string, partition int, end_offset long, committed long")
    lag = logs.consumer_lag(offs)
    assert pairs(lag, "partition", "lag") == {(0, 6), (1, -1)}
    assert logs.total_lag(lag).first().lag == 6


def test_skew_report(spark):
    deltas = spark.createDataFrame([("t", 0, 80), ("t", 1, 20), ("u", 0, 0)], "topic string, partition int, delta long")
    got = logs.skew_report(deltas, ["topic"], "partition")
    assert pairs(got, "topic", "partition", "share_pct", "bar", "hot") == {
        ("t", 0, 80.0, 40, True), ("t", 1, 20.0, 10, False), ("u", 0, 0.0, 0, False)
    }


def test_round_robin_with_few_partitions(spark):
    df = spark.createDataFrame([(i, "reg-1") for i in range(4)] + [(9, "prem-1")], "seq long, key string")
    assert pairs(logs.round_robin(df, 2), "seq", "partition") == {(0, 1), (1, 1), (2, 1), (3, 1), (9, 0)}
    assert pairs(logs.round_robin(df, 3), "seq", "partition") == {(0, 1), (1, 2), (2, 1), (3, 2), (9, 0)}


def test_kafka_options():
    opts = source.kafka_options("h:1", pattern="^a", max_offsets=5)
    assert opts["subscribePattern"] == "^a" and opts["maxOffsetsPerTrigger"] == "5"
    with pytest.raises(ValueError):
        source.kafka_options("h:1")


# --- windows --------------------------------------------------------------------


def test_window_diff_cuts_each_side_first(spark):
    a = spark.createDataFrame([(ts(3600 * i), 1) for i in (0, 1, 2)], "window_start timestamp, n long")
    b = spark.createDataFrame([(ts(3600 * i), 5) for i in (1, 2, 3)], "window_start timestamp, n long")
    got = windows.window_diff(a, b, last_n=2)
    assert pairs(got, "window_start", "event_n", "processing_n", "diff") == {
        (ts(3600), 1, 0, 1), (ts(7200), 1, 5, -4), (ts(10800), 0, 5, -5)
    }


def test_index_percentiles_use_the_lower_index(spark):
    rnd = random.Random(5)
    data = {"a": [rnd.randrange(5000) for _ in range(501)], "b": [7], "c": [3, 3, 9, 9]}
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs], "g string, v long")
    got = windows.index_percentiles(df, ["g"], "v", {"p50": 0.5, "p99": 0.99}, bits=6)
    for r in got.collect():
        xs = sorted(data[r.g])
        assert r.p50 == xs[int((len(xs) - 1) * 0.5)]
        assert r.p99 == xs[int((len(xs) - 1) * 0.99)]


@pytest.mark.parametrize("bits", [20, 26, 40])
def test_moving_window(spark, bits):
    rnd = random.Random(6)
    data = [(i, "hot" if rnd.random() < 0.4 else f"u{rnd.randrange(4)}", ts(rnd.randrange(20000)), rnd.randrange(9)) for i in range(400)]
    df = spark.createDataFrame(data, "id long, u string, t timestamp, v long")
    got = {r.id: (r.n, r.total) for r in windows.moving_window(df, 600, "u", "t", "v", bits=bits).collect()}
    for i, u, t, _ in data:
        inside = [x for x in data if x[1] == u and t - timedelta(seconds=600) <= x[2] <= t]
        assert got[i] == (len(inside), sum(x[3] for x in inside))


def test_late_split(spark):
    rnd = random.Random(8)
    data = [(i, i % 2, ts(i * 120 - rnd.choice([0, 60, 600, 9000]))) for i in range(300)]
    df = spark.createDataFrame(data, "event_id long, part int, event_ts timestamp")
    late, seen = set(), {}
    for i, p, t in data:
        start = ts((t - T0).total_seconds() // 3600 * 3600)
        if p in seen and start + timedelta(hours=1) <= seen[p] - timedelta(seconds=600):
            late.add(i)
        seen[p] = max(seen.get(p, t), t)
    assert late
    assert {r[0] for r in windows.late_split(df, 3600, 600, "side").select("event_id").collect()} == late
    assert windows.late_split(df, 3600, 600, "drop").count() == 300 - len(late)


def test_counter_rate_restarts(spark):
    df = spark.createDataFrame([("t", ts(60 * i), v) for i, v in enumerate([10, 20, 5, 8])], "topic string, ts timestamp, high_water long")
    got = windows.counter_rate(df, 120)
    # Steps 0, 10, 5 (restart), 3; two samples fall into a span of two minutes.
    assert pairs(got, "ts", "rate") == {(ts(0), 0.0), (ts(60), round(10 / 120, 6)), (ts(120), round(15 / 120, 6)), (ts(180), round(8 / 120, 6))}


@pytest.mark.parametrize("bits", [22, 27, 40])
def test_counter_rate_over_chunks(spark, bits):
    """One topic over many chunks, with restarts and samples within a second, against a plain scan."""
    rnd = random.Random(12)
    times, at = [], 0.0
    for _ in range(400):
        at += rnd.choice([0.25, 1, 1, 7, 90])
        times.append(at)
    rows, value = [], 0
    for i, s in enumerate(times):
        value = 0 if rnd.random() < 0.03 else value + rnd.randrange(9)
        rows.append(("hot" if i % 5 else f"t{i % 3}", T0 + timedelta(seconds=s), value))
    got = {(r.topic, r.ts): r.rate for r in windows.counter_rate(
        spark.createDataFrame(rows, "topic string, ts timestamp, high_water long"), 60, bits=bits).collect()}
    steps, last = [], {}
    for t, s, v in rows:
        steps.append((t, s, 0 if t not in last else v if v < last[t] else v - last[t]))
        last[t] = v
    whole = lambda s: int((s - T0).total_seconds())
    for t, s, _ in steps:
        total = sum(x for u, r, x in steps if u == t and whole(s) - 59 <= whole(r) <= whole(s))
        assert got[t, s] == pytest.approx(round(total / 60, 6), abs=1e-9)
    assert len(got) == len(rows)


# --- change capture ---------------------------------------------------------------


def envelopes(spark, *texts):
    rows = [("cdc.public.users", 0, i, "k", t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset long, key string, value string")
    return cdc.parse_cdc(df, USER_IMAGE)


def test_row_images_and_versions(spark):
    parsed = envelopes(
        spark,
        '{"before":null,"after":{"id":1,"email":"a"},"op":"c","source":{"lsn":100,"ts_ms":5}}',
        '{"before":{"id":1},"after":{"id":1},"op":"u","source":{"lsn":"200"}}',
        '{"before":{"id":1},"after":null,"op":"d","source":{"ts_ms":300}}',
        '{"before":null,"after":{"id":2},"op":"r","source":{}}',
        '{"before":null,"after":{"id":2},"op":"r","source":{"lsn":9007199254740993}}',
        '{"before":null,"after":null,"op":"c","source":{"lsn":1}}',
        '{"op":"t","source":{"lsn":1}}',
        "{bad",
        None,
    )
    assert [r.kind for r in parsed.orderBy("offset").collect()][-2:] == ["error", "tombstone"]
    images = cdc.cdc_row_image(parsed)
    assert pairs(images, "offset", "cdc_lsn", "_deleted") == {
        (0, 100, 0), (1, 200, 0), (2, 300, 1), (3, 0, 0), (4, 9007199254740993, 0)
    }


def test_versions_are_unsigned(spark):
    lsns = ["9223372036854775807", "9223372036854775808", '"18446744073709551615"', "18446744073709551616", '"-3"', '"x"']
    parsed = envelopes(spark, *[f'{{"after":{{"id":1}},"op":"c","source":{{"lsn":{v},"ts_ms":7}}}}' for v in lsns])
    rows = parsed.orderBy("offset").select(cdc.cdc_version(F.col("e.source")), cdc.version_error(F.col("e.source"))).collect()
    assert [int(r[0]) for r in rows] == [2**63 - 1, 2**63, 2**64 - 1, 7, 7, 7]
    assert [r[1] for r in rows] == [False, False, False, True, False, False]
    images = cdc.cdc_row_image(parsed).select("image.id", "cdc_lsn", "offset", "_deleted")
    assert cdc.replacing_final(images, "id", "cdc_lsn").first().offset == 2


def test_restored_counters_are_unsigned(spark):
    values = [("a", 1, 5), ("a", 2, 2**63), ("b", 1, 2**64 - 1), ("b", 2, 3), ("c", 1, 2**63), ("c", 2, None)]
    rows = [(k, o, bytearray(v.to_bytes(8, "big")) if v is not None else None) for k, o, v in values]
    got = words.restore_state(spark.createDataFrame(rows, "key string, offset long, value8 binary")).collect()
    assert {(r.key, r.n, r.applied) for r in got} == {("a", 2**63, 2), ("b", 3, 2), ("c", None, 1)}


def test_version_beyond_long_is_flagged(spark):
    parsed = envelopes(spark, '{"after":{"id":1},"op":"c","source":{"lsn":99999999999999999999,"ts_ms":4}}')
    r = parsed.select(cdc.cdc_version(F.col("e.source")), cdc.version_error(F.col("e.source"))).first()
    assert r[:] == (4, True)


def test_labels_and_tables(spark):
    df = spark.createDataFrame([("c",), ("u",), ("d",), ("r",), ("t",), ("x",)], "op string")
    assert [r[0] for r in df.select(cdc.cdc_op_label(F.col("op"))).collect()] == [
        "INSERT", "UPDATE", "DELETE", "SNAPSHOT", "TRUNCATE", "op=x"
    ]
    df = spark.createDataFrame([("cdc.public.users",), ("other.users",)], "t string")
    assert [r[0] for r in df.select(cdc.table_from_topic(F.col("t"))).collect()] == ["users", ""]


def test_anonymize_by_rules(spark):
    images = cdc.cdc_row_image(
        envelopes(spark, '{"after":{"id":1,"email":null,"full_name":"Ann Lee","birth_date":"1990"},"op":"c","source":{"lsn":1}}')
    )
    out = cdc.anonymize(images, rulesets.ANALYTICS_RULES, "users", USER_IMAGE)
    r = out.first()
    assert "birth_date" not in out.columns
    assert (r.email, r.full_name, r.target_topic, r.cdc_lsn, r["_deleted"]) == ("", "AnnL.", "analytics.users", 1, 0)
    assert cdc.anonymize(images, rulesets.ANALYTICS_RULES, "secrets", USER_IMAGE).count() == 0


def test_rule_sets_are_checked():
    with pytest.raises(ValueError, match="unknown rule"):
        rulesets.load_rules("s", [("t", "x", "f", "scramble")])
    with pytest.raises(ValueError, match="no table"):
        rulesets.load_rules("s", [])


def test_replacing_final_ties_by_arrival(spark):
    rows = [(1, 5, 0, 0, "a"), (1, 5, 1, 0, "b"), (2, 9, 2, 1, "x"), (2, 3, 3, 0, "y")]
    df = spark.createDataFrame(rows, "id long, cdc_lsn long, offset long, _deleted int, v string")
    assert pairs(cdc.replacing_final(df, "id", "cdc_lsn"), "id", "v") == {(1, "b"), (2, "x")}
    assert pairs(cdc.replacing_final(df, "id", "cdc_lsn", drop_deleted=True), "id", "v") == {(1, "b")}


def test_tolerance_none_fails(spark):
    parsed = envelopes(spark, "{bad")
    assert cdc.split_malformed(parsed).first().cause == "malformed record of 4 bytes"
    with pytest.raises(Exception, match="malformed record at offset 0"):
        cdc.split_malformed(parsed, "none").collect()


def test_append_versioned_is_idempotent(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "target_topic string, id long")
    for batch in (0, 0, 1):
        sinks.append_versioned(df, str(tmp_path / "v"), batch)
    assert sinks.read_versioned(spark, str(tmp_path / "v"), "a").count() == 2


def test_unknown_transform_is_refused():
    with pytest.raises(ValueError):
        cdc.transforms_by_name([("shout",)])


# --- joins ------------------------------------------------------------------------


def test_dedup_gate_per_consumer(spark):
    batch = spark.createDataFrame([("c1", 1, 5), ("c1", 1, 3), ("c2", 1, 4), ("c1", 2, 6)], "consumer string, outbox_id long, offset long")
    done = spark.createDataFrame([("c1", 2)], "consumer string, outbox_id long")
    passed = joins.dedup_gate(batch, done)
    assert pairs(passed, "consumer", "outbox_id", "offset") == {("c1", 1, 3), ("c2", 1, 4)}
    assert pairs(joins.gate_counts(batch, passed), "consumer", "processed", "inserted", "skipped") == {("c1", 3, 1, 2), ("c2", 1, 1, 0)}


def test_merge_upsert_keeps_created_at_and_nulls(spark):
    schema = "id long, v string, created_at string"
    target = spark.createDataFrame([(1, "old", "t1"), (2, "two", "t2")], schema)
    batch = spark.createDataFrame([(1, None, "t9"), (3, "new", "t3")], schema)
    got = joins.merge_upsert(target, batch, "id", keep=("created_at",))
    # A null of the batch overwrites the stored value.
    assert pairs(got, "id", "v", "created_at") == {(1, None, "t1"), (2, "two", "t2"), (3, "new", "t3")}


def test_upsert_delete(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    batch = spark.createDataFrame([(1, "x", 0, False), (1, None, 1, True), (3, None, 2, True), (3, "c", 3, False)], "id long, v string, offset long, gone boolean")
    got = joins.upsert_delete_sink(target, batch, "id", F.col("gone"))
    assert pairs(got, "id", "v") == {(2, "b"), (3, "c")}


def test_read_view(spark):
    events = spark.createDataFrame(
        [("c", 1, 0, "o1", "A", 5, "EUR", "NEW", "2024-01-02T00:00:00Z"), ("c", 1, 1, "o1", "B", 6, "EUR", "NEW", "2024-01-02T00:00:00Z"), ("c", 2, 2, "o2", "A", 5, "EUR", "NEW", "soon")],
        "consumer string, outbox_id long, offset long, id string, customer_id string, amount_cents long, currency string, status string, created_at string",
    )
    view = spark.createDataFrame([("o1", "Z", 1, "EUR", "OLD", T0)], "id string, customer_id string, amount_cents long, currency string, status string, created_at timestamp")
    none = spark.createDataFrame([], "consumer string, outbox_id long")
    rows, errors = joins.project_read_view(events, none, view)
    assert pairs(rows, "id", "customer_id", "status", "created_at") == {("o1", "A", "NEW", T0)}
    assert pairs(errors, "id") == {("o2",)}


def test_reconcile_and_row_diff(spark):
    a = spark.createDataFrame([(1,), (2,), (2,), (3,)], "id long")
    b = spark.createDataFrame([(2,), (3,), (4,)], "id long")
    r = joins.reconcile(a, b, "id").first()
    assert (r.source_rows, r.target_rows, r.missing_in_target, r.missing_in_source, r.match) == (4, 3, 1, 1, False)
    assert pairs(joins.row_diff(a, b), "id", "side", "copies") == {(1, "source", 1), (2, "source", 1), (4, "target", 1)}


def test_mark_published_checks_the_batch(spark):
    outbox = spark.createDataFrame([(1, None), (2, None)], "id long, published_at timestamp")
    now = F.lit(T0)
    assert pairs(ob.mark_published(outbox, spark.createDataFrame([(1,)], "id long"), now), "id", "published_at") == {(1, T0), (2, None)}
    with pytest.raises(Exception, match="differ by 1"):
        ob.mark_published(outbox, spark.createDataFrame([(9,)], "id long"), now).collect()
    with pytest.raises(Exception, match="differ by 1"):
        ob.mark_published(outbox, spark.createDataFrame([(1,), (1,)], "id long"), now).collect()


# --- retries ----------------------------------------------------------------------

PAY = "topic string, partition int, offset long, key string, value string, headers array<struct<key:string,value:binary>>, timestamp timestamp"


def payments(spark):
    modes = ["ok", "transient", "permanent", "odd"]
    rows = [("payments", 0, i, f"k{i}", f'{{"id":"p{i}","amount":1,"mode":"{m}"}}', [], ts(i)) for i, m in enumerate(modes)]
    return spark.createDataFrame(rows + [("payments", 1, 9, "k9", "oops", [], ts(9))], PAY)


def test_classify_payment(spark):
    got = rel.handled(payments(spark))
    assert pairs(got, "offset", "cls", "message") == {
        (0, "ok", None),
        (1, "transient", 'payment not settled for now, id="p1"'),
        (2, "permanent", 'payment refused for good, id="p2"'),
        (3, "permanent", 'no such mode: "odd"'),
        (9, "permanent", "invalid json"),
    }


def test_pipeline_equals_single_hops(spark):
    """The closed form gives the same headers as one hop after the other."""
    from tidemark.functions.headers import format_headers

    done = rel.retry_pipeline(payments(spark), rel.PAYMENT_STAGES, rel.DLQ_TOPIC)
    want = {}
    current = rel.handled(payments(spark)).filter("cls <> 'ok'").withColumn("at", F.col("timestamp"))
    for stage in rel.PAYMENT_STAGES:
        at = F.col("at") + F.expr(f"interval {stage.delay_s} seconds")
        hop = rel.escalate_once(current.withColumn("at", at), rel.PAYMENT_STAGES, rel.DLQ_TOPIC, F.col("at"))
        for r in hop.filter(F.col("target") == rel.DLQ_TOPIC).select("offset", "at", format_headers("headers").alias("h")).collect():
            want[r.offset] = (r.h, r.at)
        current = hop.filter(F.col("target") != rel.DLQ_TOPIC).withColumn("topic", F.col("target")).drop("target", "reason")
    got = {r.offset: (r.h, r.at) for r in done.filter("outcome = 'dlq'").select("offset", "at", format_headers("headers").alias("h")).collect()}
    assert got == want and set(got) == {1, 2, 3, 9}
    assert pairs(done.filter("outcome = 'ok'"), "offset", "final_topic") == {(0, "payments")}


def test_last_stage_reasons_differ(spark):
    df = rel.handled(payments(spark)).filter("cls = 'transient'")
    last = df.withColumn("topic", F.lit("payments-retry-1h"))
    assert rel.escalate_once(last, rel.PAYMENT_STAGES, rel.DLQ_TOPIC, F.col("timestamp")).first().reason == "next-retry"
    last = df.withColumn("topic", F.lit("payments-retry-5m"))
    assert rel.escalate_once(last, rel.NOTIFY_STAGES, rel.DLQ_TOPIC, F.col("timestamp"), coordinates=False).first().reason == "exhausted"


def test_in_place_retry(spark):
    got = rel.in_place_retry(payments(spark), 3, 100)
    assert pairs(got, "offset", "outcome", "retried", "attempts", "backoff_ms") == {
        (0, "ok", 0, 0, 0), (1, "ok", 2, 3, 300), (2, "dlq permanent", 0, 0, 0), (3, "dlq permanent", 0, 0, 0), (9, "dlq permanent", 0, 0, 0)
    }
    one = rel.in_place_retry(payments(spark), 1, 100).filter("offset = 1").first()
    assert (one.outcome, one.retried, one.attempts, one.backoff_ms) == ("dlq exhausted", 1, 2, 100)


def test_replay_keeps_the_cutoff_itself(spark):
    dead = rel.dead_letters(rel.retry_pipeline(payments(spark), rel.PAYMENT_STAGES, rel.DLQ_TOPIC), rel.DLQ_TOPIC)
    cutoff = F.lit(ts(2) + timedelta(days=1))
    assert pairs(rel.replay_select(dead, "payments", cutoff), "offset") == {(2,), (3,), (9,)}
    assert pairs(rel.replay_select(dead, "payments", cutoff, "transient"), "offset") == set()
    r = rel.replay_summary(dead, cutoff, "permanent", dry_run=True).first()
    assert (r.read, r.skipped, r.matched, r.replayed) == (4, 1, 3, 0)


def test_incidents(spark, tmp_path):
    dead = rel.dead_letters(rel.retry_pipeline(payments(spark), rel.PAYMENT_STAGES, rel.DLQ_TOPIC), rel.DLQ_TOPIC)
    sinks.write_incidents(dead, str(tmp_path / "i"))
    back = sinks.read_incidents(spark, str(tmp_path / "i"), sinks.dlq_incidents(dead).schema)
    r = back.filter("dlq_offset = 1").first()
    assert (r.original_topic, r.previous_topic, r.retry_count, r.error_class) == ("payments", "payments-retry-1h", "4", "transient")
    assert back.count() == 4


def test_failure_runs(spark):
    status = [200, 503, 503, 400, 503, None, 429, 408, 500, 200, 503]
    df = spark.createDataFrame([("c", i, s) for i, s in enumerate(status)], "channel string, seq long, status int")
    breaker = rel.failure_runs(df, 5, permanent_fails=False)
    assert pairs(breaker, "first_seq", "last_seq", "length", "tripped") == {(1, 2, 2, False), (4, 8, 5, True), (10, 10, 1, False)}
    courier = rel.failure_runs(df, 5, permanent_fails=True)
    assert pairs(courier, "first_seq", "last_seq", "length", "tripped") == {(1, 8, 8, True), (10, 10, 1, False)}


def test_validation_order(spark):
    df = spark.createDataFrame([("", 0, ""), ("c", 0, ""), ("c", 5, ""), ("c", 5, "EUR")], "customer_id string, amount_cents long, currency string")
    assert [r.error for r in records.validate_orders(df).collect()] == [
        "no customer given", "amount is not above zero", "no currency given", None
    ]
    r = records.upload_summary(df).first()
    assert (r.received, r.accepted, r.rejected, r.total_cents) == (4, 2, 2, 10)


def test_unknown_channels_are_not_dropped(spark):
    df = spark.createDataFrame([("CHANNEL_APNS",), ("CHANNEL_UNSPECIFIED",), ("CHANNEL_NEW",)], "channel string")
    out = records.route_by_channel(df, "n")
    assert [r.destination for r in out.collect()] == ["notifications-apns", records.ROUTER_DLQ, records.ROUTER_DLQ]


# --- transactions and sagas ---------------------------------------------------------


def test_gaps_keep_repeats_and_missing_ids(spark):
    orders = spark.createDataFrame([("a",), ("b",), ("b",), (None,), ("c",)], "id string")
    outbox = spark.createDataFrame([("a",), ("d",), (None,), ("c",), ("c",)], "aggregate_id string")
    got = sorted(map(tuple, joins.outbox_gaps(orders, outbox).collect()), key=repr)
    assert got == sorted([("b", "outbox"), ("b", "outbox"), (None, "outbox"), ("d", "orders"), (None, "orders")], key=repr)


def test_isolation_counts_equal_the_rows(spark):
    log = spark.createDataFrame(
        [("t", None, None), ("t", "p", 1), ("t", "p", 2), ("u", "p", 2), ("u", "q", 2), ("v", "p", 2), ("t", "p", 1)],
        "topic string, txn_id string, txn_no long")
    markers = spark.createDataFrame([("p", 1, "commit"), ("p", 1, "commit"), ("p", 2, "abort"), ("q", 2, "commit")], "txn_id string, txn_no long, outcome string")
    read = transactions.read_committed(log, markers).groupBy("topic").count().collect()
    got = {(r.level, r.label): r.records for r in transactions.isolation_counts(log, markers).collect()}
    assert {k[1]: v for k, v in got.items() if k[0] == "committed" and k[1] != "TOTAL"} == {r.topic: r["count"] for r in read}
    assert got["committed", "TOTAL"] == 4 and got["uncommitted", "TOTAL"] == 7 and ("committed", "v") not in got


def test_hot_keys_read_the_log_once(spark, tmp_path):
    spark.createDataFrame([("t", i % 3, f"k{i % 7}") for i in range(100)], "topic string, partition int, key string").write.parquet(str(tmp_path / "l"))
    df = logs.hot_keys(spark.read.parquet(str(tmp_path / "l")), 3)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert final.count("FileScan parquet") == 1 and "ReusedExchange" in final


def test_read_committed(spark):
    log = spark.createDataFrame([("t", 0, "a", 1), ("t", 1, "a", 2), ("t", 2, "a", 3), ("t", 3, None, None)], "topic string, offset long, txn_id string, txn_no long")
    marks = spark.createDataFrame([("a", 1, "commit"), ("a", 2, "abort")], "txn_id string, txn_no long, outcome string")
    assert pairs(transactions.read_committed(log, marks), "offset") == {(0,), (3,)}
    assert pairs(transactions.txn_outcomes(log, marks), "outcome", "attempts") == {("commit", 1), ("abort", 1), ("open", 1)}


def test_fencing(spark):
    rows = [("a", 1, 1), ("a", 2, 2), ("a", 3, 1), ("a", 4, 2), ("b", 5, 1)]
    df = spark.createDataFrame(rows, "txn_id string, txn_no long, epoch int")
    assert pairs(transactions.fence_stale_writers(df).filter("fenced"), "txn_no") == {(3,)}


def saga(spark, *chains):
    rows = [(f"s{i}", j, e, ts(j)) for i, c in enumerate(chains) for j, e in enumerate(c)]
    return spark.createDataFrame(rows, "saga_id string, seq long, event string, ts timestamp")


def test_saga_reports(spark):
    events = saga(
        spark,
        ["order.requested", "payment.completed", "inventory.reserved", "shipment.scheduled"],
        ["order.requested", "inventory.reserved"],
        ["order.requested", "payment.completed", "inventory.failed"],
        ["order.requested", "shipment.lost"],
    )
    got = sagas.saga_conformance(events)
    assert pairs(got, "saga_id", "violations", "missing_compensations", "outcome") == {
        ("s0", 0, 0, "success"), ("s1", 1, 0, "open"), ("s2", 0, 1, "open"), ("s3", 1, 0, "open")
    }
    assert pairs(sagas.open_sagas(events), "saga_id") == {("s1",), ("s2",), ("s3",)}
    r = sagas.saga_timeline(events).filter("saga_id = 's0'").first()
    assert r.chain == "order.requested → payment.completed → inventory.reserved → shipment.scheduled" and r.terminal


def test_saga_checks_every_event_against_the_one_before(spark):
    start = ["order.requested", "payment.completed", "inventory.reserved"]
    events = saga(
        spark,
        ["order.requested", "order.requested", "payment.failed"],
        ["order.requested", "payment.completed", "payment.failed"],
        [*start, "shipment.scheduled", "shipment.failed"],
        ["order.requested", "payment.completed", "payment.completed", "inventory.reserved"],
        ["payment.completed"],
        ["order.requested", "inventory.reserved", "payment.completed"],
    )
    want = {("s0", 0), ("s1", 1), ("s2", 1), ("s3", 1), ("s4", 1), ("s5", 2)}
    assert pairs(sagas.saga_conformance(events), "saga_id", "violations") == want
    columns = ("saga_id", "violations", "missing_compensations", "outcome")
    assert pairs(sagas.saga_conformance_running(events), *columns) == pairs(sagas.saga_conformance(events), *columns)


def test_long_saga_ends_where_it_ends(spark):
    chain = ["order.requested"] * 1499 + ["payment.failed"]
    got = sagas.saga_timeline(saga(spark, chain)).collect()
    assert {(r.last_event, r.events, r.terminal) for r in got} == {("payment.failed", 1500, True)}
    assert " → ".join(r.chain for r in sorted(got, key=lambda r: r.part)) == " → ".join(chain)


def test_fencing_with_two_epochs_in_one_transaction(spark):
    rows = [("t", 1, 1), ("t", 2, 1), ("t", 2, 2), ("t", 3, 2), ("u", 1, 5), ("u", 2, 4)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "txn_id string, txn_no long, epoch long")
        got = transactions.fence_stale_writers(df).filter("fenced")
        assert pairs(got, "txn_id", "txn_no", "epoch") == {("t", 2, 1), ("u", 2, 4)}


# --- contracts and metrics ------------------------------------------------------------


def test_schema_compat(spark):
    declared = contracts.schema_fields(spark)

    def version(v):
        return declared.filter(F.col("version") == v)

    safe = contracts.schema_compat(version(1), version(2))
    assert pairs(safe, "number", "change") == {(1, "same"), (2, "same"), (3, "same"), (4, "added")}
    broken = contracts.schema_compat(version(3), version(4))
    assert pairs(broken, "number", "name", "change") == {
        (1, "id", "same"), (2, "customer_id", "same"), (3, "amount_cents", "type changed"), (4, "currency", "removed"),
        (5, "shipping_address", "same"), (7, "currency", "moved"),
    }
    for changes, ok in ((safe, True), (broken, False)):
        assert changes.agg(contracts.compat_verdict("BACKWARD")).first()[0] is ok
        assert changes.agg(contracts.compat_verdict("NONE")).first()[0] is True


def test_wire_header(spark):
    values = ["00000000070068", "000000", "0100000007", "0000000007", "00000000070206aa", "00000000070200aa"]
    df = spark.createDataFrame([(bytearray.fromhex(v),) for v in values], "value binary")
    got = [r[:] for r in df.select(*[c.alias(n) for n, c in contracts.wire_header().items()]).collect()]
    assert got == [
        (7, 0, 1, None), (None, None, None, "short"), (None, None, None, "bad magic"), (None, None, None, "bad index"),
        (None, None, None, "bad index"), (7, 0, 1, None),
    ]


def test_wire_header_reads_every_index(spark):
    def zigzag(n):
        n = (n << 1) ^ (n >> 63)
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    head = bytes.fromhex("0000000007")
    cases = {
        head + zigzag(2) + zigzag(0) + zigzag(5) + b"xyz": (7, 0, 3, None),
        head + zigzag(3) + zigzag(-1) + zigzag(1 << 40) + zigzag(-300) + b"x": (7, -1, 1, None),
        head + zigzag(70) + zigzag(0) + b"\x02" * 69: (7, 0, 0, None),
        head + zigzag(70) + zigzag(0) + b"\x02" * 68: (None, None, None, "bad index"),
        head + zigzag(2) + zigzag(300) + zigzag(0): (None, None, None, "bad index"),
        head + zigzag(-4) + zigzag(0) + b"ab": (7, 0, 2, None),
        head + b"\x80\x00" + b"ab": (7, 0, 2, None),
        head + zigzag(1) + b"\x80" * 10 + b"\x00": (None, None, None, "bad index"),
        head + zigzag(1) + b"\x80" * 9 + b"\x02": (None, None, None, "bad index"),
        head + b"\x80": (None, None, None, "bad index"),
    }
    df = spark.createDataFrame([(bytearray(k),) for k in cases], "value binary")
    got = df.select("value", *[c.alias(n) for n, c in contracts.wire_header().items()]).collect()
    assert {bytes(r.value): tuple(r[1:]) for r in got} == cases


def test_setting_text(spark):
    cases = {
        ("retention.ms", "-1"): "no limit", ("retention.ms", "604800000"): "7d", ("segment.ms", "600000"): "10m",
        ("segment.bytes", "134217728"): "128 MB", ("max.message.bytes", "1536"): "2 KB", ("cleanup.policy", "compact"): "compact",
        ("retention.bytes", "1610612736"): "1.5 GB", ("max.message.bytes", "10"): "10 B",
    }
    df = spark.createDataFrame(list(cases), "s string, v string")
    got = df.select("s", "v", metrics.setting_text(F.col("s"), F.col("v")).alias("t")).collect()
    assert {(r.s, r.v): r.t for r in got} == cases


def test_profiles_side_by_side(spark):
    table = metrics.profile_table(metrics.profile_rows(spark))
    r = table.filter("setting = 'compression.type'").first()
    assert (r.cdc, r.events, r.metrics) == ("zstd", "lz4", "lz4")


def test_capacity_plan(spark):
    load = spark.sql("select 't' topic, 5000D msgs_per_s, 600D bytes_per_msg, 800 worker_rate, 604800 retention_s, 3 rf, 2.5D ratio")
    r = metrics.capacity_plan(load, 3).first()
    assert (r.partitions, r.partitions_30, r.partitions_50) == (7, 10, 11)
    assert round(r.disk_gb / 1000, 2) == 2.18


def test_duplicates(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k long")
    r = quality.duplicate_summary(df, "k").first()
    assert (r.total, r.unique_keys, r.duplicates, r.verdict) == (3, 2, 1, "duplicates")


def test_switch_version_waits_for_the_new_table(spark):
    old, new = spark.range(3), spark.range(2)
    assert not sinks.switch_version(spark, "current_rows", old, new, "v2").first().switched
    assert spark.table("current_rows").count() == 3
    assert sinks.switch_version(spark, "current_rows", old, spark.range(4), "v2").first().switched
    assert spark.table("current_rows").count() == 4


def test_counters_are_restored_without_a_sort_of_the_records(spark):
    """The buffer holds numbers, so records are hashed; a struct in it made Spark sort all of them by key."""
    log = spark.createDataFrame([("a", 0, bytearray(8))], "key string, offset long, value8 binary")
    plan = words.restore_state(log)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHash" not in plan


def test_word_changelog_has_few_totals(spark):
    """A rare word costs a total for each of its chunks, so chunks are large: ten thousand documents are one."""
    docs = spark.createDataFrame([(0, i, "rare") for i in range(0, 10000, 500)], "partition int, offset long, text string")
    plan = words.word_changelog(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate") == 2  # the texts are split for the totals and for the rows, not for a level above
    assert sorted(r.n for r in words.word_changelog(docs).collect()) == list(range(1, 21))
