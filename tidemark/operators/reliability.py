"""Handlers, staged retries, dead letters, replay and delivery outcomes."""

from __future__ import annotations

from collections.abc import Callable
from inspect import signature
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.binding import bound, with_once
from ..functions.headers import header, put_headers
from ..functions.names import backoff, record_coord
from ..schema import PAYMENT
from .joins import first_per_key
from .records import CHANNEL_TOPICS, classify_http, lookup
from .running import PLACES, running


class Stage(NamedTuple):
    """One step of a retry chain; an empty ``next_topic`` marks the last one."""

    topic: str
    delay_s: int
    next_topic: str


# The payment chain, whose last stage names the dead-letter topic as its next one,
# and the notification chain, whose last stage names none.
DLQ_TOPIC = "payments-dlq"
PAYMENT_STAGES = [
    Stage("payments", 0, "payments-retry-30s"),
    Stage("payments-retry-30s", 30, "payments-retry-5m"),
    Stage("payments-retry-5m", 300, "payments-retry-1h"),
    Stage("payments-retry-1h", 3600, DLQ_TOPIC),
]
NOTIFY_STAGES = [
    Stage("payments", 0, "payments-retry-30s"),
    Stage("payments-retry-30s", 30, "payments-retry-5m"),
    Stage("payments-retry-5m", 300, ""),
]
# Fixed value: a transient record succeeds at the third handler call.
TRANSIENT_CALLS = 3

ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def classify_payment(value: str | Column = "value") -> Column:
    """Struct of ``cls`` (ok, transient, permanent) and ``message`` for a payment text."""
    column = F.col(value) if isinstance(value, str) else value
    parsed = F.from_json(column, PAYMENT, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})

    def judge(p: Column) -> Column:
        bad = p["_corrupt"].isNotNull() | p.isNull()
        mode, ident = p["mode"], F.coalesce(p["id"], F.lit(""))
        cls = (
            F.when(bad, "permanent")
            .when(mode == "ok", "ok")
            .when(mode == "transient", "transient")
            .otherwise("permanent")
        )
        message = (
            F.when(bad, "invalid json")
            .when(mode == "ok", F.lit(None))
            .when(mode == "transient", F.concat(F.lit('payment not settled for now, id="'), ident, F.lit('"')))
            .when(mode == "permanent", F.concat(F.lit('payment refused for good, id="'), ident, F.lit('"')))
            .otherwise(F.concat(F.lit('no such mode: "'), F.coalesce(mode, F.lit("")), F.lit('"')))
        )
        return F.struct(cls.alias("cls"), message.alias("message"))

    return bound(parsed, judge)


# A handler takes the value column, or the value and the number of earlier retries, and gives a struct of cls and message.
Handler = Callable[..., Column]
HANDLERS: dict[str, Handler] = {"payment": classify_payment}


def register_handler(name: str, fn: Handler) -> None:
    """Add a handler; a column expression, or a pandas UDF returning the same struct."""
    HANDLERS[name] = fn


def called(handler: str | Handler) -> Column:
    """One call of a handler, given by name or itself, on the columns of a record."""
    fn = HANDLERS[handler] if isinstance(handler, str) else handler
    return fn(F.col("value"), _retries()) if len(signature(fn).parameters) > 1 else fn(F.col("value"))


def handled(df: DataFrame, handler: str | Handler = "payment") -> DataFrame:
    """Add ``cls`` and ``message`` by the handler."""
    return with_once(df, "__h", called(handler)).select(
        *df.columns, F.col("__h.cls").alias("cls"), F.col("__h.message").alias("message")
    )


def _next_hop(stages: list[Stage], dlq: str, topic: Column) -> tuple[Column, Column]:
    """Target topic and reason of a failed record by its current topic."""
    permanent = F.col("cls") == "permanent"
    follow = lookup(topic, {s.topic: s.next_topic for s in stages}, F.lit(""))
    target = F.when(permanent | (follow == ""), F.lit(dlq)).otherwise(follow)
    reason = F.when(permanent, "permanent").when(follow == "", "exhausted").otherwise("next-retry")
    return target, reason


def _failure_headers(previous: Column, retries: Column, at: Column, coordinates: bool) -> dict[str, Column]:
    """Headers of a failed record; the origin is written once."""
    origin = header("headers", "original.topic")
    updates = {"original.topic": F.coalesce(origin, F.col("source_topic"))}
    if coordinates:
        for name in ("partition", "offset"):
            kept = header("headers", f"original.{name}")
            updates[f"original.{name}"] = F.when(origin.isNull(), F.col(name).cast("string")).otherwise(kept)
    return updates | {
        "previous.topic": previous,
        "retry.count": retries,
        "error.class": F.col("cls"),
        "error.message": F.col("message"),
        "error.timestamp": F.date_format(at, ISO),
    }


def _retries() -> Column:
    return F.coalesce(header("headers", "retry.count").try_cast("int"), F.lit(0))


def escalate_once(
    failed: DataFrame, stages: list[Stage], dlq: str, at: Column, *, coordinates: bool = True
) -> DataFrame:
    """One hop after a failure: ``target``, ``reason`` and the new headers.

    ``at`` is the time of the failure. With ``coordinates`` the original
    partition and offset are kept too, without them the reason travels as a header.
    """
    target, reason = _next_hop(stages, dlq, F.col("topic"))
    out = failed.withColumn("target", target).withColumn("reason", reason).withColumn("source_topic", F.col("topic"))
    updates = _failure_headers(F.col("topic"), _retries() + 1, at, coordinates)
    if not coordinates:
        updates["forward.reason"] = F.col("reason")
    return out.withColumn("headers", put_headers("headers", updates)).drop("source_topic")


def due_records(df: DataFrame, stages: list[Stage], now: Column) -> DataFrame:
    """Due time by stage delay, eligibility at ``now`` and the remaining wait."""
    delay = F.lit(0)
    for s in stages:
        delay = F.when(F.col("topic") == s.topic, F.lit(s.delay_s)).otherwise(delay)
    due = F.timestamp_seconds(F.unix_timestamp("timestamp") + delay)
    return df.withColumn("due", due).withColumn("eligible", F.col("due") <= now).withColumn(
        "wait_s", F.greatest(F.unix_timestamp("due") - F.unix_timestamp(now), F.lit(0))
    )


def _chain_end(stages: list[Stage], start: Stage) -> tuple[int, str, int]:
    """Hops, last stage topic and total delay of a record that fails at every stage from ``start`` on."""
    by_topic = {s.topic: s for s in stages}
    stage, hops, delay = start, 1, start.delay_s
    while stage.next_topic in by_topic:
        stage = by_topic[stage.next_topic]
        hops, delay = hops + 1, delay + stage.delay_s
    return hops, stage.topic, delay


def retry_pipeline(df: DataFrame, stages: list[Stage], dlq: str, handler: str = "payment") -> DataFrame:
    """Carry every record through the chain until it is ok or in the dead-letter topic.

    A handler decides by the value, so a record that fails once fails at every
    later stage. The way to the end of the chain is known per stage when the
    plan is built, and one projection writes the headers of the last hop.
    ``final_topic`` is the dead-letter topic or the topic that handled the
    record, ``outcome`` ok or dlq, ``at`` the time of the last failure.
    """
    ends = {s.topic: _chain_end(stages, s) for s in stages}
    permanent = F.col("cls") == "permanent"

    def by_stage(values: dict[str, object], default: Column) -> Column:
        return lookup(F.col("topic"), values, default)

    hops = F.when(permanent, F.lit(1)).otherwise(by_stage({t: e[0] for t, e in ends.items()}, F.lit(1)))
    previous = F.when(permanent, F.col("topic")).otherwise(by_stage({t: e[1] for t, e in ends.items()}, F.col("topic")))
    first_delay = by_stage({s.topic: s.delay_s for s in stages}, F.lit(0))
    delay = F.when(permanent, first_delay).otherwise(by_stage({t: e[2] for t, e in ends.items()}, F.lit(0)))
    cur = handled(df, handler)
    failing = F.col("cls") != "ok"
    at = F.when(failing, F.timestamp_seconds(F.unix_timestamp("timestamp") + delay)).otherwise(F.col("timestamp"))
    cur = cur.withColumn("source_topic", F.col("topic")).withColumn("at", at)
    headers = put_headers("headers", _failure_headers(previous, _retries() + hops, F.col("at"), True))
    return cur.select(
        *[c for c in df.columns if c not in ("topic", "headers")],
        "source_topic",
        F.when(failing, F.lit(dlq)).otherwise(F.col("topic")).alias("final_topic"),
        F.when(failing, "dlq").otherwise("ok").alias("outcome"),
        F.when(failing, headers).otherwise(F.col("headers")).alias("headers"),
        "cls",
        "message",
        "at",
    )


def _stage_time(stages: list[Stage], failing: Column) -> Column:
    """When a record that arrived ``at`` a stage topic is handled; failures are stamped in whole seconds."""
    delay = lookup(F.col("topic"), {s.topic: s.delay_s for s in stages}, F.lit(0))
    return F.when(failing | (delay > 0), F.timestamp_seconds(F.unix_timestamp("at") + delay)).otherwise(F.col("at"))


def handle_stage(
    arrived: DataFrame, stages: list[Stage], dlq: str, handler: str | Handler = "payment"
) -> DataFrame:
    """One call of the handler for records whose ``at`` is their arrival on a stage topic.

    Adds ``cls``, ``message``, ``outcome`` (ok, retry or dlq) and ``target``, the topic a failed record goes to. ``at``
    becomes the time of the call; headers change on failure only.
    """
    cur = handled(arrived, handler)
    failing = F.col("cls") != "ok"
    target, _reason = _next_hop(stages, dlq, F.col("topic"))
    cur = cur.withColumn("at", _stage_time(stages, failing)).withColumn("source_topic", F.col("topic"))
    headers = put_headers("headers", _failure_headers(F.col("topic"), _retries() + 1, F.col("at"), True))
    return cur.select(
        *[c for c in arrived.columns if c not in ("headers", "at")],
        F.when(failing, headers).otherwise(F.col("headers")).alias("headers"),
        "at", "cls", "message",
        F.when(~failing, "ok").when(target == dlq, "dlq").otherwise("retry").alias("outcome"),
        F.when(failing, target).alias("target"),
    )


def staged_retry(df: DataFrame, stages: list[Stage], dlq: str, handler: str | Handler = "payment") -> DataFrame:
    """:func:`retry_pipeline` for a handler that looks at the number of earlier retries.

    Every stage calls the handler again for the records still open; stages are few, so they are unrolled into
    projections and nothing is shuffled. Rows as in :func:`retry_pipeline`; a record that succeeds on a later stage
    has that stage's topic and the time of that call.
    """
    own = [c for c in df.columns if c not in ("topic", "headers")]
    cur = df.select("*", F.col("topic").alias("source_topic"), F.col("timestamp").alias("at"), F.lit("retry").alias("outcome"),
                    F.lit(None).cast("string").alias("cls"), F.lit(None).cast("string").alias("message"))
    for _ in stages:
        open_ = F.col("outcome") == "retry"
        cur = with_once(cur, "__h", F.when(open_, called(handler)))
        failing = F.col("__h.cls") != "ok"
        judged = cur.withColumns({
            "__entry": F.col("source_topic"), "source_topic": F.col("topic"),
            "cls": F.when(open_, F.col("__h.cls")).otherwise(F.col("cls")),
            "message": F.when(open_, F.col("__h.message")).otherwise(F.col("message"))})
        judged = judged.withColumn("at", F.when(open_, _stage_time(stages, failing)).otherwise(F.col("at")))
        target, _reason = _next_hop(stages, dlq, F.col("topic"))
        headers = put_headers("headers", _failure_headers(F.col("topic"), _retries() + 1, F.col("at"), True))
        judged = judged.withColumn("__target", F.when(open_ & failing, target).otherwise(F.col("topic")))
        cur = judged.select(
            *own,
            F.col("__target").alias("topic"),
            F.when(open_ & failing, headers).otherwise(F.col("headers")).alias("headers"),
            F.col("__entry").alias("source_topic"),
            "at",
            F.when(~open_, F.col("outcome")).when(~failing, "ok").when(F.col("__target") == dlq, "dlq").otherwise("retry").alias("outcome"),
            "cls", "message")
    return cur.select(*own, "source_topic", F.col("topic").alias("final_topic"), "outcome", "headers", "cls", "message", "at")


def dead_letters(done: DataFrame, dlq: str) -> DataFrame:
    """Dead-letter log of a finished pipeline, stamped one day after the source record."""
    return done.filter("outcome = 'dlq'").select(
        F.lit(dlq).alias("topic"),
        "partition",
        "offset",
        "key",
        "value",
        "headers",
        (F.col("timestamp") + F.expr("interval 1 day")).alias("timestamp"),
    )


def in_place_retry(df: DataFrame, max_retries: int, base_ms: int, handler: str = "payment") -> DataFrame:
    """Outcome of retrying a record in place: ok, dlq permanent or dlq exhausted.

    Retries, recorded handler attempts and total backoff follow from the class
    alone, so nothing loops.
    """
    needed = TRANSIENT_CALLS - 1
    transient = F.col("cls") == "transient"
    enough = max_retries >= needed
    outcome = (
        F.when(F.col("cls") == "permanent", "dlq permanent")
        .when(transient & F.lit(not enough), "dlq exhausted")
        .otherwise("ok")
    )
    retried = F.when(transient, F.lit(min(needed, max_retries))).otherwise(F.lit(0))
    attempts = F.when(transient, F.lit(min(needed, max_retries) + 1)).otherwise(F.lit(0))
    waited = F.aggregate(
        F.when(F.col("retried") > 0, F.sequence(F.lit(1), F.col("retried"))).otherwise(F.array().cast("array<int>")),
        F.lit(0).cast("long"),
        lambda total, n: total + backoff(n, base_ms),
    )
    return (
        handled(df, handler)
        .withColumn("outcome", outcome)
        .withColumn("retried", retried)
        .withColumn("attempts", attempts)
        .withColumn("backoff_ms", waited)
    )


def retry_outcome_counts(done: DataFrame) -> DataFrame:
    """Counters of :func:`in_place_retry`."""
    return done.agg(
        F.count("*").alias("processed"),
        F.count_if(F.col("outcome") == "ok").alias("ok"),
        F.sum("retried").cast("long").alias("retried"),
        F.count_if(F.col("outcome") == "dlq permanent").alias("dlq_permanent"),
        F.count_if(F.col("outcome") == "dlq exhausted").alias("dlq_exhausted"),
    )


def escalation_counts(hops: DataFrame, dlq: str) -> DataFrame:
    """Records forwarded to the next stage and to the dead-letter topic by one hop."""
    return hops.agg(
        F.count_if(F.col("target") != dlq).alias("escalated"), F.count_if(F.col("target") == dlq).alias("dead_lettered")
    )


def replay_match(cutoff: Column, error_class: str | None) -> Column:
    """Dead letters to replay: not strictly older than the cutoff and of the class, if one is given."""
    fresh = F.col("timestamp") >= cutoff
    if not error_class:
        return fresh
    return fresh & F.coalesce(header("headers", "error.class") == error_class, F.lit(False))


def replay_select(dlq: DataFrame, to_topic: str, cutoff: Column, error_class: str | None = None) -> DataFrame:
    """Records to send again: the retry count starts at 0, the origin stays, the dead-letter coordinate is noted."""
    updates = {"retry.count": F.lit("0"), "replay.from-dlq": record_coord("topic", "partition", "offset")}
    return (
        dlq.filter(replay_match(cutoff, error_class))
        .withColumn("headers", put_headers("headers", updates))
        .withColumn("topic", F.lit(to_topic))
    )


def replay_notifications(dead: DataFrame) -> DataFrame:
    """Dead notifications under a new id on the main topic of their channel, so the dedup gate lets them pass."""
    return dead.select(
        F.concat(F.lit("replay-"), "notification_id").alias("id"),
        lookup(F.col("channel"), CHANNEL_TOPICS, F.lit(None).cast("string")).alias("topic"),
        "channel",
    )


def replay_summary(dlq: DataFrame, cutoff: Column, error_class: str | None = None, dry_run: bool = False) -> DataFrame:
    hit = replay_match(cutoff, error_class)
    sent = F.lit(0).cast("long") if dry_run else F.count_if(hit)
    return dlq.agg(
        F.count("*").alias("read"),
        F.count_if(~hit).alias("skipped"),
        F.count_if(hit).alias("matched"),
        sent.alias("replayed"),
    )


def delivery_outcomes(deliveries: DataFrame) -> DataFrame:
    """Per channel: delivered, retriable failures (escalated) and permanent ones (dead-lettered), attempts used."""
    kind = classify_http("status")
    return deliveries.withColumn("kind", kind).groupBy("channel").agg(
        F.count_if(F.col("kind") == "delivered").alias("delivered"),
        F.count_if(F.col("kind") == "retriable").alias("escalated"),
        F.count_if(F.col("kind") == "permanent").alias("dead_lettered"),
        F.sum("attempts").alias("attempts"),
    )


def failure_runs(deliveries: DataFrame, trip_after: int, permanent_fails: bool) -> DataFrame:
    """Runs of consecutive failures per channel and whether they reach the breaker limit.

    All failures after the same number of successes form one run, so a running
    count of successes names the run and an aggregation measures it.
    """
    kind = classify_http("status")
    ok = (kind == "delivered") if permanent_fails else kind.isin("delivered", "permanent")
    flagged = deliveries.select("channel", "seq", ok.cast("long").alias("ok"))
    counted = running(flagged, ["channel"], ["seq"], {"run": ("sum", F.col("ok"))}, span=PLACES)
    return (
        counted.filter("ok = 0")
        .groupBy("channel", "run")
        .agg(F.count("*").alias("length"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"))
        .drop("run")
        .withColumn("tripped", F.col("length") >= trip_after)
    )


def delivery_history(delivered: DataFrame, dead: DataFrame) -> DataFrame:
    """One row per notification and channel, the first writer wins.

    A dead letter carries its retry count (1 when absent) and error message.
    """
    columns = ["notification_id", "channel", "status", "attempts", "last_error", "seq"]
    good = delivered.withColumn("status", F.lit("delivered")).withColumn("last_error", F.lit(None).cast("string"))
    bad = dead.withColumn("status", F.lit("dlq")).withColumn("attempts", F.coalesce("attempts", F.lit(1)))
    both = good.select(*columns).unionByName(bad.select(*columns))
    return first_per_key(both, ["notification_id", "channel"], ["seq"])


def merge_topics(*parts: DataFrame) -> DataFrame:
    """One frame over several topics or stages; the topic stays a column."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
