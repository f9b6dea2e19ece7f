"""Saga timelines, conformance and orchestration."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .running import PLACES, running

# Terminal events of the choreography.
TERMINAL = ["shipment.scheduled", "payment.failed", "payment.refunded"]

# The events that may trigger each event.
TRIGGERS = {
    "payment.completed": ["order.requested"],
    "payment.failed": ["order.requested"],
    "inventory.reserved": ["payment.completed"],
    "inventory.failed": ["payment.completed"],
    "shipment.scheduled": ["inventory.reserved"],
    "shipment.failed": ["inventory.reserved"],
    "inventory.released": ["shipment.failed"],
    "payment.refunded": ["inventory.failed", "inventory.released"],
}
# Failures and the compensation each asks for.
COMPENSATIONS = {
    "inventory.failed": "payment.refunded",
    "shipment.failed": "inventory.released",
    "inventory.released": "payment.refunded",
}
EVENTS = ["order.requested", *TRIGGERS]

# Effect of an orchestrated message (kind, action, ok):
# step, status, last event and the next command.
EFFECTS = {
    ("place-order", "PLACE", True): ("AWAITING_PAYMENT", "RUNNING", "place-order", "payment:AUTHORIZE"),
    ("payment-reply", "AUTHORIZE", True): ("AWAITING_INVENTORY", "RUNNING", "payment.authorized", "inventory:RESERVE"),
    ("payment-reply", "AUTHORIZE", False): ("DONE", "FAILED", "payment.failed", None),
    ("payment-reply", "REFUND", True): ("DONE", "FAILED", "payment.refunded", None),
    ("payment-reply", "REFUND", False): ("DONE", "FAILED", "payment.refunded", None),
    ("inventory-reply", "RESERVE", True): ("AWAITING_SHIPMENT", "RUNNING", "inventory.reserved", "shipment:SCHEDULE"),
    ("inventory-reply", "RESERVE", False): ("COMPENSATING_PAYMENT", "RUNNING", "inventory.failed", "payment:REFUND"),
    ("inventory-reply", "RELEASE", True): ("COMPENSATING_PAYMENT", "RUNNING", "inventory.released", "payment:REFUND"),
    ("inventory-reply", "RELEASE", False): ("COMPENSATING_PAYMENT", "RUNNING", "inventory.released", "payment:REFUND"),
    ("shipment-reply", "SCHEDULE", True): ("DONE", "SUCCESS", "shipment.scheduled", None),
    ("shipment-reply", "SCHEDULE", False): ("COMPENSATING_INVENTORY", "RUNNING", "shipment.failed", "inventory:RELEASE"),
}
# How a failed reply words the failure reason.
FAILURE_PREFIX = {
    ("payment-reply", "AUTHORIZE"): "",
    ("payment-reply", "REFUND"): "refund-failed: ",
    ("inventory-reply", "RESERVE"): "inventory-failed: ",
    ("shipment-reply", "SCHEDULE"): "shipment-failed: ",
}
ID_OF = {"payment_id": "AUTHORIZE", "reservation_id": "RESERVE", "shipment_id": "SCHEDULE"}


# Events per row of a timeline; a longer saga takes several rows.
PART_BITS = 10


def saga_timeline(events: DataFrame) -> DataFrame:
    """Ordered chain in parts of up to 1024 positions, with last event, number of events and terminal flag per saga.

    The figures are those of the whole saga on each of its rows. They come from the totals of the parts, so no cell grows
    without bound and no list is needed for them; nearly all sagas have the part 0 only.
    """
    chain = F.array_sort(F.collect_list(F.struct("seq", "event")))
    parts = events.groupBy("saga_id", F.shiftright("seq", PART_BITS).alias("part")).agg(
        F.array_join(F.transform(chain, lambda e: e["event"]), " → ").alias("chain"),
        F.max(F.struct("seq", "event")).alias("__last"),
        F.count("*").alias("__events"),
    )
    saga = Window.partitionBy("saga_id")
    out = parts.select(
        "saga_id",
        "part",
        "chain",
        F.max("__last").over(saga)["event"].alias("last_event"),
        F.sum("__events").over(saga).alias("events"),
    )
    return out.withColumn("terminal", F.col("last_event").isin(TERMINAL))


def open_sagas(events: DataFrame) -> DataFrame:
    """Sagas without a terminal event."""
    ended = events.filter(F.col("event").isin(TERMINAL)).select("saga_id")
    return events.groupBy("saga_id").agg(F.count("*").alias("events")).join(ended, "saga_id", "left_anti")


STEPS = [f"{before}>{event}" for event, triggers in TRIGGERS.items() for before in triggers]


def _breaks(before: Column, event: Column) -> Column:
    """True for an event that may not follow the one right before it; a null stands for none."""
    step = F.concat(F.coalesce(before, F.lit("")), F.lit(">"), event)
    return (event != "order.requested") & ~step.isin(STEPS)


def _verdict(seen: Callable[[str], Column], violations: Column) -> list[Column]:
    missing = F.lit(0)
    for event, answer in COMPENSATIONS.items():
        missing = missing + (seen(event) & ~seen(answer)).cast("int")
    outcome = (
        F.when(seen("shipment.scheduled"), "success")
        .when(seen("payment.failed") | seen("payment.refunded"), "failed")
        .otherwise("open")
    )
    return [violations.cast("long").alias("violations"), missing.cast("long").alias("missing_compensations"), outcome.alias("outcome")]


def saga_conformance(events: DataFrame) -> DataFrame:
    """Violations, missing compensations and outcome per saga.

    Every event is checked against the one right before it by ``seq``, repeats included. The sort of a saga spills, and
    what is kept of it is a fixed set of figures.
    """
    known = [*COMPENSATIONS, *COMPENSATIONS.values(), "shipment.scheduled", "payment.failed", "payment.refunded"]
    before = F.lag("event").over(Window.partitionBy("saga_id").orderBy("seq", "event"))
    checked = events.select("saga_id", "event", before.alias("before"))
    per_saga = checked.groupBy("saga_id").agg(
        F.count_if(_breaks(F.col("before"), F.col("event"))).alias("violations"),
        *[F.coalesce(F.bool_or(F.col("event") == e), F.lit(False)).alias(e) for e in dict.fromkeys(known)],
    )
    return per_saga.select("saga_id", *_verdict(lambda e: F.col(f"`{e}`"), F.col("violations")))


def saga_conformance_running(events: DataFrame) -> DataFrame:
    """The same for a stream: the events of a saga are its state, in order; a saga has a few dozen at most."""
    per_saga = events.groupBy("saga_id").agg(F.array_sort(F.collect_list(F.struct("seq", "event"))).alias("chain"))
    names = per_saga.select("saga_id", F.transform("chain", lambda e: e["event"]).alias("es"))
    shifted = F.slice(F.concat(F.array(F.lit("")), F.col("es")), 1, F.size("es"))
    broken = F.size(F.filter(F.zip_with(shifted, F.col("es"), _breaks), lambda b: b))
    return names.select("saga_id", *_verdict(lambda e: F.array_contains("es", e), broken))


def _effect(position: int) -> Column:
    out = None
    for (kind, action, ok), effect in EFFECTS.items():
        hit = (F.col("kind") == kind) & (F.col("action") == action) & (F.col("ok") == F.lit(ok))
        value = F.lit(effect[position]).cast("string")
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out


def _failure() -> Column:
    out = None
    for (kind, action), prefix in FAILURE_PREFIX.items():
        hit = (F.col("kind") == kind) & (F.col("action") == action) & ~F.col("ok")
        value = F.concat(F.lit(prefix), F.col("reason"))
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out


def saga_orchestrator(messages: DataFrame) -> DataFrame:
    """State of every saga after all messages and the commands it sent.

    The first place-order opens a saga; replies without one are skipped. Steps
    are not guarded, so the last message decides step and status; an id or
    reason stays until a later message brings another one.
    """
    opening = F.col("kind") == "place-order"
    # How many place-orders came so far, counted in chunks so that a long saga stays spread.
    counted = running(messages, ["saga_id"], ["seq"], {"placed": ("sum", opening.cast("long"))}, span=PLACES)
    acted = (
        counted.filter((opening & (F.col("placed") == 1)) | (~opening & (F.col("placed") > 0)))
        .select(
            "saga_id", "seq", "kind", "action", "ok", "id", "customer_id", "amount_cents",
            _effect(0).alias("step"), _effect(1).alias("status"), _effect(2).alias("event"), _effect(3).alias("command"),
            _failure().alias("failure"),
        )
        .filter("step IS NOT NULL")
    )

    def last(value: Column, condition: Column) -> Column:
        return F.max_by(value, F.when(condition, F.col("seq")))

    ids = [
        last(F.col("id"), F.col("ok") & (F.col("action") == action)).alias(name) for name, action in ID_OF.items()
    ]
    refunded = F.max((F.col("action") == "REFUND") & F.col("ok"))
    return acted.groupBy("saga_id").agg(
        F.min_by("customer_id", "seq").alias("customer_id"),
        F.min_by("amount_cents", "seq").alias("amount_cents"),
        F.max_by("step", "seq").alias("step"),
        F.max_by("status", "seq").alias("status"),
        F.max_by("event", "seq").alias("last_event"),
        *ids,
        F.coalesce(
            last(F.col("failure"), F.col("failure").isNotNull()), F.when(refunded, F.lit(""))
        ).alias("failure_reason"),
        F.count("command").alias("commands"),
        F.max_by("command", F.when(F.col("command").isNotNull(), F.col("seq"))).alias("last_command"),
    )


def saga_orchestrator_running(messages: DataFrame) -> DataFrame:
    """The same for a stream: one row of aggregates per saga is its state, so nothing leaves the JVM.

    Messages count in the order of ``seq``, also over batches: a reply from before the first place-order is skipped
    whichever of them arrives first. What has a last value is kept with its ``seq`` and compared with the opening's when
    the row is read. Of commands the ``seq`` is kept, as their number depends on it.
    """
    opening = F.col("kind") == "place-order"
    known = messages.withColumn("ok", F.coalesce("ok", F.lit(False))).select(
        "saga_id", "seq", "action", "ok", "id", "customer_id", "amount_cents", opening.alias("opening"),
        _effect(0).alias("step"), _effect(1).alias("status"), _effect(2).alias("event"), _effect(3).alias("command"),
        _failure().alias("failure"),
    ).filter("step IS NOT NULL")
    reply = ~F.col("opening")

    def last(condition: Column, *values: str) -> Column:
        return F.max(F.when(reply & condition, F.struct("seq", *values)))

    effect = ["step", "status", "event"]
    state = known.groupBy("saga_id").agg(
        F.min(F.when(F.col("opening"), F.struct("seq", "customer_id", "amount_cents", "command", *effect))).alias("opened"),
        last(F.lit(True), *effect).alias("replied"),
        *[last(F.col("ok") & (F.col("action") == action), "id").alias(name) for name, action in ID_OF.items()],
        last(F.col("failure").isNotNull(), "failure").alias("failed"),
        last(F.col("ok") & (F.col("action") == "REFUND")).alias("refunded"),
        last(F.col("command").isNotNull(), "command").alias("sent"),
        F.collect_list(F.when(reply & F.col("command").isNotNull(), F.col("seq"))).alias("sent_at"),
    )

    def after(column: str, value: str | Column) -> Column:
        return F.when(F.col(f"{column}.seq") >= F.col("opened.seq"), F.col(f"{column}.{value}") if isinstance(value, str) else value)

    sent = F.size(F.filter("sent_at", lambda at: at >= F.col("opened.seq")))
    return state.filter("opened IS NOT NULL").select(
        "saga_id",
        "opened.customer_id",
        "opened.amount_cents",
        *[F.coalesce(after("replied", e), F.col(f"opened.{e}")).alias("last_event" if e == "event" else e) for e in effect],
        *[after(name, "id").alias(name) for name in ID_OF],
        F.coalesce(after("failed", "failure"), after("refunded", F.lit(""))).alias("failure_reason"),
        (sent + 1).cast("long").alias("commands"),
        F.coalesce(after("sent", "command"), F.col("opened.command")).alias("last_command"),
    )


def request_payment_pairs(requested: DataFrame, paid: DataFrame, minutes: int) -> DataFrame:
    """Pair requests and payments of one saga within a time interval; two tables or two streams."""
    left = requested.select(F.col("saga_id").alias("l_saga"), F.col("ts").alias("requested_at"))
    right = paid.select(F.col("saga_id").alias("r_saga"), F.col("ts").alias("paid_at"))
    if requested.isStreaming:
        left = left.withWatermark("requested_at", f"{minutes} minutes")
        right = right.withWatermark("paid_at", f"{minutes} minutes")
    on = F.expr(
        f"l_saga = r_saga AND paid_at >= requested_at AND paid_at <= requested_at + interval {minutes} minutes"
    )
    return left.join(right, on).select(F.col("l_saga").alias("saga_id"), "requested_at", "paid_at")
