"""Counts per time window, late rows, moving windows, rates and order statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.binary import decode_event_time
from .running import running


def with_event_time(events: DataFrame, header: str = "event_time_header", arrival: str = "arrival_ts") -> DataFrame:
    """Event time from the header; a missing or malformed header means arrival time."""
    decoded = decode_event_time(header)
    return events.withColumn("event_time", F.coalesce(decoded, F.col(arrival))).withColumn(
        "no_header", decoded.isNull()
    )


def event_time_counts(events: DataFrame, size: str) -> DataFrame:
    """Tumbling counts by event time with the late and header-less rows among them."""
    return (
        with_event_time(events)
        .groupBy(F.window("event_time", size).alias("w"))
        .agg(F.count("*").alias("n"), F.count_if("late").alias("late"), F.count_if("no_header").alias("missing"))
        .select(F.col("w.start").alias("window_start"), "n", "late", "missing")
    )


def processing_time_counts(events: DataFrame, size: str) -> DataFrame:
    """Tumbling counts by arrival time."""
    return (
        events.groupBy(F.window("arrival_ts", size).alias("w"))
        .agg(F.count("*").alias("n"))
        .select(F.col("w.start").alias("window_start"), "n")
    )


def last_n_windows(counts: DataFrame, n: int, start: str = "window_start") -> DataFrame:
    """Latest n windows in ascending order; 0 keeps all."""
    return (counts.orderBy(F.desc(start)).limit(n) if n > 0 else counts).orderBy(start)


def window_diff(event_counts: DataFrame, processing_counts: DataFrame, last_n: int = 0) -> DataFrame:
    """Event-time and arrival-time counts side by side.

    Each side is cut to its own last windows before the join, so a window cut
    on one side only shows 0 there.
    """

    def side(counts: DataFrame, name: str) -> DataFrame:
        cut = counts.orderBy(F.desc("window_start")).limit(last_n) if last_n > 0 else counts
        return cut.select("window_start", F.col("n").alias(name))

    both = side(event_counts, "event_n").join(side(processing_counts, "processing_n"), "window_start", "full")
    event, processing = F.coalesce("event_n", F.lit(0)), F.coalesce("processing_n", F.lit(0))
    return both.select(
        "window_start", event.alias("event_n"), processing.alias("processing_n"), (event - processing).alias("diff")
    )


def window_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """Window starts of either side, sorted."""
    return a.select("window_start").union(b.select("window_start")).distinct().orderBy("window_start")


def watermarked_counts(events: DataFrame, size: str, tolerance: str, time: str = "event_ts") -> DataFrame:
    """Counts of windows that are final: their end lies at or before the highest event time less the tolerance.

    On a stream the watermark does this; on a table the same cut is a filter.
    """
    window = F.window(time, size).alias("w")
    if events.isStreaming:
        counts = events.withWatermark(time, tolerance).groupBy(window).agg(F.count("*").alias("n"))
    else:
        mark = events.agg(F.max(time).alias("m")).select(F.expr(f"m - interval {tolerance}")).scalar()
        counts = events.groupBy(window).agg(F.count("*").alias("n")).filter(F.col("w.end") <= mark)
    return counts.select(F.col("w.start").alias("window_start"), "n")


def hopping_counts(events: DataFrame, size: str, step: str, time: str = "event_ts") -> DataFrame:
    """Counts of overlapping windows."""
    return (
        events.groupBy(F.window(time, size, step).alias("w"))
        .agg(F.count("*").alias("n"))
        .select(F.col("w.start").alias("window_start"), "n")
    )


def session_counts(events: DataFrame, gap: str, tolerance: str, time: str = "event_ts") -> DataFrame:
    """Closed activity windows per user: sessions whose end the watermark has passed."""
    session = F.session_window(time, gap).alias("w")
    if events.isStreaming:
        events = events.withWatermark(time, tolerance)
    sessions = events.groupBy("user_id", session).agg(F.count("*").alias("n"), F.max(time).alias("last"))
    if not events.isStreaming:
        # The cut uses the last event, not w.end: a filter on the grouping column
        # would be pushed below the merge and split sessions.
        mark = events.agg(F.max(time).alias("m")).select(F.expr(f"m - interval {tolerance}")).scalar()
        sessions = sessions.filter(F.expr(f"last + interval {gap}") <= mark)
    return sessions.select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def late_split(events: DataFrame, size_s: int, tolerance_s: int, policy: str = "mark") -> DataFrame:
    """Mark rows whose window was final when they arrived.

    A row is late when its window ends at or before the highest event time of
    the earlier arrivals of its partition less the tolerance. ``drop`` keeps the
    others, ``side`` only the late ones, ``mark`` all with the flag.
    """
    if policy not in ("mark", "drop", "side"):
        raise ValueError(f"unknown policy {policy!r}")
    micros = F.unix_micros("event_ts")
    timed = events.withColumn("us", micros)
    seen = running(timed, ["part"], ["event_id"], {"seen_us": ("max", F.col("us"))}, exclusive=True)
    size = size_s * 1_000_000
    window_start = F.col("us") - F.pmod("us", F.lit(size))
    late = F.coalesce(window_start + size <= F.col("seen_us") - tolerance_s * 1_000_000, F.lit(False))
    out = seen.select(
        *events.columns, F.timestamp_micros(window_start).alias("window_start"), late.alias("arrived_late")
    )
    if policy == "mark":
        return out
    return out.filter("arrived_late" if policy == "side" else "NOT arrived_late")


def moving_window(
    events: DataFrame, size_s: int, group: str, time: str, value: str, bits: int = 28
) -> DataFrame:
    """Count and sum over the ``size_s`` seconds up to and including each row.

    The window of a row is what has come up to its time less what had come
    before the window opened. Both are read off one running sum over the
    distinct times and the opening times, cut into chunks of time (2**28
    microseconds are about four minutes), so neither a busy group nor a long window
    meets in one task.
    """
    timed = events.withColumn("__t", F.unix_micros(time))
    per_time = timed.groupBy(group, "__t").agg(F.count("*").alias("n"), F.sum(value).alias("v"))
    zero = F.lit(0).cast("long")
    ends = per_time.select(group, "__t", F.col("__t").alias("at"), F.lit(0).alias("opens"), "n", "v")
    opens = per_time.select(
        group, "__t", (F.col("__t") - size_s * 1_000_000 - 1).alias("at"), F.lit(1).alias("opens"),
        zero.alias("n"), zero.alias("v"),
    )
    sums = {"upto_n": ("sum", F.col("n")), "upto_v": ("sum", F.col("v"))}
    read = running(ends.unionByName(opens), [group], ["at", "opens"], sums, bits=bits)
    sign = F.when(F.col("opens") == 1, F.lit(-1)).otherwise(F.lit(1))
    result = read.groupBy(group, "__t").agg(
        F.sum(sign * F.col("upto_n")).alias("n"), F.sum(sign * F.col("upto_v")).alias("total")
    )
    return timed.join(result, [group, "__t"], "left").select(*events.columns, "n", "total")


def rate_table(events: DataFrame, every: str, produced: str, consumed: str) -> DataFrame:
    """Produced and consumed per tick with the running lag.

    The running sum is taken over ticks, whose number grows with time and not with rows.
    """

    def ticks(column: str, name: str) -> DataFrame:
        counts = events.groupBy(F.window(column, every).alias("w")).agg(F.count("*").alias(name))
        return counts.select(F.col("w.start").alias("tick"), name)

    both = ticks(produced, "produced").join(ticks(consumed, "consumed"), "tick", "full")
    p, c = F.coalesce("produced", F.lit(0)), F.coalesce("consumed", F.lit(0))
    total = Window.orderBy("tick").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return both.select("tick", p.alias("produced"), c.alias("consumed")).withColumn(
        "lag", F.sum(F.col("produced") - F.col("consumed")).over(total)
    )


def counter_rate(
    metrics: DataFrame, span_s: int, group: str = "topic", counter: str = "high_water", bits: int = 28
) -> DataFrame:
    """Per-second increase of a monotone counter over a trailing span; a fall means a restart from zero.

    Samples are one row per topic and sampling time. The sample before a row is the latest of the earlier ones, a
    running maximum that chunks of time carry into the next; the span is a moving window over the steps. A topic with
    any number of samples is spread over its chunks of 2**bits microseconds.
    """
    timed = metrics.withColumn("__us", F.unix_micros("ts"))
    latest = {"__last": ("max", F.struct("__us", counter))}
    carried = running(timed, [group], ["__us"], latest, bits=bits, exclusive=True)
    before = F.col(f"__last.{counter}")
    step = (
        F.when(before.isNull(), F.lit(0))
        .when(F.col(counter) < before, F.col(counter))
        .otherwise(F.col(counter) - before)
    )
    # The span counts whole seconds, the row's own included.
    second = F.timestamp_seconds(F.unix_timestamp("ts"))
    stepped = carried.select("ts", group, step.alias("step"), second.alias("__second"))
    summed = moving_window(stepped, span_s - 1, group, "__second", "step", bits=bits)
    return summed.select("ts", group, F.round(F.col("total") / span_s, 6).alias("rate"))


def index_percentiles(
    df: DataFrame, group: list[str], value: str, points: dict[str, float], bits: int = 10
) -> DataFrame:
    """Exact order statistics at index ``floor((n - 1) * p)`` per group.

    Values are counted first, then ranks run over the distinct values in
    chunks, so neither a large group nor a wide value range meets in one task.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("n"))
    specs = {"upto": ("sum", F.col("n")), "total": ("total", F.col("n"))}
    placed = running(counts, group, [value], specs, bits=bits)
    picks = []
    for name, p in points.items():
        index = F.floor((F.col("total") - 1) * F.lit(p))
        hit = (F.col("upto") > index) & (F.col("upto") - F.col("n") <= index)
        picks.append(F.max(F.when(hit, F.col(value))).alias(name))
    return placed.groupBy(*group).agg(*picks)


def seconds_between(first: Column, last: Column) -> Column:
    return (F.unix_micros(last) - F.unix_micros(first)) / 1_000_000
