"""Queries over event time and arrival time."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.names import timestamp_text
from ..operators import joins, windows
from .registry import query

HOUR = "1 hour"


def started(df, column="window_start"):
    return df.withColumn(column, timestamp_text(column))


EVENT_COUNTS = """SELECT date_trunc('hour', event_ts) AS w, count(*) AS n, count(*) FILTER (late) AS late,
                         count(*) FILTER (missing) AS missing FROM v_evt GROUP BY 1"""
ARRIVAL_COUNTS = "SELECT date_trunc('hour', arrival_ts) AS w, count(*) AS n FROM v_evt GROUP BY 1"
FMT = "strftime({0}, '%Y-%m-%d %H:%M:%S')"

Z01_SQL = f"SELECT {FMT.format('w')} AS window_start, n, late, missing FROM ({EVENT_COUNTS})"
Z02_SQL = f"SELECT {FMT.format('w')} AS window_start, n FROM ({ARRIVAL_COUNTS})"
Z03_SQL = f"""SELECT {FMT.format('w')} AS window_start, n FROM ({EVENT_COUNTS})
              WHERE w + INTERVAL 1 HOUR <= (SELECT max(event_ts) FROM v_evt) - INTERVAL 2 HOUR"""
Z05_SQL = f"""SELECT {FMT.format('w')} AS window_start, count(*) AS n FROM (
                 SELECT unnest([time_bucket(INTERVAL 30 MINUTE, event_ts), time_bucket(INTERVAL 30 MINUTE, event_ts) - INTERVAL 30 MINUTE]) AS w
                 FROM v_evt) GROUP BY 1"""
Z06_SQL = f"""WITH m AS (SELECT user_id, event_ts, lag(event_ts) OVER (PARTITION BY user_id ORDER BY event_ts) AS p FROM v_evt),
                   s AS (SELECT *, sum(CASE WHEN p IS NULL OR event_ts > p + INTERVAL 2 HOUR THEN 1 ELSE 0 END)
                             OVER (PARTITION BY user_id ORDER BY event_ts ROWS UNBOUNDED PRECEDING) AS sid FROM m)
              SELECT user_id, {FMT.format('min(event_ts)')} AS session_start,
                     {FMT.format('max(event_ts) + INTERVAL 2 HOUR')} AS session_end, count(*) AS n
              FROM s GROUP BY user_id, sid
              HAVING max(event_ts) + INTERVAL 2 HOUR <= (SELECT max(event_ts) FROM v_evt) - INTERVAL 1 HOUR"""


@query("z01_event_time_counts_batch", Z01_SQL)
def _(t):
    return started(windows.event_time_counts(t.evt, HOUR))


@query("z02_processing_time_counts_batch", Z02_SQL)
def _(t):
    return started(windows.processing_time_counts(t.evt, HOUR))


@query(
    "j06_window_diff",
    f"""SELECT {FMT.format('coalesce(e.w, p.w)')} AS window_start, coalesce(e.n, 0) AS event_n, coalesce(p.n, 0) AS processing_n,
               coalesce(e.n, 0) - coalesce(p.n, 0) AS diff
        FROM ({EVENT_COUNTS}) e FULL JOIN ({ARRIVAL_COUNTS}) p ON e.w = p.w""",
)
def _(t):
    counts = windows.event_time_counts(t.evt, HOUR), windows.processing_time_counts(t.evt, HOUR)
    return started(windows.window_diff(*counts))


@query("t02_last_n_windows", f"SELECT {FMT.format('w')} AS window_start, n FROM ({EVENT_COUNTS}) ORDER BY w DESC LIMIT 24")
def _(t):
    counts = windows.event_time_counts(t.evt, HOUR)
    return started(windows.last_n_windows(counts, 24)).select("window_start", "n")


@query(
    "u02_window_union",
    f"SELECT {FMT.format('w')} AS window_start FROM (SELECT w FROM ({EVENT_COUNTS}) UNION SELECT w FROM ({ARRIVAL_COUNTS}))",
)
def _(t):
    both = windows.event_time_counts(t.evt, HOUR), windows.processing_time_counts(t.evt, HOUR)
    return started(windows.window_union(*both))


@query("z03_watermarked_counts_batch", Z03_SQL)
def _(t):
    return started(windows.watermarked_counts(t.evt, HOUR, "2 hours"))


@query(
    "z04_late_split",
    f"""WITH r AS (SELECT *, max(event_ts) OVER (PARTITION BY part ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen,
                          date_trunc('hour', event_ts) AS w FROM v_evt),
             l AS (SELECT *, coalesce(w + INTERVAL 1 HOUR <= seen - INTERVAL 10 MINUTE, false) AS arrived_late FROM r)
        SELECT {FMT.format('w')} AS window_start, count(*) FILTER (NOT arrived_late) AS dropped_policy,
               count(*) FILTER (arrived_late) AS side_policy, count(*) AS update_policy FROM l GROUP BY w""",
)
def _(t):
    marked = windows.late_split(t.evt, 3600, 600)
    return started(
        marked.groupBy("window_start").agg(
            F.count_if(~F.col("arrived_late")).alias("dropped_policy"),
            F.count_if("arrived_late").alias("side_policy"),
            F.count("*").alias("update_policy"),
        )
    )


@query("z05_hopping_counts_batch", Z05_SQL)
def _(t):
    return started(windows.hopping_counts(t.evt, HOUR, "30 minutes"))


@query("z06_session_counts_batch", Z06_SQL)
def _(t):
    out = windows.session_counts(t.evt, "2 hours", "1 hour")
    return started(started(out, "session_start"), "session_end")


@query(
    "w14_moving_window",
    """SELECT event_id, user_id, count(*) OVER w AS n, (sum(cents) OVER w)::BIGINT AS total FROM v_evt
       WINDOW w AS (PARTITION BY user_id ORDER BY epoch_us(arrival_ts) RANGE BETWEEN 21600000000 PRECEDING AND CURRENT ROW)""",
)
def _(t):
    base = t.evt.select("event_id", "user_id", "arrival_ts", "cents")
    return windows.moving_window(base, 6 * 3600, "user_id", "arrival_ts", "cents").select(
        "event_id", "user_id", "n", "total"
    )


@query(
    "a27_rate_table",
    f"""SELECT {FMT.format('coalesce(e.w, p.w)')} AS tick, coalesce(e.n, 0) AS produced, coalesce(p.n, 0) AS consumed,
               (sum(coalesce(e.n, 0) - coalesce(p.n, 0)) OVER (ORDER BY coalesce(e.w, p.w)))::BIGINT AS lag
        FROM ({EVENT_COUNTS}) e FULL JOIN ({ARRIVAL_COUNTS}) p ON e.w = p.w""",
)
def _(t):
    return started(windows.rate_table(t.evt, HOUR, "event_ts", "arrival_ts"), "tick")


@query(
    "n05_decode_event_time",
    f"""SELECT event_id, {FMT.format('event_ts')} AS event_time, epoch_us(event_ts) AS event_us, missing AS no_header FROM v_evt""",
)
def _(t):
    out = windows.with_event_time(t.evt)
    return out.select(
        "event_id",
        timestamp_text("event_time").alias("event_time"),
        F.unix_micros("event_time").alias("event_us"),
        "no_header",
    )


@query(
    "j12_stream_table_join_batch",
    """SELECT e.event_id, e.user_id, c.full_name, c.country, e.cents FROM v_evt e LEFT JOIN v_cust c ON e.user_id = c.id""",
)
def _(t):
    return joins.stream_table_join(t.evt, t.cust, "user_id", "id").select(
        "event_id", "user_id", "full_name", "country", "cents"
    )
