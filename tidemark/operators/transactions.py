"""Transaction visibility, outcomes and fencing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .running import PLACES, running


def read_committed(log: DataFrame, markers: DataFrame) -> DataFrame:
    """Records outside transactions and records of transactions with a commit marker."""
    committed = markers.filter("outcome = 'commit'").select("txn_id", "txn_no")
    inside = log.filter("txn_id IS NOT NULL").join(committed, ["txn_id", "txn_no"], "left_semi")
    return log.filter("txn_id IS NULL").unionByName(inside.select(*log.columns))


def isolation_counts(log: DataFrame, markers: DataFrame) -> DataFrame:
    """Rows per topic and in total at both isolation levels, from one count per transaction."""
    committed = markers.filter("outcome = 'commit'").select("txn_id", "txn_no").distinct().withColumn("ok", F.lit(True))
    per_txn = log.groupBy("topic", "txn_id", "txn_no").agg(F.count("*").alias("n"))
    seen = F.col("txn_id").isNull() | F.coalesce("ok", F.lit(False))
    per_topic = per_txn.join(committed, ["txn_id", "txn_no"], "left").groupBy("topic").agg(
        F.sum("n").alias("uncommitted"), F.sum(F.when(seen, F.col("n")).otherwise(0)).alias("committed")
    )
    levels = per_topic.unpivot("topic", ["uncommitted", "committed"], "level", "n").filter("n > 0")
    total = F.grouping("topic") == 1
    return (
        levels.groupingSets([["level", "topic"], ["level"]], "level", "topic")
        .agg(F.when(total, F.lit("TOTAL")).otherwise(F.first("topic")).alias("label"), F.sum("n").alias("records"))
        .drop("topic")
    )


def txn_outcomes(log: DataFrame, markers: DataFrame) -> DataFrame:
    """Attempts and records per outcome; a transaction without a marker is open."""
    per_txn = log.filter("txn_id IS NOT NULL").groupBy("txn_id", "txn_no").agg(F.count("*").alias("records"))
    joined = per_txn.join(markers.select("txn_id", "txn_no", "outcome"), ["txn_id", "txn_no"], "left")
    return joined.groupBy(F.coalesce("outcome", F.lit("open")).alias("outcome")).agg(
        F.count("*").alias("attempts"), F.sum("records").alias("records")
    )


def fence_stale_writers(writes: DataFrame, order: str = "txn_no") -> DataFrame:
    """Mark writes of an older epoch once a newer one of the same transactional id has started.

    Of the writes with one order number the newest epoch counts as the first, so the older ones among them are fenced.
    """
    inside = writes.filter("txn_id IS NOT NULL").withColumn("__older", -F.col("epoch"))
    newest = running(inside, ["txn_id"], [order, "__older"], {"newest_epoch": ("max", F.col("epoch"))}, span=PLACES)
    return newest.withColumn("fenced", F.col("epoch") < F.col("newest_epoch")).drop("newest_epoch", "__older")
