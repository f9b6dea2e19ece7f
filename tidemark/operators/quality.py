"""Duplicates, delivery history and reservation reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_summary(log: DataFrame, key: str) -> DataFrame:
    """Total, unique keys and occurrences beyond the first."""
    per_key = log.groupBy(key).agg(F.count("*").alias("n"))
    out = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count("*").alias("unique_keys"))
    dup = F.col("total") - F.col("unique_keys")
    return out.withColumn("duplicates", dup).withColumn("verdict", F.when(dup == 0, "exactly once").otherwise("duplicates"))


def duplicates_by_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Groups that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def history_by_channel(df: DataFrame) -> DataFrame:
    """Delivered, dead-lettered and total rows per channel."""
    return df.groupBy("channel").agg(
        F.count_if(F.col("status") == "delivered").alias("delivered"),
        F.count_if(F.col("status") == "dlq").alias("dlq"),
        F.count("*").alias("total"),
    )


def reservations_by_node(reservations: DataFrame) -> DataFrame:
    return reservations.groupBy("node").agg(F.count("*").alias("reservations"))


def totals_by_key(orders: DataFrame, key: str) -> DataFrame:
    """Re-key rows and aggregate by the new key; partial sums are made before the shuffle."""
    return orders.groupBy(key).agg(F.count("*").alias("orders"), F.sum("amount_cents").alias("amount_cents"))
