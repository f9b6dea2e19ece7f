"""User rules from key to partition by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hashing import key_partition_sql, worker_for_sql

Rule = Callable[[Column, int], Column]


def _key_hash(key: Column, n: int) -> Column:
    return F.expr(f"if(key IS NULL, NULL, {key_partition_sql('key', str(n))})")


def _worker(key: Column, n: int) -> Column:
    return F.expr(worker_for_sql("key", str(n)))


# Name to rule and whether equal keys always get the same partition.
PARTITIONERS: dict[str, tuple[Rule, bool]] = {"key_hash": (_key_hash, True), "worker": (_worker, True)}


def register_partitioner(name: str, fn: Rule, deterministic: bool = True) -> None:
    PARTITIONERS[name] = (fn, deterministic)


def is_deterministic(name: str) -> bool:
    return PARTITIONERS[name][1]


def place(df: DataFrame, name: str, n: int) -> DataFrame:
    """Add ``partition`` by the named rule on the column ``key``."""
    fn, _ = PARTITIONERS[name]
    return df.withColumn("partition", fn(F.col("key"), n))
