"""Table sinks and option builders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.headers import header


def append_versioned(df: DataFrame, path: str, batch_id: int) -> None:
    """Append all versions below one folder per target and batch.

    A batch written again replaces its own folders only, so a retry leaves one copy.
    """
    for_batch = df.withColumn("batch_id", F.lit(batch_id).cast("long"))
    (
        for_batch.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("target_topic", "batch_id")
        .parquet(path)
    )


def read_versioned(spark: SparkSession, path: str, target_topic: str) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("target_topic") == target_topic).drop("batch_id")


def dlq_incidents(dlq: DataFrame) -> DataFrame:
    """Dead letters as flat incident rows."""
    from_header = {
        "original_topic": "original.topic",
        "original_partition": "original.partition",
        "original_offset": "original.offset",
        "previous_topic": "previous.topic",
        "retry_count": "retry.count",
        "error_class": "error.class",
        "error_message": "error.message",
        "error_timestamp": "error.timestamp",
    }
    return dlq.select(
        F.col("topic").alias("dlq_topic"),
        F.col("partition").alias("dlq_partition"),
        F.col("offset").alias("dlq_offset"),
        "key",
        *[header("headers", h).alias(c) for c, h in from_header.items()],
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("dlq_record_time"),
        F.octet_length("value").cast("long").alias("payload_bytes"),
    )


def write_incidents(dlq: DataFrame, path: str) -> None:
    """Append one JSON line per dead letter."""
    dlq_incidents(dlq).write.mode("append").json(path)


def read_incidents(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def jdbc_options(url: str, table: str, batch_size: int = 1000) -> dict[str, str]:
    """Options of Spark's JDBC writer for a staging table; the upsert itself is a merge on the server."""
    return {"url": url, "dbtable": table, "batchsize": str(batch_size), "isolationLevel": "READ_COMMITTED"}


def switch_version(spark: SparkSession, alias: str, old: DataFrame, new: DataFrame, new_view: str) -> DataFrame:
    """Point a view at the new version once it holds at least as many rows as the old one.

    Returns the counts, the gate and the version the alias names afterwards.
    """
    counts = (
        old.select(F.lit("old").alias("v")).union(new.select(F.lit("new").alias("v"))).groupBy("v").count().collect()
    )
    sizes = {r["v"]: r["count"] for r in counts}
    ready = sizes.get("new", 0) >= sizes.get("old", 0)
    target = new if ready else old
    target.createOrReplaceTempView(alias)
    row = (alias, new_view if ready else "unchanged", sizes.get("old", 0), sizes.get("new", 0), ready)
    columns = "alias string, target string, old_count long, new_count long, switched boolean"
    return spark.createDataFrame([row], columns)
