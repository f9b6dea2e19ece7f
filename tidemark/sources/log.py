"""Reading and writing record logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import RECORD


def select_topics(df: DataFrame, topics: list[str] | None = None, pattern: str | None = None) -> DataFrame:
    """Keep topics by exact list or by regular expression; on a log partitioned by topic this prunes folders."""
    if topics is not None and pattern is not None:
        raise ValueError("give topics or a pattern, not both")
    if topics is not None:
        return df.filter(F.col("topic").isin(topics))
    return df if pattern is None else df.filter(F.col("topic").rlike(pattern))


def read_log(
    spark: SparkSession, path: str, topics: list[str] | None = None, pattern: str | None = None
) -> DataFrame:
    """Typed scan of a log written by :func:`write_log`."""
    return select_topics(spark.read.schema(RECORD).parquet(path), topics, pattern)


def stream_log(
    spark: SparkSession,
    path: str,
    topics: list[str] | None = None,
    pattern: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """The same scan as a stream, with a bounded intake per trigger."""
    reader = spark.readStream.schema(RECORD)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return select_topics(reader.parquet(path), topics, pattern)


def kafka_options(
    servers: str,
    topics: list[str] | None = None,
    pattern: str | None = None,
    starting: str = "earliest",
    max_offsets: int | None = None,
) -> dict[str, str]:
    """Options of Spark's Kafka source for the same selection."""
    if (topics is None) == (pattern is None):
        raise ValueError("give topics or a pattern")
    options = {"kafka.bootstrap.servers": servers, "startingOffsets": starting, "includeHeaders": "true"}
    if topics is not None:
        options["subscribe"] = ",".join(topics)
    else:
        options["subscribePattern"] = pattern
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def starting_offsets(df: DataFrame, policy: str, committed: DataFrame | None = None) -> DataFrame:
    """Rows a group still has to read.

    ``committed`` holds topic, partition and committed; where it has a row the
    committed offset decides, elsewhere ``earliest`` keeps all and ``latest`` none.
    """
    if policy not in ("earliest", "latest"):
        raise ValueError(f"unknown policy {policy!r}")
    if committed is None:
        return df if policy == "earliest" else df.filter(F.lit(False))
    known = committed.select("topic", "partition", F.col("committed").alias("__start"))
    joined = df.join(known, ["topic", "partition"], "left" if policy == "earliest" else "inner")
    return joined.filter(F.col("offset") >= F.coalesce("__start", F.lit(0))).drop("__start")


def bounded_read(df: DataFrame, ends: DataFrame) -> DataFrame:
    """Rows below the end offset each partition had at launch; empty partitions fall out."""
    known = ends.filter("end_offset > 0").select("topic", "partition", F.col("end_offset").alias("__end"))
    return df.join(known, ["topic", "partition"], "inner").filter(F.col("offset") < F.col("__end")).drop("__end")


def write_log(df: DataFrame, path: str, rebalance: bool = False) -> DataFrame:
    """Append records below one folder per topic; returns records per topic and partition in the log.

    With ``rebalance`` rows are first gathered by topic into files of an even
    size; AQE splits the large topics. Without it every task writes its own files.
    """
    columns = [f.name for f in RECORD.fields]
    rows = df.select(*columns)
    if rebalance:
        rows = rows.hint("rebalance", "topic")
    rows.write.mode("append").partitionBy("topic").parquet(path)
    return read_log(df.sparkSession, path).groupBy("topic", "partition").agg(F.count("*").alias("records"))


def salted_key(key: Column, hot: list[str], bucket: Column) -> Column:
    return F.when(key.isin(hot), F.concat(key, F.lit(":bucket-"), bucket.cast("string"))).otherwise(key)
