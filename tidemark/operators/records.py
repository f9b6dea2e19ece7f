"""Single-record transforms: enrichment, routing, validation, delivery preparation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hmac_sha256
from ..functions.headers import header_list, put_headers
from ..functions.names import record_coord

# Destination topic per notification channel and the router's dead-letter topic.
CHANNEL_TOPICS = {
    "CHANNEL_FIREBASE": "notifications-firebase",
    "CHANNEL_APNS": "notifications-apns",
    "CHANNEL_WEBHOOK": "notifications-webhook",
}
ROUTER_DLQ = "notifications-router-dlq"

# Operation codes of change records.
OPERATIONS = {"c": "INSERT", "u": "UPDATE", "d": "DELETE", "r": "SNAPSHOT", "t": "TRUNCATE"}


def lookup(column: Column, table: dict[str, str], default: Column) -> Column:
    """Constant table lookup as an expression, so no join is planned."""
    out = None
    for key, value in table.items():
        out = F.when(column == key, value) if out is None else out.when(column == key, value)
    return default if out is None else out.otherwise(default)


def enrich_vip(log: DataFrame) -> DataFrame:
    """Mark VIP keys and carry the source coordinates as columns and headers."""
    return log.select(
        "key",
        F.col("value").alias("src_value"),
        F.col("key").startswith("vip-").alias("vip"),
        F.col("topic").alias("src_topic"),
        F.col("partition").alias("src_partition"),
        F.col("offset").alias("src_offset"),
        header_list(
            {
                "source.topic": F.col("topic"),
                "source.partition": F.col("partition"),
                "source.offset": F.col("offset"),
            }
        ).alias("headers"),
    )


def route_by_channel(df: DataFrame, node: str, routes: dict[str, str] | None = None) -> DataFrame:
    """Destination topic per channel; unspecified and unknown channels go to the dead-letter topic."""
    dest = lookup(F.col("channel"), routes or CHANNEL_TOPICS, F.lit(ROUTER_DLQ))
    headers = F.col("headers") if "headers" in df.columns else F.lit(None)
    return df.withColumn("destination", dest).withColumn(
        "headers", put_headers(headers, {"router-node": F.lit(node), "channel": F.col("channel")})
    )


def validate_orders(df: DataFrame) -> DataFrame:
    """Add ``error`` with the first failing rule; null means accepted."""
    error = (
        F.when(F.coalesce("customer_id", F.lit("")) == "", "no customer given")
        .when(F.col("amount_cents") <= 0, "amount is not above zero")
        .when(F.coalesce("currency", F.lit("")) == "", "no currency given")
    )
    return df.withColumn("error", error)


def upload_summary(df: DataFrame) -> DataFrame:
    """Received, accepted, rejected and the accepted total; the currency is not checked here."""
    rejected = (F.col("amount_cents") <= 0) | (F.coalesce("customer_id", F.lit("")) == "")
    return df.agg(
        F.count("*").alias("received"),
        F.count_if(~rejected).alias("accepted"),
        F.count_if(rejected).alias("rejected"),
        F.coalesce(F.sum(F.when(~rejected, F.col("amount_cents"))), F.lit(0)).alias("total_cents"),
    )


def classify_http(status: str = "status") -> Column:
    """delivered, retriable or permanent; no status is a transport error and retriable."""
    s = F.col(status)
    return (
        F.when(s.isNull(), "retriable")
        .when(s.between(200, 299), "delivered")
        .when(s.isin(408, 429) | (s >= 500), "retriable")
        .otherwise("permanent")
    )


def prepare_deliveries(df: DataFrame, body: Column, secret: str, ident: Column | None = None) -> DataFrame:
    """Body, idempotency key, signature and origin headers of an outgoing delivery."""
    idem = ident if ident is not None else record_coord("topic", "partition", "offset", ":")
    signed = df.withColumn("body", body).withColumn("idempotency_key", idem)
    return signed.withColumn("signature", hmac_sha256(F.col("body"), secret)).withColumn(
        "headers",
        header_list(
            {
                "Idempotency-Key": F.col("idempotency_key"),
                "X-Signature": F.col("signature"),
                "X-Origin-Topic": F.col("topic"),
                "X-Origin-Key": F.col("user_id"),
            }
        ),
    )


def subscribe(df: DataFrame, customer: str | None = None, limit: int = 0) -> DataFrame:
    """Rows of one customer (none given: all); a positive limit keeps the first by time and id."""
    out = df.filter(F.col("customer_id") == customer) if customer else df
    return out.orderBy("created_at", "id").limit(limit) if limit > 0 else out


def chain(df: DataFrame, *transforms) -> DataFrame:
    """Apply single-record transforms in order."""
    for fn in transforms:
        df = df.transform(fn)
    return df
