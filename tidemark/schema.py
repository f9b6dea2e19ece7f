"""Row types shared by the sources, operators and streams."""

from pyspark.sql import types as T

HEADER = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())])

# The shape Spark's Kafka source gives with includeHeaders, with text keys and values.
RECORD = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("headers", T.ArrayType(HEADER)),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

PAYMENT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("amount", T.LongType()),
        T.StructField("mode", T.StringType()),
        T.StructField("_corrupt", T.StringType()),
    ]
)

# Versions stay text until cast, so 64-bit numbers keep all their digits and
# a version sent as text reads the same as one sent as a number.
CDC_SOURCE = T.StructType([T.StructField("lsn", T.StringType()), T.StructField("ts_ms", T.StringType())])


def cdc_envelope(image: T.DataType) -> T.StructType:
    """Envelope type for a known row image; ``_corrupt`` receives unparsable text."""
    return T.StructType(
        [
            T.StructField("before", image),
            T.StructField("after", image),
            T.StructField("op", T.StringType()),
            T.StructField("source", CDC_SOURCE),
            T.StructField("ts_ms", T.LongType()),
            T.StructField("_corrupt", T.StringType()),
        ]
    )


USER_IMAGE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("email", T.StringType()),
        T.StructField("phone", T.StringType()),
        T.StructField("full_name", T.StringType()),
        T.StructField("birth_date", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("created_at", T.StringType()),
    ]
)

ORDER_IMAGE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("amount_cents", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("notes", T.StringType()),
    ]
)
EVENT_IMAGE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("ip_address", T.StringType()),
        T.StructField("user_agent", T.StringType()),
    ]
)

# Row images of the analytics feed by table.
ANALYTICS_IMAGES = {"users": USER_IMAGE, "orders": ORDER_IMAGE, "events": EVENT_IMAGE}

PRODUCT_IMAGE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("price_cents", T.LongType()),
    ]
)
