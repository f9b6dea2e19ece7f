"""Wire formats, encoded sizes and schema versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.binding import bound, with_once
from ..functions.binary import (
    avro_long_len,
    avro_string_len,
    proto_bytes_len,
    proto_int_len,
    proto_string_len,
)

# Number, name and type of the order fields per schema version.
ORDER_VERSIONS = {
    1: [(1, "id", "string"), (2, "customer_id", "string"), (3, "amount_cents", "int64")],
    2: [(1, "id", "string"), (2, "customer_id", "string"), (3, "amount_cents", "int64"), (4, "currency", "string")],
    3: [
        (1, "id", "string"),
        (2, "customer_id", "string"),
        (3, "amount_cents", "int64"),
        (4, "currency", "string"),
        (5, "shipping_address", "Address"),
    ],
    4: [
        (1, "id", "string"),
        (2, "customer_id", "string"),
        (3, "amount_cents", "string"),
        (5, "shipping_address", "Address"),
        (7, "currency", "string"),
    ],
}


def wire_frame(value: str = "value") -> Column:
    """Schema id, message index, payload and error of a registry-framed value, as one struct.

    Behind the schema id come a count and as many indexes, zigzag varints of up to ten bytes; a count of 0 stands for the
    index 0. The first index counts and has to be 0 or -1. Only a frame with a count has its bytes looked at.
    """
    return bound(F.struct(F.hex(value).alias("raw"), F.octet_length(value).alias("size")), _frame)


def _frame(frame: Column) -> Column:
    raw, size = frame["raw"], frame["size"]

    def byte(pos: int | Column) -> Column:
        return F.conv(F.substring(raw, 2 * pos + 1, F.lit(2)), 16, 10).cast("int")

    def zigzag(first: Column, last: Column) -> Column:
        def add(acc: Column, pos: Column) -> Column:
            low = byte(pos).bitwiseAND(127).cast("long")
            return acc.bitwiseOR(F.call_function("shiftleft", low, (7 * (pos - first)).cast("int")))

        bits = F.aggregate(F.sequence(first, last), F.lit(0).cast("long"), add)
        return F.shiftrightunsigned(bits, 1).bitwiseXOR(-bits.bitwiseAND(1))

    def read(ends: Column) -> Column:
        def too_long(k: Column) -> Column:
            start = F.when(k == 0, F.lit(5)).otherwise(F.get(ends, k - 1) + 1)
            length = F.get(ends, k) - start + 1
            return (length > 10) | ((length == 10) & (byte(F.get(ends, k)) > 1))

        def of(count: Column) -> Column:
            due = F.greatest(count, F.lit(1))
            complete = (F.size(ends) > due) & ~F.exists(F.sequence(F.lit(0), due.cast("int")), too_long)
            none = (count == 0) & ~too_long(F.lit(0))
            first = zigzag(F.get(ends, F.lit(0)) + 1, F.get(ends, F.lit(1)))
            index = F.when(none, F.lit(0)).when(complete, first).cast("long")
            header = F.when(none, F.get(ends, F.lit(0))).otherwise(F.get(ends, due.cast("int"))) + 1
            return F.struct(index.alias("index"), header.alias("header"))

        return bound(F.when(F.size(ends) > 0, zigzag(F.lit(5), F.get(ends, F.lit(0)))), of)

    def judge(h: Column) -> Column:
        error = (
            F.when(size < 5, "short")
            .when(byte(0) != 0, "bad magic")
            .when((size < 6) | h["index"].isNull() | ~h["index"].isin(0, -1), "bad index")
        )
        good = error.isNull()
        return F.struct(
            F.when(good, F.conv(F.substring(raw, 3, 8), 16, 10).cast("long")).alias("schema_id"),
            F.when(good, h["index"]).alias("message_index"),
            F.when(good, (size - h["header"]).cast("long")).alias("payload_bytes"),
            error.alias("error"),
        )

    # Last bytes of the numbers from the count on; the numbers of a header stand at the front.
    ends = F.filter(F.sequence(F.lit(5), F.greatest(size - 1, F.lit(5))), lambda p: (p < size) & (byte(p) < 128))
    plain = F.struct(F.lit(0).cast("long").alias("index"), F.lit(6).alias("header"))
    return bound(F.when(byte(5) == 0, plain).otherwise(bound(ends, read)), judge)


def wire_header(value: str = "value") -> dict[str, Column]:
    """The fields of :func:`wire_frame`."""
    frame = wire_frame(value)
    return {name: frame[name] for name in ("schema_id", "message_index", "payload_bytes", "error")}


def wire_header_audit(log: DataFrame) -> DataFrame:
    """Records, bytes and payload bytes per schema id and per kind of error."""
    rows = with_once(log, "__w", wire_frame()).select(F.octet_length("value").cast("long").alias("size"), "__w.*")
    return rows.groupBy("schema_id", "error").agg(
        F.count("*").alias("records"), F.sum("size").alias("bytes"), F.sum("payload_bytes").alias("payload_bytes")
    )


def _item_sizes() -> tuple[Column, Column, Column]:
    sku, quantity, price = F.col("sku"), F.col("quantity"), F.col("price_cents")
    json = F.octet_length(
        F.concat(F.lit('{"sku":"'), sku, F.lit('","quantity":'), quantity, F.lit(',"price_cents":'), price, F.lit("}"))
    ).cast("long")
    avro = avro_string_len(sku) + avro_long_len(quantity) + avro_long_len(price)
    proto = proto_bytes_len(proto_string_len(sku) + proto_int_len(quantity) + proto_int_len(price))
    return json, avro, proto


def wire_size_report(items: DataFrame) -> DataFrame:
    """Payload bytes and bytes per record of nested orders as JSON, Avro and Protobuf.

    The input is one row per order item. Encoded sizes add up, so items are
    summed per order with partial aggregation and never collected.
    """
    json, avro, proto = _item_sizes()
    sized = items.select("l_orderkey", "price_cents", "shipped", json.alias("j"), avro.alias("a"), proto.alias("p"))
    orders = sized.groupBy("l_orderkey").agg(
        F.count("*").alias("n"),
        F.sum("price_cents").alias("amount_cents"),
        F.unix_timestamp(F.min("shipped")).alias("created_at"),
        F.sum("j").alias("j"),
        F.sum("a").alias("a"),
        F.sum("p").alias("p"),
    )
    ident = F.concat(F.lit("ord-"), "l_orderkey")
    customer = F.concat(F.lit("cus-"), F.col("l_orderkey") % 1000)
    amount, created, currency = F.col("amount_cents"), F.col("created_at"), F.lit("EUR")
    head = F.concat(
        F.lit('{"id":"'), ident, F.lit('","customer_id":"'), customer, F.lit('","amount_cents":'), amount,
        F.lit(',"currency":"EUR","created_at_unix":'), created, F.lit(',"items":[]}'),
    )
    sizes = orders.select(
        (F.octet_length(head) + F.col("j") + F.col("n") - 1).cast("long").alias("json"),
        (
            avro_string_len(ident) + avro_string_len(customer) + avro_long_len(amount) + avro_string_len(currency)
            + avro_long_len(created) + avro_long_len(F.col("n")) + F.col("a") + 1
        ).alias("avro"),
        (
            proto_string_len(ident) + proto_string_len(customer) + proto_int_len(amount) + proto_string_len(currency)
            + proto_int_len(created) + F.col("p")
        ).alias("protobuf"),
    )
    total = sizes.agg(
        F.count("*").alias("records"), *[F.sum(c).alias(c) for c in ("json", "avro", "protobuf")]
    )
    tall = total.select("records", F.expr("stack(3, 'json', json, 'avro', avro, 'protobuf', protobuf) AS (format, bytes)"))
    return tall.withColumn("avg_bytes", F.round(F.col("bytes") / F.col("records"), 6))


def project_schema(df: DataFrame, fields: dict[str, str], payload: str = "payload") -> DataFrame:
    """Read records with an older schema: missing fields take the type's default, others are listed.

    ``fields`` maps a name to ``string`` or ``bigint``.
    """
    defaults = {"string": F.lit(""), "bigint": F.lit(0).cast("long")}
    row = F.from_json(payload, ", ".join(f"{n} {t}" for n, t in fields.items()))
    unknown = F.array_sort(F.array_except(F.json_object_keys(payload), F.array(*[F.lit(n) for n in fields])))
    base = with_once(df, "__row", row)
    rest = [c for c in df.columns if c != payload]
    return base.select(
        *rest,
        *[F.coalesce(F.col(f"__row.{n}"), defaults[t]).alias(n) for n, t in fields.items()],
        F.array_join(unknown, ",").alias("unknown_fields"),
    )


def schema_fields(spark: SparkSession) -> DataFrame:
    """The declared versions as rows; their number is fixed above."""
    rows = ", ".join(f"({v}, {n}, '{name}', '{t}')" for v, fields in ORDER_VERSIONS.items() for n, name, t in fields)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS v(version, number, name, type)")


def schema_compat(old: DataFrame, new: DataFrame) -> DataFrame:
    """Field by field changes between two versions, by number and by name."""
    o = old.select(F.col("number"), F.col("name").alias("old_name"), F.col("type").alias("old_type"))
    n = new.select(F.col("number"), F.col("name").alias("new_name"), F.col("type").alias("new_type"))
    by_number = o.join(n, "number", "full")
    old_names = old.select(F.col("name").alias("new_name"), F.col("number").alias("moved_from"))
    change = (
        F.when(F.col("old_name").isNull() & F.col("moved_from").isNotNull(), "moved")
        .when(F.col("old_name").isNull(), "added")
        .when(F.col("new_name").isNull(), "removed")
        .when(F.col("old_type") != F.col("new_type"), "type changed")
        .when(F.col("old_name") != F.col("new_name"), "renamed")
        .otherwise("same")
    )
    return by_number.join(old_names, "new_name", "left").select(
        "number", F.coalesce("new_name", "old_name").alias("name"), change.alias("change")
    )


# What each mode forbids: a reader of the new schema must read old data (BACKWARD),
# a reader of the old schema must read new data (FORWARD).
BREAKING = {
    "NONE": [],
    "BACKWARD": ["type changed", "moved"],
    "FORWARD": ["type changed", "moved", "removed"],
    "FULL": ["type changed", "moved", "removed"],
}


def compat_verdict(mode: str) -> Column:
    """Aggregate over the changes between two versions: allowed under the mode or not."""
    if not BREAKING[mode]:
        return F.bool_and(F.lit(True))
    return F.bool_and(~F.col("change").isin(BREAKING[mode]))
