"""Binary fields and encoded sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Unsigned 64-bit numbers: BIGINT ends half way, so they are decimals of twenty digits.
U64 = "decimal(20,0)"
U64_MAX = (1 << 64) - 1


def _u64(column: str) -> str:
    return f"if(octet_length({column}) = 8, cast(conv(hex({column}), 16, 10) as {U64}), null)"


def decode_u64(column: str) -> Column:
    """Big-endian 8 bytes as an unsigned number; other lengths are null."""
    return F.expr(_u64(column))


def encode_u64(column: str) -> Column:
    """A number from 0 to 2**64 - 1 as big-endian 8 bytes; others are null."""
    number = f"cast({column} as decimal(38,0))"
    return F.expr(
        f"if({number} between 0 and {U64_MAX}, unhex(lpad(conv(cast({number} as string), 10, 16), 16, '0')), null)"
    )


def to_u64(text: Column) -> Column:
    """A text of decimal digits as an unsigned number; other texts and numbers from 2**64 on are null."""
    number = F.when(text.rlike("^[0-9]+$"), text.try_cast("decimal(38,0)"))
    return F.when(number <= F.lit(str(U64_MAX)).cast("decimal(38,0)"), number).cast(U64)


def decode_event_time(column: str) -> Column:
    """Big-endian Unix nanoseconds as a timestamp; the last three digits are cut."""
    return F.expr(f"timestamp_micros(cast({_u64(column)} div 1000 as bigint))")


def varint_len(n: Column) -> Column:
    """Bytes of a base-128 varint; negative numbers take the full ten bytes."""
    ladder = F.when(n < 0, F.lit(10))
    for size in range(1, 9):
        ladder = ladder.when(n < 1 << (7 * size), F.lit(size))
    return ladder.otherwise(F.lit(9)).cast("long")


def avro_long_len(n: Column) -> Column:
    """Bytes of a zigzag varint."""
    return varint_len(F.when(n < 0, -2 * n - 1).otherwise(2 * n))


def avro_string_len(text: Column) -> Column:
    size = F.octet_length(text).cast("long")
    return avro_long_len(size) + size


def proto_int_len(n: Column) -> Column:
    """Tag of one byte and varint; the zero value is not written."""
    return F.when(n == 0, F.lit(0)).otherwise(varint_len(n) + 1).cast("long")


def proto_bytes_len(size: Column) -> Column:
    """Tag of one byte, length varint and content of an embedded message."""
    return (varint_len(size) + size + 1).cast("long")


def proto_string_len(text: Column) -> Column:
    size = F.octet_length(text).cast("long")
    return F.when(size == 0, F.lit(0)).otherwise(proto_bytes_len(size)).cast("long")
