"""Key hashes, field hashes and signatures as pure expressions."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

# Published constants of the 32-bit murmur2 and FNV-1a hashes.
MURMUR_SEED = 0x9747B28C
MURMUR_MULTIPLIER = 0x5BD1E995
FNV_OFFSET_BASIS = 2166136261
FNV_PRIME = 16777619
MASK32 = 0xFFFFFFFF

# All 32-bit products here stay below 2**63, so long arithmetic followed by
# the mask is exact and never overflows under ANSI mode.


def murmur2_sql(key: str) -> str:
    """SQL text of the unsigned murmur2 hash of a string or binary expression."""
    m, mask = MURMUR_MULTIPLIER, MASK32
    raw = f"hex({key})"
    size = f"octet_length({key})"

    def byte(pos: str) -> str:
        return f"cast(conv(substring({raw}, cast(2 * ({pos}) + 1 as int), 2), 16, 10) as bigint)"

    block = (
        f"cast(conv(concat(substring({raw}, 8 * i + 7, 2), substring({raw}, 8 * i + 5, 2), "
        f"substring({raw}, 8 * i + 3, 2), substring({raw}, 8 * i + 1, 2)), 16, 10) as bigint)"
    )
    blocks = (
        f"if({size} < 4, array(), transform(sequence(0, {size} div 4 - 1), i -> {block}))"
    )
    scramble = f"((k * {m}) & {mask})"
    mixed = f"((({scramble} ^ shiftright({scramble}, 24)) * {m}) & {mask})"
    body = (
        f"aggregate({blocks}, cast(({MURMUR_SEED} ^ {size}) & {mask} as bigint), "
        f"(h, k) -> ((h * {m}) & {mask}) ^ {mixed})"
    )
    # Tail bytes form one little-endian word that is xored in and multiplied once.
    start = f"({size} - {size} % 4)"
    tail = (
        f"(case when {size} % 4 = 3 then {byte(start + ' + 2')} else 0 end * 65536 "
        f"+ case when {size} % 4 >= 2 then {byte(start + ' + 1')} else 0 end * 256 "
        f"+ case when {size} % 4 >= 1 then {byte(start)} else 0 end)"
    )
    final = (
        f"aggregate(array({tail}), {body}, "
        f"(h, t) -> if({size} % 4 = 0, h, ((h ^ t) * {m}) & {mask}), "
        f"h -> h)"
    )
    return f"aggregate(array({final}), 0L, (z, h) -> ((h ^ shiftright(h, 13)) * {m}) & {mask}, h -> h ^ shiftright(h, 15))"


def key_partition_sql(key: str, n: str) -> str:
    return f"cast(({murmur2_sql(key)} & 2147483647) % {n} as int)"


def key_partition(key: str, n: int) -> Column:
    """Partition of a key: positive murmur2 modulo n. A null key stays null."""
    return F.expr(f"if({key} is null, null, {key_partition_sql(key, str(n))})")


def worker_for_sql(key: str, n: str) -> str:
    size = f"octet_length({key})"
    return (
        f"if(coalesce({size}, 0) = 0, 0, cast(aggregate(transform(sequence(1, {size}), "
        f"i -> cast(conv(substring(hex({key}), 2 * i - 1, 2), 16, 10) as bigint)), {FNV_OFFSET_BASIS}L, "
        f"(h, b) -> ((h ^ b) * {FNV_PRIME}L) & {MASK32}L, h -> h % {n}) as int))"
    )


def worker_for(key: str, n: int) -> Column:
    """Worker of a key: FNV-1a 32 bit modulo n; an empty key goes to worker 0."""
    return F.expr(worker_for_sql(key, str(n)))


def hash_field(value: Column, salt: str) -> Column:
    """SHA-256 hex of ``salt:value``; null becomes the empty text."""
    return F.when(value.isNull(), F.lit("")).otherwise(
        F.sha2(F.concat(F.lit(f"{salt}:"), value.cast("string")), 256)
    )


def hmac_pads(secret: bytes) -> tuple[bytes, bytes]:
    """Inner and outer pad of HMAC-SHA256 for a secret of any length."""
    if len(secret) > 64:
        secret = hashlib.sha256(secret).digest()
    block = secret.ljust(64, b"\0")
    return bytes(b ^ 0x36 for b in block), bytes(b ^ 0x5C for b in block)


def hmac_sha256(body: Column, secret: str) -> Column:
    """HMAC-SHA256 hex of a string or binary column under a constant secret."""
    inner, outer = hmac_pads(secret.encode())
    digest = F.sha2(F.concat(F.lit(bytearray(inner)), body.cast("binary")), 256)
    return F.sha2(F.concat(F.lit(bytearray(outer)), F.unhex(digest)), 256)
