"""Names, coordinates, retry delays and the SQL forms of the public functions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .hashing import key_partition_sql, worker_for_sql
from .text import tokenize_sql

PREMIUM_PREFIX = "prem-"
# Unicode white space, as a class of both Spark's and the checking engine's patterns.
BLANK = r"\x09-\x0D\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
FIRST_WORD = rf"^[{BLANK}]*([^{BLANK}]+)"
SECOND_INITIAL = rf"^[{BLANK}]*[^{BLANK}]+[{BLANK}]+([^{BLANK}])"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def truncate_name(name: str | Column) -> Column:
    """First word, then the first letter of the second and a dot; a single word stays, null becomes empty.

    Words end at any Unicode white space.
    """
    first = F.regexp_extract(_col(name), FIRST_WORD, 1)
    initial = F.regexp_extract(_col(name), SECOND_INITIAL, 1)
    return F.coalesce(F.concat(first, F.when(initial != "", F.concat(initial, F.lit("."))).otherwise("")), F.lit(""))


def record_coord(topic: str | Column, partition: str | Column, offset: str | Column, sep: str = "/") -> Column:
    """``topic<sep>partition<sep>offset``: ``/`` for replay, ``:`` for idempotency keys."""
    return F.concat_ws(sep, _col(topic), _col(partition).cast("string"), _col(offset).cast("string"))


def short_id(identifier: str | Column) -> Column:
    """First eight characters."""
    return F.left(_col(identifier), F.lit(8))


def backoff(attempt: str | Column, base_ms: int, cap_ms: int | None = None) -> Column:
    """Delay before a retry: base doubled per attempt from 1 on, up to the cap."""
    doublings = _col(attempt) - 1
    if cap_ms:
        # The product is at the cap from here on; bounding the exponent keeps it within a long.
        doublings = F.least(doublings, F.lit(max(0, (max(1, cap_ms) // max(1, base_ms)).bit_length())))
    delay = F.lit(base_ms).cast("long") * F.pow(F.lit(2), doublings).cast("long")
    return F.least(delay, F.lit(cap_ms).cast("long")) if cap_ms else delay


def premium_partition(key: str | Column, regular_rank: str | Column, n: int) -> Column:
    """Premium keys to partition 0, regular rows in turn to 1 and 2, within the n partitions there are.

    ``regular_rank`` counts the regular rows from 1 in arrival order.
    """
    first, second = min(1, n - 1), min(2, n - 1)
    turn = F.when(F.pmod(_col(regular_rank) - 1, F.lit(2)) == 0, F.lit(first)).otherwise(F.lit(second))
    return F.when(_col(key).startswith(PREMIUM_PREFIX), F.lit(0)).otherwise(turn).cast("int")


def timestamp_text(column: str | Column) -> Column:
    return F.date_format(_col(column).cast("timestamp"), "yyyy-MM-dd HH:mm:ss")


def sql_functions(spark: SparkSession) -> list[str]:
    """Create the public functions as temporary SQL functions; they are inlined by Catalyst."""
    bodies = {
        "key_partition(k STRING, n INT) RETURNS INT": f"if(k is null, null, {key_partition_sql('k', 'n')})",
        "worker_for(k STRING, n INT) RETURNS INT": worker_for_sql("k", "n"),
        "tokenize(t STRING) RETURNS ARRAY<STRING>": tokenize_sql("t"),
        "record_coord(t STRING, p INT, o BIGINT) RETURNS STRING": "concat_ws('/', t, p, o)",
        "hash_field(v STRING, salt STRING) RETURNS STRING": "if(v is null, '', sha2(concat(salt, ':', v), 256))",
        "truncate_name(v STRING) RETURNS STRING": (
            f"coalesce(concat(regexp_extract(v, r'{FIRST_WORD}', 1), "
            f"regexp_replace(regexp_extract(v, r'{SECOND_INITIAL}', 1), r'^(.+)$', '$1.')), '')"
        ),
    }
    for signature, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    return sorted(s.split("(")[0] for s in bodies)
