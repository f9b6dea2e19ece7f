"""Column builders against byte-level Python."""

import hashlib
import hmac
import struct
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import binary, hashing, names
from tidemark.functions import headers as hd
from tidemark.functions.text import analyze_text, tokenize
from tidemark.operators.words import query_terms

KEYS = ["", "a", "ab", "abc", "abcd", "abcde", "user-1", "prem-44", "Привет", "user-000123456789", "ключ-🔑"]


def murmur2(data: bytes) -> int:
    m, mask = 0x5BD1E995, 0xFFFFFFFF
    h = (0x9747B28C ^ len(data)) & mask
    whole = len(data) // 4 * 4
    for (k,) in struct.iter_unpack("<I", data[:whole]):
        k = k * m & mask
        k = (k ^ k >> 24) * m & mask
        h = (h * m & mask) ^ k
    if data[whole:]:
        h = (h ^ int.from_bytes(data[whole:], "little")) * m & mask
    h = (h ^ h >> 13) * m & mask
    return h ^ h >> 15


def fnv1a(data: bytes) -> int:
    h = 2166136261
    for b in data:
        h = (h ^ b) * 16777619 & 0xFFFFFFFF
    return h


def test_key_hashes(spark):
    df = spark.createDataFrame([(k,) for k in KEYS], "k string")
    for r in df.select(
        "k",
        F.expr(hashing.murmur2_sql("k")).alias("m"),
        hashing.key_partition("k", 6).alias("p"),
        hashing.worker_for("k", 8).alias("w"),
    ).collect():
        data = r.k.encode()
        assert r.m == murmur2(data)
        assert r.p == (murmur2(data) & 0x7FFFFFFF) % 6
        assert r.w == (fnv1a(data) % 8 if data else 0)


def test_null_key_has_no_partition(spark):
    assert spark.sql("select cast(null as string) k").select(hashing.key_partition("k", 3)).first()[0] is None


@pytest.mark.parametrize("secret", ["s", "delivery-secret", "x" * 64, "y" * 100])
def test_hmac(spark, secret):
    df = spark.createDataFrame([(k,) for k in KEYS], "k string")
    for r in df.select("k", hashing.hmac_sha256(F.col("k"), secret).alias("h")).collect():
        assert r.h == hmac.new(secret.encode(), r.k.encode(), hashlib.sha256).hexdigest()


def test_hash_field(spark):
    df = spark.createDataFrame([("a@b.c",), (None,)], "v string")
    got = [r[0] for r in df.select(hashing.hash_field(F.col("v"), "salt")).collect()]
    assert got == [hashlib.sha256(b"salt:a@b.c").hexdigest(), ""]
    other = df.select(hashing.hash_field(F.col("v"), "pepper")).first()[0]
    assert len(other) == 64 and other != got[0]


def test_truncate_name(spark):
    cases = {
        "Иван Иванов": "ИванИ.",
        "  Anna  Smith  ": "AnnaS.",
        "Single": "Single",
        "": "",
        None: "",
        "Anna\u00a0Smith": "AnnaS.",
        "\t Anna": "Anna",
        "\u3000Anna\u2003\u0085😀x": "Anna😀.",
        " \u2028 ": "",
    }
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    assert {r.v: r.t for r in df.select("v", names.truncate_name("v").alias("t")).collect()} == cases
    names.sql_functions(spark)
    assert {r.v: r.t for r in df.selectExpr("v", "truncate_name(v) t").collect()} == cases


def test_backoff_stays_below_its_cap(spark):
    got = spark.range(1, 70).select(names.backoff("id", 200, 5000).alias("d"), names.backoff("id", 7000, 5000).alias("e")).collect()
    assert [r.d for r in got] == [min(5000, 200 * 2**k) for k in range(69)]
    assert {r.e for r in got} == {5000}


def test_tokenize_counts_bytes(spark):
    df = spark.createDataFrame([("A é x_yz foo-БАР 7 42 я",)], "t string")
    # One non-ASCII letter has two bytes and stays, one ASCII letter or digit goes.
    assert df.select(tokenize("t")).first()[0] == ["é", "yz", "foo", "бар", "42", "я"]


def test_analyze_folds_accents(spark):
    df = spark.createDataFrame([("Données du Système, Straße æon Œuvre",)], "t string")
    assert df.select(analyze_text("t")).first()[0] == ["donnees", "du", "systeme", "strasse", "aeon", "oeuvre"]
    assert query_terms("Données, système données") == ["donnees", "systeme"]


def test_u64(spark):
    values = [b"\0" * 7 + b"\5", b"\x7f" + b"\xff" * 7, b"\xff" * 8, b"\0\0\0\1", None]
    df = spark.createDataFrame([(bytearray(v) if v is not None else None,) for v in values], "b binary")
    assert [r[0] for r in df.select(binary.decode_u64("b")).collect()] == [5, 2**63 - 1, 2**64 - 1, None, None]
    large = [(str(v), Decimal(v)) for v in (0, 2**63 - 1, 2**63, 2**64 - 2, 2**64 - 1)]
    texts = spark.createDataFrame(large + [("18446744073709551616", None), ("-1", None), ("1" * 50, None), ("x", None), ("", None)], "t string, v decimal(20,0)")
    round_trip = texts.withColumn("n", binary.to_u64(F.col("t"))).withColumn("b", binary.encode_u64("n")).withColumn("again", binary.decode_u64("b"))
    for r in round_trip.collect():
        assert r.n == r.v == r.again and r.b == (None if r.v is None else struct.pack(">Q", int(r.v)))
    round_trip = spark.range(0, 1000, 333).withColumn("b", binary.encode_u64("id")).select("id", binary.decode_u64("b").alias("n"))
    assert all(r.id == r.n for r in round_trip.collect())


def test_event_time(spark):
    nanos = 1_704_067_200_123_456_789
    late = spark.createDataFrame([(bytearray(struct.pack(">Q", 2**63 + 1000)),)], "h binary")
    assert late.select(F.unix_micros(binary.decode_event_time("h"))).first()[0] == (2**63 + 1000) // 1000
    df = spark.createDataFrame([(bytearray(struct.pack(">Q", nanos)),), (bytearray(b"abc"),)], "h binary")
    got = [r[0] for r in df.select(F.unix_micros(binary.decode_event_time("h"))).collect()]
    assert got == [nanos // 1000, None]


def test_encoded_lengths(spark):
    def varint(n):
        n &= 2**64 - 1
        size = 1
        while n > 127:
            n >>= 7
            size += 1
        return size

    numbers = [0, 1, 127, 128, 16383, 16384, 2**31, 2**62, 2**63 - 1, -1, -64, -65]
    df = spark.createDataFrame([(n,) for n in numbers], "n long")
    n = F.col("n")
    for r in df.filter("abs(n) < 4611686018427387904").select(
        "n", binary.varint_len(n).alias("v"), binary.avro_long_len(n).alias("a"), binary.proto_int_len(n).alias("p")
    ).collect():
        assert r.v == varint(r.n)
        assert r.a == varint((r.n << 1) ^ (r.n >> 63))
        assert r.p == (0 if r.n == 0 else 1 + varint(r.n))


HEADERS = "array(named_struct('key','b','value',cast('1' as binary)), named_struct('key','a','value',cast('2' as binary)), named_struct('key','b','value',cast('3' as binary)))"


def test_headers(spark):
    df = spark.sql(f"select {HEADERS} h, cast(array() as array<struct<key:string,value:binary>>) e")
    assert df.select(hd.headers_map("h")).first()[0] == {"a": "2", "b": "3"}
    assert df.select(hd.header("h", "b"), hd.header("h", "zz")).first()[:] == ("3", None)
    assert df.select(hd.format_headers("h"), hd.format_headers("e")).first()[:] == ("a=2 b=3", "-")
    put = df.select(hd.put_headers("h", {"b": F.lit("x"), "c": F.lit("y"), "gone": F.lit(None).cast("string")})).first()[0]
    # The first b is replaced in place, c is appended, a null is left out.
    assert [(h.key, bytes(h.value).decode()) for h in put] == [("b", "x"), ("a", "2"), ("b", "3"), ("c", "y")]
    assert len(df.select(hd.set_header("e", "k", F.lit("v"))).first()[0]) == 1


def test_header_names_are_listed_once(spark):
    """Two bindings, the new values and one list of names for each side; none inside the loop over headers."""
    df = spark.createDataFrame([([("a", b"1"), ("c", b"0")],)], "headers array<struct<key:string,value:binary>>")
    out = df.select(hd.put_headers("headers", {"a": F.lit("2"), "b": F.lit("3")}).alias("x"))
    assert out._jdf.queryExecution().analyzed().toString().count("transform(") == 5
    assert [(h.key, bytes(h.value)) for h in out.first().x] == [("a", b"2"), ("c", b"0"), ("b", b"3")]


def test_coordinates_and_backoff(spark):
    df = spark.sql("select 't' t, 3 p, 17L o, explode(sequence(1, 6)) n")
    r = df.select(
        names.record_coord("t", "p", "o"), names.record_coord("t", "p", "o", ":"), names.short_id(F.lit("123456789"))
    ).first()
    assert r[:] == ("t/3/17", "t:3:17", "12345678")
    assert [x[0] for x in df.select(names.backoff("n", 200, 5000)).collect()] == [200, 400, 800, 1600, 3200, 5000]


def test_sql_functions(spark):
    names.sql_functions(spark)
    r = spark.sql(
        "select key_partition('user-1', 6) p, worker_for('', 8) w, tokenize('Ab c de') t, "
        "hash_field(null, 's') h, truncate_name('Ann Lee') n, record_coord('t', 1, 2) c"
    ).first()
    assert r.p == (murmur2(b"user-1") & 0x7FFFFFFF) % 6
    assert (r.w, r.t, r.h, r.n, r.c) == (0, ["ab", "de"], "", "AnnL.", "t/1/2")
