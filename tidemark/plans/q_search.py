"""Queries over documents: word counts, changelogs and search."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.binary import avro_long_len, decode_u64, encode_u64, proto_int_len, varint_len
from ..functions.text import ACCENTED, DIGRAPHS, FOLDED, analyze_text, tokenize
from ..operators import search, words
from ..session import work_dir
from .registry import query

QUERY = "données le système"

_FOLD = "lower(text)"
for _a, _b in DIGRAPHS.items():
    _FOLD = f"replace({_FOLD}, '{_a}', '{_b}')"
_FOLD = f"translate({_FOLD}, '{ACCENTED}', '{FOLDED}')"
_WS = rf"regexp_extract_all({_FOLD}, '[\p{{L}}\p{{Nd}}]+')"

COUNT_SQL = "SELECT word, count(*) AS n FROM v_tokens GROUP BY word"


@query("a01_word_count", COUNT_SQL)
def _(t):
    return words.word_count(t.docs)


@query("t01_top_n_words", f"SELECT *, row_number() OVER (ORDER BY n DESC, word) AS rank FROM ({COUNT_SQL}) ORDER BY n DESC, word LIMIT 100")
def _(t):
    return words.top_n_words(words.word_count(t.docs), 100)


@query(
    "w01_word_changelog",
    """SELECT word, "partition", "offset", pos::INT AS pos, row_number() OVER (PARTITION BY word ORDER BY "partition", "offset", pos) AS n FROM v_tokens""",
)
def _(t):
    return words.word_changelog(t.docs).select("word", "partition", "offset", "pos", "n")


@query(
    "n03_tokenize",
    "SELECT doc_id, count(*) AS tokens, sum(strlen(word))::BIGINT AS token_bytes, count(DISTINCT word) AS distinct_tokens FROM v_tokens GROUP BY doc_id",
)
def _(t):
    ws = t.docs.select("doc_id", tokenize("text").alias("ws")).filter("size(ws) > 0")
    size = F.aggregate("ws", F.lit(0).cast("long"), lambda s, w: s + F.octet_length(w))
    return ws.select(
        "doc_id",
        F.size("ws").cast("long").alias("tokens"),
        size.alias("token_bytes"),
        F.size(F.array_distinct("ws")).cast("long").alias("distinct_tokens"),
    )


@query(
    "n07_analyze_text",
    f"""SELECT doc_id, len({_WS})::BIGINT AS tokens, strlen(array_to_string({_WS}, ' '))::BIGINT AS token_bytes,
               md5(array_to_string({_WS}, ' ')) AS digest FROM v_docs""",
)
def _(t):
    ws = t.docs.select("doc_id", analyze_text("text").alias("ws"))
    text = F.array_join("ws", " ")
    return ws.select(
        "doc_id",
        F.size("ws").cast("long").alias("tokens"),
        F.octet_length(text).cast("long").alias("token_bytes"),
        F.md5(text).alias("digest"),
    )


def _terms_sql() -> str:
    terms = words.query_terms(QUERY)
    tfs = ", ".join(f"len(list_filter(ws, lambda w: w = '{x}')) AS tf{i}" for i, x in enumerate(terms))
    any_hit = " OR ".join(f"tf{i} > 0" for i in range(len(terms)))
    parts = " + ".join(
        f"round(ln(1 + (n - df{i} + 0.5) / (df{i} + 0.5)) * tf{i} * 2.2 / (tf{i} + 1.2::DOUBLE * (0.25 + 0.75 * len / avg_len)), 9)::DECIMAL(28,9)"
        for i in range(len(terms))
    )
    dfs = ", ".join(f"(count(*) FILTER (tf{i} > 0))::DOUBLE AS df{i}" for i in range(len(terms)))
    return f"""WITH a AS (SELECT doc_id, {_WS} AS ws FROM v_docs), f AS (SELECT doc_id, len(ws) AS len, {tfs} FROM a),
        c AS (SELECT count(*) AS n, avg(len) AS avg_len, {dfs} FROM f)
        SELECT doc_id, round({parts}, 6)::DOUBLE AS score FROM f, c WHERE {any_hit} ORDER BY score DESC, doc_id LIMIT 50"""


@query("t03_match_top_k", _terms_sql())
def _(t):
    return words.match_top_k(t.docs, QUERY, 50)


@query("t03_match_indexed", _terms_sql())
def _(t):
    path = work_dir(t.spark, "search-index")
    search.build_index(t.docs, path)
    return search.match_index(t.spark, path, QUERY, 50)


def changelog(t):
    """Word changelog as records: the running count per word, tombstones and values of a wrong length."""
    counted = words.word_changelog(t.docs).select(
        F.col("word").alias("key"), (F.col("n") - 1).alias("offset"), encode_u64("n").alias("value8")
    )
    # A word has a tombstone, a value of a wrong length or neither; one pass over the totals gives both.
    ends = words.word_count(t.docs).filter("length(word) % 17 = 0 OR length(word) = 13").select(
        F.col("word").alias("key"),
        F.col("n").alias("offset"),
        F.when(F.length("word") == 13, F.unhex(F.lit("00000001"))).alias("value8"),
    )
    return counted.unionByName(ends)


@query(
    "z08_restore_state",
    f"SELECT word AS key, CASE WHEN length(word) % 17 = 0 THEN NULL ELSE n END AS n, n AS applied FROM ({COUNT_SQL})",
)
def _(t):
    return words.restore_state(changelog(t)).withColumn("n", F.col("n").cast("bigint"))


# Counters that pass 2**63: one per customer and step, the highest offset last.
WIDE_SQL = """SELECT 'c' || c_custkey AS key, step, CASE WHEN c_custkey % 5 = 0 AND step = 3 THEN NULL
    ELSE 9223372036854775806::HUGEINT + step + c_custkey * (step % 2) END AS n FROM customer, (VALUES (1), (2), (3)) s(step)"""


def wide_changelog(t):
    rows = t.table("customer").select("c_custkey", F.explode(F.array(*[F.lit(i) for i in (1, 2, 3)])).alias("step"))
    n = F.lit(2**63 - 2).cast("decimal(38,0)") + F.col("step") + F.col("c_custkey") * (F.col("step") % 2)
    n = F.when((F.col("c_custkey") % 5 != 0) | (F.col("step") != 3), n.cast("decimal(20,0)"))
    rows = rows.select(F.concat(F.lit("c"), "c_custkey").alias("key"), F.col("step").cast("long").alias("offset"), n.alias("n"))
    return rows.select("key", "offset", encode_u64("n").alias("value8"))


@query(
    "z08_restore_state_u64",
    f"""SELECT key, any_value(n::VARCHAR) FILTER (step = 3) AS n, count(n) AS applied FROM ({WIDE_SQL}) GROUP BY key""",
)
def _(t):
    return words.restore_state(wide_changelog(t)).withColumn("n", F.col("n").cast("string"))


@query("n05_decode_u64_large", f"SELECT key, step::BIGINT AS \"offset\", n::VARCHAR AS n FROM ({WIDE_SQL})")
def _(t):
    return wide_changelog(t).select("key", "offset", decode_u64("value8").cast("string").alias("n"))


@query(
    "z08_restore_report",
    f"SELECT sum(n)::BIGINT AS applied, count(*) FILTER (length(word) % 17 <> 0) AS keys FROM ({COUNT_SQL})",
)
def _(t):
    return words.restore_report(changelog(t))


@query(
    "n08_encoded_lengths",
    """WITH v AS (SELECT price_cents AS n, count(*) AS c FROM v_ordn GROUP BY 1)
       SELECT CASE WHEN n < 128 THEN 1 WHEN n < 16384 THEN 2 WHEN n < 2097152 THEN 3 WHEN n < 268435456 THEN 4 ELSE 5 END::BIGINT AS varint,
              CASE WHEN 2 * n < 128 THEN 1 WHEN 2 * n < 16384 THEN 2 WHEN 2 * n < 2097152 THEN 3 WHEN 2 * n < 268435456 THEN 4 ELSE 5 END::BIGINT AS avro,
              CASE WHEN n = 0 THEN 0 ELSE 1 + CASE WHEN n < 128 THEN 1 WHEN n < 16384 THEN 2 WHEN n < 2097152 THEN 3 WHEN n < 268435456 THEN 4 ELSE 5 END END::BIGINT AS proto,
              sum(c)::BIGINT AS items FROM v GROUP BY ALL""",
)
def _(t):
    n = F.col("price_cents")
    return t.ordn_items.groupBy(
        varint_len(n).alias("varint"), avro_long_len(n).alias("avro"), proto_int_len(n).alias("proto")
    ).agg(F.count("*").alias("items"))
