"""Word counts, their changelog and search over documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.binary import decode_u64
from ..functions.binding import with_once
from ..functions.text import analyze_literal, analyze_text, tokenize
from ..session import cut_lineage
from .running import CHUNK_BITS, PLACES, running


def words(docs: DataFrame) -> DataFrame:
    """One row per token with its place in the log."""
    keep = [c for c in ("partition", "offset") if c in docs.columns]
    return docs.select(*keep, F.posexplode(tokenize("text")).alias("pos", "word"))


def word_count(docs: DataFrame) -> DataFrame:
    """Occurrences per token; a partial count runs before the shuffle."""
    return docs.select(F.explode(tokenize("text")).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def top_n_words(counts: DataFrame, n: int) -> DataFrame:
    """Highest counts, ties by word in byte order, with rank. The rank runs over n rows."""
    top = counts.orderBy(F.desc("n"), F.asc("word")).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), F.asc("word"))).cast("long"))


def word_changelog(docs: DataFrame, bits: int = CHUNK_BITS) -> DataFrame:
    """One row per occurrence with the running count of its word in log order.

    Log order is partition, then offset, then position. A frequent word is cut
    into chunks of offsets, so it never has to be sorted by one task. Chunks of
    few offsets would cost a total and a head for nearly every rare word in each.
    """
    return running(
        words(docs), ["word"], ["offset", "pos"], {"n": ("count", None)}, lead=["partition"], bits=bits, span=PLACES
    )


def restore_state(changelog: DataFrame) -> DataFrame:
    """Counters rebuilt from a changelog: the last valid record per key, keys that end deleted left out.

    Null and empty keys and values of a wrong length are skipped, an empty
    value deletes. ``applied`` counts the records that set a value.
    """
    rows = changelog.filter("key IS NOT NULL AND key <> ''").select(
        "key", "offset", F.coalesce(F.octet_length("value8"), F.lit(0)).alias("size"), decode_u64("value8").alias("n")
    )
    valid = rows.filter("size IN (0, 8)")  # eight bytes are always a number; asking it would decode them once more
    # Numbers only, so that the records are hashed on their way in; a struct in the buffer would have them sorted by key.
    return valid.groupBy("key").agg(F.max_by("n", "offset").alias("n"), F.count("n").alias("applied"))


def seeded_word_count(docs: DataFrame, counters: DataFrame) -> DataFrame:
    """Word counts that go on from restored ``counters`` (``key, n``, null where deleted).

    For streams, pass the restored table as a stream too: a counter is then one more input row of its word, read once
    per checkpoint. Sums do not depend on order, so it does not matter whether new documents come before the counters,
    and the state stays in the JVM and combines before the shuffle, which a state processor per word would not.
    """
    before = counters.filter("n IS NOT NULL").select(F.col("key").alias("word"), F.col("n").cast("bigint").alias("n"))
    new = docs.select(F.explode(tokenize("text")).alias("word"), F.lit(1).cast("bigint").alias("n"))
    return new.unionByName(before).groupBy("word").agg(F.sum("n").alias("n"))


def restore_report(changelog: DataFrame) -> DataFrame:
    """Records applied and keys alive after the rebuild."""
    return restore_state(changelog).agg(
        F.coalesce(F.sum("applied"), F.lit(0)).alias("applied"), F.count("n").alias("keys")
    )


# Parameters of the BM25 score.
K1, B = 1.2, 0.75


def query_terms(query: str) -> list[str]:
    """Distinct terms of a query text by the analyzer of the documents; the text is a parameter, not data."""
    return list(dict.fromkeys(analyze_literal(query)))


def match_top_k(docs: DataFrame, query: str, k: int, ident: str = "doc_id") -> DataFrame:
    """Best k documents by BM25 for any term of the query, ties by id.

    Term frequencies and lengths are taken per document without exploding the
    text; the corpus figures are one row, read as a scalar subquery.
    """
    terms = query_terms(query)

    def occurrences(term: str) -> Column:
        return F.size("ws") - F.size(F.array_remove("ws", term))

    analyzed = with_once(docs.select(ident, "text"), "ws", analyze_text("text"))
    freq = analyzed.select(ident, F.size("ws").alias("len"), *[occurrences(t).alias(f"tf{i}") for i, t in enumerate(terms)])
    # The texts are read once; what the score needs is a few numbers per document.
    freq = cut_lineage(freq, "term-counts")
    corpus = freq.agg(
        F.count("*").alias("n"),
        F.avg("len").alias("avg_len"),
        *[F.count_if(F.col(f"tf{i}") > 0).alias(f"df{i}") for i in range(len(terms))],
    )
    figures = corpus.select(F.struct("*").alias("c")).scalar()
    scored = freq.filter(" OR ".join(f"tf{i} > 0" for i in range(len(terms)))).withColumn("c", figures)
    total = F.lit(0).cast("decimal(28,9)")
    for i in range(len(terms)):
        tf, df = F.col(f"tf{i}"), F.col(f"c.df{i}")
        idf = F.log(1 + (F.col("c.n") - df + 0.5) / (df + 0.5))
        norm = tf + K1 * (1 - B + B * F.col("len") / F.col("c.avg_len"))
        # Terms are rounded before they are added, so the order of the sum cannot show.
        total = total + F.round(idf * tf * (K1 + 1) / norm, 9).cast("decimal(28,9)")
    score = F.round(total, 6).cast("double")
    return scored.select(ident, score.alias("score")).orderBy(F.desc("score"), F.asc(ident)).limit(k)
