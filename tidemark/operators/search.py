"""A stored inverted index with block maxima, and best-k search that reads the query's postings only.

Documents are numbered in scan order and cut into ranges of up to 1024. The postings of a term in a range are one row:
its documents, and the two numbers that bound every score in it (highest frequency, shortest length). A posting is one
number of the place in the range and the frequency; id and length of a document are stored once, with the range. The rows
are sorted by bucket, term and range, so a frequent term spreads over files, and a query prunes folders by bucket and row
groups by term. A search sums the bounds of its terms per range, scores the most promising ranges first and then only
those ranges whose bound reaches the k-th score found.
"""

from __future__ import annotations

from functools import reduce
from zlib import crc32

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.binding import bound, with_once
from ..functions.text import analyze_text
from .words import B, K1, query_terms

RANGE_BITS = 10
PLACE = (1 << RANGE_BITS) - 1
TF_BITS = 32  # the place of a posting is above its frequency
ALL = ""  # no analyzed term is empty, so this one stands for every document


def term_counts(terms: Column) -> Column:
    """Array of ``term, tf`` of an array of terms, by one sort."""

    def runs(s: Column) -> Column:
        place = F.when(F.size(s) > 0, F.sequence(F.lit(0), F.size(s) - 1)).otherwise(F.array().cast("array<int>"))
        starts = F.filter(place, lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return bound(starts, lambda st: F.transform(st, lambda at, k: F.struct(
            F.get(s, at).alias("term"), (F.coalesce(F.get(st, k + 1), F.size(s)) - at).alias("tf"))))

    return bound(F.sort_array(terms), runs)


def build_index(docs: DataFrame, path: str, ident: str = "doc_id", buckets: int = 64) -> None:
    """Write the index of ``text`` below ``path``: tables ``postings``, ``terms`` and ``about``.

    The texts are read and analyzed once and never shuffled. A row of ``docs`` is a document, also where ids repeat; a
    null text is a document without terms and without a length. A group of the shuffle holds one term of one range.
    """
    spark = docs.sparkSession
    numbered = docs.select(F.col(ident).alias("ident"), "text", F.monotonically_increasing_id().alias("row"))
    analyzed = with_once(numbered, "ws", analyze_text("text"))
    every = F.array(F.struct(F.lit(ALL).alias("term"), F.lit(0).alias("tf")))
    found = term_counts(F.coalesce("ws", F.array().cast("array<string>")))
    counted = analyzed.select("ident", "row", F.size("ws").alias("len"), F.inline(F.concat(every, found)))
    place = F.col("row").bitwiseAND(PLACE)
    posting = F.shiftleft(place, TF_BITS).bitwiseOR(F.col("tf").cast("long"))
    blocks = counted.groupBy("term", F.shiftright("row", RANGE_BITS).alias("range")).agg(
        F.sort_array(F.collect_list(F.when(F.col("term") != ALL, posting))).alias("docs"),
        F.sort_array(F.collect_list(F.when(F.col("term") == ALL, F.struct(place.alias("place"), "ident", "len")))).alias("about"),
        F.max("tf").alias("max_tf"), F.min("len").alias("min_len"))
    # Counts follow from the lists, lengths are summed for the whole range only; neither is shuffled with the postings.
    known = F.filter("about", lambda d: d["len"].isNotNull())
    blocks = blocks.select(
        "*", F.greatest(F.size("docs"), F.size("about")).cast("long").alias("df"), F.size(known).cast("long").alias("known"),
        F.aggregate(known, F.lit(0).cast("long"), lambda total, d: total + d["len"]).alias("sum_len"))
    blocks = blocks.withColumn("bucket", (F.crc32(F.col("term").cast("binary")) % buckets).cast("int"))
    order = ["bucket", "term", "range"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks.repartitionByRange(parts, *order).sortWithinPartitions(*order).write.partitionBy("bucket").parquet(f"{path}/postings")
    spark.range(1).select(F.lit(buckets).alias("buckets"), F.lit(docs.schema[ident].dataType.simpleString()).alias("ident")).write.parquet(
        f"{path}/about")
    stored = read_postings(spark, path)
    terms = stored.groupBy("bucket", "term").agg(F.sum("df").alias("df"), F.sum("known").alias("known"), F.sum("sum_len").alias("sum_len"))
    terms.repartitionByRange(parts, "bucket", "term").sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(
        f"{path}/terms")


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    """The blocks of an index; also where it has none."""
    ident = spark.read.parquet(f"{path}/about").first().ident
    return spark.read.schema(
        f"term string, range long, docs array<bigint>, about array<struct<place:bigint,ident:{ident},len:int>>, df long, max_tf int, "
        "min_len int, known long, sum_len long, bucket int").parquet(f"{path}/postings")


def of_terms(table: DataFrame, terms: list[str], buckets: int) -> DataFrame:
    """Rows of some terms: folders are pruned by bucket, row groups by term."""
    wanted = sorted({crc32(t.encode()) % buckets for t in terms})
    return table.filter(F.col("bucket").isin(wanted) & F.col("term").isin(terms))


class Search:
    """One query over a stored index; the figures of its terms are read once, a row per term."""

    def __init__(self, spark: SparkSession, path: str, query: str):
        self.buckets = spark.read.parquet(f"{path}/about").first().buckets
        self.terms = query_terms(query)
        terms = spark.read.schema("term string, df long, known long, sum_len long, bucket int").parquet(f"{path}/terms")
        known = of_terms(terms, [*self.terms, ALL], self.buckets).collect()
        figures = {r.term: r for r in known}
        corpus = figures.pop(ALL, None)
        self.n = corpus.df if corpus else 0
        self.avg_len = corpus.sum_len / corpus.known if corpus and corpus.known else 0.0
        self.df = {t: figures[t].df for t in self.terms if t in figures}
        self.postings = of_terms(read_postings(spark, path), list(self.df), self.buckets)
        self.documents = of_terms(read_postings(spark, path), [ALL], self.buckets)

    def _weight(self, tf: Column, length: Column) -> Column:
        """Score of the row's term at a frequency and a length, rounded before it is added to others."""
        n = F.lit(self.n)
        df = reduce(lambda c, t: c.when(F.col("term") == t, F.lit(self.df[t])), self.df, F.when(F.lit(False), F.lit(0).cast("long")))
        idf = F.log(1 + (n - df + 0.5) / (df + 0.5))
        norm = tf + K1 * (1 - B + B * length / F.lit(self.avg_len))
        return F.round(idf * tf * (K1 + 1) / norm, 9).cast("decimal(28,9)")

    def bounds(self) -> DataFrame:
        """``range, most``: what no document of a range can exceed. Reads block heads, not the lists."""
        return self.postings.groupBy("range").agg(F.sum(self._weight(F.col("max_tf"), F.col("min_len"))).alias("most"))

    def scores(self, ranges: DataFrame | None = None) -> DataFrame:
        """Scores of all documents of some ranges that hold a term."""
        postings, documents = self.postings, self.documents
        if ranges is not None:
            postings, documents = (b.join(ranges.select("range"), "range", "left_semi") for b in (postings, documents))
        row = F.shiftleft("range", RANGE_BITS)
        hits = postings.select("term", row.alias("first"), F.explode("docs").alias("posting")).select(
            "term", (F.col("first") + F.shiftright("posting", TF_BITS)).alias("row"),
            F.col("posting").bitwiseAND((1 << TF_BITS) - 1).cast("int").alias("tf"))
        about = documents.select(row.alias("first"), F.inline("about")).select(
            (F.col("first") + F.col("place")).alias("row"), "ident", "len")
        total = F.sum(self._weight(F.col("tf"), F.col("len")))
        return hits.join(about, "row").groupBy("row").agg(F.first("ident").alias("ident"), F.round(total, 6).cast("double").alias("score"))

    def promising(self, k: int) -> DataFrame:
        """Ranges that can hold one of the best ``k``: the bound reaches the k-th score of the k ranges with the highest bounds."""
        bounds = self.bounds()
        first = bounds.orderBy(F.desc("most"), "range").limit(k)  # each holds a document at least
        found = self.scores(first).select("score").orderBy(F.desc("score")).limit(k).agg(F.count("*").alias("n"), F.min("score").alias("s"))
        floor = found.first()
        # Bounds have nine digits, scores six.
        return bounds if floor.n < k else bounds.filter(F.col("most").cast("double") + 1e-6 >= F.lit(floor.s))


def match_index(spark: SparkSession, path: str, query: str, k: int, ident: str = "doc_id") -> DataFrame:
    """Best k documents by BM25 for any term of the query, ties by id; the rows of ``words.match_top_k``."""
    search = Search(spark, path, query)
    scored = search.scores(search.promising(k)) if k > 0 else search.scores().limit(0)
    return scored.select(F.col("ident").alias(ident), "score").orderBy(F.desc("score"), F.asc(ident)).limit(k)
