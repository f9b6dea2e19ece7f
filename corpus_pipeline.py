"""From documents to packed sequences: toxicity, near copies, secrets, mixing, packing.

Each stage is a function of (spark, docs, sf_dir) on the rows its predecessor kept; between stages the rows are written
as Parquet below ``spark.checkpoint.dir`` and read again, so a lost executor costs the stage it runs in at most. All
stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import jaccard, mixing, packing, secrets, toxicity
from tidemark.llm.common import importable, table, unused
from tidemark.llm.registry import tokenizer
from tidemark.session import cut_lineage, prepare

# The stages share their executors, which keep the largest buffers of any of them: smaller batches than for one query.
BATCH = "2m"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go. Learned from the labelled rows of ``docs``; null texts stay."""
    importable(spark, BATCH)
    weights = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    score, predicted = unused(docs, "toxic_score"), unused(docs, "toxic_predicted")
    scored = toxicity.score(docs, weights, names=(score, predicted))
    return scored.where(F.col(predicted) == 0).select([F.col(f"`{c}`") for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: the one with the smallest id, null last, then hash of the text.

    A row goes only if its own text is a copy, whatever else its id has. Of rows with the same id and text one stays.
    Documents without words are no copies of anything and all stay.
    """
    importable(spark, BATCH)
    found = cut_lineage(jaccard.row_components(docs).where("n_shingles > 0"), "near-copies")
    row = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "mark")
    first = found.groupBy("component").agg(F.min(row).alias("first"))
    first = first.select(F.col("first.doc_id").alias("doc_id"), F.col("first.mark").alias("mark"))
    # Rows of one key have one text, so a key stays or goes as a whole.
    keys = found.groupBy("doc_id", "mark").count().alias("k")
    key = lambda a, b: F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.mark") == F.col(f"{b}.mark"))
    gone = cut_lineage(keys.join(first.alias("f"), key("k", "f"), "left_anti").select("doc_id", "mark"), "copies").alias("g")
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                         F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark")).alias("d")
    kept = marked.join(gone, key("d", "g"), "left_anti")
    again = cut_lineage(keys.where("count > 1").select("doc_id", "mark"), "repeated-rows").alias("r")
    if not again.isEmpty():
        once, some = (kept.alias("d").join(again, key("d", "r"), how) for how in ("left_anti", "left_semi"))
        # Which of them does not depend on what columns there are: the least hash of the row as text.
        one = F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row")
        kept = once.select("row").unionByName(some.groupBy("doc_id", "mark").agg(one).select("row"))
    return kept.select("row.*")


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret that is found is replaced by a mark; all documents stay."""
    importable(spark, BATCH)
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture of the sources by weight: what is taken of a document, once per repeat."""
    importable(spark, BATCH)
    return mixing.mixed_texts(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 tokens, one row per piece."""
    importable(spark, BATCH)
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("secret scans", hide_secrets),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack),
]

# Hashed n-grams, seeded blocks and token ids can't be expressed in SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents of a folder to the pieces of the packed sequences."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {}
