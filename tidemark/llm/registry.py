"""The queries of this folder and their SQL. Tokenizer files are found through the public package, never copied."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import prepare
from . import ann, attribution, audit, jaccard, language, middle, mixing, packing, pages, quality, secrets, toxicity, wavelet
from .common import importable, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(importable(prepare(spark)), sf_dir)

    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


@query
def op1_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every 20th id."""
    return ann.search(table(spark, sf_dir, "embeddings"))


@query
def op2_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written to wavelet files and read back."""
    return wavelet.encode_and_read(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


@query
def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-copy components of all documents."""
    return jaccard.similar_components(table(spark, sf_dir, "documents"))


@query
def op4_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and the share of content lines of every document."""
    return quality.line_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_token_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document."""
    return attribution.attributed_counts(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return language.identify(table(spark, sf_dir, "documents"))


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return secrets.scan(table(spark, sf_dir, "documents"))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), cache=800_000)


@query
def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-the-middle forms of every document."""
    return middle.digests(table(spark, sf_dir, "documents"))


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order effects and Shapley values of five filters per language."""
    return audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op13_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return pages.main_text(table(spark, sf_dir, "pages"))


ORACLE |= {"op11_fill_in_middle": middle.SQL, "op12_filter_audit": audit.SQL}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
