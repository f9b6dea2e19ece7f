"""Toxicity scores by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are its distinct words, pairs of neighbours and pairs with one word between them, hashed to
``2 ** bits`` places. The learner keeps a rate per coordinate and an L1 threshold, so most weights are exactly zero;
the rest are shipped with the scoring function, at most ``2 ** bits`` of them whatever the corpus.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fold, mix64, release, trim

LETTERS = re.compile(r"\w+")
KINDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


class Weights(NamedTuple):
    """The non-zero weights, their places, and the bias. ``bits`` is the size of the hash space."""

    places: np.ndarray
    values: np.ndarray
    bias: float
    bits: int


def places(text: str | None, bits: int) -> np.ndarray:
    """Hash places of all features of a text, with repeats."""
    words = LETTERS.findall((text or "").lower())
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    pairs = h[:-1] * KINDS[1] + h[1:]
    skips = h[:-2] * KINDS[2] + h[2:]
    return (mix64(np.concatenate([h, pairs + KINDS[1], skips + KINDS[2]])) >> np.uint64(64 - bits)).astype(np.int64)


def packed(found: np.ndarray) -> bytes:
    """Distinct places as compressed distances, less than half of their size."""
    return zlib.compress(np.diff(np.unique(found), prepend=0).astype("<u4").tobytes(), 1)


def unpacked(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(raw), "<u4"), dtype=np.uint32)


def fit(examples: list[tuple[np.ndarray, int]], bits: int, epochs: int = 8, alpha: float = 1.5, beta: float = 1.0,
        l1: float = 8.0, l2: float = 0.02) -> Weights:
    """FTRL-proximal over examples of distinct places and a label, in the given order, ``epochs`` times.

    With ``l1`` at least ``epochs`` a feature of a single example keeps the weight zero.
    """
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    share = np.mean([y for _, y in examples]) if examples else 0.0
    # The bias is free of L1 and starts at the log odds of the labels.
    bias, bias_n = float(np.log((share + 1e-3) / (1 - share + 1e-3))), 1.0

    def weight(zs: np.ndarray, ns: np.ndarray) -> np.ndarray:
        shrunk = np.sign(zs) * np.maximum(np.abs(zs) - l1, 0)
        return -shrunk / ((beta + np.sqrt(ns)) / alpha + l2)

    for _ in range(epochs):
        for at, y in examples:
            zs, ns = z[at], n[at]
            w = weight(zs, ns)
            g = 1 / (1 + np.exp(-np.clip(bias + w.sum(), -35, 35))) - y
            z[at] = zs + g - (np.sqrt(ns + g * g) - np.sqrt(ns)) / alpha * w
            n[at] = ns + g * g
            bias_n += g * g
            bias -= 0.1 * g / np.sqrt(bias_n)
    used = np.flatnonzero(np.abs(z) > l1)
    return Weights(used, weight(z[used], n[used]), bias, bits)


def learn(docs: DataFrame, labels: DataFrame, sample: int = 12_000, bits: int = 20) -> Weights:
    """Weights from a bounded sample: the ``sample`` labelled ids with the smallest hashes outside the held-out fold.

    An id with several labels counts as toxic if one of them says so, an id with several texts has the smallest.
    Rows without id, label or text are left out. Only hashed places travel to the driver.
    """
    known = labels.where("doc_id is not null and toxic is not null").where(fold(F.col("doc_id"), 4) != 2)
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("y"))
    known = known.select("doc_id", "y", F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id").limit(sample)
    # At most ``sample`` rows of three numbers, so the texts stay where they are.
    rows = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(known), "doc_id")
    rows = rows.groupBy("doc_id", "h", "y").agg(F.min("text").alias("text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [packed(places(t, bits)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("h"), batch.column("y"), pa.array(found, pa.binary())],
                names=["doc_id", "h", "y", "places"])

    # In small pieces, of which the driver's JVM holds a few at a time.
    found = rows.mapInArrow(hashed, "doc_id long, h long, y int, places binary").repartition(64)
    got = sorted(found.collect(), key=lambda r: (r.h, r.doc_id))
    examples = [(unpacked(r.places), r.y) for r in got]
    del got
    weights = fit(examples, bits)
    del examples
    trim()  # the driver goes on with other work
    return weights


def score(docs: DataFrame, weights: Weights, threshold: float = 0.3, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """All rows and columns of ``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on), or other ``names``.

    Only ``text`` is looked at; a null counts as empty and gets the score of the bias. Columns of ``docs`` with these
    names are replaced.
    """
    docs = docs.drop(*names)
    at = docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        table = np.zeros(1 << weights.bits)
        table[weights.places] = weights.values
        for batch in batches:
            out = []
            for text in batch.column(at).to_pylist():
                found = places(text, weights.bits)
                found = np.unique(found[table[found] != 0])
                out.append(1 / (1 + np.exp(-np.clip(weights.bias + table[found].sum(), -35, 35))))
            scores = np.array(out, float)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                names=[*batch.schema.names, *names])

    return docs.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = 12_000) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document; an empty table gives no rows.

    ``held_out`` marks the fold that is never learned from; a null id is in the fold of the text ''. Without labelled
    rows every score is that of no evidence, below 0.3.
    """
    scored = score(docs.select("doc_id", "text"), learn(docs, labels, sample))
    return scored.select(F.col("doc_id").cast("long").alias("doc_id"), (fold(F.col("doc_id"), 4) == 2).alias("held_out"),
                         "score", "predicted")
