"""Quality by line sequence labelling: a linear-chain conditional random field marks lines as content or boilerplate.

The features of a line come from its own words and from whether it occurred earlier in the text; neighbours act through
the transition weights. Viterbi decoding labels all lines of a text; a document is retained when content lines hold
at least ``share`` of its words and the base rules hold.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORDS

SYMBOLS = re.compile(r"[#*$%&|<>]")
MARKS = re.compile(r"[!?#*$%&|<>=@{}\[\]\\^~_]")
UPPER = re.compile(r"[A-ZÀ-Þ]")
FEATURES = ("always", "repeated", "one word", "under five words", "marks in a tenth of its words", "marks in half of its words",
            "mostly capitals", "ends a sentence", "few distinct words", "long words", "digits in half of its words",
            "first line")


class Field(NamedTuple):
    """Weights of the features for the label boilerplate, and of the transitions [from, to] (0 content)."""

    emit: np.ndarray
    move: np.ndarray


def line_features(text: str) -> tuple[np.ndarray, np.ndarray, int]:
    """One row of 0/1 features and a word count for every line with a word; how many of them repeat an earlier one."""
    seen: set[str] = set()
    rows, sizes, repeated = [], [], 0
    for line in text.split("\n"):
        words = WORDS.findall(line)
        if not words:
            continue
        n, again = len(words), line in seen
        repeated += again
        seen.add(line)
        chars = sum(map(len, words))
        marked = len(MARKS.findall(line))
        rows.append((1, again, n == 1, n < 5, 10 * marked >= n, 2 * marked >= n, 2 * len(UPPER.findall(line)) > chars,
                     line.rstrip()[-1:] in ".!?:;", n > 9 and 2 * len(set(words)) < n, chars > 12 * n,
                     2 * sum(w.isdigit() for w in words) >= n, not sizes))
        sizes.append(n)
    return np.array(rows, float).reshape(-1, len(FEATURES)), np.array(sizes, np.int64), repeated


def viterbi(scores: np.ndarray, move: np.ndarray) -> np.ndarray:
    """The best labelling of one sequence; ``scores`` are those of label 1 against label 0. Ties go to content."""
    (m00, m01), (m10, m11) = move.tolist()
    back = []
    a, b = 0.0, 0.0
    for k, s in enumerate(scores.tolist()):
        if k:
            from0, from1 = a + m00, b + m10
            to0 = 0 if from0 >= from1 else 1
            one0, one1 = a + m01, b + m11
            to1 = 0 if one0 >= one1 else 1
            back.append((to0, to1))
            a, b = max(from0, from1), max(one0, one1) + s
        else:
            b = s
    out = np.zeros(len(scores), np.int8)
    if len(scores):
        label = 0 if a >= b else 1
        out[-1] = label
        for k in range(len(back) - 1, -1, -1):
            label = back[k][label]
            out[k] = label
    return out


def fit(sequences: list[tuple[np.ndarray, np.ndarray]], steps: int = 150, rate: float = 0.2, l2: float = 1e-3) -> Field:
    """Maximum likelihood by forward and backward sums over all sequences at once (Adam steps, fixed start)."""
    width = len(FEATURES)
    emit, move = np.zeros(width), np.zeros((2, 2))
    sequences = [s for s in sequences if len(s[1])]
    if not sequences:
        return Field(emit, move)
    longest, count = max(len(y) for _, y in sequences), len(sequences)
    x, y, on = np.zeros((count, longest, width)), np.zeros((count, longest), int), np.zeros((count, longest), bool)
    for k, (f, labels) in enumerate(sequences):
        x[k, : len(labels)], y[k, : len(labels)], on[k, : len(labels)] = f, labels, True
    total = on.sum()
    pairs = on[:, 1:]
    seen_emit = np.einsum("ktf,kt->f", x, y * on)
    seen_move = np.array([[((y[:, :-1] == i) & (y[:, 1:] == j) & pairs).sum() for j in (0, 1)] for i in (0, 1)], float)
    theta = np.zeros(width + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        emit, move = theta[:width], theta[width:].reshape(2, 2)
        s = np.stack([np.zeros(on.shape), x @ emit], -1)
        ahead, behind = np.zeros_like(s), np.zeros_like(s)
        ahead[:, 0] = s[:, 0]
        for t in range(1, longest):
            new = np.logaddexp.reduce(ahead[:, t - 1, :, None] + move, 1) + s[:, t]
            ahead[:, t] = np.where(on[:, t, None], new, ahead[:, t - 1])
        norm = np.logaddexp.reduce(ahead[:, -1], 1)
        for t in range(longest - 2, -1, -1):
            new = np.logaddexp.reduce(move + (s[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(on[:, t + 1, None], new, 0)
        p = np.exp(ahead + behind - norm[:, None, None])[:, :, 1] * on
        joint = np.exp(ahead[:, :-1, :, None] + move + (s + behind)[:, 1:, None, :] - norm[:, None, None, None])
        due_move = (joint * pairs[:, :, None, None]).sum((0, 1))
        grad = np.concatenate([seen_emit - np.einsum("ktf,kt->f", x, p), (seen_move - due_move).ravel()]) / total - l2 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Field(theta[:width], theta[width:].reshape(2, 2))


def learn(docs: DataFrame, labels: DataFrame, sample: int = 1500, window: int = 32) -> Field:
    """Weights from a bounded sample: at most ``sample`` labelled ids of either quality, those with the smallest hashes.

    Lines of documents of quality 0 count as boilerplate; of the others, lines that repeat an earlier one do. Lines go
    in windows of ``window``; all lines of a sampled text are used. Only features travel to the driver.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("q"))
    known = known.withColumn("h", F.xxhash64("doc_id"))
    picked = known.where("q > 0").orderBy("h", "doc_id").limit(sample).unionByName(
        known.where("q <= 0").orderBy("h", "doc_id").limit(sample))
    rows = docs.select("doc_id", "text").where("text is not null").join(picked, "doc_id")
    rows = rows.groupBy("doc_id", "h", "q").agg(F.min("text").alias("text"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.packbits(line_features(t)[0].astype(bool)).tobytes() for t in batch.column("text").to_pylist()]
            lines = [sum(1 for x in t.split("\n") if WORDS.search(x)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("h"), batch.column("q").cast(pa.int32()), pa.array(lines, pa.int32()), pa.array(found, pa.binary())],
                names=["h", "q", "lines", "bits"])

    sequences = []
    got = rows.mapInArrow(features, "h long, q int, lines int, bits binary").collect()
    for r in sorted(got, key=lambda r: r.h):
        x = np.unpackbits(np.frombuffer(r.bits, np.uint8), count=r.lines * len(FEATURES))
        x = x.reshape(r.lines, len(FEATURES)).astype(float)
        y = x[:, 1].astype(int) if r.q > 0 else np.ones(r.lines, int)
        sequences += [(x[a : a + window], y[a : a + window]) for a in range(0, r.lines, window)]
    return fit(sequences)


def measure(text: str | None, field: Field) -> tuple[int, int, int, int, int, int, float]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, content`` of one whole text."""
    text = text or ""
    words = WORDS.findall(text)
    n = len(words)
    repeat = 0
    if n > 3:
        h = np.fromiter(map(hash, words), np.int64, n).astype(np.uint64)
        triples = (h[:-2] * np.uint64(0x9E3779B97F4A7C15) + h[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + h[2:]
        _, place, times = np.unique(triples, return_inverse=True, return_counts=True)
        again = times[place] > 1
        covered = np.zeros(n, bool)
        for k in range(3):
            covered[k : n - 2 + k] |= again
        repeat = int(covered.sum())
    rows, sizes, repeated = line_features(text)
    labels = viterbi(rows @ field.emit, field.move)
    content = float(sizes[labels == 0].sum() / n) if n else 0.0
    return n, sum(map(len, words)), len(SYMBOLS.findall(text)), repeated, repeat, len(sizes), content


def assess(docs: DataFrame, field: Field, share: float = 0.5) -> DataFrame:
    """One row per document: the base counts, ``base_failed``, ``kept``, and ``n_lines`` and ``content_share``.

    A null or empty text has no words and fails the base. Repeated rows are assessed one by one; a null id stays.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [measure(t, field) for t in batch.column("text").to_pylist()]
            cols = [pa.array([g[k] for g in got], pa.int64() if k < 6 else pa.float64()) for k in range(7)]
            n, repeat = np.array([g[0] for g in got]), np.array([g[4] for g in got])
            failed = (n < 50) | (100 * repeat > 50 * n)
            kept = ~failed & (np.array([g[6] for g in got]) >= share)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cols[:5], pa.array(failed, pa.bool_()),
                                              pa.array(kept, pa.bool_()), *cols[5:]], names=NAMES)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, n_lines long, content_share double")
NAMES = [f.split()[0] for f in SCHEMA.split(", ")]


def line_quality(docs: DataFrame, labels: DataFrame, sample: int = 1500) -> DataFrame:
    """Learn the field from labelled documents and assess all documents."""
    return assess(docs, learn(docs, labels, sample))
