"""Language identification by cross-parsing entropy.

Per language a suffix automaton holds a bounded reference text. A document is parsed into the longest phrases that
occur in the reference; the fewer phrases, the closer the language. A count of c phrases over n characters against a
reference of m characters stands for c * log2(m) / n bits per character, and the language with fewest bits wins.

Texts are folded to lower case with digits and blanks joined, and parsed in blocks of ``BLOCK`` characters; a phrase ends
with its block. All blocks and languages of a batch advance together, one character a step, through one table.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks, fold

BLOCK = 1024
BLANKS, DIGITS = re.compile(r"\s+"), re.compile(r"\d+")


def folded(text: str) -> str:
    return DIGITS.sub("0", BLANKS.sub(" ", text.lower()))


class Automaton:
    """Suffix automaton of a text: forward transitions only, as dicts per state; state 0 is the start."""

    def __init__(self, text: str):
        self.next: list[dict[str, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in text:
            state = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = state
                p = link[p]
            if p >= 0:
                q = self.next[p][c]
                if length[p] + 1 == length[q]:
                    link[state] = q
                else:
                    clone = len(self.next)
                    self.next.append(dict(self.next[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and self.next[p].get(c) == q:
                        self.next[p][c] = clone
                        p = link[p]
                    link[q] = link[state] = clone
            last = state

    def phrases(self, text: str) -> int:
        """Number of longest-match phrases of a text; a character that never occurs is one of its own."""
        state = count = 0
        for c in text:
            to = self.next[state].get(c)
            if to is None or state == 0:
                count += 1
                to = self.next[0].get(c, 0)
            state = to
        return count


class Model(NamedTuple):
    """Reference texts, in the order of ``langs``."""

    langs: tuple[str, ...]
    texts: tuple[str, ...]


_TABLES: dict[Model, tuple] = {}


def tables(model: Model) -> tuple[np.ndarray, np.ndarray, dict[int, int], int]:
    """One transition table for all languages, built once per worker: entry = next row * 2 + (a phrase began)."""
    if model not in _TABLES:
        _TABLES.clear()
        letters = [c for c, _ in Counter("".join(model.texts)).most_common()]
        codes = {ord(c): k + 1 for k, c in enumerate(letters)}  # 0 stands for anything else
        width = len(letters) + 1
        parts, roots, base = [], [], 0
        for text in model.texts:
            own = Automaton(text).next
            table = np.empty((len(own), width), np.int64)
            first = np.zeros(width, np.int64)
            for c, to in own[0].items():
                first[codes[ord(c)]] = to
            table[:] = (first + base) * width * 2 + 1
            for state, edges in enumerate(own[1:], 1):
                for c, to in edges.items():
                    table[state, codes[ord(c)]] = (to + base) * width * 2
            parts.append(table.ravel())
            roots.append(base * width)
            base += len(own)
        kind = np.int32 if base * width * 2 < 1 << 31 else np.int64
        _TABLES[model] = np.concatenate(parts).astype(kind), np.array(roots, kind), codes, width
    return _TABLES[model]


def parse_counts(texts: list[str], model: Model) -> np.ndarray:
    """Phrases of each (folded) text against each language."""
    table, roots, codes, _ = tables(model)
    lengths = np.array([len(t) for t in texts], np.int64)
    raw = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    top = max(codes, default=0) + 1
    lookup = np.zeros(top + 1, np.int16)
    for c, k in codes.items():
        lookup[c] = k
    chars = lookup[np.minimum(raw, top)]
    starts = np.cumsum(lengths) - lengths
    blocks = -(-lengths // BLOCK)
    owner = np.repeat(np.arange(len(texts)), blocks)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    at, size = starts[owner] + nth * BLOCK, np.minimum(BLOCK, lengths[owner] - nth * BLOCK)
    order = np.argsort(-size, kind="stable")
    at, size, owner = at[order], size[order], owner[order]
    counts = np.zeros((len(roots), len(owner)), np.int32)
    state = np.repeat(roots[:, None], len(owner), 1)
    active = np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), "left")
    for step, n in enumerate(active.tolist()):
        went = table[state[:, :n] + chars[at[:n] + step]]
        counts[:, :n] += went & 1
        state[:, :n] = went >> 1
    out = np.zeros((len(texts), len(roots)), np.int64)
    for k in range(len(roots)):
        out[:, k] = np.bincount(owner, counts[k], len(texts)).astype(np.int64)
    return out


def bits(counts: np.ndarray, texts: list[str], model: Model) -> np.ndarray:
    """Bits per character of each text under each language."""
    weight = np.log2(np.array([max(2, len(t)) for t in model.texts]))
    return counts * weight / np.maximum(1, np.array([len(t) for t in texts]))[:, None]


def learn(docs: DataFrame, rows: int = 400, chars: int = 48_000) -> Model:
    """Reference texts from at most ``rows`` ids per language, ``chars`` folded characters in all of them together.

    Rows with a null id, language or text and those of the held-out fold are left out. The ids are those with the
    smallest hashes, ranked in salted groups first, without their texts; an id with several texts has the smallest.
    Each text gives the same share, from a place in the whole text that the hash of its id sets, before what is missing
    is filled up from the longer ones. Of a text of more than ``chars`` characters a window from such a place is fetched.
    """
    ids = docs.where("lang is not null and text is not null and doc_id is not null").where(fold(F.col("doc_id"), 3) != 1)
    ids = ids.select("doc_id", "lang").distinct().withColumn("h", F.xxhash64("doc_id"))
    for group in (["lang", F.pmod("h", F.lit(256))], ["lang"]):
        ranked = Window.partitionBy(*group).orderBy("h", "doc_id")
        ids = ids.withColumn("at", F.row_number().over(ranked)).where(F.col("at") <= rows)
    texts = docs.select("doc_id", "lang", "text").where("text is not null").join(ids, ["doc_id", "lang"])
    texts = texts.groupBy("lang", "at", "doc_id").agg(F.min("text").alias("text"))
    begin, place = (F.pmod(F.xxhash64("doc_id", F.lit(k)), F.lit(1 << 31)) for k in (1, 2))
    begin = F.pmod(begin, F.greatest(F.length("text") - chars + 1, F.lit(1))).cast("int")
    texts = texts.select("lang", "at", F.substring("text", begin + 1, F.lit(chars)).alias("text"), place.alias("place"))
    by: dict[str, list[tuple[str, int]]] = {}
    for r in sorted(texts.collect(), key=lambda r: (r.lang, r.at)):
        by.setdefault(r.lang, []).append((folded(r.text), r.place))
    langs = tuple(sorted(by))
    return Model(langs, tuple(reference(by[k], chars) for k in langs))


def reference(texts: list[tuple[str, int]], chars: int) -> str:
    """The shares of all texts, each from its place modulo the places there are, then what the shares leave."""
    share = -(-chars // max(1, len(texts)))
    starts = [place % max(1, len(t) - share + 1) for t, place in texts]
    head = "".join(t[a : a + share] for (t, _), a in zip(texts, starts, strict=True))
    rest = "".join(t[:a] + t[a + share :] for (t, _), a in zip(texts, starts, strict=True))
    return (head + rest)[:chars]


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row, from its whole text alone.

    ``score`` is the share of the runner-up in the bits of the two best languages: 0.5 for a draw, 1 where no other
    language was learned. Ties go to the language first by code point. A text that is null or has no letter, and
    every text where nothing was learned, is ``und`` with score 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                texts = part.column("text").to_pylist()
                able = [k for k, t in enumerate(texts) if t and model.langs and any(map(str.isalpha, t))]
                names, scores = np.full(len(texts), "und", object), np.zeros(len(texts))
                if able:
                    own = [folded(texts[k]) for k in able]
                    cost = bits(parse_counts(own, model), own, model)
                    best = cost.argmin(1)
                    names[able] = np.array(model.langs, object)[best]
                    two = np.sort(np.concatenate([cost, np.full((len(own), 1), np.inf)], 1), 1)[:, :2]
                    scores[able] = np.where(np.isinf(two[:, 1]), 1.0, two[:, 1] / np.maximum(two.sum(1), 1e-12))
                    scores[able] = np.where(np.isnan(scores[able]), 1.0, scores[able])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(list(names), pa.string()), pa.array(scores)],
                    names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, rows: int = 400, chars: int = 48_000) -> DataFrame:
    """Learn from the labelled rows outside the held-out fold and predict all rows."""
    return predict(docs, learn(docs, rows, chars))
