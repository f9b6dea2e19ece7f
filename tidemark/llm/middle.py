"""Fill-in-the-middle forms of whole texts, with the tokens of shared chunks counted once.

A rolling hash cuts every text into chunks at places that depend on the characters around them alone, so passages that
several texts share fall into the same chunks. A chunk that was seen before is recognised by its whole content, and
its summary (words that start in it, whether its first and last characters belong to words) is taken from a cache. The
summaries of a text combine to its number of tokens: a word that runs over a joint is counted in both chunks and taken
off once. Running counts tell in which chunk the wanted token starts; only that chunk is looked into.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORDS, blocks, mix64

STARTS = re.compile(r"(?:^|(?<=[\x20\x09-\x0D]))[^\x20\x09-\x0D]")
BLANK = frozenset(" \t\n\v\f\r")
MARKS = ("<P>", "<S>", "<M>")
WIDTH = 32  # characters that decide on a cut
SPAN = 1 << 20  # characters hashed at a time
GEAR = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).astype(np.uint32)


class Summary(NamedTuple):
    """Words that start in a chunk if a blank stands before it, and whether its ends belong to words."""

    words: int
    opens: bool
    closes: bool


def cuts(text: str, average: int = 1024, most: int = 8192) -> list[int]:
    """Ends of the chunks of a text, about ``average`` characters each and ``most`` at most; none for an empty text.

    The hash of a place is a sum of shifted values of its last 32 characters, found by doubling for a span at a time.
    """
    found: list[int] = []
    raw = text.encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(raw, "<u4")
    limit = np.uint32((1 << 32) // average)
    for at in range(0, len(points), SPAN):
        lead = min(at, WIDTH - 1)
        part = points[at - lead : at + SPAN]
        h = GEAR[(part ^ (part >> 8)) & 0xFF]
        step = 1
        while step < WIDTH:
            shifted = h.copy()
            shifted[step:] += h[:-step] << np.uint32(step)
            h = shifted
            step *= 2
        places = np.flatnonzero(h[lead:] < limit) + at + 1
        found += places[places >= WIDTH].tolist()
    ends, last = [], 0
    for end in [*found, len(points)]:
        while end - last > most:
            last += most
            ends.append(last)
        if end > last:
            ends.append(end)
            last = end
    return ends


class Chunks:
    """Summaries of chunks by their content, in two generations of at most ``size`` characters each."""

    def __init__(self, size: int = 16 << 20):
        self.size, self.held = size, 0
        self.new: dict[str, Summary] = {}
        self.old: dict[str, Summary] = {}
        self.looked = self.made = 0

    def summary(self, chunk: str) -> Summary:
        self.looked += 1
        found = self.new.get(chunk)
        if found is None:
            found = self.old.get(chunk)
            if found is None:
                self.made += 1
                found = Summary(len(WORDS.findall(chunk)), chunk[0] not in BLANK, chunk[-1] not in BLANK)
            if self.held > self.size:
                self.old, self.new, self.held = self.new, {}, 0
            self.new[chunk] = found
            self.held += len(chunk)
        return found


class Counted:
    """Tokens of one text: blanks and the word after them; blanks at the end are a token of their own."""

    def __init__(self, text: str, chunks: Chunks):
        self.text = text
        self.ends = cuts(text)
        self.before = [0]  # words that start before each chunk
        open_ = False
        start = 0
        self.joined = []  # whether the chunk goes on with a word of the one before
        for end in self.ends:
            s = chunks.summary(text[start:end])
            self.joined.append(open_ and s.opens)
            self.before.append(self.before[-1] + s.words - self.joined[-1])
            open_, start = s.closes, end
        self.words = self.before[-1]
        self.n = self.words + (bool(text) and not open_)

    def end_of(self, k: int) -> int:
        """Characters of the first ``k`` tokens."""
        if k <= 0:
            return 0
        if k > self.words:
            return len(self.text)
        c = int(np.searchsorted(self.before, k, "left")) - 1
        low = self.ends[c - 1] if c else 0
        wanted = k - self.before[c] + self.joined[c]
        for seen, m in enumerate(STARTS.finditer(self.text[low : self.ends[c]]), 1):
            if seen == wanted:
                return WORDS.match(self.text, low + m.start()).end()
        raise AssertionError("a chunk has fewer words than its summary says")


class Form(NamedTuple):
    """What a text becomes."""

    n: int
    form: str
    prefix: int | None
    middle: int | None
    output: str


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four unsigned 32-bit numbers that depend on the seed and the id; a null id counts as the text ''."""
    digest = sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[k : k + 4], "big") for k in (0, 4, 8, 12)]


def transform(doc_id: int | None, text: str, chunks: Chunks, seed: int, rate: int, spm: int) -> Form:
    """The form of one text: ``rate`` percent are rearranged, ``spm`` percent of these with the suffix first."""
    found = Counted(text, chunks)
    h = draws(doc_id, seed)
    if not text or any(m in text for m in MARKS) or h[2] % 100 >= rate:
        return Form(found.n, "plain", None, None, text)
    one, two = sorted(x % (found.n + 1) for x in h[:2])
    a, b = found.end_of(one), found.end_of(two)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < spm:
        return Form(found.n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}")
    return Form(found.n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}")


def restore(output: str, form: str) -> str:
    """The text behind an output. A mark can't begin in a part and end in the mark after it, so the first match is it."""
    if form == "plain":
        return output
    head, middle = output[3:].split("<M>", 1)
    if form == "psm":
        prefix, suffix = head.split("<S>", 1)
    else:
        suffix, prefix = head.split("<P>", 1)
    return prefix + middle + suffix


FIM = T.StructType([T.StructField(name, kind) for name, kind in [
    ("n", T.LongType()), ("form", T.StringType()), ("prefix_chars", T.LongType()), ("middle_chars", T.LongType()),
    ("output", T.StringType()), ("restored", T.StringType())]])


def fill_in_middle(docs: DataFrame, seed: int = 42, rate: int = 50, spm: int = 80, into: str = "fim") -> DataFrame:
    """All rows and columns of ``docs`` and a struct ``into``: tokens, form, cut sizes, output and the text rebuilt from it.

    A null text counts as empty and stays plain, as does one that holds a mark; cut sizes are null there. Rows with the
    same id and text get the same form; a null id draws like the text ''. An input column named ``into`` is replaced;
    other names are free. An empty table gives no rows.
    """
    docs = docs.drop(into)
    id_at, text_at = docs.columns.index("doc_id"), docs.columns.index("text")
    kind = pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
                      ("output", pa.string()), ("restored", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = Chunks()
        for batch in batches:
            for part in blocks(batch, text_at, 500):
                out = []
                for doc_id, text in zip(part.column(id_at).to_pylist(), part.column(text_at).to_pylist(), strict=True):
                    f = transform(doc_id, text or "", chunks, seed, rate, spm)
                    out.append((*f, restore(f.output, f.form)))
                cols = [pa.array([row[k] for row in out], field.type) for k, field in enumerate(kind)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.StructArray.from_arrays(cols, fields=list(kind))],
                                                 names=[*part.schema.names, into])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(into, FIM)]))


def digests(docs: DataFrame, seed: int = 42, rate: int = 50, spm: int = 80) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256`` of every document."""
    got = fill_in_middle(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), seed, rate, spm)
    return got.select("doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars",
                      F.sha2("fim.output", 256).alias("output_sha256"), F.sha2("fim.restored", 256).alias("restored_sha256"))


# The same rows with plain matches; an exact restoration has the digest of the text itself.
SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units FROM documents
), drawn AS (
  SELECT *, len(units) AS n, ('0x' || h[1:8])::BIGINT % (len(units) + 1) AS one, ('0x' || h[9:16])::BIGINT % (len(units) + 1) AS two,
    CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR ('0x' || h[17:24])::BIGINT % 100 >= 50 THEN 'plain'
         WHEN ('0x' || h[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM cut
), parts AS (
  SELECT doc_id, text, n, form, array_to_string(units[1:least(one, two)], '') AS prefix,
    array_to_string(units[least(one, two) + 1:greatest(one, two)], '') AS middle,
    array_to_string(units[greatest(one, two) + 1:], '') AS suffix FROM drawn
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
         ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""
