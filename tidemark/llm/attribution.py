"""Token counts of fields or sections: encode a document once, map its tokens back to character spans, attribute them.

The bytes behind the ids of a byte-level vocabulary join up to the text, so their running sum gives the span of every
token, without a second encoding per section. Spans and sections are joined by position. A token within one section
is its own; one that crosses a boundary goes by a rule: ``majority`` gives it to the section with most of its characters
(the earlier one in a draw), ``first`` to the section of its first character. Tokens that touch no section count as
section -1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks
from .encoder import encoder

RULES = ("majority", "first")


def token_spans(text: str, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (code points) of tokens that stand for ``sizes`` bytes; parts of a character share its span."""
    ends = np.cumsum(sizes)
    starts = ends - sizes
    if text.isascii():
        return starts, ends
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    char = np.cumsum((raw & 0xC0) != 0x80) - 1
    return char[starts], char[ends - 1] + 1


def line_sections(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every line, its line feed included; a text without characters has no line."""
    ends, at = [], text.find("\n")
    while at >= 0:
        ends.append(at + 1)
        at = text.find("\n", at + 1)
    if text and (not ends or ends[-1] < len(text)):
        ends.append(len(text))
    found = np.array(ends, np.int64)
    return np.concatenate([[0], found[:-1]]).astype(np.int64) if ends else found, found


def attribute(starts: np.ndarray, ends: np.ndarray, lo: np.ndarray, hi: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Section of every token (-1: none), and whether it crosses a boundary. Sections are sorted and don't overlap."""
    first = np.searchsorted(hi, starts, "right")
    last = np.searchsorted(lo, ends, "left") - 1
    touched = first <= last
    home = np.where(touched, first, -1)
    if len(lo):
        at = np.minimum(first, len(lo) - 1)
        inside = touched & (first == last) & (lo[at] <= starts) & (ends <= hi[at])
    else:
        inside = touched
    crossing = touched & ~inside
    for k in np.flatnonzero(crossing):
        span = np.arange(first[k], last[k] + 1)
        if rule == "majority":
            shared = np.minimum(hi[span], ends[k]) - np.maximum(lo[span], starts[k])
            home[k] = span[int(np.argmax(shared))]
        elif lo[span[0]] > starts[k]:
            home[k] = -1
    return home, crossing


def attributed_counts(docs: DataFrame, tokenizer: str, sections: str | None = None, rule: str = "majority") -> DataFrame:
    """Rows ``doc_id, section, start, end, n_tokens, n_crossing`` for every section of every document.

    ``sections`` names a column ``array<struct<start, end>>`` of code points, end exclusive, sorted and apart; None
    takes the lines. ``n_crossing`` counts the tokens that were given to the section by the rule. A section without
    tokens has 0; tokens outside all sections are in one row with section -1, null start and end. A null or empty
    text has no tokens and no lines. Repeated rows are counted one by one.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        width = enc.token_bytes()
        for batch in batches:
            for part in blocks(batch, 1, 400):
                texts = [t or "" for t in part.column(1).to_pylist()]
                given = part.column(2).to_pylist() if sections else None
                cols: list[list] = [[] for _ in NAMES]
                for k, (doc_id, raw) in enumerate(zip(part.column(0).to_pylist(), enc.encode(texts), strict=True)):
                    starts, ends = token_spans(texts[k], width[np.frombuffer(raw, enc.dtype)])
                    if given is None:
                        lo, hi = line_sections(texts[k])
                    else:
                        lo = np.array([s["start"] for s in given[k] or []], np.int64)
                        hi = np.array([s["end"] for s in given[k] or []], np.int64)
                    home, crossing = attribute(starts, ends, lo, hi, rule)
                    counts = np.bincount(home + 1, minlength=len(lo) + 1).tolist()
                    crossed = np.bincount(home[crossing] + 1, minlength=len(lo) + 1).tolist()
                    skip = 0 if counts[0] else 1
                    n = len(lo) + 1 - skip
                    cols[0] += [doc_id] * n
                    cols[1] += range(skip - 1, len(lo))
                    cols[2] += ([] if skip else [None]) + lo.tolist()
                    cols[3] += ([] if skip else [None]) + hi.tolist()
                    cols[4] += counts[skip:]
                    cols[5] += crossed[skip:]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, KINDS, strict=True)], names=NAMES)

    cols = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text")]
    return docs.select(cols + ([F.col(sections)] if sections else [])).mapInArrow(run, SCHEMA)


SCHEMA = "doc_id long, section int, start long, end long, n_tokens long, n_crossing long"
NAMES = [f.split()[0] for f in SCHEMA.split(", ")]
KINDS = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
