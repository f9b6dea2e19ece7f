"""Best-fit packing of documents into token sequences, improved by swaps between underfull ones.

Documents are encoded once and cut into pieces of at most ``size`` tokens; the table of pieces (no ids, no text) is
written to the shared folder. Pieces are dealt to buckets of about ``bucket`` pieces by a hash that holds a running
number, so that no source, id or group of copies can fill one. Each bucket is packed best-fit decreasing, then by
local search. Sequences that stay underfull are opened again and packed together, with the leftovers of other
buckets, until one bucket holds all that is left.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .encoder import encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, salt long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pieces(docs: DataFrame, tokenizer: str, end_id: int, size: int, cache: int = 300_000) -> DataFrame:
    """One row per piece of at most ``size`` ids of every document (end id included)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, seen = encoder(tokenizer, cache), 0
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(ids), 400):
                rows = []
                for doc_id, raw in zip(ids[at : at + 400], enc.encode(texts[at : at + 400]), strict=True):
                    wide = np.frombuffer(raw, enc.dtype).astype("<u4").tobytes() + end
                    for k, a in enumerate(range(0, len(wide), 4 * size)):
                        part = wide[a : a + 4 * size]
                        rows.append((doc_id, k, a // 4, len(part) // 4, zlib.crc32(part), seen))
                        seen += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), KINDS, strict=True)], names=NAMES)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES)


NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "salt"]
KINDS = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Best fit, longest first: every bin is a list of positions in ``lengths``."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []  # (free, bin), sorted
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[i]
        at = bisect_left(room, (n, -1))
        if at == len(room):
            b = len(bins)
            bins.append([i])
            free = size - n
        else:
            free, b = room.pop(at)
            bins[b].append(i)
            free -= n
        if free:
            insort(room, (free, b))
    return bins


def local_search(bins: list[list[int]], lengths: list[int], size: int) -> list[list[int]]:
    """Empty the least filled bin into the room of the others, as long as that can succeed.

    A step takes tokens out of that bin: by moving a document, by exchanging one for a shorter one of another bin,
    or two for a shorter one. Of the steps that fit the one that carries most tokens is taken; the target ends
    fuller than the source was or the source shrinks, and the sum of squared fills rises with every step. The
    search ends when the free room of all others is below what the bin holds, or no step is left.
    """
    n = np.asarray(lengths, np.int64)
    bins = [list(b) for b in bins if b]
    home = np.empty(len(n), np.int64)
    for k, b in enumerate(bins):
        home[b] = k
    fill = np.array([n[b].sum() for b in bins], np.int64)
    alive = np.ones(len(bins), bool)
    while alive.sum() > 1:
        low = int(np.flatnonzero(alive)[np.argmin(fill[alive])])
        free = np.where(alive, size - fill, 0)
        free[low] = 0
        if free.sum() < fill[low]:
            break
        while fill[low]:
            free = np.where(alive, size - fill, 0)
            free[low] = 0
            own = sorted(bins[low], key=lambda i: -n[i])
            best = (0, None, None, None)
            roomy = int(free.max())
            for i in own:  # move
                if n[i] <= roomy and n[i] > best[0]:
                    fits = np.flatnonzero(free >= n[i])
                    best = (int(n[i]), [i], None, int(fits[np.argmin(free[fits])]))
            others = np.flatnonzero((free[home] > 0) & (home != low))
            if len(others):
                give, space = n[others], free[home[others]]
                takes = [[i] for i in own] + [[i, j] for x, i in enumerate(own) for j in own[x + 1 :]]
                for group in takes:  # one or two for one
                    gain = n[group].sum() - give
                    ok = (gain > 0) & (gain <= space) & (fill[home[others]] + gain > fill[low])
                    if ok.any():
                        at = int(np.argmax(np.where(ok, gain, 0)))
                        if gain[at] > best[0]:
                            best = (int(gain[at]), group, int(others[at]), int(home[others[at]]))
            gain, group, back, to = best
            if not gain:
                break
            bins[low] = [i for i in bins[low] if i not in group] + ([back] if back is not None else [])
            bins[to] = [i for i in bins[to] if i != back] + list(group)
            home[list(group)] = to
            if back is not None:
                home[back] = low
            fill[low] -= gain
            fill[to] += gain
        if fill[low]:
            break
        alive[low] = False
    return [b for b in bins if b]


def pack_lengths(lengths: list[int], size: int) -> list[list[int]]:
    """Bins of positions; full pieces keep a bin of their own."""
    full = [i for i, x in enumerate(lengths) if x >= size]
    rest = [i for i, x in enumerate(lengths) if x < size]
    own = [lengths[i] for i in rest]
    packed = local_search(best_fit(own, size), own, size) if rest else []
    return [[i] for i in full] + [[rest[i] for i in b] for b in packed]


def _round(rows: DataFrame, buckets: int, number: int, size: int) -> DataFrame:
    base = number << 48

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        lengths = group["length"].tolist()
        sequence = np.zeros(len(group), np.int64)
        offset = np.zeros(len(group), np.int64)
        filled = np.zeros(len(group), np.int64)
        first = base + (int(group["bucket"].iloc[0]) << 24)
        for k, members in enumerate(pack_lengths(lengths, size)):
            at = 0
            for i in members:
                sequence[i], offset[i] = first + k, at
                at += lengths[i]
            filled[members] = at
        return group.drop(columns=["bucket"]).assign(sequence_id=sequence, offset=offset, filled=filled)

    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "salt", F.lit(number)), F.lit(buckets)))
    return dealt.groupBy("bucket").applyInPandas(
        pack, PIECES + ", sequence_id long, offset long, filled long")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, size: int = 4096, bucket: int = 16_384,
         tight: float = 0.98, cache: int = 300_000) -> DataFrame:
    """All documents in sequences of at most ``size`` tokens.

    Needs ``doc_id`` and ``text``; other columns are ignored. Returns one row per piece: ``doc_id, piece, start,
    length, ids_crc32, sequence_id, offset``. A null or empty text is one piece of the end id alone; a null
    ``doc_id`` is kept as such; repeated rows are packed as often as they occur; an empty table gives no rows.
    ``bucket`` is the number of pieces a task packs at once, ``tight`` the fill from which a sequence is left alone
    in later rounds, ``cache`` the chunks that a generation of the encoder's cache holds in a worker.
    """
    rows = cut_lineage(pieces(docs, tokenizer, end_id, size, cache), "pieces")
    out, number, count, before = None, 0, rows.count(), None
    while True:
        buckets = max(1, -(-count // bucket))
        done = cut_lineage(_round(rows, buckets, number, size), "packed")
        last = buckets == 1 or count == before
        kept = done if last else done.where(F.col("filled") >= tight * size)
        out = kept if out is None else out.unionByName(kept)
        if last:
            return out.select([f.split()[0] for f in PACKED.split(", ")])
        rows = done.where(F.col("filled") < tight * size).select(NAMES)
        before, count, number = count, rows.count(), number + 1
