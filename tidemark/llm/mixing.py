"""Mixing sources to target weights by Sainte-Lague apportionment of equal blocks of words.

The documents of a source are dealt to shards of about ``shard_words`` words by a hash, put in a seeded order there
and cut into blocks of about ``block`` words. Blocks are allotted to sources by highest quotients ``target / (2k + 1)``,
then in the same way to the shards of each source. A shard repeats all its blocks as often as its quota covers them
and draws the rest by a seeded permutation. Nothing but one row per source and one per shard reaches the driver.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORDS, word_count

WEIGHTS = (3, 1, 2)
BROADCAST_ROWS = 20_000  # of at most 100 bytes or so each


def targets(sizes: Sequence[int], weights: Sequence[float], factor: float = 1.5, most: float = 2.0) -> list[float]:
    """Words per source: ``factor`` times all words shared by weight, none above ``most`` times its own size."""
    limit = [most * s for s in sizes]
    out: list[float] = [0.0] * len(sizes)
    left, open_ = factor * sum(sizes), [i for i, s in enumerate(sizes) if s]
    while open_:
        total = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / total > limit[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in over:
            out[i] = limit[i]
        left -= sum(limit[i] for i in over)
        open_ = [i for i in open_ if i not in set(over)]
    return out


def sainte_lague(seats: int, weights: Sequence[float], limits: Sequence[int]) -> list[int]:
    """``seats`` allotted one by one to the highest quotient ``weight / (2 * own + 1)``, ties to the earlier one.

    A claimant with ``limits`` seats gets no more. The first seats, which no order could change, are given at once:
    with the divisor below, nobody gets more than the highest quotients would give.
    """
    n, total = len(weights), sum(weights)
    if not n or total <= 0:
        return [0] * n
    divisor = total / max(1e-9, seats - n / 2) if seats > n / 2 else float("inf")
    got = [min(limits[i], int(np.floor(weights[i] / divisor + 0.5)) if divisor < float("inf") else 0) for i in range(n)]
    left = seats - sum(got)
    heap = [(-weights[i] / (2 * got[i] + 1), i) for i in range(n) if got[i] < limits[i] and weights[i] > 0]
    heapq.heapify(heap)
    while left > 0 and heap:
        _, i = heapq.heappop(heap)
        got[i] += 1
        left -= 1
        if got[i] < limits[i]:
            heapq.heappush(heap, (-weights[i] / (2 * got[i] + 1), i))
    return got


def cut(text: str, ranges: Iterable[tuple[int, int]]) -> str:
    """The given ranges of words (end exclusive) as they stand in the text, one below the other."""
    spans = [m.span() for m in WORDS.finditer(text)]
    return "\n".join(text[spans[a][0] : spans[b - 1][1]] for a, b in ranges)


def small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a table of few rows; above that the planner joins by shuffling and splits the hot keys."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def local(spark: SparkSession, rows: list[tuple], kinds: dict[str, pa.DataType]) -> DataFrame:
    """A table of the driver's rows, sent as Arrow: from plain rows Spark starts a Python worker per core to pickle them."""
    columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
    return spark.createDataFrame(pa.table([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], names=list(kinds)))


def _deal(docs: DataFrame, seed: int, block: int, shard_words: int) -> DataFrame:
    """Rows with their ``size``, ``src`` and ``shard``, and the blocks and the quota of the shard; ``text`` is dropped."""
    spark = docs.sparkSession
    sized = docs.withColumn("size", word_count(F.col("text"))).withColumn("place", F.xxhash64("doc_id", "text", F.lit(seed)))
    sized = sized.drop("text")
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size")).collect()
    per.sort(key=lambda r: (r.source is None, r.source or ""))
    goal = targets([r.source_size for r in per], [WEIGHTS[i % len(WEIGHTS)] for i in range(len(per))])
    rows = [(r.source, i, r.source_size, goal[i], max(1, -(-r.source_size // shard_words))) for i, r in enumerate(per)]
    sources = local(spark, rows, {"of": pa.string(), "src": pa.int32(), "source_size": pa.int64(), "target": pa.float64(), "shards": pa.int64()})
    dealt = sized.join(small(sources, len(rows)), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("place"), F.col("shards")))
    held = dealt.groupBy("src", "shard").agg(F.sum("size").alias("words")).collect()
    shards: dict[int, list[tuple[int, int]]] = {}
    for r in held:
        if r.words:
            shards.setdefault(r.src, []).append((r.shard, r.words))
    order = sorted(shards)
    blocks = {s: [max(1, round(w / block)) for _, w in sorted(shards[s])] for s in order}
    seats = sainte_lague(round(sum(goal[s] for s in order) / block), [goal[s] for s in order],
                         [2 * sum(blocks[s]) for s in order])
    quotas = []
    for s, n in zip(order, seats, strict=True):
        own = sorted(shards[s])
        given = sainte_lague(n, [w for _, w in own], [2 * b for b in blocks[s]])
        quotas += [(s, k, b, q) for (k, _), b, q in zip(own, blocks[s], given, strict=True)]
    given = local(spark, quotas, {"src": pa.int32(), "shard": pa.int64(), "blocks": pa.int64(), "quota": pa.int64()})
    return dealt.drop("shards").join(small(given, len(quotas)), ["src", "shard"], "left")


def _counts(blocks: int, quota: int, seed: int, src: int, shard: int) -> np.ndarray:
    """How often each block of a shard is taken."""
    out = np.full(blocks, quota // blocks, np.int64)
    out[np.random.default_rng([seed, src, shard]).permutation(blocks)[: quota % blocks]] += 1
    return out


def _taken(group: pd.DataFrame, seed: int) -> tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    group = group.sort_values(["place", "doc_id", "size"], kind="stable", ignore_index=True)
    size = group["size"].to_numpy(np.int64)
    ends = np.cumsum(size)
    starts = ends - size
    blocks, quota = group["blocks"].iloc[0], group["quota"].iloc[0]
    if pd.isna(blocks):  # a shard without a word
        blocks, quota = 1, 0
    blocks, quota, total = int(blocks), int(quota), int(size.sum())
    edges = np.arange(blocks + 1) * total // blocks
    counts = _counts(blocks, quota, seed, int(group["src"].iloc[0]), int(group["shard"].iloc[0]))
    upto = np.concatenate([[0], np.cumsum(counts * np.diff(edges))])

    def before(p: np.ndarray) -> np.ndarray:
        b = np.clip(np.searchsorted(edges, p, "right") - 1, 0, blocks - 1)
        return upto[b] + counts[b] * (p - edges[b])

    return group, before(ends) - before(starts), starts, edges, counts


def mix(docs: DataFrame, seed: int = 17, block: int = 32, shard_words: int = 1 << 20) -> DataFrame:
    """Per document: ``doc_id, size, source_size, target, taken``.

    Sources are ranked by code point, null last, and weigh 3, 1, 2, repeating. A null text has no words. Repeated
    rows are documents of their own. Reruns give the same rows. An empty table, or one without a word, takes nothing.
    """
    slim = _deal(docs.select("doc_id", "text", F.col("source").cast("string").alias("source")), seed, block, shard_words)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group, taken, *_ = _taken(group, seed)
        return group[["doc_id", "size", "source_size", "target"]].assign(taken=taken)

    out = slim.groupBy("src", "shard").applyInPandas(
        run, "doc_id long, size long, source_size long, target double, taken long")
    return out


def mixed_texts(docs: DataFrame, seed: int = 17, block: int = 32, shard_words: int = 1 << 20) -> DataFrame:
    """The mixture itself, with the columns of ``docs``: what is taken of each document, once per repeat.

    A whole document keeps its text as it is; of a part the taken ranges of words stand below each other. ``n_chars``
    is set anew where there is such a column. Documents of which nothing is taken are gone. One task holds the texts of one
    shard, about ``shard_words`` words. The given frame is read three times and should be a stored table.
    """
    names = docs.columns
    own = F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")
    keyed = docs.select("doc_id", "text", F.col("source").cast("string").alias("source"), own)
    dealt = _deal(keyed, seed, block, shard_words).drop("source_size", "target", "source")
    kind = docs.schema.simpleString()

    def run(group: pa.Table) -> pa.Table:
        rows = pa.concat_arrays(group.column("row").chunks)
        frame = group.select(["doc_id", "size", "place", "src", "shard", "blocks", "quota"]).to_pandas()
        frame, taken, starts, edges, counts = _taken(frame.assign(at=np.arange(len(frame))), seed)
        words, at = frame["size"].to_numpy(np.int64), frame["at"].to_numpy()
        origin, texts = [], []
        own = pc.struct_field(rows, "text")
        for i in np.flatnonzero(taken):
            a, b = int(starts[i]), int(starts[i] + words[i])
            first, last = (np.searchsorted(edges, [a, b - 1], "right") - 1).tolist()
            text = own[int(at[i])].as_py()
            for copy in range(1, int(counts[first : last + 1].max()) + 1):
                ranges: list[tuple[int, int]] = []
                for k in range(first, last + 1):
                    lo, hi = max(a, int(edges[k])) - a, min(b, int(edges[k + 1])) - a
                    if counts[k] < copy or hi <= lo:
                        continue
                    if ranges and ranges[-1][1] == lo:
                        ranges[-1] = (ranges[-1][0], hi)
                    else:
                        ranges.append((lo, hi))
                if ranges:
                    origin.append(int(at[i]))
                    texts.append(text if ranges == [(0, b - a)] else cut(text, ranges))
        return pa.table({"row": rows.take(pa.array(origin, pa.int64())), "new_text": pa.array(texts, pa.string())})

    out = dealt.groupBy("src", "shard").applyInArrow(run, f"row {kind}, new_text string")
    cols = [F.col("new_text").alias(c) if c == "text"
            else F.length("new_text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
            else F.col(f"row.`{c}`").alias(c) for c in names]
    return out.select(cols)
