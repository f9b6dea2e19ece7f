"""Approximate nearest neighbours by learned partitions.

A bounded sample of the vectors gives a neighbour graph. The graph is cut into balanced parts with few links across,
and a small classifier learns to tell the part from the vector. Every vector is placed in its most probable part; a query
is routed to its most probable parts by a second classifier, which learned where the neighbours of a vector are
placed, and the vectors found there are ranked exactly.

Equal vectors are stored once with their smallest ids, as many as a result can hold, so a vector that fills a third of the
table is one row. Parts are cut into slices of a fixed number of rows and queries likewise, so a task never holds more
than one slice of each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k rows of largest inner product with each row, itself left out."""
    out = np.empty((len(x), k), np.int32)
    for a in range(0, len(x), 512):
        s = x[a : a + 512] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out[a : a + 512] = np.argpartition(-s, k - 1, 1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, m: int, rounds: int = 12, slack: float = 1.1, seed: int = 5) -> np.ndarray:
    """Parts of at most ``slack`` times the mean size with few links across.

    Starts from centres with a capacity and moves vectors to the part most of their neighbours are in, the largest
    gains first, while there is room.
    """
    rng = np.random.default_rng(seed)
    n, room = len(x), math.ceil(slack * len(x) / m)
    centres = x[rng.choice(n, m, replace=False)]
    part = np.zeros(n, np.int32)
    for _ in range(8):
        near = ((centres**2).sum(1) - 2 * x @ centres.T)
        part = assign(near, room)
        for p in range(m):
            if (part == p).any():
                centres[p] = x[part == p].mean(0)
    both = np.concatenate([np.stack([np.repeat(np.arange(n), graph.shape[1]), graph.ravel()], 1),
                           np.stack([graph.ravel(), np.repeat(np.arange(n), graph.shape[1])], 1)])
    for _ in range(rounds):
        links = np.zeros((n, m), np.float32)
        np.add.at(links, (both[:, 0], part[both[:, 1]]), 1)
        best = links.argmax(1)
        gain = links[np.arange(n), best] - links[np.arange(n), part]
        size = np.bincount(part, minlength=m)
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[best[i]] < room:
                size[part[i]] -= 1
                size[best[i]] += 1
                part[i] = best[i]
                moved += 1
        if not moved:
            break
    return part


def assign(cost: np.ndarray, room: int) -> np.ndarray:
    """Each row to its cheapest column that has room, rows with most to lose first."""
    two = np.partition(cost, min(1, cost.shape[1] - 1), 1)
    order = np.argsort(-(two[:, min(1, cost.shape[1] - 1)] - two[:, 0]), kind="stable")
    ranked = np.argsort(cost, 1, kind="stable")
    left, out = np.full(cost.shape[1], room), np.zeros(len(cost), np.int32)
    for i in order:
        p = next(p for p in ranked[i] if left[p])
        left[p] -= 1
        out[i] = p
    return out


class Net(NamedTuple):
    """One hidden layer; inputs are divided by ``scale``."""

    scale: float
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of the parts."""
        return np.maximum(x.astype(np.float32) / self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def fit_net(x: np.ndarray, y: np.ndarray, hidden: int = 128, epochs: int = 30, seed: int = 7) -> Net:
    """Cross entropy with the distribution ``y`` over parts, Adam, fixed order of batches."""
    rng = np.random.default_rng(seed)
    scale = float(np.sqrt((x**2).mean())) or 1.0
    x = (x / scale).astype(np.float32)
    p = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), np.zeros(hidden),
         rng.normal(0, hidden**-0.5, (hidden, y.shape[1])), np.zeros(y.shape[1])]
    p = [v.astype(np.float32) for v in p]
    m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for a in range(0, len(x), 128):
            at = order[a : a + 128]
            h = np.maximum(x[at] @ p[0] + p[1], 0)
            s = h @ p[2] + p[3]
            e = np.exp(s - s.max(1, keepdims=True))
            d = (e / e.sum(1, keepdims=True) - y[at]) / len(at)
            dh = (d @ p[2].T) * (h > 0)
            t += 1
            for k, g in enumerate((x[at].T @ dh, dh.sum(0), h.T @ d, d.sum(0))):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] = p[k] - 2e-3 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return Net(scale, *(a.astype(np.float32) for a in p))


class Index(NamedTuple):
    """``mass``: parts are searched from the most probable one on until those before hold this much probability."""

    place: Net
    route: Net
    mass: float

    def probes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Parts of each row by falling probability, and how many of them to search."""
        order, before = ranked_parts(self.route, x)
        return order, (before < self.mass).sum(1)


def ranked_parts(route: Net, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parts by falling probability, and the probability of all parts before each."""
    s = route(x).astype(np.float64)
    p = np.exp(s - s.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    order = np.argsort(-p, 1, kind="stable")
    p = np.take_along_axis(p, order, 1)
    return order, np.cumsum(p, 1) - p


def train(x: np.ndarray, m: int, recall: float = 0.95, neighbours: int = 20) -> Index:
    """The two classifiers, from a sample of distinct vectors.

    An eighth of the sample is kept from the routing classifier. On it the probability mass is set that reaches the
    parts of ``recall`` of all neighbours; with fewer than 64 such vectors all parts are searched.
    """
    x = x.astype(np.float32)
    m = min(m, len(x))
    k = min(neighbours, len(x) - 1)
    graph = neighbour_graph(x, k) if k > 0 else np.zeros((len(x), 0), np.int32)
    part = balanced_parts(x, graph, m) if k > 0 else np.zeros(len(x), np.int32)

    def spread(home: np.ndarray, own: float) -> np.ndarray:
        y = np.zeros((len(x), m), np.float32)
        np.add.at(y, (np.repeat(np.arange(len(x)), graph.shape[1]), home[graph.ravel()]), 1)
        y[np.arange(len(x)), home] += own
        return y / y.sum(1, keepdims=True)

    place = fit_net(x, spread(part, max(1, k)))
    home = place(x).argmax(1)
    fit = len(x) - len(x) // 8
    route = fit_net(x[:fit], spread(home, 1.0)[:fit])
    if len(x) - fit < 64:
        return Index(place, route, 2.0)
    order, before = ranked_parts(route, x[fit:])
    reached = np.empty_like(before)
    np.put_along_axis(reached, order, before, 1)
    needed = np.take_along_axis(reached, home[graph[fit:]], 1)
    return Index(place, route, float(np.nextafter(np.quantile(needed, recall), 2)))


def valid_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, v``: one row per id, the smallest of its vectors.

    Without id, null, zero, or holding a null or non-finite component, a row takes no part; nor do vectors of another
    length than the most frequent one (the smaller length in a draw).
    """
    v = F.col("v")
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where("vec_id is not null and v is not null and size(v) > 0")
    rows = rows.where(F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    rows = rows.where(F.exists(v, lambda c: c != 0))
    top = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    rows = rows.where(F.size("v") == (top[0].n if top else 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def distinct_vectors(rows: DataFrame, most: int) -> DataFrame:
    """``v, ids``: each vector once, with its ``most`` smallest ids. Salted, so that no task sees all copies of one."""
    salted = Window.partitionBy("v", "salt").orderBy("vec_id")
    few = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(32))).withColumn("at", F.row_number().over(salted))
    few = few.where(F.col("at") <= most).drop("at", "salt")
    few = few.withColumn("at", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("at") <= most)
    return few.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def search(rows: DataFrame, query_every: int = 20, k: int = 20, parts: int = 32, least_rows: int = 64,
           sample: int = 8192, recall: float = 0.95, slice_rows: int = 65_536, query_rows: int = 4096, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest by inner product found for every vector whose id is divisible by ``query_every``.

    Returns ``query_id, rank, vec_id, score``; ranks go by score, ties by the smaller id. ``sample`` bounds the
    vectors the classifiers are fitted on; all vectors are indexed. There are ``parts`` parts, fewer where they would hold
    under ``least_rows`` distinct vectors; a part gives a query its ``k`` best, so what is passed on grows with the
    queries alone until a part exceeds ``slice_rows``. A query searches as many as it takes to reach ``recall`` of the neighbours in the sample, and to
    see ``k`` candidates: few where vectors are clustered, most where they have no structure. Fewer candidates than
    ``k`` are all returned. A table without valid vectors gives no rows.
    """
    kind = "query_id long, rank int, vec_id long, score double"
    spark = rows.sparkSession
    vectors = cut_lineage(valid_vectors(rows, id_col, vector_col), "vectors")
    distinct = cut_lineage(distinct_vectors(vectors, k + 1), "distinct")
    count = distinct.count()
    if not count:
        return spark.createDataFrame([], kind)
    picked = distinct.orderBy(F.xxhash64("v"), "v").select("v").limit(sample).toPandas()
    x = np.array(picked["v"].tolist())
    dim = x.shape[1]
    index = train(x, min(parts, -(-count // least_rows)), recall)
    m = index.place.b2.shape[0]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part = index.place(matrix(b.column("v"), dim)).argmax(1) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), *b.columns], names=["part", *b.schema.names])

    homes = cut_lineage(distinct.mapInArrow(placed, "part int, v array<double>, ids array<long>"), "placed")
    held = {r.part: (r.rows, r.ids) for r in homes.groupBy("part").agg(F.count("*").alias("rows"), F.sum(F.size("ids")).alias("ids")).collect()}
    slices = [max(1, -(-held.get(p, (0, 0))[0] // slice_rows)) for p in range(m)]
    ids_in = np.array([held.get(p, (0, 0))[1] for p in range(m)])

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            order, need = index.probes(matrix(b.column("v"), dim))
            seen = np.cumsum(ids_in[order], 1)
            need = np.maximum(need, (seen < k + 1).sum(1) + 1).clip(max=m)
            row = np.repeat(np.arange(b.num_rows), need)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(need) - need, need)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id").take(pa.array(row)), b.column("v").take(pa.array(row)), pa.array(order[row, nth], pa.int32())],
                names=["query_id", "v", "part"])

    probing = vectors.where(F.col("vec_id") % query_every == 0).mapInArrow(routed, "query_id long, v array<double>, part int")
    probing = cut_lineage(probing, "probes")
    asked = {r.part: r["count"] for r in probing.groupBy("part").count().collect()}
    q_slices = [max(1, -(-asked.get(p, 0) // query_rows)) for p in range(m)]

    def dealt(df: DataFrame, own: list[int], other: list[int], key: str, mine: str, theirs: str) -> DataFrame:
        n, copies = (F.get(F.lit(c), F.col("part")) for c in (own, other))
        df = df.withColumn(mine, F.pmod(F.xxhash64(key), n).cast("int"))
        return df.withColumn(theirs, F.explode(F.sequence(F.lit(0), copies - 1)))

    left = dealt(homes, slices, q_slices, "v", "i", "q").groupBy("part", "i", "q")
    right = dealt(probing, q_slices, slices, "query_id", "q", "i").groupBy("part", "i", "q")

    def rank(found: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, float]] = []
        if len(found) and len(queries):
            x, ids = np.array(found["v"].tolist()), found["ids"].tolist()
            names, q = queries["query_id"].tolist(), np.array(queries["v"].tolist())
            for a in range(0, len(q), 256):
                scores = q[a : a + 256] @ x.T
                n = min(k + 1, len(x))
                for s, v, name in zip(scores, q[a : a + 256], names[a : a + 256], strict=True):
                    least = -np.partition(-s, n - 1)[n - 1]
                    # Rounding differs with the shape of the product, so near ties are kept and summed exactly.
                    near = np.flatnonzero(s >= least - 1e-9 * (1 + abs(least)))
                    exact = [(-math.fsum((v * x[j]).tolist()), i) for j in near for i in ids[j] if i != name]
                    out += [(name, i, -e) for e, i in sorted(exact)[:k]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    best = left.cogroup(right).applyInPandas(rank, "query_id long, vec_id long, score double")
    ranks = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = best.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
