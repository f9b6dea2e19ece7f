"""How filters overlap: their order effects and Shapley values from the potential of the removal game.

A coalition is a set of filters, its worth the number of documents that fail at least one of them. The potential of a
coalition is ``(worth + sum of the potentials without one member) / size`` (Hart and Mas-Colell), so five steps go from
the empty coalition to the grand one. The Shapley value of a filter is the grand potential minus the potential without
it. Everything per step of an order is a difference of two worths. Documents are counted once per set of filters they
fail: a few rows per part, whatever the corpus.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"


def base_fails(text: Column, cut: Column) -> list[Column]:
    """The conditions of all filters but the last: short, repetitive, loud, marks. ``cut`` is the text split at blanks."""
    blank = lambda at: (F.element_at(cut, at) == "").cast("int")
    words = F.size(cut) - blank(1) - F.when(F.size(cut) > 1, blank(-1)).otherwise(0)
    distinct = F.size(F.array_distinct(cut)) - F.array_contains(cut, "").cast("int")
    loud = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    return [words < 200, 100 * distinct < 50 * words, 100 * loud > 3 * F.length(text), text.rlike("[#$%&*|]")]


def bits(conditions: Sequence[Column]) -> Column:
    """Conditions as one integer, the first in the lowest bit."""
    return reduce(lambda a, b: a + b, [F.when(c, 1 << k).otherwise(0) for k, c in enumerate(conditions)])


def failed_sets(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, fails, n, good, toxic``: documents per part and set of failed filters (bits in the order of FILTERS).

    A null text counts as empty, a null language as ''. Texts are compared by their sha256 and leave the scan as that
    digest only. A row fails E if a smaller id has the same text anywhere in the table; rows that share the smallest id
    don't, nor do rows without an id, which are no one's smaller id either. A document is good (toxic) if a label of
    its id says so. Other columns are not looked at.
    """
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("q"), F.max((F.col("toxic") == 1).cast("int")).alias("t"))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"))
    rows = rows.withColumn("cut", F.split("text", r"[\x20\x09-\x0D]+"))
    rows = rows.select("doc_id", "part", bits(base_fails(F.col("text"), F.col("cut"))).alias("base"),
                       F.unhex(F.sha2("text", 256)).alias("same"))
    flag = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    rows = rows.join(known, "doc_id", "left").select("doc_id", "part", "base", "same", flag("q"), flag("t"))
    # One row per text, id and flags, then one per text and flags: how many, and how many of them have the smallest id.
    key = ["same", "base", "part", "q", "t"]
    per_id = rows.groupBy(*key, "doc_id").agg(F.count(F.lit(1)).alias("n"))
    has = F.col("doc_id").isNotNull()
    groups = per_id.groupBy(*key).agg(
        F.sum("n").alias("n"), F.sum(F.when(~has, F.col("n")).otherwise(0)).alias("without"),
        F.min(F.when(has, F.struct("doc_id", "n"))).alias("first"))
    # At most one row per part and label of a text, so no window is large here.
    smallest = F.min("first.doc_id").over(Window.partitionBy("same"))
    at_first = F.when(F.col("first.doc_id") == F.col("smallest"), F.col("first.n")).otherwise(0)
    groups = groups.withColumn("smallest", smallest).select(*key[1:], "n", (F.col("without") + at_first).alias("once"))
    copy = 1 << (len(FILTERS) - 1)
    both = F.array(F.struct(F.col("base").alias("fails"), F.col("once").alias("n")),
                   F.struct((F.col("base") + copy).alias("fails"), (F.col("n") - F.col("once")).alias("n")))
    return groups.select("part", "q", "t", F.inline(both)).groupBy("part", "fails").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("q")).alias("good"), F.sum(F.col("n") * F.col("t")).alias("toxic"))


def worths(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """``part, n, all, good, toxic``: arrays with the worth of every coalition, in the games over all, good and toxic rows."""
    size = 1 << len(filters)
    games = ["n", "good", "toxic"]
    hit = F.col("fails").bitwiseAND(F.col("s")) != 0
    by_set = counts.select("*", F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("s")).groupBy("part", "s").agg(
        F.sum("n").alias("total"), *[F.sum(F.when(hit, F.col(g)).otherwise(0)).alias(g) for g in games])
    # One entry per coalition.
    lists = by_set.groupBy("part").agg(F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("s", *games))).alias("w"))
    return lists.select("part", F.col("total").alias("n"), F.col("w.n").alias("all"), F.col("w.good").alias("good"),
                        F.col("w.toxic").alias("toxic"))


def with_potentials(games: DataFrame, filters: str = FILTERS) -> DataFrame:
    """``games`` with ``shapley``: the Shapley value of each filter in the game over all rows, times the number of orders.

    The potential of a coalition of k times k! is an integer, so scaled by n! every step divides without a rest.
    """
    n = len(filters)
    scale = factorial(n)
    out = games.withColumn("p0", F.lit(0).cast("long"))
    for k in range(1, n + 1):
        level = {}
        for s in (s for s in range(1 << n) if s.bit_count() == k):
            smaller = [F.col(f"p{s ^ (1 << i)}") for i in range(n) if s >> i & 1]
            total = reduce(lambda a, b: a + b, smaller, scale * F.element_at("all", s + 1))
            level[f"p{s}"] = F.call_function("div", total, F.lit(k))
        out = out.withColumns(level)
    grand = (1 << n) - 1
    return out.select(*games.columns, F.array(*[F.col(f"p{grand}") - F.col(f"p{grand ^ (1 << i)}") for i in range(n)]).alias("shapley"))


def interactions(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """The audit of sets of failed filters (``part, fails, n, good, toxic``, see ``failed_sets``) for every order and step.

    Per part, order and step: rows kept after the step, removed by it, failing its filter but removed before, failing
    its filter only, good and toxic rows it removes, and its Shapley value times the number of orders. No rows give no
    part.
    """
    n = len(filters)
    steps = [{"filter_order": order, "step": at + 1, "before": sum(1 << filters.index(f) for f in order[:at]), "i": filters.index(f)}
             for order in map("".join, permutations(filters)) for at, f in enumerate(order)]
    entry = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order: string, step: int, before: int, i: int>>")
    rows = with_potentials(worths(counts, filters), filters).select("*", F.inline(entry))
    bit = F.call_function("shiftleft", F.lit(1), F.col("i"))
    after = F.col("before") + bit
    worth = lambda game, s: F.element_at(game, (s + 1).cast("int"))
    grand = F.lit((1 << n) - 1)
    lost = lambda game: worth(game, after) - worth(game, F.col("before"))
    return rows.select(
        "part", "filter_order", "step", (F.col("n") - worth("all", after)).alias("kept"), lost("all").alias("removed"),
        (worth("all", bit) - lost("all")).alias("redundant"),
        (worth("all", grand) - worth("all", grand - bit)).alias("unique_fails"),
        lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"),
        F.element_at("shapley", F.col("i") + 1).alias("shapley"))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over all documents; see ``failed_sets`` for odd rows."""
    return interactions(failed_sets(docs, labels))


# The same rows by brute force over the orders; the Shapley value is the sum over all of them.
SQL = r"""
WITH seen AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY text) AS first_id FROM seen
), known AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS q, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS t
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), flags AS (
  SELECT part, coalesce(q, 0) AS q, coalesce(t, 0) AS t,
    len(w) < 200 AS a, 100 * list_unique(w) < 50 * len(w) AS b,
    100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text) AS c,
    regexp_matches(text, '[#$%&*|]') AS d, coalesce(first_id < words.doc_id, false) AS e
  FROM words LEFT JOIN known ON words.doc_id = known.doc_id
), sets AS (
  SELECT part, a::INT AS a, b::INT AS b, c::INT AS c, d::INT AS d, e::INT AS e,
    count(*) AS n, sum(q) AS good, sum(t) AS toxic FROM flags GROUP BY ALL
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
), orders AS (
  SELECT l1.f || l2.f || l3.f || l4.f || l5.f AS filter_order
  FROM letters l1, letters l2, letters l3, letters l4, letters l5
  WHERE len(list_distinct([l1.f, l2.f, l3.f, l4.f, l5.f])) = 5
), steps AS (SELECT filter_order, unnest(range(1, 6))::INT AS step FROM orders
), judged AS (
  SELECT part, filter_order, step, substr(filter_order, step, 1) AS f, n, good, toxic,
    list_select([a, b, c, d, e], [strpos('ABCDE', substr(filter_order, 1, 1)), strpos('ABCDE', substr(filter_order, 2, 1)),
      strpos('ABCDE', substr(filter_order, 3, 1)), strpos('ABCDE', substr(filter_order, 4, 1)),
      strpos('ABCDE', substr(filter_order, 5, 1))]) AS fails
  FROM sets, steps
), counted AS (
  SELECT part, filter_order, step, f,
    sum(CASE WHEN list_sum(fails[1:step]) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN fails[step] = 1 AND list_sum(fails[1:step]) = 1 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN fails[step] = 1 AND list_sum(fails[1:step]) > 1 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails[step] = 1 AND list_sum(fails) = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN fails[step] = 1 AND list_sum(fails[1:step]) = 1 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN fails[step] = 1 AND list_sum(fails[1:step]) = 1 THEN toxic ELSE 0 END) AS toxic_lost
  FROM judged GROUP BY ALL
)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM counted
"""
