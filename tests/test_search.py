"""The stored index against the scan of all texts, and what a query reads of it."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import search, words


def corpus(n=3000, seed=3):
    """Texts whose vocabulary drifts with the id, so that some ranges hold a term and others don't."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        pool = ["common", "the"] * 6 + [f"topic{i // 500}"] * 2 + [f"w{rnd.randrange(400)}" for _ in range(6)] + ["Été"]
        rows.append((i, " ".join(rnd.choice(pool) for _ in range(rnd.randrange(1, 60)))))
    rows[10] = (10, "rare " * 9)
    rows[2500] = (2500, "rare and common")
    return rows + [(7, None), (7, ""), (11, "repeated id rare"), (11, "repeated id rare"), (12, "... !!")]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index"))
    df = spark.createDataFrame(corpus(), "doc_id long, text string").coalesce(1)
    df.write.parquet(f"{path}/docs")
    docs = spark.read.parquet(f"{path}/docs")
    search.build_index(docs, path, buckets=8)
    return docs, path


def plain(rows, terms, k):
    """BM25 by the published formula, over rows."""
    texts = [(i, re.findall(r"[a-z0-9]+", (t or "").lower().replace("é", "e"))) for i, t in rows]
    n, avg = len(texts), sum(len(w) for _, w in texts) / sum(t is not None for _, t in rows)
    out = []
    for i, w in texts:
        if not set(terms) & set(w):
            continue
        total = 0.0
        for t in terms:
            df, tf = sum(t in x for _, x in texts), w.count(t)
            total += round(math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / avg)), 9)
        out.append((-round(total, 6), i))
    return [(i, -s) for s, i in sorted(out)[:k]]


@pytest.mark.parametrize("query", ["rare", "common topic2", "the rare été", "w17 W18 nowhere", "topic0 topic5 the"])
@pytest.mark.parametrize("k", [3, 5000])
def test_same_rows_as_the_scan(spark, index, query, k):
    docs, path = index
    got = [tuple(r) for r in search.match_index(spark, path, query, k).collect()]
    assert got == [tuple(r) for r in words.match_top_k(docs, query, k).collect()]
    if k == 3:
        want = plain(corpus(), words.query_terms(query), k)
        assert [s for _, s in got] == pytest.approx([s for _, s in want], abs=2e-6)


def test_nothing_to_find(spark, index):
    _, path = index
    assert search.match_index(spark, path, "nowhere", 5).collect() == []
    assert search.match_index(spark, path, "...", 5).collect() == []
    assert search.match_index(spark, path, "rare", 0).collect() == []


def test_empty_table(spark, tmp_path):
    path = str(tmp_path)
    search.build_index(spark.createDataFrame([], "doc_id long, text string"), path)
    assert search.match_index(spark, path, "rare", 5).collect() == []


def test_a_query_reads_its_terms_postings_only(spark, index):
    """Folders are pruned by bucket and row groups by term, and block lists of other ranges are not read."""
    _, path = index
    found = search.Search(spark, path, "rare common")
    plan = found.postings._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*bucket", plan) and re.search(r"PushedFilters: \[[^]]*In\(term", plan)
    heads = found.bounds()._jdf.queryExecution().executedPlan().toString()
    schema = re.search(r"ReadSchema: struct<([^\n]*)>", heads)[1]
    assert "max_tf" in schema and "docs" not in schema
    whole = search.read_postings(spark, path)
    read = found.postings.select(F.input_file_name().alias("f")).distinct().count()
    assert read < whole.select(F.input_file_name().alias("f")).distinct().count()
    assert {r.term for r in found.postings.select("term").distinct().collect()} == {"rare", "common"}


def test_ranges_below_the_kth_score_are_skipped(spark, index):
    _, path = index
    found = search.Search(spark, path, "rare the")
    ranges = {r.range for r in found.bounds().collect()}
    kept = {r.range for r in found.promising(1).collect()}
    assert len(ranges) >= 3 and kept < ranges
    best = search.match_index(spark, path, "rare the", 1).first()
    assert best == words.match_top_k(index[0], "rare the", 1).first()
    # The bound holds for every document of its range.
    most = {r.range: float(r.most) for r in found.bounds().collect()}
    for r in found.scores().select(F.shiftright("row", search.RANGE_BITS).alias("range"), "score").collect():
        assert r.score <= most[r.range] + 1e-6


def test_lists_are_bounded(spark, index):
    _, path = index
    top = search.read_postings(spark, path).agg(F.max(F.size("docs")), F.max("df")).first()
    assert max(top) <= 1 << search.RANGE_BITS


def test_a_posting_is_one_number(spark, index):
    """Id and length of a document are stored once a document, not once a posting."""
    _, path = index
    stored = search.read_postings(spark, path)
    assert stored.schema["docs"].dataType.simpleString() == "array<bigint>"
    assert stored.agg(F.sum(F.size("about"))).first()[0] == len(corpus())
    assert stored.filter("size(about) > 0").select("term").distinct().collect() == [(search.ALL,)]


def test_ids_of_any_type_and_long_frequencies(spark, tmp_path):
    rows = [(f"d{i}", " ".join(["often"] * (70000 if i == 1500 else 1 + i % 3))) for i in range(2100)] + [(None, "often rare")]
    docs = spark.createDataFrame(rows, "name string, text string")
    search.build_index(docs, str(tmp_path), ident="name")
    got = search.match_index(spark, str(tmp_path), "often rare", 7, ident="name").collect()
    assert got == words.match_top_k(docs, "often rare", 7, ident="name").collect()
    assert {r.name for r in got} >= {None, "d1500"}


def test_term_counts(spark):
    df = spark.createDataFrame([(["b", "a", "b"],), ([],), (["x"],)], "ws array<string>")
    got = [[tuple(t) for t in r[0]] for r in df.select(search.term_counts(F.col("ws"))).collect()]
    assert got == [[("a", 1), ("b", 2)], [], [("x", 1)]]
