"""The filter audit against all orders applied one by one, and the SQL."""

import re
from collections import defaultdict
from itertools import permutations

import duckdb
import pytest

from tidemark.llm import audit, registry

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(docs, labels):
    """(part, order, step) -> figures, by applying every order to the rows."""
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    parts = defaultdict(list)
    for i, text, lang in docs:
        text = text or ""
        w = WORD.findall(text)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
                 "D": bool(re.search(r"[#$%&*|]", text)), "E": i is not None and first[text] < i}
        parts[lang or ""].append((fails, i in good, i in toxic))
    out, shapley = {}, defaultdict(int)
    for part, rows in parts.items():
        for order in map("".join, permutations("ABCDE")):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if r[0][f]]
                left = [r for r in left if not r[0][f]]
                shapley[part, f] += len(gone)
                out[part, order, step] = (
                    len(left), len(gone), sum(r[0][f] for r in rows) - len(gone),
                    sum(r[0][f] and sum(r[0].values()) == 1 for r in rows), sum(r[1] for r in gone), sum(r[2] for r in gone))
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def collected(df):
    rows = df.collect()
    out = {(r.part, r.filter_order, r.step): tuple(r[3:]) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", SF])
def test_the_query_equals_brute_force_and_sql(spark, sf):
    df = registry.queries()["op12_filter_audit"](spark, sf)
    got = collected(df)
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    labels = [(r.doc_id, r.quality, r.toxic) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    assert got == plain(docs, labels)
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    found = con.execute(audit.SQL).fetchall()
    assert {r[:3]: r[3:] for r in found} == got


def test_hard_rows(spark):
    long = " ".join(f"w{k}" for k in range(300))
    docs = [
        (1, long, "en"), (2, long, "en"), (2, long, "en"), (2, long, "fr"), (None, long, "en"), (None, None, None), (3, None, None),
        (4, "", ""), (5, " \n ", ""), (6, "A" * 40, "en"), (7, "same word " * 60_000, "de"), (8, "x # " * 150, "de"), (8, "other", "de"),
        (-1, long + " %", "fr"), (9, long + " %", "fr"), (0, long + " %", "en"), (10, "É" * 300, None)]
    docs += [(100 + k, long, "en") for k in range(50)]  # a hot group of copies
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, None), (None, 1, 1), (7, None, 1), (8, 1, 1), (101, 1, 1)]
    rows = [(i, t, lang, "p", 7, {"n": 1}) for i, t, lang in docs]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, part string, n int, base map<string,int>")
    marks = spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, lang string")
    assert collected(audit.filter_audit(table, marks)) == plain(docs, labels)
    assert collected(audit.filter_audit(table, marks.where("1 = 0"))) == plain(docs, [])
    assert audit.filter_audit(table.where("1 = 0"), marks).collect() == []


def test_potentials_of_other_games(spark):
    counts = [("p", s, (s * 37) % 11, s % 3, s % 2) for s in range(8)]
    df = audit.interactions(spark.createDataFrame(counts, "part string, fails int, n long, good long, toxic long"), "XYZ")
    got = collected(df)
    assert len(got) == 6 * 3
    for f in "XYZ":
        values = {v[-1] for (_, order, step), v in got.items() if order[step - 1] == f}
        assert values == {sum(v[1] for (_, order, step), v in got.items() if order[step - 1] == f)}
