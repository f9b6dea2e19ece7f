"""Fill-in-the-middle forms against plain matches, exact round trips and the SQL."""

import re
from hashlib import sha256

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import middle, registry
from tidemark.llm.common import importable

SF = "/root/testdata/sf0.01"
UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(doc_id, text):
    """The contract, word for word."""
    text = text or ""
    units = UNITS.findall(text)
    n = len(units)
    hexed = sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexed[k : k + 8], 16) for k in (0, 8, 16, 24)]
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, mid, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return n, "spm", len(prefix), len(mid), f"<S>{suffix}<P>{prefix}<M>{mid}"
    return n, "psm", len(prefix), len(mid), f"<P>{prefix}<S>{suffix}<M>{mid}"


def test_chunk_ends_depend_on_their_surroundings_alone():
    rng = np.random.default_rng(1)
    shared = " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(4000))
    one, two = middle.cuts("x" * 777 + shared), middle.cuts("y z" * 2000 + shared)
    a, b = {e - 777 for e in one}, {e - 6000 for e in two}
    inner = [e for e in a if e > 9000]
    assert len(inner) > 5 and set(inner) <= b
    assert one[-1] == 777 + len(shared) and max(np.diff([0, *one])) <= 8192
    assert middle.cuts("") == [] and middle.cuts("a") == [1]


def test_a_span_boundary_changes_no_cut(monkeypatch):
    text = "".join(np.random.default_rng(2).choice(list("ab cdé 漢"), 30_000))
    whole = middle.cuts(text)
    monkeypatch.setattr(middle, "SPAN", 1000)
    assert middle.cuts(text) == whole


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab \n<SPM>é漢", max_size=60), st.integers(1, 7))
def test_counts_and_cuts_of_any_chunking(text, size):
    real = middle.cuts
    middle.cuts = lambda t: list(range(size, len(t), size)) + ([len(t)] if t else [])
    try:
        found = middle.Counted(text, middle.Chunks(size=20))
    finally:
        middle.cuts = real
    units = UNITS.findall(text)
    assert found.n == len(units)
    assert [found.end_of(k) for k in range(len(units) + 1)] == [len("".join(units[:k])) for k in range(len(units) + 1)]


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**6), st.text(alphabet="ab \n<SPM>", max_size=40))
def test_forms_and_round_trip(doc_id, text):
    got = middle.transform(doc_id, text, middle.Chunks(), 42, 50, 80)
    assert tuple(got) == plain(doc_id, text)
    assert middle.restore(got.output, got.form) == text


def test_shared_chunks_are_counted_once():
    rng = np.random.default_rng(3)
    shared = " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(20_000))
    chunks = middle.Chunks()
    for k in range(5):
        middle.transform(k, f"text {k} " * (100 + k) + shared, chunks, 42, 50, 80)
    assert chunks.made < chunks.looked / 3


HARD = [(1, None), (2, ""), (3, " \n\t "), (4, "word " * 3000), (5, "a<P>b c"), (6, "é" * 500 + " 😀 漢字  x"), (6, "é" * 500 + " 😀 漢字  x"),
        (6, "another text of this id"), (None, "no id here"), (None, None), (7, "a\0b c d e"), (8, "<" * 50 + " < S> <M"),
        (9, "x" * 300_000), (10, "many words " * 200_000), (11, " lead and trail "), (12, "a"), (-5, "negative id")]


def test_hard_rows_keep_their_columns(spark):
    importable(spark)
    rows = [(i, t, "kept", 1.5, {"a": 1}) for i, t in HARD]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, n double, output map<string,int>")
    got = middle.fill_in_middle(docs).collect()
    assert len(got) == len(HARD)
    for r in got:
        assert (r.form, r.n, r.output) == ("kept", 1.5, {"a": 1})
        assert (r.fim.n, r.fim.form, r.fim.prefix_chars, r.fim.middle_chars, r.fim.output) == plain(r.doc_id, r.text)
        assert r.fim.restored == (r.text or "")
    assert middle.digests(docs).count() == len(HARD)
    assert middle.digests(docs.where("1 = 0")).collect() == []


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", SF])
def test_the_query_equals_its_sql(spark, sf):
    got = sorted(map(tuple, registry.queries()["op11_fill_in_middle"](spark, sf).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert got == sorted(con.execute(middle.SQL).fetchall())
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
