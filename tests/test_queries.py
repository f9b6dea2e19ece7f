"""Every registered query against its SQL on the smallest tables."""

import math

import duckdb
import pytest

from tidemark.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
QUERIES = registry.queries()
ORACLE = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def cell(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return str(v)


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(cell(r[c]) for c in columns) for r in df.collect())
    rel = con.execute(ORACLE[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = sorted(tuple(cell(r[i]) for i in order) for r in rel.fetchall())
    assert got == want
