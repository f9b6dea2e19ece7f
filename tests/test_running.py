"""Chunked running aggregates against a plain scan in Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

import tidemark.operators.running as running_module
from tidemark.operators.running import row_numbers, running


def rows(n=900, seed=7):
    """A third of the rows in one group, gaps in the order column."""
    rnd = random.Random(seed)
    order = sorted(rnd.sample(range(5 * n), n))
    return [("hot" if rnd.random() < 0.34 else f"g{rnd.randrange(6)}", o, rnd.randrange(-5, 100)) for o in order]


def scan(data, descending=False, exclusive=False):
    out, state = {}, {}
    for g, o, v in sorted(data, key=lambda r: r[1], reverse=descending):
        n, s, m = state.get(g, (0, 0, None))
        after = (n + 1, s + v, v if m is None else max(m, v))
        out[(g, o)] = (n, s, m) if exclusive else after
        state[g] = after
    return out


@pytest.mark.parametrize("bits", [3, 7, 18])
@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("exclusive", [False, True])
def test_running_matches_plain_scan(spark, bits, descending, exclusive):
    data = rows()
    df = spark.createDataFrame(data, "g string, o long, v long")
    specs = {"n": ("count", None), "s": ("sum", F.col("v")), "m": ("max", F.col("v"))}
    got = running(df, ["g"], ["o"], specs, bits=bits, descending=descending, exclusive=exclusive).collect()
    assert {(r.g, r.o): (r.n, r.s, r.m) for r in got} == scan(data, descending, exclusive)


def test_running_without_group(spark):
    df = spark.createDataFrame(rows(), "g string, o long, v long")
    got = row_numbers(df, [], ["o"], bits=5).orderBy("o").collect()
    assert [r.rn for r in got] == list(range(1, len(got) + 1))


def test_leading_order_column(spark):
    data = [(w, p, o, i) for p in range(3) for o in range(p, 60, 3) for i, w in enumerate(["a", "b", "a"])]
    df = spark.createDataFrame(data, "w string, p int, o long, i int").orderBy(F.rand(1))
    got = running(df, ["w"], ["o", "i"], {"n": ("count", None)}, lead=["p"], bits=3).collect()
    for word in ("a", "b"):
        ordered = sorted((r for r in got if r.w == word), key=lambda r: (r.p, r.o, r.i))
        assert [r.n for r in ordered] == list(range(1, len(ordered) + 1))


def test_null_group_is_its_own_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 9), ("a", 4)], "g string, o long")
    got = row_numbers(df, ["g"], ["o"], bits=2).collect()
    assert {(r.g, r.o): r.rn for r in got} == {(None, 1): 1, (None, 9): 2, ("a", 4): 1}


@pytest.mark.parametrize("shape", ["stride", "nanoseconds", "extremes", "one group"])
@pytest.mark.parametrize(("descending", "exclusive"), [(False, False), (True, False), (False, True)])
def test_levels_over_sparse_values(spark, shape, descending, exclusive):
    """Values far apart: many levels of small chunks, and the totals that one task of the top level sees stay few."""
    rnd = random.Random(3)
    if shape == "stride":
        order = [i << 20 for i in range(400)]
    elif shape == "nanoseconds":
        order = sorted({1_700_000_000_000_000_000 + int(rnd.expovariate(1e-9)) for _ in range(400)})
    elif shape == "extremes":
        order = sorted({rnd.randrange(-(2**63), 2**63) for _ in range(300)} | {-(2**63), 2**63 - 1, 0, -1})
    else:
        order = list(range(0, 4_000_000, 9973))
    data = [("g" if shape == "one group" or rnd.random() < 0.4 else f"g{rnd.randrange(4)}", o, rnd.randrange(-5, 100)) for o in order]
    df = spark.createDataFrame(data, "g string, o long, v long")
    specs = {"n": ("count", None), "s": ("sum", F.col("v")), "m": ("max", F.col("v")), "t": ("total", F.col("v"))}
    got = running(df, ["g"], ["o"], specs, bits=12, upper=19, descending=descending, exclusive=exclusive).collect()
    assert {(r.g, r.o): (r.n, r.s, r.m) for r in got} == scan(data, descending, exclusive)
    whole = {}
    for g, _, v in data:
        whole[g] = whole.get(g, 0) + v
    assert all(r.t == whole[r.g] for r in got)


def level_shifts(bits, upper, span=64):
    """Bits that the chunks of each level leave out."""
    out = [bits]
    while span - out[-1] > upper:
        out.append(out[-1] + upper)
    return out


@pytest.mark.parametrize("bits", [12, 18, 28])
def test_rows_per_task_are_bounded_on_every_level(spark, bits):
    """Distinct chunks of a level within a chunk of the next one, and at the top, for any values of the type."""
    shifts = level_shifts(bits, running_module.UPPER)
    df = spark.createDataFrame([(i, i << 20) for i in range(100)], "i int, o long")
    plan = running(df, [], ["o"], {"n": ("count", None)}, bits=bits)._jdf.queryExecution().analyzed().toString()
    assert len(set(re.findall(r"__chunk\d+", plan))) == len(shifts)
    assert all(b - a <= running_module.UPPER for a, b in zip(shifts, [*shifts[1:], 64], strict=True))


def test_a_short_type_has_one_level(spark):
    df = spark.createDataFrame([(i,) for i in range(100)], "o int")
    plan = running(df, [], ["o"], {"n": ("count", None)})._jdf.queryExecution().analyzed().toString()
    assert set(re.findall(r"__chunk\d+", plan)) == {"__chunk32"}
