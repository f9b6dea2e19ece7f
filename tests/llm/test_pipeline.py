"""Every stage of the pipeline on what its predecessor kept, against plain versions."""

import os
import sys
from collections import Counter

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from brute import KINDS, base_secrets, jaccard_components, words  # noqa: E402
from test_text_operators import HARD, SF, empty, hard  # noqa: E402
from test_tokens_and_mixing import sound  # noqa: E402

from tidemark.llm import mixing, toxicity  # noqa: E402
from tidemark.llm.common import importable  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows after each stage, the given ones first."""
    importable(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_columns(stages):
    assert all(d.columns == stages[0].columns for d in stages[:-1])


def test_toxic_documents_go(spark, stages):
    given, kept = stages[0].collect(), {r.doc_id for r in stages[1].collect()}
    scored = toxicity.toxicity(stages[0], spark.read.parquet(f"{SF}/labels.parquet")).collect()
    assert kept == {r.doc_id for r in scored if not r.predicted}
    known = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [r.doc_id for r in given if known.get(r.doc_id) == 0]
    assert sum(i in kept for i in clean) >= 0.98 * len(clean)


def test_one_of_each_group_stays(stages):
    given = [(r.doc_id, r.text) for r in stages[1].collect()]
    want = {i for i, (n, c) in jaccard_components(given).items() if i == c or not n}
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(want)


def test_secrets_are_hidden(stages):
    before = {r.doc_id: r for r in stages[2].collect()}
    after = {r.doc_id: r for r in stages[3].collect()}
    assert before.keys() == after.keys()
    for i, r in after.items():
        if not base_secrets(before[i].text)[4]:
            assert r == before[i] or "[secret]" in r.text
        else:
            for kind, pattern, least in KINDS:
                assert not any(len(m[1]) >= least for m in pattern.finditer(r.text)), kind
            assert r.n_chars == len(r.text)


def test_mixture_meets_the_targets(stages):
    size, taken = Counter(), Counter()
    for r in stages[3].collect():
        size[r.source] += len(words(r.text))
    for r in stages[4].collect():
        taken[r.source] += len(words(r.text))
    order = sorted(size)
    for s, t in zip(order, mixing.targets([size[s] for s in order], [(3, 1, 2)[k % 3] for k in range(len(order))]), strict=True):
        assert abs(taken[s] - t) <= 0.01 * t + 64


def test_sequences_hold_all_pieces(stages):
    rows = stages[5].collect()
    count = Counter(r.doc_id for r in rows if r.piece == 0)
    assert count == Counter(r.doc_id for r in stages[4].collect())
    assert sound(rows) <= sum(r.length for r in rows) // 4096 + 2


def test_run_gives_the_rows_of_its_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF).collect()
    name = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert Counter(map(name, got)) == Counter(map(name, stages[5].collect()))


def test_stages_on_hard_rows(spark, tmp_path):
    for make, some in ((hard, True), (empty, False)):
        docs = make(spark)
        path = str(tmp_path / make.__name__)
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, docs, SMALL)
            if name != "best-fit packing":
                assert got.columns == docs.columns
            assert bool(got.collect()) == some
    docs = spark.read.parquet(str(tmp_path / "hard"))
    kept = Counter(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, SMALL).collect())
    assert kept == Counter(dict.fromkeys([i for i, *_ in HARD], 1))


def test_stages_keep_columns_of_any_name_and_type(spark, tmp_path):
    """Columns named like what the stages add, and a map column, come through by value."""
    names = ["score", "predicted", "assign", "access", "hex", "markov", "hit", "row", "mark", "toxic_score", "component", "node"]
    rows = [(i, t, "en", f"s{i or 0}", len(t or ""), {"k": i or 0}, *[f"{n}-{i}" for n in names]) for i, t, *_ in HARD]
    schema = "doc_id long, text string, lang string, source string, n_chars long, m map<string,int>, " + ", ".join(f"{n} string" for n in names)
    importable(spark).createDataFrame(rows, schema).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    given = {tuple(r[6:]): r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:4]:
        got = stage(spark, docs, SMALL)
        assert got.columns == docs.columns
        for r in got.collect():
            was = given[tuple(r[6:])]
            assert (r.doc_id, r.lang, r.source, r.m) == (was.doc_id, was.lang, was.source, was.m), name
            if name in ("toxicity", "n-gram Jaccard join"):
                assert r == was


def test_rows_go_only_if_their_own_text_is_a_copy(spark, tmp_path):
    texts = {k: " ".join(f"{k}{j}" for j in range(30)) for k in "abcdef"}
    near = {k: t + " more" for k, t in texts.items()}
    rows = [(1, texts["a"]), (2, near["a"]), (2, texts["b"]), (2, texts["c"]), (2, texts["c"]), (3, near["b"]), (None, near["c"]),
            (None, texts["d"]), (None, near["d"]), (None, texts["e"]), (None, texts["e"]), (4, texts["f"]), (4, near["f"]), (5, ""), (5, None), (None, " ")]
    importable(spark).createDataFrame([(i, t, len(t or "")) for i, t in rows], "doc_id long, text string, n_chars long").write.parquet(str(tmp_path / "d"))
    got = corpus_pipeline.drop_near_copies(spark, spark.read.parquet(str(tmp_path / "d")), SMALL)
    assert got.columns == ["doc_id", "text", "n_chars"]
    kept = Counter((r.doc_id, r.text) for r in got.collect())
    assert [kept[x] for x in [(1, texts["a"]), (2, texts["b"]), (2, texts["c"]), (None, texts["e"]), (5, ""), (5, None), (None, " ")]] == [1] * 7
    assert kept[None, texts["d"]] + kept[None, near["d"]] == 1 == kept[4, texts["f"]] + kept[4, near["f"]]
    assert sum(kept.values()) == 9


def test_stages_bound_their_batches(spark):
    """Executors run all stages one after another, so each of them hands small batches to its Python workers."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        importable(spark)
        stage(spark, docs, SMALL)
        assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "2m", name
    importable(spark)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "16m"


def test_mixing_sends_its_tables_without_python(spark, capsys):
    docs = spark.createDataFrame([(1, "a b", "x"), (2, "c", None)], "doc_id long, text string, source string")
    mixing.mix(docs.coalesce(1)).explain()
    assert capsys.readouterr().out.count("ExistingRDD") == 1  # the documents given here
    kinds = {"of": mixing.pa.string(), "n": mixing.pa.int64()}
    assert [tuple(r) for r in mixing.local(spark, [("x", 1), (None, None)], kinds).collect()] == [("x", 1), (None, None)]
    none = mixing.local(spark, [], kinds)
    assert none.dtypes == [("of", "string"), ("n", "bigint")] and none.isEmpty()
