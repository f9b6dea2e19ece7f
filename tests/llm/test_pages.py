"""Main text of pages: the reader, the trees, the decision, the given pages and layouts that were not learned from."""

import html
import itertools
import random
import re

import numpy as np
import pytest

from tidemark.llm import boosting, dom, pages, registry
from tidemark.llm.common import importable

SF = "/root/testdata/sf0.01"


def shown(text, model=None):
    """All blocks of a page, whatever they are."""
    page = dom.read(text)
    return pages.joined(page, [pages.OUT if t in dom.RAW else pages.MAIN for t in page.tags]).split("\n\n")


@pytest.mark.parametrize(("text", "blocks"), [
    ("<p>a<p>b", ["a", "b"]), ("<p><b>bold<br><p>next", ["bold", "next"]), ("a<br>b", ["a b"]), ("x &amp; y &lt;p&gt; &#8364; &nbsp;z", ["x & y <p> € z"]),
    ("<div>a<div>b</div>c</div>d", ["a", "b", "c", "d"]), ("<ul><li>1<li>2<ul><li>3</ul><li>4</ul>", ["1", "2", "3", "4"]),
    ("<script>var t='</p>';a<b</script>t", ["t"]), ("<style>p{}</style><!-- <p>no</p> -->yes", ["yes"]), ("<!-- never closed <p>x", [""]),
    ("a<span class='s'>b</span>c <i>d</i>", ["abc d"]), ('<p title="a>b">c</p>', ["c"]), ("1 < 2 and 3 <4", ["1 < 2 and 3 <4"]),
    ("<p title='x>never closed</p>y", ["never closed", "y"]), ("</nothing></p>z</>", ["z"]), ("<SCRIPT>x</SCRIPT ><P>Q</P>", ["Q"]),
    ("<p>a\n\t b c</p>", ["a b c"]), ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]), ("<script>open", [""]), ("", [""]),
    ("<p>a</b>b</p>", ["ab"]), ("<textarea>t</textarea>after", ["after"]), ("<", ["<"]), ("<p>&amp;amp;</p>", ["&amp;"]),
])
def test_reader(text, blocks):
    assert shown(text) == blocks


def test_reader_is_linear_in_hard_texts():
    for part in ("<p", "<a title=\"", "<!--", "<div>", "</p>", "<b><p>", "&#", "<script>", "<x a='b' \"", "</"):
        dom.read(part * 20_000)


def test_trees_learn_a_rule_and_probabilities_add_up():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    y = np.where(x[:, 0] > 0.3, 2, np.where(x[:, 1] * x[:, 2] > 0, 1, 0))
    trees = boosting.fit(x[:2000], y[:2000], 3)
    log_p = boosting.apply(trees, x[2000:])
    assert np.allclose(np.exp(log_p).sum(1), 1)
    assert (log_p.argmax(1) == y[2000:]).mean() > 0.95
    assert np.isfinite(boosting.apply(boosting.fit(x[:1], y[:1], 3), x)).all()


def test_first_tree_takes_the_best_split():
    x = np.array([[0.0], [1], [2], [3], [4], [5]])
    y = np.array([0, 0, 0, 1, 1, 1])
    trees = boosting.fit(x, y, 2, rounds=1, depth=1, rate=1.0, l2=1.0, smallest=0.1)
    assert trees.limit[0, 0, 0] == 2.0
    # Leaf: minus gradient sum over curvature sum plus l2, at p = 1/2.
    assert np.allclose(trees.leaf[0, 0], [1.5 / 1.75, -1.5 / 1.75])


def test_decode_is_the_best_consistent_labelling():
    rng = np.random.default_rng(5)
    allowed = {pages.FRAME: {0, 1, 2}, pages.MAIN: {1, 2}, pages.OUT: {2}}
    for _ in range(60):
        n = int(rng.integers(2, 7))
        parents = [-1] + [int(rng.integers(0, k)) for k in range(1, n)]
        page = dom.Page(["#page"] + ["div"] * (n - 1), parents, [()] * n, [0] * n, [], [None] * n)
        log_p = np.log(rng.dirichlet([1, 1, 1], n))
        inner = set(parents)

        def worth(labels):
            if any(labels[k] not in allowed[labels[parents[k]]] or (labels[k] == 0 and k not in inner) for k in range(1, n)):
                return -np.inf
            return sum(log_p[k, labels[k]] for k in range(1, n))

        best = max(worth((0, *rest)) for rest in itertools.product(range(3), repeat=n - 1))
        assert np.isclose(worth(tuple(pages.decode(page, log_p))), best)


def article(text):
    """The blocks of the given pages, whose main text is what stands in their one article element."""
    inner = text[text.index("<article>") + 9 : text.index("</article>")]
    parts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", " ", x))).strip() for x in re.split(r"</?(?:p|h1)>", inner)]
    return "\n\n".join(p for p in parts if p)


def test_query_on_the_table(spark):
    given = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = registry.queries()["op13_html_text"](spark, SF).collect()
    assert sorted(r.page_id for r in got) == sorted(given)
    for r in got:
        assert (r.url, r.text, r.n_chars) == (given[r.page_id].url, article(given[r.page_id].html), len(r.text))


@pytest.fixture(scope="module")
def model(spark):
    rows = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").orderBy("page_id").collect()]
    return rows, pages.fit(rows[:120], layouts=4)


def test_held_out_layouts(model):
    rows, fitted = model
    good, other = [], []
    for text in rows[150:]:
        page = dom.read(text)
        a, b = pages.blocks_of(page, pages.marked(page))
        good, other = good + a, other + b
    rng = random.Random(11)
    made = [dom.read(pages.layout(rng, rng.sample(good, 20), rng.sample(other, 20))) for _ in range(200)]
    wanted = [pages.joined(p, pages.told(p)) for p in made]
    exact = sum(w == g for w, g in zip(wanted, pages.extract(made, fitted), strict=True))
    assert exact >= 0.85 * len(made)


def test_pages_unlike_the_given_ones(model):
    rows, fitted = model
    words = re.findall(r"[a-z]+", rows[3])
    text = lambda k, n: " ".join(words[40 * k : 40 * k + n]).capitalize() + "."
    page = f"""<html><body><div id="wrapper"><div class="masthead"><a href="/">{text(0, 3)}</a></div>
      <div class="navbar"><ul><li><a href="/1">One</a></li><li><a href="/2">Two</a></li><li><a href="/3">Three</a></li></ul></div>
      <div class="cookie-notice"><p>{text(1, 12)}</p><button>OK</button></div>
      <div class="post-content"><h1>{text(2, 6)}</h1><p>{text(3, 35)}</p><p>{text(4, 30)} &amp; more</p>
        <div class="advert"><p>{text(5, 9)}</p></div><p>{text(6, 33)}</p></div>
      <div class="sidebar"><h3>Related</h3><ul><li><a href="/4">{text(7, 4)}</a></li><li><a href="/5">{text(8, 4)}</a></li></ul></div>
      <section class="comments"><div class="comment"><b>Ann</b><p>{text(9, 20)}</p></div><div class="comment"><p>{text(10, 25)}</p></div></section>
      <form><label>Mail</label><input><button>Go</button></form><div class="site-footer"><p>{text(11, 8)}</p></div></div></body></html>"""
    (got,) = pages.extract([dom.read(page)], fitted)
    assert got == "\n\n".join([text(2, 6), text(3, 35), text(4, 30) + " & more", text(6, 33)])


def test_hard_rows(spark):
    importable(spark)
    base = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").orderBy("page_id").limit(60).collect()]
    hard = [(1, "u", None), (2, None, ""), (None, "u", base[0]), (3, "u", base[0]), (3, "u", base[0]), (4, "u", " \n "), (5, "u", "no markup at all"),
            (6, "u", "<div>" * 5000 + "deep"), (7, "u", base[1].replace("</article>", "<p>" + "long text here. " * 100_000 + "</p></article>"))]
    rows = [(i, u, h, "t", 5) for i, u, h in hard] + [(100 + k, "v", h, "t", 5) for k, h in enumerate(base)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int").repartition(3)
    got = pages.main_text(table, sample=40).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by = {}
    for r in got:
        by.setdefault(r.page_id, []).append(r.text)
    assert by[1] == by[2] == by[4] == [""] and by[3] == [article(base[0])] * 2 and by[None] == [article(base[0])]
    assert by[7][0].startswith(article(base[1])) and by[7][0].endswith(("long text here. " * 100_000).strip())
    assert pages.main_text(table.where("1 = 0")).collect() == []
    assert [r.text for r in pages.main_text(table.where("page_id in (1, 2, 4)")).collect()] == ["", "", ""]
