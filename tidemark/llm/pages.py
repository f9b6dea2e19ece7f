"""Main text of web pages: boosted trees over DOM-node features, then one consistent decision per page.

Every node is frame (holds main text and other things, or stands above both), main text, or other. The trees give the
probabilities of the three from the node's own features; the most probable labelling of the whole tree is found in
which below main text stands main text or a part cut out of it, and below a part that is out nothing is main text.

Learned from a bounded sample of the given pages, of two kinds: pages whose marks leave no doubt (one ``article`` or
``main`` outside all menus and footers), and layouts made of the sampled pages' own blocks in which the place of every
block is known by construction. The layouts teach what the given pages may lack: pages without ``article``, sidebars,
notices, adverts, forms and reader comments.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator
from html import escape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import boosting, dom
from .common import blocks

FRAME, MAIN, OUT = 0, 1, 2
SPACE = re.compile(r"\s+")
STOPS = re.compile(r"[.!?…。！？]")

GROUPS = [
    {"article", "main"}, {"nav", "menu", "search"}, {"header", "hgroup"}, {"footer"}, {"aside", "dialog"},
    {"form", "fieldset", "button", "option", "legend", "label", "input"} | {"select", "textarea"},
    dom.RAW - {"select", "textarea"}, {"h1"}, {"h2", "h3", "h4", "h5", "h6"}, {"p"}, {"blockquote", "pre", "figure", "figcaption"},
    {"ul", "ol", "dl"}, {"li", "dt", "dd"}, {"table", "tbody", "thead", "tr", "td", "th"}, {"div"}, {"section"}, {"body"}, {"#run"},
]
GROUP = {tag: k for k, tags in enumerate(GROUPS) for tag in tags}
# What decides by name alone: never main text, whatever the trees say.
NEVER = dom.RAW | {"head", "form", "button", "option", "fieldset", "legend", "nav", "footer"}


class Model(NamedTuple):
    """Fitted trees and the evidence of attribute words (positive: main text)."""

    trees: boosting.Trees
    words: dict[str, float]


def features(page: dom.Page, words: dict[str, float]) -> np.ndarray:
    """One row of numbers per node; every pass over the nodes is linear."""
    n = len(page.tags)
    parents = np.array(page.parents)
    chars, count, stops, blocks = (np.zeros(n) for _ in range(4))
    own = np.zeros(n)
    seen: set[tuple[int, int]] = set()
    for node, block, text in page.pieces:
        size = len(text.strip())
        if size:
            own[node] += size
            count[node] += text.count(" ") + 1
            stops[node] += len(STOPS.findall(text))
            if (node, block) not in seen:
                seen.add((node, block))
                blocks[node] += 1
    chars += own
    links = np.array(page.links, float)
    paragraphs = np.array([t == "p" for t in page.tags], float)
    lists = np.array([t in ("li", "option", "input") for t in page.tags], float)
    below = np.ones(n)
    children, depth, nth, same = (np.zeros(n) for _ in range(4))
    kinds: Counter = Counter()
    for k in range(1, n):
        p = parents[k]
        depth[k] = depth[p] + 1
        nth[k] = children[p]
        children[p] += 1
        kinds[p, page.tags[k]] += 1
    for k in range(1, n):
        same[k] = kinds[parents[k], page.tags[k]]
    largest = np.zeros(n)
    for k in range(n - 1, 0, -1):
        p = parents[k]
        for a in (chars, count, stops, blocks, links, paragraphs, lists, below):
            a[p] += a[k]
        largest[p] = max(largest[p], chars[k])
    up = np.maximum(parents, 0)
    group = np.array([GROUP.get(t, len(GROUPS)) for t in page.tags])
    said = np.array([max((words.get(w, 0.0) for w in names), key=abs, default=0.0) for names in page.names])
    above_out, above_in = np.zeros(n), np.zeros(n)
    for k in range(1, n):
        p = parents[k]
        above_out[k] = min(above_out[p], said[p])
        above_in[k] = max(above_in[p], said[p])
    many = np.log1p
    total = max(chars[0], 1.0)
    x = [
        group, group[up], said, above_out, above_in, depth, nth, many(children), many(children[up]),
        nth / np.maximum(children[up], 1), same / np.maximum(children[up], 1), many(chars), many(own), many(count),
        links / np.maximum(chars, 1), many(below), chars / below, chars / total, many(paragraphs), many(lists),
        stops / np.maximum(count, 1), count / np.maximum(blocks, 1), many(blocks), chars / np.maximum(largest[up], 1),
        chars[up] / total, links[up] / np.maximum(chars[up], 1), chars[up] / below[up],
    ]
    hot = [(group == g).astype(float) for g in range(len(GROUPS) + 1)] + [(group[up] == g).astype(float) for g in (0, 1, 2, 3, 4, 5, 16)]
    return np.stack(x[2:] + hot, 1)


def decode(page: dom.Page, log_p: np.ndarray) -> list[int]:
    """The most probable labels of which no node contradicts one above it.

    Below a frame all three may stand, below main text main text or out, below out only out. Nodes that are never main
    text and empty runs of names are out. One pass up and one down, without recursion.
    """
    n = len(page.tags)
    own = log_p.copy()
    inner = set(page.parents)
    for k in range(n):
        if page.tags[k] in NEVER:
            own[k, [FRAME, MAIN]] = -1e9
        elif k not in inner:
            own[k, FRAME] = -1e9  # a leaf is in or out
    own[0] = [0.0, -1e9, -1e9]
    gain = own.copy()
    for k in range(n - 1, 0, -1):
        p, (frame, main, out) = page.parents[k], gain[k]
        gain[p, FRAME] += max(frame, main, out)
        gain[p, MAIN] += max(main, out)
        gain[p, OUT] += out
    label = [FRAME] * n
    for k in range(1, n):
        above = label[page.parents[k]]
        frame, main, out = gain[k]
        if above == OUT:
            label[k] = OUT
        elif above == MAIN:
            label[k] = MAIN if main >= out else OUT
        else:
            label[k] = FRAME if frame > max(main, out) else MAIN if main >= out else OUT
    return label


def joined(page: dom.Page, label: list[int]) -> str:
    """The blocks of main text: white space within a block is one space, blocks are two line feeds apart."""
    found: list[list[str]] = []
    last = None
    for node, block, text in page.pieces:
        if label[node] == MAIN or text.isspace():
            if block != last:
                found.append([])
                last = block
            found[-1].append(text)
    blocks = (SPACE.sub(" ", "".join(parts)).strip() for parts in found)
    return "\n\n".join(b for b in blocks if b)


def extract(pages: list[dom.Page], model: Model | None) -> list[str]:
    """Main text of each page. Without a model nothing was there to learn from, and every text is empty."""
    if model is None:
        return ["" for _ in pages]
    x = [features(p, model.words) for p in pages]
    log_p = boosting.apply(model.trees, np.concatenate(x)) if x else np.zeros((0, 3))
    ends = np.cumsum([len(a) for a in x])
    return [joined(p, decode(p, log_p[end - len(a) : end])) for p, a, end in zip(pages, x, ends, strict=True)]


# ---- learning ----

CHROME = {"nav", "header", "footer", "aside", "form", "dialog", "menu", "search"} | dom.RAW


def marked(page: dom.Page) -> list[int] | None:
    """Labels of a page whose element names leave no doubt: one ``article`` or ``main`` that lies in nothing of the frame."""
    n, tags, parents = len(page.tags), page.tags, page.parents
    inside, chrome = [False] * n, [False] * n
    roots = []
    for k in range(1, n):
        inside[k], chrome[k] = inside[parents[k]], chrome[parents[k]]
        if tags[k] in ("article", "main") and not inside[k] and not chrome[k]:
            roots.append(k)
            inside[k] = True
        elif tags[k] in CHROME and not (tags[k] == "header" and inside[k]):
            chrome[k] = True
    if len(roots) != 1:
        return None
    label = [OUT if chrome[k] else MAIN if inside[k] else OUT for k in range(n)]
    k = parents[roots[0]]
    while k >= 0:
        label[k] = FRAME
        k = parents[k]
    return label


def told(page: dom.Page) -> list[int]:
    """Labels of a layout, from the marks written into it."""
    n = len(page.tags)
    label, holds = [FRAME] * n, [False] * n
    for k in range(1, n):
        above = label[page.parents[k]]
        said = page.truth[k]
        label[k] = OUT if above == OUT or said == "0" or page.tags[k] in dom.RAW | {"head"} else MAIN if said == "1" else above
    for k in range(n - 1, 0, -1):
        holds[k] |= label[k] == MAIN
        holds[page.parents[k]] |= holds[k]
    return [label[k] if label[k] != FRAME or holds[k] or k == 0 else OUT for k in range(n)]


# Words that page authors use for parts of a page.
OUT_NAMES = {
    "menu": "nav menu navbar navigation topnav mainmenu breadcrumb breadcrumbs pagination toc".split(),
    "head": "header masthead topbar site-header branding logo banner page-header".split(),
    "side": "sidebar aside side-column widget related recommended popular trending tags secondary rail teaser".split(),
    "note": "cookie cookie-notice notice consent gdpr alert popup modal overlay newsletter subscribe disclaimer".split(),
    "ad": "ad ads advert advertisement sponsored promo promotion adsense banner-ad".split(),
    "share": "share social sharing follow buttons meta toolbar".split(),
    "form": "login signup search search-form contact form subscribe-form".split(),
    "comments": "comments comment comment-list reader-comments responses discussion replies disqus comment-body reply".split(),
    "foot": "footer site-footer copyright colophon bottom legal credits".split(),
}
IN_NAMES = "content article post entry story main body text post-content article-body entry-content main-content".split()
FRAME_NAMES = "page wrapper container wrap site layout row inner outer columns".split()


def layout(rng: random.Random, good: list[str], other: list[str]) -> str:
    """A page made of given blocks, marked by ``data-truth``: 1 on main text, 0 on what is not."""
    pick, chance = rng.choice, lambda p: rng.random() < p
    some = lambda lo, hi: [escape(pick(other)) for _ in range(rng.randint(lo, hi))]

    def attribute(kind: str, p: float = 0.85) -> str:
        names = FRAME_NAMES if kind == "frame" else IN_NAMES if kind == "in" else OUT_NAMES[kind]
        return f' {pick(["class", "class", "id"])}="{pick(names)}"' if chance(p) else ""

    def links(kind: str, tags: list[str]) -> str:
        items = "".join(f'<li><a href="/x">{t}</a></li>' for t in some(2, 9)) if chance(0.8) else " | ".join(
            f'<a href="/x">{t}</a>' for t in some(2, 9))
        tag = pick(tags)
        return f'<{tag}{attribute(kind, 0.9 if tag == "div" else 0.4)} data-truth="0">{"<ul>" + items + "</ul>" if items[:3] == "<li" else items}</{tag}>'

    def box(kind: str, tags: list[str]) -> str:
        tag = pick(tags)
        texts = [escape(pick(good)) for _ in range(rng.randint(1, 3))] if chance(0.4) else some(1, 4)
        inner = "".join(f"<p>{t}</p>" for t in texts) if chance(0.7) else " ".join(texts)
        title = f"<h3>{escape(pick(other))}</h3>" if chance(0.3) else ""
        return f'<{tag}{attribute(kind, 1.0 if tag in ("div", "section", "p") else 0.5)} data-truth="0">{title}{inner}</{tag}>'

    def form() -> str:
        return (f'<form{attribute("form", 0.6)} data-truth="0"><label>{escape(pick(other))}</label><input type="text">'
                f'<p>{escape(pick(other))}</p><button>{escape(pick(other))}</button></form>')

    def comments() -> str:
        one = [f'<{pick(["div", "li", "article"])}{attribute("comments")}><b>{escape(pick(other))}</b> <p>{escape(pick(good))}</p>'
               for _ in range(rng.randint(1, 6))]
        body = "".join(c + f"</{c[1:c.index(' ')] if ' ' in c[: c.index('>')] else c[1:c.index('>')]}>" for c in one)
        title = f"<h2>{escape(pick(other))}</h2>" if chance(0.6) else ""
        return f'<{pick(["section", "div", "div"])}{attribute("comments", 1.0)} data-truth="0">{title}{body}'

    def main_block() -> str:
        t = escape(pick(good))
        kind = rng.random()
        if kind < 0.72:
            return pick([f"<p>{t}</p>", f"<p>{t}", f"<p><b>{t}</b><br><p>{escape(pick(good))}</p>", f"<p>{t} <a href='/y'>{escape(pick(other))}</a></p>"])
        if kind < 0.8:
            return f"<{pick(['h2', 'h3'])}>{escape(pick(other))}</h2>"
        if kind < 0.87:
            return "<ul>" + "".join(f"<li>{escape(x)}</li>" for x in [pick(good) for _ in range(rng.randint(1, 5))]) + "</ul>"
        if kind < 0.91:
            return f"<blockquote>{t}</blockquote>"
        if kind < 0.94:
            return f"<table><tr><td>{t}</td><td>{escape(pick(other))}</td></tr></table>"
        return pick([box("ad", ["div", "aside"]), links("share", ["div", "ul"]), box("side", ["div", "aside"]), box("note", ["div"]), form()])

    tag = pick(["article", "main", "div", "div", "div", "section"])
    body = [main_block() for _ in range(rng.choice([1, 2, 3, 5, 8, 13, 21]))]
    title = f"<h1>{escape(pick(good)[:80])}</h1>" if chance(0.8) else ""
    if title and chance(0.15):
        title = f"<header>{title}</header>"
    closing = comments() + pick(["</section>", "</div>"]) if chance(0.12) else ""
    story = f'<{tag}{attribute("in", 0.8 if tag == "div" else 0.4)} data-truth="1">{title}{"".join(body)}{closing}</{tag}>'
    before = [part for p, part in [
        (0.3, lambda: box("head", ["header", "div"])), (0.7, lambda: links("menu", ["nav", "nav", "div", "ul"])),
        (0.2, lambda: box("note", ["div", "aside", "section"])), (0.4, lambda: box("ad", ["div", "div", "aside"])),
        (0.15, lambda: links("menu", ["div", "nav"])), (0.1, form)] if chance(p) for part in [part()]]
    after = [part for p, part in [
        (0.25, lambda: box("side", ["aside", "div", "section"])), (0.2, lambda: links("side", ["aside", "div"])),
        (0.25, lambda: comments() + "</div>"), (0.2, lambda: box("ad", ["div"])), (0.1, form), (0.1, lambda: box("note", ["div"])),
        (0.8, lambda: box("foot", ["footer", "footer", "div"]))] if chance(p) for part in [part()]]
    if chance(0.2):
        rng.shuffle(before)
    if chance(0.3):
        story = f'<div{attribute("frame", 0.7)}>{story}{after.pop(0) if after and chance(0.6) else ""}</div>'
    inside = "".join(before) + story + "".join(after)
    if chance(0.5):
        inside = f'<div{attribute("frame", 0.9)}>{inside}</div>'
    head = f"<head><title>{escape(pick(other))}</title><style>p{{}}</style></head>" if chance(0.8) else ""
    return f"<!DOCTYPE html><html>{head}<body>{inside}</body></html>" if chance(0.9) else inside


def blocks_of(page: dom.Page, label: list[int] | None) -> tuple[list[str], list[str]]:
    """Main and other blocks of a page; where labels are missing, long blocks and short ones."""
    raw = set(k for k, t in enumerate(page.tags) if t in dom.RAW)
    by: dict[tuple[int, int], list[str]] = {}
    for node, block, text in page.pieces:
        if node not in raw:
            by.setdefault((block, node), []).append(text)
    good, other = [], []
    for (_, node), parts in by.items():
        t = SPACE.sub(" ", "".join(parts)).strip()
        if t:
            main = label[node] == MAIN if label else t.count(" ") > 7
            (good if main else other).append(t)
    return good, other


def fit(pages: list[str], layouts: int = 3, seed: int = 42) -> Model | None:
    """A model from sampled pages and ``layouts`` made of the blocks of each; None without any text."""
    read = [dom.read(p) for p in pages]
    labels = [marked(p) for p in read]
    goods, others = [], []
    for p, label in zip(read, labels, strict=True):
        good, other = blocks_of(p, label)
        goods.append(good)
        others.append(other)
    all_good, all_other = [t for g in goods for t in g], [t for o in others for t in o]
    if not all_good:
        all_good = all_other
    if not all_good:
        return None
    short = all_other or [" ".join(t.split()[:4]) for t in all_good]
    examples = [(p, label) for p, label in zip(read, labels, strict=True) if label]
    rng = random.Random(seed)
    for good, other in zip(goods, others, strict=True):
        for _ in range(layouts):
            page = dom.read(layout(rng, good + rng.sample(all_good, min(4, len(all_good))), other + rng.sample(short, min(4, len(short)))))
            examples.append((page, told(page)))
    # Evidence of a word: log odds of standing on main text, smoothed; words of the frame say little.
    inside, outside = Counter(), Counter()
    for page, label in examples:
        for names, what in zip(page.names, label, strict=True):
            for w in set(names):
                if what != FRAME:
                    (inside if what == MAIN else outside)[w] += 1
    words = {w: float(np.log((inside[w] + 0.5) / (outside[w] + 0.5))) for w in sorted(inside | outside)}
    x = np.concatenate([features(p, words) for p, _ in examples])
    y = np.concatenate([np.array(label) for _, label in examples])
    use = np.concatenate([np.arange(len(label)) > 0 for _, label in examples])
    return Model(boosting.fit(x[use], y[use], 3), words)


def learn(pages: DataFrame, sample: int = 256, most: int = 100_000) -> Model | None:
    """A model from the ``sample`` pages with the smallest hashes among those of at most ``most`` characters.

    Equal pages count once. At most ``sample * most`` characters travel to the driver, a few MB on ordinary pages.
    """
    rows = pages.select("html").where(F.col("html").isNotNull() & (F.length("html") <= most))
    rows = rows.select(F.xxhash64("html").alias("h"), "html")
    # At most ``sample`` numbers, so the pages stay where they are.
    picked = rows.select("h").distinct().orderBy("h").limit(sample)
    found = rows.join(F.broadcast(picked), "h").groupBy("h").agg(F.min("html").alias("html")).collect()
    return fit([r.html for r in sorted(found, key=lambda r: r.h)])


def main_text(pages: DataFrame, sample: int = 256) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page, whole; nothing is dropped or capped.

    A null or empty page, or one without main text, has the empty text. Equal rows give equal texts. Other columns are
    not looked at, and neither the id nor the address is. An empty table gives no rows.
    """
    model = learn(pages, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, 2, 64, 1 << 20):
                texts = extract([dom.read(h or "") for h in part.column(2).to_pylist()], model)
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    found = pages.select("page_id", "url", "html")
    schema = T.StructType([*found.schema.fields[:2], T.StructField("text", T.StringType())])
    return found.mapInArrow(run, schema).withColumn("n_chars", F.length("text").cast("long"))
