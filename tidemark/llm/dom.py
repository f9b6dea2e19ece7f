"""A tolerant HTML reader that gives the nodes and text pieces of a page as flat lists, in page order."""

from __future__ import annotations

import re
from html import unescape
from typing import NamedTuple

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*)>?")  # a quote is never closed
ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
TRUTH = re.compile(r'data-truth="([01])"')
LETTERS = re.compile(r"[a-z]+")

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object select".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table "
    "tbody td tfoot th thead tr ul".split())
# An element that opens closes an open one of these, unless one of the barriers lies between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"form"}), "body": ({"head"}, {"html"}),
}
# Blocks that may stand inside a paragraph's parent but never inside a paragraph.
NO_PARAGRAPH = BLOCKS - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "li", "dd", "dt", "option", "legend", "button",
                         "html", "head", "body", "summary", "figcaption"}
SCOPE = frozenset("html body article section div main aside td th table button blockquote li dd form nav header footer".split())


class Page(NamedTuple):
    """Nodes of a page, parents first, and its pieces of text.

    A node is a block element, an inline element with a class, id or role, or a run of text beside such nodes (tag
    '#run'). A piece is ``(node, block, text)``; pieces of one block number stand in one block. ``truth`` is what a
    mark in a training page says of a node: 1 main text, 0 not, None nothing.
    """

    tags: list[str]
    parents: list[int]
    names: list[tuple[str, ...]]
    links: list[int]
    pieces: list[tuple[int, int, str]]
    truth: list[str | None]


def read(html: str) -> Page:
    """The page of any text: unclosed, misnested and unknown elements are allowed; references are decoded."""
    tags, parents, names, truth = ["#page"], [-1], [()], [None]
    linked = [0]  # characters of link text directly in a node
    pieces: list[tuple[int, int, str]] = []
    stack: list[tuple[str, int]] = [("#page", 0)]  # open elements, each with the node that texts in it belong to
    block, at, size, links_open = 0, 0, len(html), 0

    def text(raw: str) -> None:
        if raw:
            decoded = unescape(raw) if "&" in raw else raw
            pieces.append((stack[-1][1], block, decoded))
            if links_open:
                linked[stack[-1][1]] += len(decoded.strip())

    def close_to(k: int) -> None:
        nonlocal block, links_open
        for tag, _ in stack[k:]:
            block += tag in BLOCKS
            links_open -= tag == "a"
        del stack[k:]

    while at < size:
        lt = html.find("<", at)
        if lt < 0:
            text(html[at:])
            break
        nxt = html[lt + 1 : lt + 2]
        if nxt == "!" or nxt == "?":
            text(html[at:lt])
            end = html.find("-->", lt + 4) if html.startswith("<!--", lt) else html.find(">", lt)
            at = size if end < 0 else end + (3 if html[end] == "-" else 1)
            continue
        m = TAG.match(html, lt) or LOOSE.match(html, lt)
        if not m:
            if nxt == "/":  # an end tag without a name is a comment
                text(html[at:lt])
                end = html.find(">", lt)
                at = size if end < 0 else end + 1
            else:
                text(html[at : lt + 1])
                at = lt + 1
            continue
        text(html[at:lt])
        at = m.end()
        tag = m[2].lower()
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    close_to(k)
                    break
                if tag not in BLOCKS and stack[k][0] in SCOPE:
                    break  # an inline end tag does not close blocks around it
            continue
        if tag in NO_PARAGRAPH:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p":
                    close_to(k)
                    break
                if stack[k][0] in SCOPE:
                    break
        if tag in CLOSES:
            shut, barrier = CLOSES[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in shut:
                    close_to(k)
                    break
                if stack[k][0] in barrier:
                    break
        block += tag in BLOCKS
        own: tuple[str, ...] = ()
        if m[3] and "=" in m[3]:
            own = tuple(w for a in ATTRIBUTE.finditer(m[3]) for w in LETTERS.findall((a[2] or a[3] or a[4] or "").lower()))
        node = stack[-1][1]
        if tag in BLOCKS or own or tag in RAW:
            node = len(tags)
            tags.append(tag)
            parents.append(stack[-1][1])
            names.append(own)
            known = TRUTH.search(m[3]) if "data-truth" in m[3] else None
            truth.append(known[1] if known else None)
            linked.append(0)
        if tag in RAW and not m[3].endswith("/"):
            end = find_end(html, tag, at)
            if tag == "textarea":
                block += 1
            at = end
            continue
        if tag == "br":
            text(" ")
        if tag not in VOID:
            stack.append((tag, node))
            links_open += tag == "a"
    return runs(Page(tags, parents, names, linked, pieces, truth))


def find_end(html: str, tag: str, at: int) -> int:
    """Where the raw text of ``tag`` ends, its end tag included."""
    m = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.IGNORECASE).search(html, at)
    return m.end() if m else len(html)


def runs(page: Page) -> Page:
    """Give every run of text beside child nodes a node of its own; pieces of blanks stay with their element."""
    inner = set(page.parents)
    pieces, last = [], None
    for node, block, text in page.pieces:
        if node in inner and not text.isspace():
            key = (node, block)
            if last is None or last[0] != key or last[1] != len(page.tags) - 1:
                page.tags.append("#run")
                page.parents.append(node)
                page.names.append(())
                page.links.append(0)
                page.truth.append(None)
                last = (key, len(page.tags) - 1)
            pieces.append((last[1], block, text))
        else:
            if not text.isspace():
                last = None
            pieces.append((node, block, text))
    return page._replace(pieces=pieces)
