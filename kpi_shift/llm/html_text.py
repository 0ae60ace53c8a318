"""Main text of web pages by composite text density.

A page becomes a small tree. Each node has the characters and tags below it, and how many of both belong to links; its
density is characters per tag, lowered where links prevail. The node whose children's densities have the greatest sum
is the main one. The least density on its path up to the body is the threshold: every node that reaches it gives the
subtree of greatest sum below it. Menus, forms, notices and the like are cut before, by tag, role, class or id.

Each page is a row by itself: nothing is shuffled.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names as HTML defines them, and usual names of page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
CUT_TAGS = frozenset(
    "head script style title textarea noscript iframe template nav footer aside form button select datalist dialog menu "
    "object embed svg canvas audio video map xmp noembed noframes label".split()
)
CUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
CUT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar aside footer foot masthead comment comments disqus discussion replies notice notices cookie cookies "
    "consent gdpr popup modal newsletter subscribe subscription signup login share sharing social related recommended recommendations "
    "widget toolbar pagination pager skip disclaimer alert".split()
)
#: Names that content has too: they cut only where links confirm it.
WEAK_NAMES = frozenset(
    "discussion menu related recommended recommendations notice notices alert disclaimer aside social share sharing promotion "
    "navigation skip foot banner widget".split()
)
COMMENT_NAMES = frozenset("comment comments disqus replies".split())
LINKED = 1 / 3  # share of a node's characters in links that confirms a weak name
OUTER_NAMES = frozenset("header head topbar".split())
KEPT_TAGS = frozenset("html body main article h1".split())
CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table select menu body html article section main div".split())

TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
NAME = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Page:
    """The tree as parallel lists; node 0 is the root. Blocks hold (node, text) in page order."""

    def __init__(self) -> None:
        self.tag, self.parent, self.cut, self.named = ["html"], [-1], [False], [False]
        self.weak, self.comments = [False], [False]
        self.text: list[tuple[int, int, str]] = []  # block, node, text
        self.block_node: list[int] = [0]

    def add(self, tag: str, parent: int, attributes: str) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        cut, named, weak, comments = tag in CUT_TAGS, False, False, False
        if attributes and attributes.strip(" /"):
            found = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(attributes)}
            names = {n.lower() for n in NAME.findall(f"{found.get('class', '')} {found.get('id', '')}")}
            cut |= found.get("role", "").lower() in CUT_ROLES or "hidden" in found or found.get("aria-hidden") == "true"
            cut |= bool(HIDDEN.search(found.get("style", "")))
            named = bool(names & CUT_NAMES) and tag not in KEPT_TAGS
            weak = named and not names & (CUT_NAMES - WEAK_NAMES)
            comments = bool(names & COMMENT_NAMES)
            self.outer = bool(names & OUTER_NAMES) and tag not in KEPT_TAGS
            if self.outer and not self.inside_article(parent):
                named, weak = True, False
        if tag == "header" and not self.inside_article(parent):
            named, weak = True, False
        self.cut.append(cut and tag not in ("html", "body"))
        self.named.append(named)
        self.weak.append(weak)
        self.comments.append(comments)
        return len(self.tag) - 1

    def inside_article(self, node: int) -> bool:
        while node >= 0:
            if self.tag[node] in ("article", "main"):
                return True
            node = self.parent[node]
        return False


def parse(source: str) -> Page:
    """A forgiving tree: unknown ends are ignored, paragraphs and items end where the next block or item begins."""
    page, stack, at = Page(), [0], 0

    def new_block() -> None:
        node = next(n for n in reversed(stack) if n == 0 or page.tag[n] in BLOCKS)
        page.block_node.append(node)

    def write(text: str) -> None:
        if text:
            page.text.append((len(page.block_node) - 1, stack[-1], html.unescape(text)))

    def pop_to(depth: int) -> None:
        block = any(page.tag[n] in BLOCKS for n in stack[depth:])
        del stack[depth:]
        if block:
            new_block()

    while (found := TOKEN.search(source, at)) is not None:
        write(source[at : found.start()])
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            if tag in ("html", "body"):
                continue
            depth = next((i for i in range(len(stack) - 1, 0, -1) if page.tag[stack[i]] == tag), 0)
            if depth and (tag in BLOCKS or not any(page.tag[n] in BLOCKS for n in stack[depth + 1 :])):
                pop_to(depth)
            continue
        if tag in ("html", "body"):
            if tag == "body" and not any(page.tag[n] == "body" for n in stack):
                pop_to(1)
                stack.append(page.add(tag, 0, found[3]))
                new_block()
            continue
        for other in CLOSED_BY.get(tag, ()):
            depth = next((i for i in range(len(stack) - 1, 0, -1) if page.tag[stack[i]] == other or page.tag[stack[i]] in SCOPES), 0)
            if depth and page.tag[stack[depth]] == other:
                pop_to(depth)
        if tag in BLOCKS:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if page.tag[stack[i]] == "p"), 0)
            if depth:
                pop_to(depth)
        if tag in ("br", "td", "th", "img", "option"):
            write(" ")
        node = page.add(tag, stack[-1], found[3])
        if tag in VOID or found[3].endswith("/") and tag not in BLOCKS:
            if tag == "hr":
                new_block()
            continue
        if tag in RAW:  # up to its end, nothing is markup
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(source, at)
            at = end.end() if end else len(source)
            continue
        stack.append(node)
        if tag in BLOCKS:
            new_block()
    write(source[at:])
    return page


def _drop(page: Page) -> list[bool]:
    """Nodes in or below furniture.

    A name alone cuts no node that holds the article or most of the text that tags and roles leave; comments may hold most
    of it, or articles, beside the page's own. A name that content has too cuts only where links are ``LINKED`` of the text.
    """
    count = len(page.tag)
    by_tag = [False] * count
    linked = [False] * count
    for n in range(1, count):
        by_tag[n] = by_tag[page.parent[n]] or page.cut[n] and page.tag[n] not in ("article", "main")
        linked[n] = page.tag[n] == "a" or linked[page.parent[n]]
    size = _sizes(page, by_tag)
    links = _sizes(page, [by_tag[n] or not linked[n] for n in range(count)])
    marks = [t in ("article", "main") and bool(size[n]) for n, t in enumerate(page.tag)]
    heads = [m or t == "h1" and bool(size[n]) for n, (m, t) in enumerate(zip(marks, page.tag, strict=True))]
    holds, headed = [int(m) for m in marks], [int(h) for h in heads]
    for n in range(count - 1, 0, -1):
        holds[page.parent[n]] += holds[n]
        headed[page.parent[n]] += headed[n]
    gone = [False] * count
    for n in range(1, count):
        by_name = page.named[n] and size[n] > 0
        if by_name and page.comments[n]:
            only = holds[n] and holds[n] == holds[0] or 2 * size[n] > size[0] and headed[n] == headed[0]
            by_name = not only
        elif by_name:
            by_name = not holds[n] and 2 * size[n] <= size[0] and (not page.weak[n] or links[n] >= LINKED * size[n])
        gone[n] = gone[page.parent[n]] or by_tag[n] or by_name
    return gone


def _sizes(page: Page, gone: list[bool] | None) -> list[int]:
    size = [0] * len(page.tag)
    for _, node, text in page.text:
        if gone is None or not gone[node]:
            size[node] += len("".join(text.split()))
    for n in range(len(page.tag) - 1, 0, -1):
        size[page.parent[n]] += size[n]
    return size


def densities(page: Page, gone: list[bool], root: int) -> tuple[list[float], list[float]]:
    """Composite text density of each node, and the sum over its children."""
    n = len(page.tag)
    chars = _sizes(page, gone)
    link = [False] * n
    for i in range(1, n):
        link[i] = page.tag[i] == "a" or link[page.parent[i]]
    tags, link_tags, link_chars = [0] * n, [0] * n, [0] * n
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        if page.tag[i] == "a":
            link_chars[i] = chars[i]
        if not gone[i]:
            tags[p] += tags[i] + 1
            link_tags[p] += link_tags[i] + link[i]
            link_chars[p] += link_chars[i]
    share = link_chars[root] / max(1, chars[root])
    density, sums = [0.0] * n, [0.0] * n
    for i in range(n - 1, 0, -1):
        if gone[i] or not chars[i]:
            continue
        c, t, lc, lt = chars[i], max(1, tags[i]), max(1, link_chars[i]), max(1, link_tags[i])
        base = math.log(c / max(1, c - link_chars[i]) * link_chars[i] + share * c + math.e)
        density[i] = c / t * math.log(max(1.0, c / lc * t / lt)) / math.log(base + 1e-9) if base > 1 + 1e-6 else c / t * math.log(max(math.e, c / lc * t / lt))
        sums[page.parent[i]] += density[i]
    return density, sums


def main_text(source: str | None) -> str:
    """Blocks of the main content, one a line, white space within a block as one space. Empty if there is none."""
    if not source:
        return ""
    page = parse(source)
    gone = _drop(page)
    size = _sizes(page, gone)
    if not size[0]:
        return ""
    articles = [i for i, t in enumerate(page.tag) if t == "article" and size[i] and not gone[i]]
    outer = [i for i in articles if not any(a in articles for a in _path(page, page.parent[i]))]
    mains = [i for i, t in enumerate(page.tag) if t == "main" and size[i] and not gone[i]]
    bodies = [i for i, t in enumerate(page.tag) if t == "body"]
    body = bodies[0] if bodies else 0
    # a mark is evidence only: it must hold most of the text or the node of greatest sum
    _, sums = densities(page, gone, body)
    best = max((i for i in range(body + 1, len(page.tag)) if size[i] and not gone[i]), key=lambda i: (sums[i], -i), default=body)
    marks = [m[0] for m in (outer, mains) if len(m) == 1]
    marked = next((m for m in marks if 2 * size[m] > size[0] or m in _path(page, best)), None)
    root = body if marked is None else marked
    density, sums = densities(page, gone, root)
    below = [False] * len(page.tag)
    below[root] = True
    for i in range(root + 1, len(page.tag)):
        below[i] = below[page.parent[i]] and not gone[i]
    # text right in the root counts as a child of it
    best = max((i for i in range(root, len(page.tag)) if below[i]), key=lambda i: (sums[i], -i))
    threshold = min((density[i] for i in _path(page, best, root) if density[i] > 0), default=0.0)
    chosen = [False] * len(page.tag)
    top = list(range(len(page.tag)))  # the node of greatest sum in each subtree
    for i in range(len(page.tag) - 1, root, -1):
        if below[i] and (sums[top[i]], -top[i]) > (sums[top[page.parent[i]]], -top[page.parent[i]]):
            top[page.parent[i]] = top[i]
    for i in range(root, len(page.tag)):
        if below[i] and (i == root or density[i] >= threshold > 0):
            chosen[top[i] if sums[top[i]] > 0 else i] = True
    if marked is not None:  # the page says itself where its article is, and its text agrees; nothing in it is dropped
        chosen[root] = True
    for i in range(root + 1, len(page.tag)):
        chosen[i] |= chosen[page.parent[i]]
    blocks: dict[int, list[str]] = {}
    for block, node, text in page.text:
        if below[node] and chosen[node] and not gone[node]:
            blocks.setdefault(block, []).append(text)
    lines = (" ".join("".join(parts).split()) for _, parts in sorted(blocks.items()))
    return "\n".join(line for line in lines if line)


def _path(page: Page, node: int, root: int = -1) -> Iterator[int]:
    while node >= 0:
        yield node
        if node == root:
            return
        node = page.parent[node]


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("html")
        texts = []
        for first in range(0, batch.num_rows, 256):
            texts += map(main_text, batch.column(at).slice(first, 256).to_pylist())
        sizes = pa.array([len(t) for t in texts], pa.int64())
        rest = batch.drop_columns(["html"])
        yield rest.append_column("text", pa.array(texts, pa.string())).append_column("n_chars", sizes)


def extract_text(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep``, ``text`` and ``n_chars`` (code points) of every page.

    A null or empty ``html``, or one without text, gives an empty text. Repeated rows are extracted each for itself; an
    empty table gives an empty result; columns other than ``keep`` and ``html`` are not read.
    """
    rows = pages.select(*keep, F.col("html"))
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep) + ", text string, n_chars bigint"
    return rows.mapInArrow(_extract, schema)
