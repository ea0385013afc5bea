"""Main text of HTML pages with a tree-structured graphical model over DOM nodes.

Each block element of a page is a node with a hidden label, content or not.  A node's
potential comes from its tag, its class and id words, its link density, its text and its
place; a parent-child potential, by the child's kind, ties neighbours.  Sum-product
messages run up from the leaves and down from the root, which gives every node's exact
marginal in two sweeps.  All pages of a batch form one forest and are swept depth by
depth with numpy, so deep or long pages take no recursion.

The weights are fitted, by the same messages, on labelled pages (``html_pages``).

A page's text: the blocks of nodes whose content marginal is above one half, in page
order, one a line.  Character references are decoded, white space inside a block becomes
one space, ``br`` counts as white space.

Defined results: null html counts as empty; a page without content has empty text;
unclosed, misnested and truncated markup is read as far as it goes; repeated rows repeat,
and a page's text doesn't depend on the pages beside it.  Time is linear in a page's length.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import html_pages

TRAIN_PAGES = 400
STEPS = 60
BATCH_PAGES = 200

# HTML's element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp noembed noframes".split())
SKIP = frozenset("head script style title noscript template svg math iframe object canvas audio video select button textarea".split())
BLOCKS = "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html ins legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
BLOCK = frozenset(BLOCKS)
CLOSES_P = BLOCK - {"html", "body", "ins", "td", "th", "tr", "tbody", "thead", "tfoot", "dd", "dt"}
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
# Words of class, id and role that tell a part of a page.
HINTS = {
    "menu": "nav menu navbar breadcrumb breadcrumbs navigation topnav pagination pager",
    "header": "header masthead branding logo banner topbar top",
    "footer": "footer copyright colophon contentinfo bottom",
    "side": "sidebar side aside widget related recommended rail complementary",
    "notice": "cookie cookies consent gdpr notice alert popup modal disclaimer warning",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promotion",
    "form": "form newsletter subscribe search login signup",
    "comments": "comment comments reply replies discussion responses disqus",
    "share": "share social toolbar tags meta buttons",
    "content": "content article post entry main story body text",
}
HINT_OF = {w: k for k, ws in HINTS.items() for w in ws.split()}
HINT_KINDS = list(HINTS)

# A tag whose quotes don't close before the page ends reaches to its first ">".
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?=>)|[^>]*+(?=>))>|<(?=[a-zA-Z/])[^>]*\Z", re.S)
# Skipped elements that are not raw text: they may be unclosed, nested or, for svg, closed by its own slash.
NESTED = frozenset("noscript template iframe svg select button".split())
PAIRED = re.compile(rf"<!--.*?(?:-->|\Z)|<(script|style)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)({'|'.join(sorted(NESTED))})(?=[\s/>])((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S | re.I)
ATTRIBUTE = re.compile(r"(class|id|role|data-y)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"display\s*:\s*none|\bhidden\b|aria-hidden\s*=\s*[\"']?true", re.I)
SPACES = re.compile(r"\s+")

TAG_FEATURES = [*BLOCKS, "other"]
NUMERIC = ["bias", "hidden", "no_text", "few", "some", "many", "lots", "ends", "no_links", "half_links", "all_links", "below_links", "top", "late", "large", "deep", "in_main", "in_part", "in_main_only"]
# Elements that hold a page's main content, and parts of a page beside it (fixed values).
MAIN = ["article", "main"]
PARTS = ["nav", "header", "footer", "aside", "form", "menu", "dialog", "fieldset"]
WIDTH = len(TAG_FEATURES) + 2 * len(HINT_KINDS) + len(NUMERIC)
EDGES = 3  # plain child, child that is a part of its own, child with a hint


@dataclass
class Tree:
    """Block nodes of a page: parents come before children."""

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    hints: list[frozenset] = field(default_factory=list)
    hidden: list[bool] = field(default_factory=list)
    label: list[int] = field(default_factory=list)
    text: list[int] = field(default_factory=list)  # characters straight in the node
    linked: list[int] = field(default_factory=list)
    ends: list[bool] = field(default_factory=list)
    blocks: list[tuple[int, str]] = field(default_factory=list)  # (node, text)


def closings(page: str) -> dict[int, int]:
    """Where each closed element of ``NESTED`` ends, by the end of its start tag; unclosed ones are left out."""
    ends: dict[int, int] = {}
    open_tags: dict[str, list[int]] = {}
    for m in PAIRED.finditer(page):
        if m[3]:
            tag = m[3].lower()
            starts = open_tags.setdefault(tag, [])
            if m[2]:
                if starts:
                    ends[starts.pop()] = m.end()
            elif not (tag == "svg" and m[4].endswith("/")):
                starts.append(m.end())
    return ends


def parse(page: str, labelled: bool = True) -> Tree:
    """Block tree of a page, lenient as browsers are; ``labelled`` reads the training pages' data-y."""
    t = Tree()

    def node(parent: int, tag: str, attributes: str) -> int:
        found: set[str] = set()
        label = t.label[parent] if parent >= 0 else 0
        if attributes:
            for m in ATTRIBUTE.finditer(attributes):
                value = m[2] or m[3] or m[4] or ""
                if m[1].lower() == "data-y":
                    label = int(value) if labelled else label
                else:
                    found.update(HINT_OF[w] for w in re.split(r"[^a-z]+", value.lower()) if w in HINT_OF)
        t.parent.append(parent)
        t.tag.append(tag if tag in BLOCK else "other")
        t.hints.append(frozenset(found))
        t.hidden.append(bool(attributes) and bool(HIDDEN.search(attributes)))
        t.label.append(label)
        t.text.append(0)
        t.linked.append(0)
        t.ends.append(False)
        return len(t.parent) - 1

    node(-1, "other", "")
    stack: list[tuple[str, int]] = [("", 0)]  # (tag, block node) of the open elements
    opened: dict[str, int] = {}  # how many of a tag are open: what isn't open is never searched for
    pending: list[str] = []
    links = 0
    closed: dict[int, int] | None = None
    headless = False  # no end of a head follows

    def flush(owner: int) -> None:
        if pending:
            text = SPACES.sub(" ", entities.unescape("".join(pending))).strip()
            pending.clear()
            if text:
                t.blocks.append((owner, text))
                t.text[owner] += len(text)
                t.ends[owner] = text[-1] in ".!?:\"”»…"

    def said(raw: str) -> None:
        pending.append(raw)
        if links:
            t.linked[stack[-1][1]] += len(raw.strip())

    def pop(to: int) -> None:
        nonlocal links
        for tag, owner in reversed(stack[to:]):
            if tag in BLOCK:
                flush(owner)
            links -= tag == "a"
            opened[tag] -= 1
        del stack[to:]

    at, n = 0, len(page)
    while at < n:
        m = TOKEN.search(page, at)
        if m is None:
            said(page[at:])
            break
        if m.start() > at:
            said(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                said(m[0][9:].removesuffix("]]>"))
            continue
        tag = m[2].lower()
        if m[1]:
            for k in range(len(stack) - 1, 0, -1) if opened.get(tag) else ():
                if stack[k][0] == tag:
                    pop(k)
                    break
            continue
        if tag == "br":
            said(" ")
            continue
        if tag in SKIP:
            if tag in NESTED:
                if closed is None:
                    closed = closings(page)
                at = closed.get(at, at)
            elif tag in RAW or (tag == "head" and not headless):
                end = re.compile(rf"</{tag}\s*>|<body\b" if tag == "head" else rf"</{tag}\s*>", re.I).search(page, at)
                if end is None:
                    at, headless = (n, headless) if tag != "head" else (at, True)
                else:
                    at = end.start() if end[0].lower().startswith("<body") else end.end()
            continue
        if tag in VOID:
            continue
        if tag in CLOSES_P and opened.get("p"):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p":
                    pop(k)
                    break
                if stack[k][0] in BLOCK:
                    break
        if tag in SIBLINGS:
            own, scope = SIBLINGS[tag]
            for k in range(len(stack) - 1, 0, -1) if any(opened.get(x) for x in own) else ():
                if stack[k][0] in scope:
                    break
                if stack[k][0] in own:
                    pop(k)
                    break
        if tag in ("html", "body") and opened.get(tag):
            continue
        opened[tag] = opened.get(tag, 0) + 1
        if tag in BLOCK:
            flush(stack[-1][1])
            stack.append((tag, node(stack[-1][1], tag, m[3])))
        else:
            stack.append((tag, stack[-1][1]))
            links += tag == "a"
        if m[3].endswith("/"):
            pop(len(stack) - 1)
    flush(stack[-1][1])
    pop(1)
    return t


def features(trees: list[Tree]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all pages' nodes: features, parents (-1 for roots), depths, edge kinds."""
    sizes = np.array([len(t.parent) for t in trees])
    first = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    parent = np.concatenate([np.where(np.array(t.parent) < 0, -1, np.array(t.parent) + f) for t, f in zip(trees, first, strict=True)])
    n = len(parent)
    page = np.repeat(np.arange(len(trees)), sizes)
    depth = np.zeros(n, np.int64)
    x = np.zeros((n, WIDTH))
    tag_no = {tag: i for i, tag in enumerate(TAG_FEATURES)}
    hint_no = {k: i for i, k in enumerate(HINT_KINDS)}
    tags = [tag for t in trees for tag in t.tag]
    x[np.arange(n), [tag_no[tag] for tag in tags]] = 1
    base = len(TAG_FEATURES)
    own = np.zeros((n, len(HINT_KINDS)))
    for i, found in enumerate(h for t in trees for h in t.hints):
        for k in found:
            own[i, hint_no[k]] = 1
    text = np.array([v for t in trees for v in t.text], float)
    linked = np.minimum(np.array([v for t in trees for v in t.linked], float), np.maximum(text, 0))
    for i in range(n):  # parents come first
        if parent[i] >= 0:
            depth[i] = depth[parent[i]] + 1
    part = np.isin(tags, PARTS)
    in_main, in_part = np.isin(tags, MAIN), part.copy()
    all_text, all_linked, above = text.copy(), linked.copy(), own.copy()
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)
    for level in reversed(levels[1:]):
        np.add.at(all_text, parent[level], all_text[level])
        np.add.at(all_linked, parent[level], all_linked[level])
    for level in levels[1:]:
        above[level] = np.maximum(own[level], above[parent[level]])
        in_main[level] |= in_main[parent[level]]
        in_part[level] |= in_part[parent[level]]
    x[:, base : base + len(HINT_KINDS)] = own
    x[:, base + len(HINT_KINDS) : base + 2 * len(HINT_KINDS)] = above
    total = np.maximum(1.0, all_text[first][page])
    density = linked / np.maximum(1, text)
    below = all_linked / np.maximum(1, all_text)
    where = (np.arange(n) - first[page]) / np.maximum(1, sizes[page])
    flags = [np.ones(n, bool), np.array([v for t in trees for v in t.hidden]), text == 0, (text > 0) & (text < 25), (text >= 25) & (text < 80), (text >= 80) & (text < 300), text >= 300, np.array([v for t in trees for v in t.ends]), (text > 0) & (density < 0.1), (density >= 0.3) & (density < 0.8), density >= 0.8, below > 0.5, where < 0.15, where > 0.85, all_text > 0.4 * total, depth > 6, in_main, in_part, in_main & ~in_part & (above.sum(1) == above[:, hint_no["content"]])]
    x[:, base + 2 * len(HINT_KINDS) :] = np.stack(flags, 1)
    edge = np.where(part, 1, np.where(own.any(1), 2, 0))
    return x, parent, depth, edge


def sum_product(unary: np.ndarray, pair: np.ndarray, parent: np.ndarray, depth: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact node marginals and (parent, child) marginals of a forest of binary nodes.

    unary: n x 2 scores; pair: EDGES x 2 x 2 scores, parent's label first.  Messages are
    sent upward from the deepest level, then downward, a level at a time.
    """
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)
    belief = unary.astype(float).copy()  # own score and the children's messages
    up = np.zeros_like(belief)
    for level in reversed(levels[1:]):
        s = pair[edge[level]] + belief[level][:, None, :]
        up[level] = np.logaddexp(s[:, :, 0], s[:, :, 1])
        np.add.at(belief, parent[level], up[level])
    down = np.zeros_like(belief)
    both = np.zeros((len(unary), 2, 2))
    for level in levels[1:]:
        rest = belief[parent[level]] + down[parent[level]] - up[level]  # all that the parent knows but from this child
        joint = rest[:, :, None] + pair[edge[level]] + belief[level][:, None, :]
        joint -= joint.max((1, 2), keepdims=True)
        joint = np.exp(joint)
        both[level] = joint / joint.sum((1, 2), keepdims=True)
        s = rest[:, :, None] + pair[edge[level]]
        down[level] = np.logaddexp(s[:, 0], s[:, 1])
    full = belief + down
    full -= full.max(1, keepdims=True)
    full = np.exp(full)
    return full / full.sum(1, keepdims=True), both


def train(count: int = TRAIN_PAGES, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Node weights and parent-child potentials, by gradient ascent on the labelled pages' likelihood."""
    trees = [parse(p) for p in html_pages.pages(count)]
    x, parent, depth, edge = features(trees)
    gold = np.array([v for t in trees for v in t.label])
    child = np.flatnonzero(parent >= 0)
    seen = np.zeros((EDGES, 2, 2))
    np.add.at(seen, (edge[child], gold[parent[child]], gold[child]), 1)
    w, pair = np.zeros(WIDTH), np.zeros((EDGES, 2, 2))
    moments = [(np.zeros(WIDTH), np.zeros(WIDTH)), (np.zeros_like(pair), np.zeros_like(pair))]
    for step in range(1, steps + 1):
        unary = np.stack([np.zeros(len(x)), x @ w], 1)
        node, both = sum_product(unary, pair, parent, depth, edge)
        expected = np.zeros_like(pair)
        np.add.at(expected, edge[child], both[child])
        grads = (x.T @ (gold - node[:, 1]) / len(trees) - 0.01 * w, (seen - expected) / len(trees) - 0.01 * pair)
        for p, g, (m1, m2) in zip((w, pair), grads, moments, strict=True):
            m1 += 0.1 * (g - m1)
            m2 += 0.01 * (g * g - m2)
            p += 0.2 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
    return w, pair


def extract_texts(pages: list[str], model: tuple[np.ndarray, np.ndarray]) -> list[str]:
    w, pair = model
    trees = [parse(p, labelled=False) for p in pages]
    if not trees:
        return []
    x, parent, depth, edge = features(trees)
    node, _ = sum_product(np.stack([np.zeros(len(x)), x @ w], 1), pair, parent, depth, edge)
    out, first = [], 0
    for t in trees:
        keep = node[first : first + len(t.parent), 1] > 0.5
        out.append("\n".join(text for owner, text in t.blocks if keep[owner]))
        first += len(t.parent)
    return out


_MODEL: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}


def model(count: int = TRAIN_PAGES, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    if (count, steps) not in _MODEL:
        _MODEL[count, steps] = train(count, steps)
    return _MODEL[count, steps]


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    shipped = pages.sparkSession.sparkContext.broadcast(model())
    schema = T.StructType([T.StructField("page_id", pages.schema[id_col].dataType), T.StructField("url", pages.schema[url_col].dataType), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, BATCH_PAGES):
                part = batch.slice(i, BATCH_PAGES)
                texts = extract_texts([h or "" for h in part.column(2).to_pylist()], shipped.value)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=schema.names)

    return pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html")).mapInArrow(run, schema)
