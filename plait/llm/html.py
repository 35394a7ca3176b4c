"""Main text of web pages by minimum cut.

A page becomes a sequence of text blocks.  A linear classifier gives every
block a cost of being content and a cost of being boilerplate; these are the
capacities to the two terminals.  Smoothness edges join neighbours in the
page and blocks close to each other in the element tree.  The minimum cut
separates content from boilerplate.  Elements that hold no article text by
their kind (menus, footers, forms) have an unbounded cost of being content,
unless an article or main element opens inside them; names of classes and ids
are features of the classifier, no more.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import deque
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

# Fixed element lists of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg math textarea title select head".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
# Elements whose text is no part of an article, and names in class and id that hint at the same.
OUTSIDE = frozenset("nav footer aside form menu dialog button fieldset".split())
OUTSIDE_WORDS = frozenset("ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
                          "cookie cookies consent disqus footer header login masthead menu modal nav navbar navigation "
                          "newsletter notice notices notification pager pagination popup promo related reply replies share "
                          "sharing sidebar signup social sponsor sponsored subscribe tags toolbar widget".split())
INSIDE = frozenset("article main".split())
INSIDE_WORDS = frozenset("article articlebody body content entry main post story text".split())

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+'|[\"'])*+)>")
#: Elements without text of their own that may stand inside a paragraph.
UNSEEN = frozenset("script style noscript template iframe object svg math textarea select".split())
ATTRIBUTE = re.compile(r"(?i)\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
SPACE = re.compile(r"\s+")

FEATURES = ("bias", "outside", "inside", "links", "length", "sentence", "paragraph", "heading", "item", "depth", "hint")
#: Weights used where a sample has no marked-up blocks to fit on.
DEFAULT = np.array([-0.5, -4.0, 3.0, -4.0, 1.5, 1.0, 0.8, 0.6, -1.0, 0.0, -2.0])
#: Pages the classifier is fitted on, at most.
SAMPLE_PAGES = 300
#: Capacity of a smoothness edge between blocks of one parent next to each other.
SMOOTH = 0.6


@dataclass
class Block:
    text: str
    linked: int
    tag: str
    #: Ids of the open elements, the outermost first.
    path: tuple[int, ...]
    #: In an element that holds no article text by its kind.
    barred: bool
    #: In an element named as such, as a whole name or as part of one.
    outside: bool
    hint: bool
    inside: bool


def _names(attributes: str) -> tuple[set[str], set[str]]:
    """Whole names of class, id and role, and the words they are made of."""
    found = " ".join("".join(m) for m in ATTRIBUTE.findall(attributes)).lower()
    return (set(found.split()), set(re.split(r"[^a-z]+", found))) if found else (set(), set())


def blocks(page: str | None) -> list[Block]:
    """Text blocks of a page in order.  Markup that is never closed, or closed
    without being open, is read as a browser would: a block element ends an
    open paragraph, an item ends the item before."""
    page = page or ""
    out: list[Block] = []
    stack: list[tuple] = [("", 0, False, False, False, False)]
    pieces: list[str] = []
    linked, links, count, at, n = 0, 0, 0, 0, len(page)

    def flush() -> None:
        nonlocal linked
        text = SPACE.sub(" ", "".join(pieces)).strip()
        if text:
            tag = next((e[0] for e in reversed(stack) if e[0] not in INLINE), "")
            out.append(Block(text, min(linked, len(text)), tag, tuple(e[1] for e in stack if e[0] not in INLINE), *stack[-1][2:]))
        pieces.clear()
        linked = 0

    def close(tag: str, stop: frozenset[str] = frozenset()) -> None:
        nonlocal links
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] == tag:
                links -= sum(e[0] == "a" for e in stack[i:])
                del stack[i:]
                return
            if stack[i][0] in stop:
                return

    while at < n:
        lt = page.find("<", at)
        if lt != at:
            raw = entities.unescape(page[at:lt if lt >= 0 else n])
            pieces.append(raw)
            linked += len(raw) if links else 0
            if lt < 0:
                break
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        m = TAG.match(page, lt)
        if not m:
            if page[lt + 1:lt + 2] in ("!", "?", "/"):
                end = page.find(">", lt)
                at = n if end < 0 else end + 1
            else:
                pieces.append("<")
                at = lt + 1
            continue
        at = m.end()
        tag = m[2].lower()
        if m[1]:
            if tag not in INLINE:
                flush()
                close(tag)
            elif tag != "br":
                close(tag, frozenset(e[0] for e in stack if e[0] not in INLINE))
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag in RAW and not m[3].endswith("/"):
            found = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            if tag == "head" and not found:
                found = re.compile(r"(?=<body\b)", re.I).search(page, at)
                at = found.start() if found else at
            else:
                at = found.end() if found else n
            if tag not in UNSEEN:
                flush()
            continue
        if tag not in INLINE:
            flush()
            if tag == "li":
                close("li", frozenset(("ul", "ol", "menu")))
            elif tag in ("td", "th", "tr"):
                close("td", frozenset(("table", "tr")))
                close("th", frozenset(("table", "tr")))
                if tag == "tr":
                    close("tr", frozenset(("table",)))
            elif tag in ("dt", "dd"):
                close("dt", frozenset(("dl",)))
                close("dd", frozenset(("dl",)))
            close("p", frozenset(("table", "button", "td", "li", "article", "section", "div", "body")))
        if tag in VOID or m[3].endswith("/"):
            continue
        count += 1
        names, words = _names(m[3])
        _, _, barred, outside, hint, inside = stack[-1]
        if tag in INSIDE:      # an article is what it is, whatever stands around it; comments are marked up as articles too
            barred, hint, outside = False, False, outside and inside
        elif tag not in ("html", "body"):
            named = bool(names & OUTSIDE_WORDS) and not words & INSIDE_WORDS
            barred = barred or tag in OUTSIDE or (tag == "header" and not inside)
            outside = outside or barred or named
            hint = hint or outside or (bool(words & OUTSIDE_WORDS) and not words & INSIDE_WORDS)
        inside = inside or tag in INSIDE or bool(words & INSIDE_WORDS and tag not in ("html", "body"))
        stack.append((tag, count, barred, outside, hint, inside))
        links += tag == "a"
    flush()
    return out


def block_features(b: Block) -> list[float]:
    return [1.0, float(b.outside), float(b.inside), b.linked / len(b.text), min(len(b.text), 400) / 400,
            float(b.text[-1] in ".!?:\"'”»"), float(b.tag in ("p", "blockquote", "pre")),
            float(len(b.tag) == 2 and b.tag[0] == "h" and b.tag[1].isdigit()), float(b.tag in ("li", "td", "th", "dt", "dd")),
            min(len(b.path), 20) / 20, float(b.hint)]


def edges(page: list[Block], strength: float = SMOOTH) -> list[tuple[int, int, float]]:
    """Smoothness edges: to the next block, weaker the further apart in the
    tree, and to the next block under the same parent element."""
    out, last = [], {}
    for j, b in enumerate(page):
        parent = b.path[-2] if len(b.path) > 1 else 0
        if j:
            a = page[j - 1].path
            common = 0
            for x, y in zip(a, b.path):
                if x != y:
                    break
                common += 1
            out.append((j - 1, j, 2 * strength / max(2, len(a) + len(b.path) - 2 * common)))
        if parent in last and last[parent] != j - 1:
            out.append((last[parent], j, strength / 2))
        last[parent] = j
    return out


def minimum_cut(gain: list[float], links: list[tuple[int, int, float]]) -> list[bool]:
    """The labelling (True: content) of least cost, where leaving content
    costs ``gain`` if positive, taking it costs ``-gain`` if negative, and an
    edge costs its weight if its ends differ.

    Nodes whose own cost outweighs all their edges are settled first and
    become costs of their neighbours; the rest is solved by maximum flow
    along shortest augmenting paths.
    """
    n = len(gain)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, w in links:
        near[i][j] = near[i].get(j, 0.0) + w
        near[j][i] = near[j].get(i, 0.0) + w
    own, label = list(gain), [None] * n
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if label[i] is not None or abs(own[i]) < sum(near[i].values()) or (own[i] == 0 and near[i]):
            continue
        label[i] = own[i] > 0
        for j, w in near[i].items():
            if label[j] is None:
                own[j] += w if label[i] else -w
                del near[j][i]
                queue.append(j)
    rest = [i for i in range(n) if label[i] is None]
    if not rest:
        return label
    source, sink = n, n + 1
    room: dict[int, dict[int, float]] = {i: {j: w for j, w in near[i].items() if label[j] is None} for i in rest}
    room[source], room[sink] = {}, {}
    for i in rest:
        a, b = (source, i) if own[i] > 0 else (i, sink)
        room[a][b] = abs(own[i])
        room[b].setdefault(a, 0.0)
    while True:
        came, queue = {source: source}, deque([source])
        while queue and sink not in came:
            u = queue.popleft()
            for v, w in room[u].items():
                if w > 1e-12 and v not in came:
                    came[v] = u
                    queue.append(v)
        if sink not in came:
            break
        flow, v = math.inf, sink
        while v != source:
            flow, v = min(flow, room[came[v]][v]), came[v]
        v = sink
        while v != source:
            u = came[v]
            room[u][v] -= flow
            room[v][u] = room[v].get(u, 0.0) + flow
            v = u
    for i in rest:
        label[i] = i in came
    return label


def main_text(page: str | None, weights: np.ndarray = DEFAULT) -> str:
    """The article of a page: its content blocks joined by an empty line."""
    found = blocks(page)
    if not found:
        return ""
    z = (np.array([block_features(b) for b in found]) @ weights).tolist()  # log odds: the difference of the two costs
    keep = minimum_cut([-1e6 if b.barred else min(max(x, -8.0), 8.0) for b, x in zip(found, z)], edges(found))
    return "\n\n".join(b.text for b, k in zip(found, keep) if k)


def fit(pages: DataFrame, *, page_id: str = "page_id", html: str = "html", sample_pages: int = SAMPLE_PAGES) -> np.ndarray:
    """Classifier weights from the marked-up blocks (in an article or main
    element, or in one that is no article) of at most ``sample_pages`` pages
    with the smallest hashed ids.  Each block counts twice, with and without
    its markup, so that the other features carry pages without markup."""
    ship_package(pages.sparkSession)
    ids = pages.select(F.col(page_id).alias("id")).filter("id is not null").distinct() \
        .orderBy(F.xxhash64("id"), "id").limit(sample_pages)
    some = pages.select(F.col(page_id).alias("id"), F.col(html).alias("html")).join(F.broadcast(ids), "id").select("html")

    def sums(batches):
        for b in batches:
            rows = [[*block_features(x), float(x.inside and not x.outside)] for t in b.column(0) for x in blocks(t.as_py())
                    if x.inside or x.outside]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64()))], ["f"])
    got = some.mapInArrow(sums, "f array<double>").groupBy("f").agg(F.count("*").alias("n")).orderBy("f").toPandas()
    if not len(got):
        return DEFAULT
    data, n = np.array(got["f"].tolist()), got["n"].to_numpy(dtype=float)
    x, y = data[:, :-1], data[:, -1]
    if y.min() == y.max():
        return DEFAULT
    bare = x.copy()
    bare[:, [1, 2, 10]] = 0.0
    x, y, n = np.vstack([x, bare]), np.concatenate([y, y]), np.concatenate([n, n])
    n = n / n.sum()
    w = DEFAULT.copy()
    for _ in range(400):  # near the default where the sample says nothing
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= 0.5 * (x.T @ (n * (p - y)) + 1e-3 * (w - DEFAULT))
    return w


def extract(html: Column, weights: np.ndarray = DEFAULT) -> Column:
    @F.arrow_udf("string")
    def text(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py(), weights) for p in pages], pa.string())
    return text(html)


def extract_text(pages: DataFrame, *, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """The input rows with ``text``, the article of the whole page.

    A null or empty page, and one without content, has an empty text.
    Repeated rows each get theirs.  An input column ``text`` is replaced.
    """
    ship_package(pages.sparkSession)
    weights = fit(pages, page_id=page_id, html=html)
    return pages.withColumn("text", extract(F.col(html), weights))
