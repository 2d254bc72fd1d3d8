"""Main text of HTML pages by minimum-cut labelling.

A page becomes a sequence of text blocks with the elements they stand in. A linear classifier gives each
block a cost for either label; the costs are the capacities of the edges to the two terminals, and
neighbouring blocks (in page order, and within one parent element) are tied by smoothness edges that weaken
with their distance in the element tree. The maximum flow separates content from boilerplate.
"""
from __future__ import annotations

import html
import re
from collections import deque

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
                  r"""|<(/?)([A-Za-z][A-Za-z0-9:-]*+)([^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""(?i)(?:^|\s)(class|id|role|style|aria-label|aria-hidden|hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Elements by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg math object canvas audio video textarea select title".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s
samp small span strike strong sub sup time tt u var wbr br""".split())
CLOSED_BY_ITSELF = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"),
                    "th": ("tr", "table"), "option": ("select",)}

# Classifier weights. Elements and name parts that speak for (+) or against (-) main content.
ELEMENTS = {"article": 4.0, "main": 3.0, "nav": -9.0, "footer": -9.0, "header": -5.0, "aside": -9.0, "form": -9.0,
            "button": -9.0, "menu": -9.0, "dialog": -9.0, "head": -30.0, "fieldset": -9.0, "figcaption": -0.5}
NAMES = {"article": 2.0, "content": 1.5, "main": 1.5, "story": 1.5, "entry": 1.5, "post": 1.0, "body": 0.5, "text": 0.5}
NAMES |= dict.fromkeys("""nav navbar navigation menu footer sidebar aside ad ads adv advert adverts advertisement
advertising banner promo promotion promoted sponsor sponsored cookie cookies consent gdpr notice notices alert popup modal
overlay newsletter subscribe subscription share sharing social related recommended breadcrumb breadcrumbs comment
comments reply replies respond disqus discussion login signup signin register search widget toolbar pagination
pager copyright legal disclaimer skip masthead hidden form tags complementary contentinfo""".split(), -9.0)
NAMES |= {"header": -4.0, "byline": -0.5, "meta": -2.0}
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
BIAS, PER_WORD, MOST_FOR_WORDS, LINK_DENSITY, SENTENCE, PARAGRAPH, HEADING, LIST_ITEM = -1.0, 0.06, 2.5, -5.0, 0.6, 0.8, 0.5, -0.4
#: Capacity of a smoothness edge between neighbours in the same parent; halves with each further step.
SMOOTH_ORDER, SMOOTH_PARENT = 1.2, 0.8
#: Capacities are integers: costs times this.
SCALE = 1000


class Element:
    __slots__ = ("tag", "weight", "path", "inside", "link")

    def __init__(self, tag: str, attributes: str, parent: "Element | None", number: int):
        self.tag = tag
        own = ELEMENTS.get(tag, 0.0)
        if tag == "header" and parent is not None and parent.inside:
            own = -1.0   # the heading part of an article, not of the page
        good = bad = 0.0
        hidden = False
        if attributes:
            for name, value in _ATTRIBUTE.findall(attributes):
                name, value = name.lower(), value.strip("\"'")
                if name == "hidden" or name == "aria-hidden" and value == "true" or (
                        name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
                    hidden = True
                elif name in ("class", "id", "role", "aria-label"):
                    for part in _NAME.findall(value):
                        w = NAMES.get(part.lower(), 0.0)
                        good, bad = max(good, w), min(bad, w)
        self.weight = (parent.weight if parent else 0.0) + own + good + bad - 20.0 * hidden
        self.path = (parent.path if parent else ()) + (number,)
        self.inside = tag in ("article", "main") or (parent is not None and parent.inside)
        self.link = tag == "a" or (parent is not None and parent.link)


class Block:
    __slots__ = ("parts", "link_chars", "tag", "weight", "path", "inside")

    def __init__(self, top: Element):
        self.parts: list[str] = []
        self.link_chars = 0
        self.tag, self.weight, self.path, self.inside = top.tag, top.weight, top.path, top.inside


def blocks(page: str) -> list[tuple[str, Block]]:
    """(text, block) of a page's text blocks in order, white space collapsed, references decoded."""
    root = Element("#page", "", None, 0)
    stack, out, current, number, at = [root], [], None, 0, 0

    def text(raw: str) -> None:
        nonlocal current
        if raw.strip():
            top = stack[-1]
            if current is None:
                holder = next(e for e in reversed(stack) if e.tag not in INLINE)
                current = Block(holder)
                out.append(current)
            current.parts.append(raw)
            current.weight = min(current.weight, top.weight)
            if top.link:
                current.link_chars += len(raw)
        elif current is not None and raw:
            current.parts.append(" ")

    def close(tag: str, until: tuple[str, ...] = ()) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag == tag:
                del stack[k:]
                return
            if stack[k].tag in until:
                return

    while True:
        m = _TAG.search(page, at)
        if m is None:
            text(page[at:])
            break
        if m.start() > at:
            text(page[at:m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue   # a comment or declaration
        tag, ending, attributes = tag.lower(), m[1] or m[4], m[3] or m[6] or ""
        if tag == "br":
            text(" ")
            continue
        if tag not in INLINE:
            current = None
        if ending:
            close(tag)
            continue
        if tag in RAW and not attributes.endswith("/"):
            stop = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = len(page) if stop is None else stop.end()
            continue
        if tag in VOID or attributes.endswith("/"):
            continue
        if tag not in INLINE:
            close("p", ("button", "td", "th", "table"))
        if tag in CLOSED_BY_ITSELF:
            close(tag, CLOSED_BY_ITSELF[tag])
        if tag == "a":
            close("a", ("td", "th", "table", "li", "p"))
        number += 1
        stack.append(Element(tag, attributes, stack[-1], number))
    found = []
    for b in out:
        words = " ".join(html.unescape("".join(b.parts)).split())
        if words:
            found.append((words, b))
    return found


def evidence(words: str, block: Block) -> float:
    """Classifier: positive for content, negative for boilerplate."""
    n = words.count(" ") + 1
    z = BIAS + block.weight + min(PER_WORD * n, MOST_FOR_WORDS)
    z += LINK_DENSITY * min(1.0, block.link_chars / max(len(words), 1))
    z += SENTENCE * (words[-1] in ".!?…\"”»")
    if block.tag == "p":
        z += PARAGRAPH
    elif block.tag in HEADINGS:
        z += HEADING + (1.5 if block.inside else 0.0)
    elif block.tag == "li":
        z += LIST_ITEM
    return z


def smoothness(found: list[tuple[str, Block]]) -> list[tuple[int, int, float]]:
    """Edges (i, j, capacity): neighbours in page order, and the previous block like it of one parent.

    A capacity halves with each step of distance in the element tree and with each two points by which
    the elements that only one of the two stands in speak for or against content.
    """
    def unlike(a: Block, b: Block) -> float:
        return abs(a.weight - b.weight) / 2

    edges, last_of = [], {}
    for i, (_, b) in enumerate(found):
        if i:
            a = found[i - 1][1].path
            shared = 0
            for x, y in zip(a, b.path):
                if x != y:
                    break
                shared += 1
            steps = len(a) + len(b.path) - 2 * shared
            edges.append((i - 1, i, SMOOTH_ORDER * 0.5 ** (max(0, steps - 2) + unlike(found[i - 1][1], b))))
        kind = (b.path[:-1], b.tag)
        j = last_of.get(kind)
        if j is not None and j != i - 1:
            edges.append((j, i, SMOOTH_PARENT * 0.5 ** unlike(found[j][1], b)))
        last_of[kind] = i
    return edges


def min_cut(evidences: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Whether each node stays on the source (content) side of a minimum cut.

    Level graphs and blocking flows over integer capacities; of all minimum cuts, the one with the
    smallest source side, so an undecided block is boilerplate.
    """
    n = len(evidences)
    source, sink = n, n + 1
    graph: list[list[int]] = [[] for _ in range(n + 2)]
    to, cap = [], []

    def edge(a: int, b: int, forward: int, backward: int) -> None:
        graph[a].append(len(to))
        to.append(b)
        cap.append(forward)
        graph[b].append(len(to))
        to.append(a)
        cap.append(backward)

    for i, z in enumerate(evidences):
        c = round(abs(z) * SCALE)
        if z > 0:
            edge(source, i, c, 0)
        elif c:
            edge(i, sink, c, 0)
    for i, j, w in edges:
        c = round(w * SCALE)
        if c:
            edge(i, j, c, c)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for e in graph[u]:
                if cap[e] and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        position = [0] * (n + 2)
        path: list[int] = []
        u = source
        while True:
            if u == sink:
                flow = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= flow
                    cap[e ^ 1] += flow
                k = next(k for k, e in enumerate(path) if not cap[e])
                u = to[path[k] ^ 1]
                del path[k:]
                continue
            while position[u] < len(graph[u]):
                e = graph[u][position[u]]
                if cap[e] and level[to[e]] == level[u] + 1:
                    break
                position[u] += 1
            if position[u] < len(graph[u]):
                path.append(graph[u][position[u]])
                u = to[path[-1]]
            elif u == source:
                break
            else:
                level[u] = -1
                u = to[path.pop() ^ 1]


def main_text(page: str | None) -> str:
    """Content blocks joined by a blank line; empty for a null, empty or all-boilerplate page."""
    found = blocks(page or "")
    if not found:
        return ""
    keep = min_cut([evidence(w, b) for w, b in found], smoothness(found))
    return "\n\n".join(w for (w, _), k in zip(found, keep) if k)


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` per row of ``pages``.

    Null or empty pages have an empty text; null ids or urls, repeated rows and other columns do no harm
    (one output row per input row, other columns are not read); an empty table gives an empty result.
    Pages are parsed whole, unclosed and stray tags included.
    """
    @pandas_udf("string")
    def text_of(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(p) for p in pages], dtype=object)

    return (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), text_of(F.col(html_col)).alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
