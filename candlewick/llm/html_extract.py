"""Main text of web pages by minimum-cut labelling.

A page becomes a list of text blocks in page order. A linear classifier gives each block a score,
positive for content; its size is the capacity of the edge to the content or boilerplate terminal.
Length, sentences, links and the block's own element say little of short blocks, headings and list
items; what elements around it say (article, nav, class names) adds up along the path. Blocks next
to each other, and consecutive blocks of one parent element, are joined by edges whose capacity
falls with their distance in the element tree and with the difference of what the elements around
them say. A minimum cut labels the blocks: it is the labelling with the least total of terminal and
joining capacity cut, so a short line goes with the blocks that it stands among.

Blocks whose score outweighs all their joining edges are labelled first and their edges folded into
their neighbours' scores, which keeps the minimum; maximum flow (Dinic) settles the rest. A page on
which nothing is content is labelled again without the hints (class names that article pages use too)
and with content elements counting double.

Defined cases: null or empty html gives the empty text; a page without content blocks too; broken
markup is read as far as it goes (unclosed elements end with the page, an unclosed comment, script
or style swallows the rest); repeated rows give repeated results; columns other than page_id, url
and html are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import deque
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import bound_batches, text_bytes

_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_MARK = re.compile(r"[>=]")
_BLANK = re.compile(r"\s*")
_ATTR = re.compile(r"""([a-zA-Z_:-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_WORD = re.compile(r"[a-z]+")
_STOP = re.compile(r"[.!?](?:\s|$)")

# Elements of HTML by how they bear on text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math select option button object canvas".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var br wbr img".split())
#: Elements that end an open element of the same group when they start.
IMPLIED = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements and words of class, id or role that speak for or against content.
CHROME_TAGS = frozenset("nav footer aside form dialog menu head".split())
CONTENT_TAGS = frozenset(("article", "main"))
CHROME_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs byline captcha comment comments consent cookie cookies disqus footer form gdpr "
    "login masthead menu menubar modal nav navbar navigation newsletter pager pagination popup promo promoted promotion "
    "related share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget contentinfo complementary".split()
)
#: Words that sections of articles are called by as well.
HINT_WORDS = frozenset("alert announcement copyright disclaimer discussion header legal notice notification notifications overlay replies reply review reviews search tags teaser".split())
CONTENT_WORDS = frozenset("article body content entry main post story text".split())

# Weights of the classifier and of the joining edges.
CHROME, HINT, CONTENT = -6.0, -2.0, 0.6
PARAGRAPH, HEADING, LIST_ITEM, LINKS, LENGTH, SENTENCE, BASE = 0.5, 0.3, -0.3, -4.0, 0.6, 0.4, -1.6
ADJACENT, SIBLING = 1.0, 0.8


class _Open:
    """An open element and what it and those around it say of text inside: ``cost``, of which
    ``hint`` is from hints."""

    __slots__ = ("tag", "cost", "hint", "last", "hidden")

    def __init__(self, tag: str, cost: float, hint: float, hidden: bool) -> None:
        self.tag, self.cost, self.hint, self.last, self.hidden = tag, cost, hint, -1, hidden


def _cue(tag: str, attrs: str, around: _Open) -> tuple[float, float, bool]:
    """(cost, hint, hidden) of an element inside ``around``. Content counts once on a path; chrome
    inside content takes back what content gave."""
    words: set[str] = set()
    hidden = False
    if attrs.strip():
        for m in _ATTR.finditer(attrs):
            key = m[1].lower()
            value = m[2] or m[3] or m[4] or ""
            if key in ("class", "id", "role", "itemprop"):
                words.update(_WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()))
            elif key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                hidden = True
        hidden = hidden or bool(re.search(r"(?:^|\s)hidden(?:\s|$|=)", attrs.lower()) and "aria-hidden" not in attrs.lower())
    cost, hint = around.cost, around.hint
    if tag in ("body", "html"):
        return cost, hint, hidden
    content = tag in CONTENT_TAGS or bool(words & CONTENT_WORDS)
    if tag in CHROME_TAGS or tag == "header" and cost < CONTENT or words & CHROME_WORDS and not words & CONTENT_WORDS:
        return min(cost, 0.0) + CHROME, hint, hidden
    if (words & HINT_WORDS or tag == "header") and not hint:
        cost, hint = cost + HINT, HINT
    if content and cost - hint == 0.0:
        cost += CONTENT
    return cost, hint, hidden


def _tag_end(page: str, at: int, open_quotes: dict[str, int]) -> int:
    """Where the start tag whose attributes begin at ``at`` ends, or -1. A quote directly after "="
    runs to its like; one without (its place is kept in ``open_quotes``) is an ordinary character."""
    while m := _MARK.search(page, at):
        if m[0] == ">":
            return m.end()
        at = _BLANK.match(page, m.end()).end()
        quote = page[at : at + 1]
        if quote in open_quotes and at < open_quotes[quote]:
            close = page.find(quote, at + 1)
            if close < 0:
                open_quotes[quote] = at
            at = max(close, at) + 1
    return -1


def parse_blocks(page: str) -> tuple[list[str], list[float], list[float], list[tuple[int, int, float]]]:
    """(texts, scores, what a second labelling adds to them, edges) of a page; edges are (block, later block, capacity)."""
    stack = [_Open("", 0.0, 0.0, False)]
    texts: list[str] = []
    scores: list[float] = []
    second: list[float] = []
    costs: list[float] = []
    open_quotes = {'"': len(page), "'": len(page)}
    edges: dict[tuple[int, int], float] = {}
    pieces: list[str] = []
    links = link_chars = hidden = low = 0
    opened: dict[str, int] = {}

    def flush() -> None:
        nonlocal low, link_chars
        if not pieces:
            return
        raw = "".join(pieces)
        pieces.clear()
        text = " ".join(raw.split())
        linked, link_chars = link_chars, 0
        if not text:
            return
        top = len(stack) - 1
        while top > 0 and stack[top].tag in INLINE:
            top -= 1
        at = stack[top]
        score = at.cost + BASE + LENGTH * math.log1p(len(text) / 20) + LINKS * min(1.0, linked / max(len(text), 1))
        score += SENTENCE * min(2, len(_STOP.findall(text)))
        score += PARAGRAPH * (at.tag in ("p", "blockquote", "pre")) + HEADING * (at.tag in HEADINGS) + LIST_ITEM * (at.tag == "li")
        i = len(texts)
        texts.append(text)
        scores.append(score)
        second.append(CONTENT * (at.cost - at.hint > 0.0) - at.hint)
        costs.append(at.cost)
        if i:  # to the block before, by steps up to the common element and down again
            steps = max(0, previous_depth - low) + max(0, top - low)
            edges[i - 1, i] = ADJACENT / max(1, steps - 1) / (1.0 + abs(costs[i - 1] - at.cost))
        parent = stack[max(top - 1, 0)]
        if parent.last >= 0:
            key = (parent.last, i)
            edges[key] = edges.get(key, 0.0) + SIBLING / (1.0 + abs(costs[parent.last] - at.cost))
        parent.last = i
        mark(top)

    previous_depth = 0

    def mark(depth: int) -> None:
        nonlocal previous_depth, low
        previous_depth = low = depth

    def pop_to(n: int) -> None:
        nonlocal links, hidden, low
        while len(stack) > n:
            gone = stack.pop()
            opened[gone.tag] -= 1
            links -= gone.tag == "a"
            hidden -= gone.hidden
        low = min(low, len(stack) - 1)

    at, end = 0, len(page)
    while at < end:
        start = page.find("<", at)
        while start >= 0 and not page[start + 1 : start + 2].isalpha() and page[start + 1 : start + 2] not in ("/", "!", "?"):
            start = page.find("<", start + 1)  # an ordinary character
        stop = start if start >= 0 else end
        if stop > at and not hidden:
            piece = page[at:stop]
            pieces.append(unescape(piece) if "&" in piece else piece)
            if links:
                link_chars += len(piece.strip())
        if start < 0:
            break
        if page.startswith("<!--", start):
            at = page.find("-->", start + 4) + 3
            if at < 3:
                break
            continue
        m, at = _NAME.match(page, start), page.find(">", start) + 1
        if not at:
            break
        if not m:
            continue
        attrs = page[m.end() : at - 1]
        if '"' in attrs or "'" in attrs:
            at = _tag_end(page, m.end(), open_quotes)
            if at < 0:
                break
            attrs = page[m.end() : at - 1]
        tag = m[1].lower()
        if page[start + 1] == "/":
            if tag in VOID:
                continue
            if tag not in INLINE:
                flush()
            for depth in range(len(stack) - 1 if opened.get(tag) else 0, 0, -1):
                if stack[depth].tag == tag:
                    pop_to(depth)
                    break
                if tag in INLINE and stack[depth].tag not in INLINE:
                    break  # an inline end tag does not reach out of its block
            continue
        if tag in RAW:
            if not attrs.endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                at = close.end() if close else end
            pieces.append(" ")
            continue
        if tag in VOID:
            if tag not in INLINE:
                flush()
            pieces.append(" ")
            continue
        if tag not in INLINE:
            flush()
            ends = IMPLIED.get(tag, ()) + (("p",) if tag in CLOSES_P else ())
            for depth in range(len(stack) - 1, 0, -1) if ends else ():
                if stack[depth].tag in ends:
                    pop_to(depth)
                    break
                if stack[depth].tag not in INLINE:
                    break
        if attrs.endswith("/") and tag in INLINE:
            continue
        cost, hint, hide = _cue(tag, attrs, stack[-1])
        stack.append(_Open(tag, cost, hint, hide))
        opened[tag] = opened.get(tag, 0) + 1
        links += tag == "a"
        hidden += hide
    flush()
    return texts, scores, second, [(a, b, c) for (a, b), c in edges.items()]


def max_flow(n: int, source: int, sink: int, arcs: list[tuple[int, int, float, float]]) -> list[bool]:
    """Dinic on (u, v, capacity, capacity back); True for nodes on the source's side of the cut."""
    head: list[list[int]] = [[] for _ in range(n)]
    to: list[int] = []
    left: list[float] = []
    for u, v, c, back in arcs:
        head[u].append(len(to))
        to.append(v)
        left.append(c)
        head[v].append(len(to))
        to.append(u)
        left.append(back)
    tiny = 1e-12
    while True:
        level = [-1] * n
        level[source] = 0
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for e in head[u]:
                if left[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [x >= 0 for x in level]
        turn = [0] * n
        path: list[int] = []
        u = source
        while True:
            if u == sink:
                flow = min(left[e] for e in path)
                for k, e in enumerate(path):
                    left[e] -= flow
                    left[e ^ 1] += flow
                cut = next(k for k, e in enumerate(path) if left[e] <= tiny)
                u = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while turn[u] < len(head[u]):
                e = head[u][turn[u]]
                if left[e] > tiny and level[to[e]] == level[u] + 1:
                    break
                turn[u] += 1
            if turn[u] < len(head[u]):
                path.append(head[u][turn[u]])
                u = to[path[-1]]
            elif path:
                u = to[path.pop() ^ 1]
                turn[u] += 1
            else:
                break


def min_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """The labelling (True: content) of least cut capacity; ties go to boilerplate."""
    n = len(scores)
    score, around = list(scores), [dict() for _ in range(n)]
    for a, b, c in edges:
        around[a][b] = around[a].get(b, 0.0) + c
        around[b][a] = around[b].get(a, 0.0) + c
    weight = [sum(x.values()) for x in around]
    label: list[bool | None] = [None] * n
    queue = deque(range(n))
    while queue:  # whatever its neighbours are, such a block is cheapest with its own label
        i = queue.popleft()
        if label[i] is not None or abs(score[i]) < weight[i] or (score[i] == 0 and weight[i] > 0):
            continue
        label[i] = score[i] > 0
        for j, c in around[i].items():
            if label[j] is None:
                score[j] += c if label[i] else -c
                weight[j] -= c
                queue.append(j)
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        at = {i: k for k, i in enumerate(rest)}
        source, sink = len(rest), len(rest) + 1
        arcs = [(source, k, score[i], 0.0) if score[i] > 0 else (k, sink, -score[i], 0.0) for i, k in at.items()]
        arcs += [(at[i], at[j], c, c) for i in rest for j, c in around[i].items() if i < j and label[j] is None]
        for i, content in zip(rest, max_flow(len(rest) + 2, source, sink, arcs), strict=False):
            label[i] = content
    return [bool(x) for x in label]


def content_blocks(scores: list[float], second: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """The cut's labels; of a page without content, those of a second labelling."""
    labels = min_cut(scores, edges)
    if not any(labels) and any(second):
        labels = min_cut([a + b for a, b in zip(scores, second, strict=True)], edges)
    return labels


def extract_text(page: str) -> str:
    """Content blocks of a page, joined by two line feeds."""
    texts, scores, second, edges = parse_blocks(page)
    return "\n\n".join(t for t, content in zip(texts, content_blocks(scores, second, edges), strict=True) if content)


def _extract(pages: pa.Array) -> pa.Array:
    texts = [extract_text(x.as_py().decode("utf-8", "replace")) for x in pages]
    return pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["text", "n_chars"])


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars."""
    bound_batches(pages.sparkSession)
    e = F.arrow_udf(_extract, "struct<text:string,n_chars:bigint>")(text_bytes("html"))
    return pages.select("page_id", "url", e.alias("e")).select("page_id", "url", "e.text", "e.n_chars")
