"""Main-text extraction from HTML by minimum cut.

A page is split into blocks of text with their place in the element tree. A logistic
classifier gives each block a cost of being called content or boilerplate, which become
capacities from the source and to the sink; edges between neighbours on the page and between
neighbours under one parent carry a smoothness capacity that falls with their distance in
the tree. The minimum cut separates content from boilerplate. Blocks whose own cost outweighs
all their edges are settled first (they have that label in some minimum cut); max-flow runs on what is left.

The classifier is trained here, on the blocks of a bounded, hashed sample of pages, with
weak labels from elements that say what they are (an article; a menu, footer, advert ...).
Half of the training blocks have that evidence hidden, so that shape alone is learned too. A Gaussian
prior around plain starting weights stands in where a sample says nothing.

Inside a block, white space becomes one space; character references are decoded; a line break
element is white space. Blocks are joined by newlines in page order.

Rows: null or empty html gives an empty text; broken markup is read as far as it goes; very
long pages are read whole; repeated pages and null ids are treated like any others. Other
columns pass through; the added ones are ``text`` and ``n_chars``.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from fillwise.llm.common import ship

#: Pages whose blocks train the classifier at most.
SAMPLE_PAGES = 1000
#: Smoothness of neighbours, and how it falls with each step through the tree.
SMOOTH = 1.0
FALL = 0.5
COST_MOST = 8.0

NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
UNQUOTED = re.compile(r"""[^>"']*""")
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
TOKEN = re.compile(r"[a-z]+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their contents are not text of the page.
SILENT = frozenset("script style noscript template svg math iframe object canvas head title textarea select".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small
    span strike strong sub sup time tt u var wbr img br""".split())
CLOSED_BY_BLOCK = frozenset(["p"])
CLOSES = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option", "p": "p"}
CLOSES = {k: frozenset(v.split()) for k, v in CLOSES.items()}
HOLDERS = frozenset("article main section div table ul ol dl body nav aside footer header form td th tr blockquote".split())
CONTENT_TAGS = frozenset(["article", "main"])
#: Elements and names of parts that are no main text wherever they stand.
APART_TAGS = frozenset("footer aside dialog button label".split())
#: Parts inside an article; elsewhere they may hold the whole page and say nothing.
FORM_TAGS = frozenset("form fieldset".split())
APART_NAMES = frozenset("""ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar
    footer cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe signup login
    share sharing social related recommended comment comments disqus reply replies respond form search widget copyright
    disclaimer contentinfo complementary""".split())
#: Those that have articles of their own.
OWN_ARTICLES = frozenset("comment comments disqus reply replies respond related recommended".split())
#: In a name of several words: it tells what the page has, not what the element is.
ABOUT = frozenset("has no not with without is hide show open opened closed enabled disabled category tag status".split())
#: Elements that are not a part of the page by their name.
WHOLE_TAGS = frozenset("html body main".split())
#: The same, but an article inside them still is one.
MENU_TAGS = frozenset("nav menu".split())
MENU_NAMES = frozenset("nav navbar navigation menu breadcrumb breadcrumbs toolbar pagination pager".split())
HEAD_NAMES = frozenset("header masthead".split())
CONTENT_NAMES = frozenset("article content main post entry story".split())

#: LOOSE: apart by a name outside of content; HELD: an article inside such an element.
APART, LOOSE, MENU, PLAIN, CONTENT, HELD = -3, -2, -1, 0, 1, 2
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

FEATURES = ["bias", "content", "boilerplate", "length", "links", "stops", "heading", "item", "paragraph"]
#: Centre of the prior: what the evidence is taken to mean before any page is seen.
PRIOR = np.array([-1.0, 4.0, -5.0, 0.5, -3.0, 1.0, 0.5, -0.5, 0.5])
PRIOR_WEIGHT = 2.0


@dataclass(eq=False)
class Element:
    tag: str
    number: int
    sign: int
    parent: Element | None = None
    depth: int = 0
    holder: int = 0  # place on the stack of the nearest element, itself included, that holds others
    mark: int = 0


@dataclass
class Block:
    text: str
    at: Element  # the element around it
    sign: int
    tag: str
    link_chars: int = 0
    mark: int = 0  # the outermost LOOSE element around it


class Tags:
    """Finds the tags of a page in time that grows with its length, however broken they are.

    A tag whose end is missing is text. Its vain search for the end is remembered: a later tag
    that begins outside of the quotes which that search saw has no end either. Quotes permute
    the three states of a search (outside, in either quote), so at most three searches fail."""

    def __init__(self, page: str):
        self.page = page
        self.last = page.rfind(">")
        self.failed: list[tuple[list[int], list[int]]] = []  # begins and ends of the quotes seen
        self.endless: set[str] = set()

    def _end(self, at: int) -> int | None:
        """Place of the ``>`` that ends a tag whose attributes begin at ``at``."""
        if at > self.last:
            return None
        for begins, ends in self.failed:
            i = bisect_left(begins, at) - 1
            if i < 0 or ends[i] < at:
                return None
        begins, ends = [], []
        while True:
            at = UNQUOTED.match(self.page, at).end()
            if at < len(self.page) and self.page[at] == ">":
                return at
            close = self.page.find(self.page[at], at + 1) if at < len(self.page) else -1
            if close < 0:
                begins.append(at)
                ends.append(len(self.page))
                self.failed.append((begins, ends))
                return None
            begins.append(at)
            ends.append(close)
            at = close + 1

    def next(self, at: int) -> tuple[int, int, str, str | None, str] | None:
        """(begin, end, slash, name, attributes) of the next tag; name None for comments and the like."""
        page = self.page
        while (i := page.find("<", at)) >= 0:
            if page.startswith("<!--", i):
                j = page.find("-->", i + 4)
                return i, len(page) if j < 0 else j + 3, "", None, ""
            m = NAME.match(page, i)
            if m and (j := self._end(m.end())) is not None:
                return i, j + 1, m[1], m[2], page[m.end() : j]
            if page[i + 1 : i + 2] in ("!", "?", "/") and i + 2 <= self.last:
                return i, page.find(">", i + 2) + 1, "", None, ""
            at = i + 1
        return None

    def end_of(self, tag: str, at: int) -> int | None:
        """End of the closing tag of a silent element."""
        if tag not in self.endless:
            over = re.compile(rf"</{re.escape(tag)}\b", re.I).search(self.page, at)
            if over and over.end() <= self.last:
                return self.page.find(">", over.end()) + 1
            self.endless.add(tag)
        return None


def names_of(tag: str, attributes: str) -> set[str]:
    """Words of the class, id and role that tell what the element is."""
    names: set[str] = set()
    if "=" in attributes and tag not in WHOLE_TAGS:
        for _, a, b, c in ATTRIBUTE.findall(attributes):
            for name in (a or b or c).lower().split():
                words = TOKEN.findall(name)
                # an article carries the names of its categories and settings
                if len(words) == 1 or tag != "article" and ABOUT.isdisjoint(words):
                    names.update(words)
    return names - {tag}


def sign_of(tag: str, attributes: str, around: int) -> int:
    """What an element says about its text, given what the elements around it say."""
    if around == APART or tag in APART_TAGS:
        return APART
    inside = around in (CONTENT, HELD)
    if tag in FORM_TAGS and inside:
        return APART
    names = names_of(tag, attributes)
    if names & OWN_ARTICLES:
        return APART
    if names & APART_NAMES:
        return APART if inside else LOOSE
    if around == LOOSE:
        return {"main": CONTENT, "article": HELD}.get(tag, LOOSE)
    if tag in MENU_TAGS or names & MENU_NAMES:
        return MENU
    if (tag == "header" or names & HEAD_NAMES) and not inside:
        return MENU
    if around != HELD and (tag in CONTENT_TAGS or names & CONTENT_NAMES):
        return CONTENT
    return around


def settled(blocks: list[Block]) -> list[Block]:
    """The signs once the whole page is known. Where nothing else is content, an article in a
    LOOSE element is, or else a LOOSE element with most of the text says nothing."""
    if any(b.sign == CONTENT for b in blocks):
        held = LOOSE
    else:
        held = CONTENT
        if not any(b.sign == HELD for b in blocks):
            size: dict[int, int] = {}
            for b in blocks:
                size[b.mark] = size.get(b.mark, 0) + len(b.text)
            whole = sum(size.values())
            for b in blocks:
                if b.sign == LOOSE and 2 * size[b.mark] > whole:
                    b.sign = PLAIN
    for b in blocks:
        if b.sign == HELD:
            b.sign = held
    return blocks


def blocks_of(page: str) -> list[Block]:
    out: list[Block] = []
    stack = [Element("", 0, PLAIN)]
    places: dict[str, list[int]] = {}  # of open elements on the stack, by tag
    tags = Tags(page)
    numbers = 0
    parts: list[str] = []
    links = link_chars = 0

    def flush() -> None:
        nonlocal link_chars
        if parts:
            text = "".join(parts)
            if "&" in text:
                text = html.unescape(text)
            text = " ".join(text.split())
            if text:
                top = stack[-1]
                out.append(Block(text, top, top.sign, top.tag, min(link_chars, len(text)), top.mark))
            parts.clear()
        link_chars = 0

    def leave(depth: int) -> None:
        while len(stack) > depth:
            places[stack.pop().tag].pop()

    at, end = 0, len(page)
    while at < end:
        found = tags.next(at)
        stop = found[0] if found else end
        if stop > at:
            parts.append(page[at:stop])
            if links:
                link_chars += stop - at
        if not found:
            break
        _, at, closing, tag, attributes = found
        if tag is None:
            continue
        tag = tag.lower()
        if tag in SILENT:
            if not closing and not attributes.endswith("/"):
                parts.append(" ")
                over = tags.end_of(tag, at)
                # a head without an end goes on as a page
                at = over or (at if tag == "head" else end)
            continue
        if tag == "a":
            links = max(0, links + (-1 if closing else 1))
        inline = tag in INLINE
        if closing:
            if places.get(tag):
                if not inline or stack[-1].tag == tag:
                    flush()
                    leave(places[tag][-1])
                    if not inline:
                        links = 0
            elif not inline:
                flush()
            continue
        if tag == "br":
            parts.append(" ")
            continue
        sign = sign_of(tag, attributes, stack[-1].sign) if attributes or not inline else stack[-1].sign
        if inline and sign == stack[-1].sign:
            continue
        flush()
        if not inline:
            links = 0
            # elements whose end may be left out
            shut = max((places[t][-1] for t in CLOSES.get(tag, CLOSED_BY_BLOCK) if places.get(t)), default=0)
            if shut and (shut >= stack[-1].holder or tag in ("td", "th", "tr")):
                leave(shut)
            sign = sign_of(tag, attributes, stack[-1].sign)
        if tag in VOID or attributes.endswith("/") and tag not in HOLDERS:
            continue
        numbers += 1
        top = stack[-1]
        places.setdefault(tag, []).append(len(stack))
        stack.append(Element(tag, numbers, sign, top, top.depth + 1, len(stack) if tag in HOLDERS else top.holder,
                             top.mark or (numbers if sign == LOOSE else 0)))
    flush()
    return settled(out)


def measured(blocks: list[Block], hide: bool = False) -> np.ndarray:
    """Features of blocks. What an element says is evidence beside length, links and stops;
    the tag speaks only where no element does: menus and comments have paragraphs too.
    ``hide`` leaves out every other block's evidence."""
    x = np.zeros((len(blocks), len(FEATURES)))
    for i, b in enumerate(blocks):
        n = len(b.text)
        x[i, 0], x[i, 3:6] = 1, (math.log1p(n) - 4, b.link_chars / n, b.text[-1] in ".!?:;\"'”»…")
        if b.sign != PLAIN and not (hide and i % 2):
            x[i, 1:3] = b.sign == CONTENT, b.sign < 0
        else:
            x[i, 6:] = b.tag in HEADINGS, b.tag == "li", b.tag == "p"
    return x


def fit_weights(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression with a Gaussian prior around PRIOR, by Newton steps."""
    w = PRIOR.copy()
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + PRIOR_WEIGHT * (w - PRIOR)
        bend = (x * (p * (1 - p))[:, None]).T @ x + PRIOR_WEIGHT * np.eye(len(w))
        w = w - np.linalg.solve(bend, slope)
    return w


def edges_of(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Neighbours on the page, and neighbours under one parent where they are not that too."""
    out = []
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if i:
            a, c, steps = blocks[i - 1].at, b.at, 0
            while a is not c:
                steps += 1
                if a.depth >= c.depth:
                    a = a.parent
                else:
                    c = c.parent
            out.append((i - 1, i, SMOOTH * FALL ** max(steps - 2, 0)))
        parent = b.at.parent.number if b.at.parent else 0
        if last.get(parent, i) < i - 1:
            out.append((last[parent], i, SMOOTH * FALL))
        last[parent] = i
    return out


def min_cut(cost: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels of least energy: a node with label False pays max(cost, 0), with True
    max(-cost, 0); an edge whose ends differ pays its weight."""
    n = len(cost)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, w in edges:
        near[i][j] = near[i].get(j, 0.0) + w
        near[j][i] = near[j].get(i, 0.0) + w
    own = list(cost)
    label: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:  # settle nodes that outweigh all their edges
        i = todo.popleft()
        if label[i] is not None or abs(own[i]) < sum(near[i].values()) or own[i] == 0:
            continue
        label[i] = own[i] > 0
        for j, w in near[i].items():
            own[j] += w if label[i] else -w
            del near[j][i]
            todo.append(j)
        near[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        content = _max_flow(rest, own, near)
        for i in rest:
            label[i] = i in content
    return [bool(x) for x in label]


def _max_flow(nodes: list[int], own: list[float], near: list[dict[int, float]]) -> set[int]:
    """Nodes on the source's side after augmenting along shortest paths."""
    source, sink = -1, -2
    room: dict[int, dict[int, float]] = {i: dict(near[i]) for i in nodes}
    room[source], room[sink] = {}, {}
    for i in nodes:
        if own[i] > 0:
            room[source][i], room[i][source] = own[i], 0.0
        elif own[i] < 0:
            room[i][sink], room[sink][i] = -own[i], 0.0
    while True:
        came = {source: source}
        queue = deque([source])
        while queue and sink not in came:
            i = queue.popleft()
            for j, c in room[i].items():
                if c > 1e-12 and j not in came:
                    came[j] = i
                    queue.append(j)
        if sink not in came:
            return {i for i in came if i >= 0}
        path, j = [], sink
        while j != source:
            path.append((came[j], j))
            j = came[j]
        push = min(room[i][j] for i, j in path)
        for i, j in path:
            room[i][j] -= push
            room[j][i] += push


def main_text(page: str, weights: np.ndarray) -> str:
    blocks = blocks_of(page)
    if not blocks:
        return ""
    cost = np.clip(measured(blocks) @ weights, -COST_MOST, COST_MOST)
    return "\n".join(b.text for b, keep in zip(blocks, min_cut(cost.tolist(), edges_of(blocks))) if keep)


def fit(pages: DataFrame, key: str = "page_id", page: str = "html", sample: int = SAMPLE_PAGES) -> np.ndarray:
    """Weights of the classifier from a bounded sample of pages."""
    ship(pages.sparkSession)
    n = pages.count()
    some = pages.where(F.pmod(F.xxhash64(F.col(key), F.col(page), F.lit(5)), F.lit(1 << 20)) < int((1 << 20) * min(1.0, sample / max(n, 1))))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column(0):
                blocks = [b for b in blocks_of(p.as_py() or "") if b.sign != PLAIN]
                # one sum a page keeps what comes to the driver small
                x = measured(blocks, hide=True)
                y = np.array([b.sign == CONTENT for b in blocks], float)
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()]), pa.array([y.tobytes()])], ["x", "y"])

    rows = some.select(page).mapInArrow(read, "x binary, y binary").collect()
    x = np.frombuffer(b"".join(r["x"] for r in rows)).reshape(-1, len(FEATURES))
    return fit_weights(x, np.frombuffer(b"".join(r["y"] for r in rows)))


def extracted(pages: DataFrame, weights: np.ndarray, page: str = "html") -> DataFrame:
    """``pages`` with text and n_chars in place of the html column."""
    ship(pages.sparkSession)
    at = pages.columns.index(page)
    rest = [i for i in range(len(pages.columns)) if i != at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 500):
                batch = whole.slice(i, 500)
                texts = [main_text(p.as_py() or "", weights) for p in batch.column(at)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k) for k in rest), pa.array(texts), pa.array([*map(len, texts)], pa.int64())],
                    [*(batch.schema.names[k] for k in rest), "text", "n_chars"])

    fields = [pages.schema.fields[k] for k in rest]
    return pages.mapInArrow(run, StructType([*fields, StructField("text", StringType()), StructField("n_chars", LongType())]))
