"""Main text of HTML pages by minimum-cut labelling.

A page is a row of text blocks.  A cost table turns each block's features
(enclosing elements, class and id words, link share, length) into what it costs
to call the block content or boilerplate; these are the capacities of its two
terminal edges.  Neighbouring blocks, and blocks that follow each other under
one parent, are joined by smoothness edges that are stronger the closer the
blocks are in the DOM.  Maximum flow gives the cut of least total cost: the
blocks on the source side are the content.
"""

from __future__ import annotations

import html as entities
import re
import sys
from collections import Counter, deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden|href|type)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""",
                       re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

#: Elements whose content is no text of the page.
DROPPED = frozenset("script style title noscript template svg math iframe object embed canvas video audio map select"
                    " option datalist textarea button noembed noframes xmp".split())
#: Of these, the ones whose content is not parsed: it runs to the end tag.
RAW = frozenset("script style textarea title iframe noembed noframes noscript xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr output q ruby"
                   " rb rp rt s samp small span strike strong sub sup time tt u var wbr input".split())
#: Start tags that end an open element of the second set (an end tag that may be left out).
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}}
CLOSES_P = frozenset("address article aside blockquote details dialog dir div dl fieldset figcaption figure footer form h1 h2"
                     " h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul li dt dd".split())
#: Start tags that no unclosed element of the second set can hold; and elements that end where the next one of them starts.
SECTIONS, ENDED = frozenset("article main section nav aside header footer body".split()), frozenset(
    "button select option datalist object canvas video audio map".split())
ALONE = frozenset("button select option".split())
END_TAG = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.I | re.A) for t in DROPPED}
#: Up to which element an end tag or an implied end reaches.
BARRIER = frozenset("ul ol dl table tbody thead tfoot article section div body html main aside nav".split())

#: Cost table (fixed weights, in units of a tenth): positive speaks for content, negative for boilerplate.
ELEMENT_COST = {"article": 40, "main": 30, "nav": -200, "footer": -200, "aside": -200, "menu": -200,
                "dialog": -200, "header": -60, "address": -20, "fieldset": -80, "h1": 20, "blockquote": 5, "pre": 5, "p": 10}
#: Words of a class or id that name what no article holds, at any length.
NEVER = frozenset("ad ads advert adverts advertisement advertising advertorial sponsor sponsored promo promotion cookie cookies"
                  " consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup paywall comment"
                  " comments commentlist respond reply replies disqus outbrain taboola".split())
#: Words of the page's layout, which long text may outweigh; and words that an article can also be about.
LAYOUT = frozenset("banner sidebar nav navbar navigation menu breadcrumb breadcrumbs footer masthead topbar toolbar pagination pager"
                   " discussion share sharing social follow related recommended recommendations trending widget skip rail teaser"
                   " hidden".split())
AMBIGUOUS = frozenset("legal disclaimer copyright search searchbox form login register".split())
WORD_COST = dict.fromkeys(NEVER | LAYOUT | AMBIGUOUS, -200)
WORD_COST |= {"header": -60, "article": 30, "content": 20, "main": 20, "post": 10, "entry": 20, "story": 20, "body": 5}
ROLE_COST = {"navigation": -200, "banner": -200, "contentinfo": -200, "complementary": -200, "search": -200, "form": -200,
             "dialog": -200, "alert": -200, "menu": -200, "main": 30, "article": 40}
#: A boilerplate word behind one of the first or before one of the second tells of the page's layout or topic, not of the element.
LAYOUT_BEFORE = frozenset("no has with without non not category tag topic".split())
LAYOUT_AFTER = frozenset("enabled disabled free open closed".split())
#: What boilerplate words cost beside a positive word of the same attribute; what they may cost at most in all; how much of
#: that reaches into an article, main or positively named element that holds most of the page's text; how much unlinked text
#: outweighs layout words; what a word of NEVER costs.
MIXED_COST, WORD_FLOOR, REACH, OUTWEIGHS, NEVER_COST = -40, -200, -40, 1000, -400
#: A form is the page's frame, not a form, if it holds most of the text, at least so much for each control.
FORM_COST, CHARS_PER_CONTROL = -200, 200
CONTROLS = frozenset("input select textarea button".split())
#: Elements that cost this much hold no text that counts as the page's.  A longer link holds text of the page, as does one that
#: is no short one and holds most of the page's text.
OUTSIDE, LINK_CHARS, SHORT_LINK = -100, 400, 100
LINK_COST, LONG_COST, SENTENCE_COST, BASE_COST = -60, 30, 10, 5
ADJACENT, SIBLING = 8, 12


class Node:
    """An open element.  ``cost``: of the element, role and style; ``good``, ``bad``: of the words of class and id, ``kind``: the
    strongest kind of the bad ones; ``text``: unlinked text below it, ``controls``: of forms."""

    __slots__ = ("tag", "parent", "depth", "cost", "good", "bad", "kind", "never", "text", "controls", "words",
                 "form")

    def __init__(self, tag: str, parent: Node | None, attributes: dict[str, str]):
        self.tag, self.parent, self.depth = tag, parent, parent.depth + 1 if parent else 0
        self.cost, self.good, self.bad, self.kind = ELEMENT_COST.get(tag, 0), 0, 0, None
        self.text = self.controls = self.words = self.form = 0
        for key, value in attributes.items():
            if key in ("class", "id"):
                if tag not in ("body", "html"):
                    self._weigh(value)
            elif key == "role":
                self.cost += ROLE_COST.get(value.strip().lower(), 0)
            elif key == "style":
                if "display:none" in value.replace(" ", "").lower():
                    self.cost -= 200
            elif key == "hidden" or key == "aria-hidden" and value.strip().lower() == "true":
                self.cost -= 200
        self.never = self.kind is NEVER

    def _weigh(self, value: str) -> None:
        """Each name of a class or id; then names that speak for content against the others."""
        good = bad = 0
        for name in value.split():
            words = [w.lower() for w in WORD.findall(name)]
            found = [w for i, w in enumerate(words) if w in WORD_COST and not (
                WORD_COST[w] < 0 and (i and words[i - 1] in LAYOUT_BEFORE or i + 1 < len(words) and words[i + 1] in LAYOUT_AFTER))]
            costs = [WORD_COST[w] for w in found]
            if costs and min(costs) < 0:
                bad = min(bad, *costs)
                for kind in (NEVER, LAYOUT, AMBIGUOUS):
                    if self.kind is not NEVER and (self.kind is None or kind is not AMBIGUOUS) and not kind.isdisjoint(found):
                        self.kind = kind
                        break
            elif costs:
                good = max(good, *costs)
        self.good += good
        self.bad += max(bad, MIXED_COST) if good and bad else bad


def _attributes(source: str) -> dict[str, str]:
    """The first of each attribute that a cost or a link depends on."""
    out: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(source):
        out.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return out


class Block:
    """``place``: the element that holds the block's own; ``links``: (link, characters) in it."""

    __slots__ = ("text", "cost", "node", "place", "links")

    def __init__(self, text: str, node: Node, place: Node, links: list[tuple[int, int]]):
        self.text, self.cost, self.node, self.place, self.links = text, 0, node, place, links

    @property
    def parent(self) -> Node:
        return self.place.parent or self.place


def weigh(nodes: list[Node], found: list[Block], link_chars: list[int]) -> None:
    """Set the cost of every block.  Nodes are in the order in which they were opened, so parents come first."""
    unlinked, total = [], 0
    whole = sum(len(b.text) for b in found)
    label = [n <= LINK_CHARS and (n < SHORT_LINK or 2 * n <= whole) for n in link_chars]
    for node in nodes:
        above = node.parent
        if above:
            node.never |= above.never
            node.cost = max(-400, min(100, above.cost + node.cost))
    for b in found:
        n = len(b.text) - min(len(b.text), sum(c for link, c in b.links if label[link]))
        unlinked.append(n)
        if not b.node.never and b.node.cost > OUTSIDE:
            b.node.text += n
            total += n
    for node in reversed(nodes):
        if node.parent:
            node.parent.text += node.text
            node.parent.controls += node.controls
    for node in nodes:
        above = node.parent
        most = 2 * node.text > total
        bad, reached, form = node.bad, above.words if above else 0, above.form if above else 0
        if most and (node.kind is AMBIGUOUS or node.kind is LAYOUT and node.text >= OUTWEIGHS):
            bad = 0
        if most and (node.good + bad > 0 or node.tag in ("article", "main")):
            reached = max(reached, REACH)
        if node.tag == "form" and not (most and node.text >= CHARS_PER_CONTROL * node.controls):
            form += FORM_COST
        node.words, node.form = max(WORD_FLOOR, min(100, reached + node.good + bad)), max(-400, form)
    for b, free in zip(found, unlinked):
        n, node = len(b.text), b.node
        b.cost = max(-400, min(100, node.cost + node.form + node.words)) + BASE_COST
        if node.never:
            b.cost += NEVER_COST
        b.cost += LINK_COST * (n - free) // n + LONG_COST * min(n, 200) // 200
        if b.text[-1] in ".!?…:;\"”»)":
            b.cost += SENTENCE_COST


def blocks(page: str) -> list[Block]:
    """Text blocks in page order, with the cost of their enclosing elements and of their own features.  Time and memory are
    linear in the page, however deep it is nested."""
    out: list[Block] = []
    nodes = [Node("", None, {})]
    stack = [nodes[0]]
    where: dict[str, list[int]] = {}  # places of the open elements of each tag
    barriers: list[int] = []
    bases = [0]  # beside the stack: place of the innermost element that is not inline
    parts: list[str] = []
    link_chars: list[int] = []
    links: list[tuple[int, int]] = []
    in_link = False
    dropped: str | None = None
    inside: list[str] = []  # elements open in the dropped one
    open_inside: Counter[str] = Counter()
    next_end: dict[str, int] = {}

    def end_tag(tag: str) -> int:
        """Where the next end tag starts, -1: there is none.  Each is searched for once."""
        found = next_end.get(tag, 0)
        if 0 <= found < at or tag not in next_end:
            m = END_TAG[tag].search(page, at)
            found = next_end[tag] = m.start() if m else -1
        return found

    def flush() -> None:
        nonlocal parts, links
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, stack[-1], stack[max(0, bases[-1] - 1)], links))
        parts, links = [], []

    def drop(tag: str | None) -> None:
        nonlocal dropped
        dropped = tag
        inside.clear()
        open_inside.clear()

    def close(tag: str) -> None:
        nonlocal in_link
        if where.get(tag):
            if tag not in INLINE:
                flush()
            first = where[tag][-1]
            while len(stack) > first:
                gone = stack.pop()
                bases.pop()
                where[gone.tag].pop()
                if gone.tag in BARRIER:
                    barriers.pop()
                elif gone.tag == "a":
                    in_link = False

    def imply(tags) -> None:
        """End the innermost open one of ``tags`` if no barrier stands within it."""
        first = max((where[t][-1] for t in tags if where.get(t)), default=0)
        if first and first >= (barriers[-1] if barriers else 0):
            close(stack[first].tag)

    at = 0
    end = len(page)
    while at < end:
        m = TOKEN.search(page, at)
        text = page[at:m.start() if m else end]
        if text and dropped is None:
            if "&" in text:
                text = entities.unescape(text)
            parts.append(text)
            if in_link:
                n = len(text.strip())
                link_chars[-1] += n
                links.append((len(link_chars) - 1, n))
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA[") and dropped is None:
                parts.append(m[0][9:].removesuffix("]]>"))
            continue
        closing = m[1] or m[4]
        if m[5] and not m[0].endswith(">"):
            break  # the page ends inside a tag
        if dropped is not None:
            if closing:
                if open_inside[tag]:
                    while (gone := inside.pop()) != tag:
                        open_inside[gone] -= 1
                    open_inside[tag] -= 1
                    continue
                if tag == dropped:
                    drop(None)
                    continue
                if not where.get(tag):
                    continue
                drop(None)  # an enclosing element ends, so the dropped one does
            elif tag in SECTIONS and dropped in ENDED:
                drop(None)
            elif tag == dropped and tag in ALONE:
                drop(tag)
                continue
            else:
                if tag in RAW:
                    stop = end_tag(tag)
                    at = end if stop < 0 else stop
                elif tag not in VOID and not m[0].endswith("/>"):
                    inside.append(tag)
                    open_inside[tag] += 1
                continue
        if tag == "head":  # what it may hold is dropped by itself, and anything else ends it
            flush()
            continue
        if closing:
            close(tag)
            if tag == "br":
                parts.append(" ")
            elif tag not in INLINE:
                flush()
            continue
        attributes = _attributes(m[3] or m[6]) if m[3] or m[6] else {}
        if tag in CONTROLS and attributes.get("type", "").lower() != "hidden":
            stack[-1].controls += 1
        if tag in DROPPED and tag not in VOID:
            if tag not in ("button", "select", "textarea"):
                if tag not in INLINE and tag not in ("script", "style", "svg", "math"):
                    flush()
            if (m[3] or m[6] or "").rstrip().endswith("/") and tag in ("svg", "math"):
                continue
            if tag in RAW:
                stop = end_tag(tag)
                if stop < 0:
                    break
                close_at = page.find(">", stop)
                at = end if close_at < 0 else close_at + 1
            elif end_tag(tag) >= 0:
                drop(tag)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in ENDS:
            imply(ENDS[tag])
        if tag in CLOSES_P:
            imply(("p",))
        if tag not in INLINE:
            flush()
        if tag in VOID:
            continue
        if tag == "a":
            in_link = "href" in attributes  # an open link ends where the next anchor starts
            if in_link:
                link_chars.append(0)
        node = Node(tag, stack[-1], attributes)
        nodes.append(node)
        where.setdefault(tag, []).append(len(stack))
        if tag in BARRIER:
            barriers.append(len(stack))
        bases.append(bases[-1] if tag in INLINE else len(stack))
        stack.append(node)
    flush()
    weigh(nodes, out, link_chars)
    return out


class Flow:
    """Maximum flow by Dinic's algorithm; capacities are integers."""

    def __init__(self, n: int):
        self.edges: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.room: list[int] = []

    def join(self, u: int, v: int, forth: int, back: int = 0) -> None:
        self.edges[u].append(len(self.to))
        self.edges[v].append(len(self.to) + 1)
        self.to += [v, u]
        self.room += [forth, back]

    def levels(self, source: int) -> list[int]:
        level = [-1] * len(self.edges)
        level[source] = 0
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for e in self.edges[u]:
                v = self.to[e]
                if self.room[e] > 0 and level[v] < 0:
                    level[v] = level[u] + 1
                    queue.append(v)
        return level

    def source_side(self, source: int, sink: int) -> list[bool]:
        """Run to the maximum; the nodes still reachable from the source are on its side of the least cut."""
        to, room, edges = self.to, self.room, self.edges
        while True:
            level = self.levels(source)
            if level[sink] < 0:
                return [x >= 0 for x in level]
            nxt = [0] * len(edges)
            path: list[int] = []
            u = source
            while True:
                if u == sink:
                    least = min(room[e] for e in path)
                    for e in path:
                        room[e] -= least
                        room[e ^ 1] += least
                    cut = next(i for i, e in enumerate(path) if not room[e])
                    u = to[path[cut] ^ 1]
                    del path[cut:]
                    continue
                while nxt[u] < len(edges[u]):
                    e = edges[u][nxt[u]]
                    if room[e] > 0 and level[to[e]] == level[u] + 1:
                        break
                    nxt[u] += 1
                if nxt[u] < len(edges[u]):
                    path.append(edges[u][nxt[u]])
                    u = to[path[-1]]
                elif path:
                    u = to[path.pop() ^ 1]
                    nxt[u] += 1
                else:
                    break


def smoothness(found: list[Block]) -> list[tuple[int, int, int]]:
    """(block, later block, weight): neighbours in page order by DOM proximity, and successive blocks of one parent."""
    out = []
    last: dict[Node, int] = {}
    for i, b in enumerate(found):
        if i:
            a = found[i - 1]
            x, y, apart = a.place, b.place, 0
            while x is not y and apart < ADJACENT:  # further apart weighs nothing
                if x.depth >= y.depth:
                    x, apart = x.parent, apart + 1
                else:
                    y, apart = y.parent, apart + 1
            weight = ADJACENT // (1 + apart)
            if a.parent is b.parent:
                weight += SIBLING
            if weight:
                out.append((i - 1, i, weight))
        before = last.get(b.parent)
        if before is not None and before < i - 1:
            out.append((before, i, SIBLING // 2))
        last[b.parent] = i
    return out


def label(found: list[Block]) -> list[bool]:
    """Which blocks are content: the source side of the minimum cut."""
    signs = {b.cost > 0 for b in found}
    if len(signs) < 2:  # all terminal edges lead to one side: nothing to cut
        return [b.cost > 0 for b in found]
    n = len(found)
    flow = Flow(n + 2)
    for i, b in enumerate(found):
        if b.cost > 0:
            flow.join(n, i, b.cost)
        elif b.cost < 0:
            flow.join(i, n + 1, -b.cost)
    for i, j, w in smoothness(found):
        flow.join(i, j, w, w)
    return flow.source_side(n, n + 1)[:n]


def main_text(page: str | None) -> str:
    """Content blocks of a page, one a line."""
    found = blocks(page or "")
    return "\n".join(b.text for b, content in zip(found, label(found)) if content)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Null and empty pages, and pages without content, have an empty text.  Rows are
    independent: repeated rows and null ids stay.  Other columns are not read.
    """
    source = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    schema = source.select("page_id", "url").withColumn("text", F.lit("")).withColumn("n_chars", F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h.as_py()) for h in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    return source.mapInArrow(run, schema)
