"""HTML extraction by minimum-cut labelling.

A page is cut into blocks: runs of text between block-level tags, with the elements around
them. A linear classifier (tags, roles and names around a block, link share, length,
punctuation) gives the cost of calling a block content or boilerplate. Neighbouring blocks,
and a block and the block before it in the same parent element, are joined by an edge whose
weight follows how much of their element paths they share: that is the price of labelling
them differently. A class or id
of which a whole name is a boilerplate word ("sidebar", "cookie-notice") counts unless the
element holds half of the page's text and an h1 or main. A word that is only part of a name
("has-sidebar", "entry-header") does not count for an element that holds half of the text,
or a fifth of it with an article, main or h1, nor for the head of content with its h1;
inside content its penalty is finite. Terminal capacities are the costs, and the minimum cut between the two
terminals is the cheapest labelling of the whole page. Blocks whose own costs outweigh all
their edges are settled first (that changes no minimum), and maximum flow (Dinic) on the
rest gives the cut; of several minimum cuts, the one with the least content is taken.

The text of a page is its content blocks in page order, joined by an empty line: character
references decoded, white space runs turned into one space, trimmed. Scripts, styles,
comments, titles and other text that is not displayed are never blocks.

Defined cases: null or empty html, or html without content, gives empty text. Unclosed tags,
quotes and comments end with the page. A page of any length is parsed whole, in time
proportional to its length but for the flow on unsettled blocks. Rows are independent, so
repeated rows, ties and null ids need nothing special; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tastegraph.llm.common import byte_texts, slices_by_bytes

TAG = re.compile(
    r"<(?:!--(?:.*?)(?:-->|\Z)|[!?][^>]*+(?:>|\Z)|"
    r"(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?)*+)(?:>|\Z))", re.DOTALL)
# one attribute after the other, so that nothing in a value is taken for a name
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)(?:"|\Z)|'([^']*)(?:'|\Z)|([^\s"'>]+)))?""")

# fixed values of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSHOWN = frozenset("script style title noscript template textarea iframe svg math object audio video canvas "
                    "select datalist noframes".split())
BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
                  "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
                  "nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
ENDS_WITH_NEXT = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
                  "th": {"td", "th"}, "option": {"option"}}

# the classifier: log-odds towards content
TAG_WEIGHT = {"nav": -9, "footer": -9, "aside": -9, "form": -8, "menu": -9, "button": -9, "dialog": -9, "header": -5,
              "search": -9, "article": 5, "main": 4, "h1": 1, "h2": 0.5, "h3": 0.5, "p": 1.5, "blockquote": 1,
              "pre": 1, "figcaption": 0.5, "address": -1, "fieldset": -4, "label": -3, "a": 0}
ROLE_WEIGHT = {"navigation": -9, "banner": -7, "contentinfo": -9, "complementary": -9, "search": -9, "dialog": -9,
               "alert": -8, "alertdialog": -9, "menu": -9, "menubar": -9, "form": -8, "main": 4, "article": 5}
BOILERPLATE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notices banner sidebar side menu menus nav navbar navigation breadcrumb breadcrumbs comment comments "
    "discussion disqus reply replies respond footer header masthead share sharing social related recommended newsletter "
    "subscribe subscription signup login popup modal overlay pagination pager toolbar widget copyright legal "
    "disclaimer tags taglist skip search".split())
CONTENT_NAMES = frozenset("article content story post entry body text main prose".split())
INLINE = frozenset("p b i em strong span a u small font".split())  # what may stand between a block and an open paragraph
NAME_PART = re.compile(r"[a-z]+")
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
SCALE = 1000  # capacities are whole numbers


class _Element:
    __slots__ = ("name", "depth", "parent", "block", "weight", "unshown", "own", "named", "plain", "holds")

    def __init__(self, name: str, parent: _Element | None, attributes: str):
        self.name, self.parent = name, parent
        self.depth = parent.depth + 1 if parent else 0
        self.block = self if parent is None or name in BLOCK else parent.block  # the nearest block-level element
        self.unshown = parent.unshown if parent else False
        self.own, self.weight = 0.0, 0.0
        self.named = 0  # boilerplate names: 1 part of a name, 2 that of a part of content, 3 a whole name
        self.plain = 0  # characters of text outside links
        self.holds = {name} & {"article", "main", "h1"}
        if attributes:
            for m in ATTRIBUTE.finditer(attributes):
                key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
                if key == "role":
                    self.own += ROLE_WEIGHT.get(value.strip(), 0)
                elif key == "style":
                    self.unshown |= bool(HIDDEN_STYLE.search(value))
                elif key == "hidden":
                    self.unshown |= value not in ("until-found", "false")
                elif key in ("class", "id"):
                    names = set(NAME_PART.findall(value))
                    if names & BOILERPLATE_NAMES and name not in ("body", "html", "main", "article"):
                        whole = [set(NAME_PART.findall(x)) for x in value.split()]
                        of_content = any(x & BOILERPLATE_NAMES and x & CONTENT_NAMES for x in whole)
                        kind = 3 if any(x and x <= BOILERPLATE_NAMES for x in whole) else 2 if of_content else 1
                        self.named = max(self.named, kind)
                    elif names & CONTENT_NAMES:
                        self.own += 2

    def weigh(self, total: int) -> None:
        """The weight of an element whose parent is weighed, on a page of ``total`` characters outside links."""
        around = self.parent.weight if self.parent else 0.0
        own = self.own + (-2 if self.name == "header" and around > 0 else TAG_WEIGHT.get(self.name, 0.0))
        if self.named == 3:
            if not (2 * self.plain >= total > 0 and self.holds & {"h1", "main"}):
                own -= 9
        elif self.named:
            wrapper = total > 0 and (2 * self.plain >= total or 5 * self.plain >= total and self.holds)
            head = "h1" in self.holds and (self.named == 2 or around > 0)
            if not (wrapper or head):
                if around > 0:  # finite inside content: the cut decides
                    self.weight = around + own - 7
                    return
                own -= 9
        # boilerplate is not undone by what lies inside it
        self.weight = min(around, 0) + min(own, 0) if min(around, own) <= -5 else around + own


def _weigh(elements: list[_Element], found: list[Block]) -> None:
    """Weights of all elements of a page; parents come before what they hold."""
    for block in found:
        block.element.plain += len(block.text) - block.linked
    for e in reversed(elements):
        if e.parent:
            e.parent.plain += e.plain
            e.parent.holds |= e.holds
    for e in elements:
        e.weigh(elements[0].plain)


class Block:
    __slots__ = ("text", "linked", "element", "shared")

    def __init__(self, text: str, linked: int, element: _Element, shared: int):
        self.text, self.linked, self.element = text, linked, element
        self.shared = shared  # depth of the innermost element around this block and the one before it


def blocks(page: str) -> list[Block]:
    """The displayed text of a page by block, in page order."""
    found: list[Block] = []
    pieces: list[str] = []
    top = _Element("", None, "")
    elements = [top]
    element, links, linked, owner, at = top, 0, 0, None, 0
    opened: Counter[str] = Counter()  # open elements by name
    lowest = shared = 0  # depth of the shallowest element since the last block began

    def end_block() -> None:
        nonlocal linked, owner
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                found.append(Block(text, min(linked, len(text)), owner or element, shared))
            pieces.clear()
        linked, owner = 0, None

    def close(upto: _Element) -> None:
        """Closes what is open inside ``upto``."""
        nonlocal element, lowest
        while element is not upto:
            opened[element.name] -= 1
            element = element.parent
        lowest = min(lowest, element.depth)

    def add(raw: str) -> None:
        nonlocal linked, owner, lowest, shared
        if not raw or element.unshown:
            return
        text = html.unescape(raw) if "&" in raw else raw
        pieces.append(text)
        if owner is None and not text.isspace():
            owner = element
            shared = min(lowest, element.depth)
            lowest = element.depth
        if links:
            linked += len(text)

    while (m := TAG.search(page, at)) is not None:
        add(page[at:m.start()])
        at, name = m.end(), (m[2] or "").lower()
        if not name:
            continue
        if m[1]:  # a closing tag: up to its element, if that is open
            if name in BLOCK:
                end_block()
            if name == "a":
                links = max(0, links - 1)
            if opened[name]:  # each step closes an element, so all of them take time in proportion to the page
                e = element
                while e.name != name:
                    e = e.parent
                close(e.parent)
            continue
        if name in UNSHOWN:
            closing = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            if not m[3].endswith("/"):
                at = closing.end() if closing else len(page)
            continue
        if name == "br":
            pieces.append(" ")
        if name in BLOCK:
            end_block()
            ending = ENDS_WITH_NEXT.get(name, ())
            e, inside = element, None
            if name != "p" and not ending:
                while opened["p"] and e.name in INLINE:
                    if e.name == "p":  # a block ends an open paragraph and what is open inside it
                        inside = e
                        break
                    e = e.parent
            elif opened["p"] or any(opened[x] for x in ending):
                while e is not top and (e.name in ending or e.name not in BLOCK or e.name == "p"):
                    if e.name in ending or e.name == "p":
                        inside = e
                    e = e.parent
            if inside is not None:
                close(inside.parent)
            links = links if element.name == "a" else 0
        if name == "a":
            links = 1
        if name not in VOID and not m[3].endswith("/"):
            element = _Element(name, element, m[3])
            elements.append(element)
            opened[name] += 1
    add(page[at:])
    end_block()
    _weigh(elements, found)
    return found


def content_score(block: Block) -> float:
    """Log-odds that a block is content."""
    n = len(block.text)
    words = block.text.count(" ") + 1
    share = block.linked / n
    # a list of links within an article is part of it, unless its element says otherwise
    score = block.element.weight - 1.5 + min(words, 40) * 0.06 - (2.5 if block.element.weight >= 4 else 4) * share
    if block.text[-1] in ".!?:;\"'”»…":
        score += 0.7
    return max(-12.0, min(12.0, score))


def edges_of(found: list[Block], strength: float = 1.2) -> list[tuple[int, int, int]]:
    """(block, later block, weight): neighbours, and siblings with others between them."""
    out, last = [], {}
    containers = [b.element.block.parent or b.element.block for b in found]  # around the blocks' own tags
    for i, block in enumerate(found):
        if i:
            depth = max(found[i - 1].element.depth, block.element.depth)
            near = block.shared / depth if depth else 1.0  # share of the longer element path that both have
            out.append((i - 1, i, int(SCALE * strength * near * near)))
        before = last.get(id(containers[i]))
        if before is not None and before < i - 1:
            out.append((before, i, int(SCALE * strength * 0.7)))
        last[id(containers[i])] = i
    return [(a, b, w) for a, b, w in out if w > 0]


def minimum_cut(gain: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Labels that minimise the costs: ``gain`` is what calling a node True saves (or costs, if
    negative); an edge costs its weight if its ends differ. Of several minima, the one with
    the fewest nodes True."""
    n = len(gain)
    gain = list(gain)
    near: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    for a, b, w in edges:
        near[a].append((b, w))
        near[b].append((a, w))
    free = [sum(w for _, w in near[i]) for i in range(n)]
    label: list[bool | None] = [None] * n
    waiting = deque(range(n))
    while waiting:  # settle nodes that outweigh all their undecided edges
        i = waiting.popleft()
        if label[i] is not None or not (gain[i] > free[i] or -gain[i] >= free[i]):
            continue
        label[i] = gain[i] > free[i]
        for j, w in near[i]:
            if label[j] is None:
                gain[j] += w if label[i] else -w
                free[j] -= w
                waiting.append(j)
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        place = {i: k for k, i in enumerate(rest)}
        side = _source_side([gain[i] for i in rest],
                            [(place[a], place[b], w) for a, b, w in edges if a in place and b in place])
        for i, k in place.items():
            label[i] = side[k]
    return [bool(x) for x in label]


def _source_side(gain: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Dinic's maximum flow; which nodes the source still reaches."""
    n = len(gain)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[int] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def connect(a: int, b: int, forward: int, back: int) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(forward)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, g in enumerate(gain):
        if g > 0:
            connect(source, i, g, 0)
        elif g < 0:
            connect(i, sink, -g, 0)
    for a, b, w in edges:
        connect(a, b, w, w)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        at = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:  # blocking flow, without recursion
            if a == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                cut = next(k for k, e in enumerate(path) if not room[e])
                a = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while at[a] < len(out[a]):
                e = out[a][at[a]]
                if room[e] and level[to[e]] == level[a] + 1:
                    break
                at[a] += 1
            if at[a] < len(out[a]):
                path.append(out[a][at[a]])
                a = to[path[-1]]
            elif a == source:
                break
            else:
                e = path.pop()
                a = to[e ^ 1]
                at[a] += 1


def main_text(page: str) -> str:
    found = blocks(page)
    labels = minimum_cut([int(SCALE * content_score(b)) for b in found], edges_of(found))
    return "\n\n".join(b.text for b, keep in zip(found, labels, strict=True) if keep)


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices_by_bytes(batches, "html", 8 << 20):
            texts = [main_text(raw.decode("utf-8")) for raw in byte_texts(batch.column("html"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id").cast(pa.int64()), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
