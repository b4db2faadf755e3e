"""Main text of web pages by composite text density (operator 6).

A page is read into a tree of elements. Every node gets its characters, its tags, and the characters and tags inside
links. The composite density is characters for each tag, times a factor that falls with the share of linked text; the
base of its logarithm brings in the share of links in the whole body. The sum of a node's children's densities finds
the content: the node with the largest sum is the main text, and the least density on its path to the body is the
threshold above which other subtrees belong to it as well. Where the largest sum lies in an article or main element, the
nearest one is taken whole in place of that node; a mark elsewhere has no say.

Elements that by their name, role or class are menus, notices, adverts, forms, comments and the like are cut out of
the tree first: a short advert without links has a high density, and no density tells it from a paragraph. One that
holds nearly all text, as a form around a whole page, or the page's main element, is not cut (``without_asides``).

Defined results: a null, empty or tagless page gives its text, decoded (an empty text for null). Unclosed and cut-off
tags end with the page. Every page is one row, repeated rows and null page_ids included. Pages are read in one pass,
whole; nothing but a row's tree is kept.
"""

from __future__ import annotations

import heapq
import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data dfn em font i img ins kbd mark q s samp small span strike strong "
    "sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main nav ol p pre section table ul".split()
)
# What an opening tag ends, and the elements beyond which it does not look.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
# What no reader sees, or nobody reads as text.
HIDDEN = frozenset(
    "audio button canvas embed head iframe input map noscript object script select style svg template textarea title "
    "video".split()
)
# Elements, roles and class names of what stands around a text.
ASIDE = frozenset("aside dialog footer menu nav".split())
CUT_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
CUT_NAME = re.compile(
    r"(?:[a-z]+[-_])?(?:ads?|advert\w*|banner|breadcrumbs?|comments?|cookies?|consent|disqus|footer|masthead|menu|modal|"
    r"nav\w*|newsletter|notices?|pager|pagination|popup|promo\w*|related|replies|respond|share|sharing|sidebar|"
    r"social|sponsor\w*|subscribe|toolbar|widget)"
    r"(?:[-_](?:articles?|area|bar|block|bottom|box|container|content|inner|items?|left|links?|list|outer|overlay|"
    r"panel|posts?|right|section|slot|thread|top|unit|wrap|wrapper|[0-9]+))*",
    re.IGNORECASE,
)
COMMENTS = re.compile(r"comments?|disqus|replies|respond", re.IGNORECASE)
PROSE = frozenset("article h1 h2 h3 p".split())
DOMINANT = 4  # times the text around it, a part that is cut by its name has at least to stay
# Comments, declarations and tags; each may be cut off by the end of the page. A quote opens a value after '=' only, if
# it is closed anywhere; any other quote is a character, and the tag ends at the next '>'.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*+)|[^>])*+)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=>\"'/][^\s=>/]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
BLANK = re.compile(r"\s+")


@dataclass(slots=True, eq=False)
class Node:
    name: str
    parent: Node | None = None
    parts: list[Node | str] = field(default_factory=list)
    cut: bool = False
    aside: bool = False  # stands around a text, by its name: goes unless it holds the text
    lifts: bool = False  # may hold the text nonetheless
    chars: int = 0
    tags: int = 0
    link_chars: int = 0
    link_tags: int = 0
    density: float = 0.0


def _attributes(found: str) -> dict[str, str]:
    """Whole names with their values, the first of equal names."""
    out: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(found):
        out.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return out


def _marked(node: Node, attributes: str, in_article: bool) -> None:
    """Say whether a node is unseen, stands around a text, and may hold the text although its name says otherwise."""
    name = node.name
    node.cut = node.cut or name in HIDDEN
    node.aside = name in ASIDE or name == "form" or name == "header" and not in_article
    node.lifts = name == "form"
    if not attributes or name in ("html", "body", "article", "main"):
        return
    own = _attributes(attributes)
    node.cut = node.cut or "hidden" in own
    if own.get("role", "").lower() in CUT_ROLES:
        node.aside = node.lifts = True
    names = [n for n in f"{own.get('class', '')} {own.get('id', '')}".split() if CUT_NAME.fullmatch(n)]
    if names:
        node.lifts = (node.lifts or not node.aside) and not any(map(COMMENTS.search, names))
        node.aside = True


class _Open:
    """The open elements, with the places of each name, so that a name that is not open is never looked for."""

    def __init__(self, root: Node):
        self.nodes, self.places = [root], {}

    def push(self, node: Node) -> None:
        self.places.setdefault(node.name, []).append(len(self.nodes))
        self.nodes.append(node)

    def close(self, place: int) -> None:
        while len(self.nodes) > place:
            self.places[self.nodes.pop().name].pop()

    def last(self, names) -> int:
        """The place of the innermost open element of these names; 0 if there is none."""
        return max((own[-1] for name in names if (own := self.places.get(name))), default=0)

    def end(self, name: str) -> None:
        """What an opening tag of that name ends."""
        if name in CLOSES_P:
            ended, within = {"p"}, WITHIN_P
        elif name in ENDS:
            ended, within = ENDS[name]
        else:
            return
        place = self.last(ended)
        if place and place > (bound := self.last(within)):
            if name == "tr":  # a cell goes with its row
                place = min(p for e in ended for p in self.places.get(e, ()) if p > bound)
            self.close(place)


WITHIN_P = CLOSES_P - {"p"} | {"td", "th", "li"}


def parse(page: str) -> Node:
    """The page's tree, without what no reader sees and what stands around the text."""
    root = Node("body")
    open_, at = _Open(root), 0

    def text(piece: str) -> None:
        if piece and not open_.nodes[-1].cut:
            open_.nodes[-1].parts.append(html.unescape(piece))

    while m := TOKEN.search(page, at):
        text(page[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name or name in ("html", "body"):
            continue
        if m[1]:
            if place := open_.last((name,)):
                open_.close(place)
            continue
        open_.end(name)
        parent = open_.nodes[-1]
        node = Node(name, parent, cut=parent.cut)
        _marked(node, m[3], bool(open_.last(("article", "main"))))
        if not node.cut:
            parent.parts.append(node)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            if not node.cut:
                node.parts.append(html.unescape(page[at : end.start() if end else len(page)]))
            at = end.end() if end else len(page)
        elif name not in VOID and not m[3].endswith("/"):
            open_.push(node)
    text(page[at:])
    without_asides(root)
    return root


def without_asides(root: Node) -> None:
    """Take out what stands around the text; a part that holds the text stays, and what is in it is looked at alone.

    A part holds the text if it has the page's ``main`` element, or paragraphs and headings, and ``DOMINANT`` times what
    is outside all such parts: a form or a widget around a whole page.
    """
    nodes = _in_order(root)
    if not any(n.aside for n in nodes):
        return
    chars, prose, main = {}, {}, {}
    for n in reversed(nodes):
        inner = [p for p in n.parts if isinstance(p, Node)]
        own = sum(len(BLANK.sub(" ", p).strip()) for p in n.parts if isinstance(p, str))
        chars[id(n)] = own + sum(chars[id(p)] for p in inner)
        prose[id(n)] = (n.name in PROSE) + sum(prose[id(p)] for p in inner)
        main[id(n)] = n.name == "main" or any(main[id(p)] for p in inner)

    def topmost(start: Node) -> list[Node]:
        found, waiting = [], [p for p in start.parts if isinstance(p, Node)]
        while waiting:
            n = waiting.pop()
            if n.aside:
                found.append(n)
            else:
                waiting.extend(p for p in n.parts if isinstance(p, Node))
        return found

    parts = topmost(root)
    outside = chars[id(root)] - sum(chars[id(n)] for n in parts)
    heap = [(-chars[id(n)], k, n) for k, n in enumerate(parts)]
    heapq.heapify(heap)
    gone, count = [], len(parts)
    while heap:
        _, _, n = heapq.heappop(heap)
        size = chars[id(n)]
        if main[id(n)] or n.lifts and prose[id(n)] >= 2 and size > DOMINANT * outside:
            n.aside = False
            inner = topmost(n)
            outside += size - sum(chars[id(p)] for p in inner)
            for p in inner:
                count += 1
                heapq.heappush(heap, (-chars[id(p)], count, p))
        else:
            gone.append(n)
    out: dict[int, set[int]] = {}
    for n in gone:
        out.setdefault(id(n.parent), set()).add(id(n))
    for parent in {id(n.parent): n.parent for n in gone}.values():
        parent.parts = [p for p in parent.parts if isinstance(p, str) or id(p) not in out[id(parent)]]


def _in_order(root: Node) -> list[Node]:
    """All nodes, parents first; no recursion, as pages may be nested very deeply."""
    nodes, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        nodes.append(node)
        waiting.extend(p for p in reversed(node.parts) if isinstance(p, Node))
    return nodes


def measure(nodes: list[Node]) -> None:
    """Counts and composite densities, children before parents."""
    for node in reversed(nodes):
        for part in node.parts:
            if isinstance(part, str):
                node.chars += len(BLANK.sub(" ", part).strip())
            else:
                node.chars += part.chars
                node.tags += 1 + part.tags
                node.link_chars += part.link_chars
                node.link_tags += part.link_tags
        if node.name == "a":
            node.link_chars, node.link_tags = node.chars, node.link_tags + 1
    body = nodes[0]
    linked = body.link_chars / max(body.chars, 1)
    for node in nodes:
        if not node.chars:
            continue
        tags, links, link_tags = max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
        plain = max(node.chars - node.link_chars, 1)
        base = math.log(node.chars / plain * node.link_chars + linked * node.chars + math.e)
        share = max(node.chars / links * tags / link_tags, 1.0)
        # A base of exactly one would make the factor infinite: pages without links have the plain logarithm.
        node.density = node.chars / tags * math.log(share) / max(math.log(base), 1.0)


def content(nodes: list[Node]) -> set[int]:
    """Identities of the topmost nodes of the main text."""
    sums = {
        id(n): sum(p.density for p in n.parts if isinstance(p, Node) and p.name not in INLINE)
        for n in nodes
        if n.name not in INLINE
    }
    best = max((n for n in nodes if id(n) in sums), key=lambda n: sums[id(n)])
    if sums[id(best)] <= 0:
        return {id(nodes[0])}
    path, node = [], best
    while node is not None:
        path.append(node)
        node = node.parent
    threshold = min(n.density for n in path)
    # A page that marks its article says how far the text goes: the nearest mark around the best node widens it.
    at = next((i for i, n in enumerate(path) if n.name in ("article", "main")), 0)
    best, path = path[at], path[at:]
    chosen, waiting = set(), [nodes[0]]
    on_path = {id(n) for n in path[1:]}
    while waiting:
        node = waiting.pop()
        if id(node) in on_path:
            waiting.extend(p for p in node.parts if isinstance(p, Node))
        elif node is best or node.density >= threshold and node.name not in INLINE:
            chosen.add(id(node))
    return chosen


def _blocks(root: Node, chosen: set[int]) -> Iterator[str]:
    """Text runs of the chosen subtrees in page order, split where a block begins or ends."""
    run: list[str] = []
    waiting: list[tuple[Node | str | None, bool]] = [(root, False)]
    while waiting:
        part, inside = waiting.pop()
        if isinstance(part, str):
            if inside:
                run.append(part)
            continue
        block = part is None or part.name not in INLINE
        if block and run:
            yield "".join(run)
            run = []
        if part is None:
            continue
        if part.name == "br":
            run.append(" ")
        inside = inside or id(part) in chosen
        if block:
            waiting.append((None, False))
        waiting.extend((p, inside) for p in reversed(part.parts))
    if run:
        yield "".join(run)


def main_text(page: str | None) -> str:
    """The page's main text: one line for each block."""
    if not page:
        return ""
    root = parse(page)
    nodes = _in_order(root)
    measure(nodes)
    chosen = content(nodes)
    lines = (BLANK.sub(" ", block).strip() for block in _blocks(root, chosen))
    return "\n".join(line for line in lines if line)


def extracted(pages: DataFrame, *keep: str) -> DataFrame:
    """The kept columns with text and n_chars for every page."""

    @F.pandas_udf("string")
    def text(found: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in found:
            yield pd.Series([main_text(page) for page in batch], dtype=object)

    return pages.select(*keep, text("html").alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))
