"""Main text of HTML pages by composite text density.

A page becomes a tree of elements. For every node, with C characters and T tags in its subtree, LC of
the characters and LT of the tags in links, and LCb, Cb the same for the body, the density is

    C / T * log_b(C / LC * T / LT),  b = ln(C / (C - LC) * LC + LCb / Cb * C + e)

so text raises it and links lower it. The sum of a node's child densities is greatest where many
dense blocks are side by side: the article. The least density on the path from that node to the body
is the threshold that other blocks must reach. If the page marks the article itself, the marked element
takes that node's place, and elements marked like it stay whatever their density.

Elements that can't be part of an article (navigation, page headers and footers, asides, scripts, hidden
ones) leave the tree before densities are computed. A class or id that says advert, notice, share and the
like, and a form, are hints: blocks of one hint that are link-poor and a quarter as dense as the article
they are in (or the page) clear it there if together they hold a tenth of its text, or half of it where the
hint is of text by or for others (adverts, cookies, sidebars), which beside a marked article nothing clears.
Link-rich blocks go in any case. Comments can be as dense and longer than an article; they go unless the
page has no other text.

Nulls and edge cases: null and empty pages, and pages without an article, give an empty text. Broken
markup (unclosed or stray tags, cut-off pages) is read as browsers do: a new paragraph closes an open
one, a stray end tag is ignored. Very long pages are read whole. Repeated rows give repeated results; an empty table gives an empty one.
Of other columns only page_id and url are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.llm.common import raw_texts, slices

# Names of HTML elements and of roles.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody "
    "td tfoot th thead title tr ul".split()
)
CLOSES_P = BLOCK - {"br", "option", "title", "legend", "body", "html", "td", "th", "tr", "tbody", "thead", "tfoot"}
P_SCOPE = frozenset("body button caption html object table td template th".split())
#: An element that closes an open one of these, up to one of those.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
DROPPED = frozenset(
    "aside button canvas datalist dialog embed footer head iframe input label menu nav noscript object "
    "script select style svg template textarea title".split()
)
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog menu menubar navigation search tablist toolbar".split()
)
HINTS = frozenset(
    "ad ads adbox adslot advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice pager pagination popup promo "
    "promotion recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored "
    "subscribe subscription toolbar widget".split()
)
COMMENT_HINTS = frozenset("comment comments replies reply".split())
#: Elements that are a hint themselves.
HINT_TAGS = frozenset("fieldset form".split())
#: Hints of text by or for others, which may be as dense as an article's.
FIRM_HINTS = frozenset(
    "ad ads adbox adslot advert advertisement adverts advertising consent cookie cookies disqus footer gdpr masthead newsletter "
    "promo promotion recommended sidebar signup sponsor sponsored subscribe subscription".split()
)
#: Of an article's text, the part that is much: one in so many characters.
MUCH, FIRM_MUCH = 10, 2
#: A block with a hint is dense from this part of the article's density on.
DENSE = 4
CONTAINERS = frozenset("article body center div main section td".split())

_TOKEN = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "up", "parts", "noise", "hints", "main", "chars", "tags", "link_chars", "link_tags", "density", "sum")

    def __init__(self, tag: str, up: Node | None, noise: bool = False, main: bool = False, hints: frozenset[str] = frozenset()):
        self.tag, self.up, self.noise, self.main, self.hints = tag, up, noise, main, hints
        self.parts: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0


def _hidden(attrs: dict[str, str]) -> bool:
    """Whether an element's own attributes say that it isn't shown, or plays another role than an article's."""
    if "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return True
    if "display:none" in attrs.get("style", "").replace(" ", "").lower():
        return True
    return attrs.get("role", "").lower() in ROLES


def _hints(tag: str, attrs: dict[str, str]) -> frozenset[str]:
    """Words of an element that hint at no part of an article."""
    if tag in ("html", "body"):
        return frozenset()
    words = set(_TOKEN.findall(f"{attrs.get('class', '')} {attrs.get('id', '')}".lower()))
    if tag in ("article", "main"):
        return COMMENT_HINTS & words
    forms = {tag, attrs.get("role", "").lower()} & HINT_TAGS
    return HINTS & words | forms


class Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", None)

    def _close(self, tags, until) -> None:
        """Close the nearest open element of these tags, unless one of `until` is nearer."""
        found, node = None, self.at
        while node.up is not None and node.tag not in until:
            if node.tag in tags:
                found = node
            node = node.up
        if found is not None:
            self.at = found.up

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in CLOSES_P:
            self._close({"p"}, P_SCOPE)
        if tag in SIBLINGS:
            self._close(*SIBLINGS[tag])
        given = {k: v or "" for k, v in attrs} if attrs else {}
        noise = tag in DROPPED or bool(given) and _hidden(given)
        hints = _hints(tag, given) if given or tag in HINT_TAGS else frozenset()
        main = tag in ("article", "main") or given.get("role") == "main" or given.get("itemprop") == "articleBody"
        node = Node(tag, self.at, noise or bool(hints), main, frozenset() if noise else hints)
        self.at.parts.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        while node.up is not None:
            if node.tag == tag:
                self.at = node.up
                return
            node = node.up

    def handle_data(self, data: str) -> None:
        self.at.parts.append(data)


def parse(page: str) -> Node:
    tree = Tree()
    try:
        tree.feed(page)
        tree.close()
    except AssertionError:  # a malformed marked section
        tree = Tree()
        tree.feed(page.replace("<![", "&lt;!["))
        tree.close()
    return tree.root


def _in_order(root: Node) -> list[Node]:
    """Nodes that are no noise, parents first."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(x for x in reversed(node.parts) if type(x) is Node and not x.noise)
    return out


def _prune(root: Node) -> tuple[set[int], list[Node]]:
    """Page headers leave, unless within the article they hold its heading; so do aside-like elements, but
    never one that the article is in. Returns ids of nodes that hold a marked one, and nodes taken back."""
    nodes, stack = [], [root]
    while stack:
        node = stack.pop()
        nodes.append(node)
        stack.extend(x for x in node.parts if type(x) is Node)
    holds_main: set[int] = set()
    holds_h1: set[int] = set()
    back: list[Node] = []
    for node in nodes:
        for found, there in ((node.main and not node.noise, holds_main), (node.tag == "h1", holds_h1)):
            up = node.up if found else None
            while up is not None and id(up) not in there:
                there.add(id(up))
                up = up.up
    for node in nodes:
        if node.tag == "header":
            up = node.up
            while up is not None and not up.main:
                up = up.up
            node.noise = not (up is not None and id(node) in holds_h1)
            node.hints = frozenset()
        elif node.noise and node.tag not in ("head", "script", "style", "template") and id(node) in holds_main:
            node.noise = False
            back.append(node)
    return holds_main, back


def _link_poor(node: Node) -> bool:
    return node.chars > 0 and node.link_chars * 2 < node.chars


def _confirm(root: Node, back: list[Node], ignored: frozenset[str] = frozenset()) -> list[Node]:
    """Blocks whose hints their density and share of the text speak against are no noise. Returns the nodes
    of `back` whose hints stand."""
    stack, hinted = [root], []
    while stack:
        node = stack.pop()
        if node.hints and not node.hints & COMMENT_HINTS - ignored:
            hinted.append(node)
            node.noise = False
        stack.extend(x for x in node.parts if type(x) is Node and (x.hints or not x.noise))
    if hinted:
        place: dict[int, Node] = {}  # the article that a node is in, or the page
        counted: dict[int, frozenset[str]] = {}  # hints whose characters an outer block has there
        held: dict[tuple[int, str], int] = {}
        marked = False
        for node in measure(root):
            up = node.up
            marked = marked or node.main and node.chars > 0
            at = place[id(node)] = root if up is None else up if up.main else place[id(up)]
            outer = frozenset() if up is None or up.main else counted[id(up)]
            if node.hints and _link_poor(node) and node.density * DENSE >= at.density:
                for word in node.hints - outer:
                    held[id(at), word] = held.get((id(at), word), 0) + node.chars
                outer |= node.hints
            counted[id(node)] = outer
        kept = set(map(id, back))
        for node in hinted:
            at = place.get(id(node))
            stands = at is None or not _link_poor(node)
            for word in node.hints - ignored:
                much = FIRM_MUCH if word in FIRM_HINTS else MUCH
                beside = marked and at is root and word in FIRM_HINTS
                stands = stands or beside or held.get((id(at), word), 0) * much < at.chars
            if not stands:
                node.hints = frozenset()
            node.noise = stands and id(node) not in kept
    return [n for n in back if n.hints or n.tag in DROPPED]


def measure(root: Node) -> list[Node]:
    """Densities and sums of all nodes below root, children before parents in the computation."""
    nodes = _in_order(root)
    for node in nodes:
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        node.density = node.sum = 0.0
    for node in reversed(nodes):
        own = sum(len("".join(x.split())) for x in node.parts if type(x) is str)
        node.chars += own
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, max(1, node.link_tags)
        if node.up is not None:
            up = node.up
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags
    body = root
    share = body.link_chars / body.chars if body.chars else 0.0
    for node in nodes:
        c, t = node.chars, max(1, node.tags)
        if not c:
            continue
        lc, lt = max(1, node.link_chars), max(1, node.link_tags)
        rest = max(1, c - node.link_chars)
        base = math.log(c / rest * node.link_chars + share * c + math.e)
        inside = max(c / lc * t / lt, 1.0)
        node.density = c / t * math.log(inside + math.e - 1) / math.log(base + math.e - 1)
    for node in nodes:
        if node.up is not None:
            node.up.sum += node.density
    return nodes


def chosen(root: Node) -> list[Node]:
    """The subtrees that are the article, in page order."""
    holds_main, back = _prune(root)
    aside = _confirm(root, back)
    nodes = measure(root)
    if not root.chars:
        aside = _confirm(root, back, COMMENT_HINTS)
        nodes = measure(root)
    full = [n for n in nodes if n.chars]
    if not full:
        return []
    best = max(full, key=lambda n: n.sum)  # of equal sums the outermost, which comes first
    if not best.sum:
        return [root]
    threshold, node, marked = best.density, best, None
    while node is not None and node.up is not None:
        if node.main and marked is None:
            marked = node
        if node.tag not in ("html", "body"):
            threshold = min(threshold, node.density)
        node = node.up
    if marked is not None:
        best = marked
    while marked is None and best.up is not None and best.tag not in CONTAINERS:
        best = best.up
    if marked is None and best.tag in ("body", "html", "#root"):
        return [best]
    kept, path = [], set()
    node = best
    while node is not None:
        path.add(id(node))
        node = node.up
    for node in aside:
        node.noise = id(node) not in path
    stack = [root]
    while stack:  # blocks beside the path that are marked or as dense as its weakest node
        node = stack.pop()
        if node is best:
            kept.append(node)
        elif node.noise:
            continue
        elif node.main and _link_poor(node) and id(node) not in path:
            kept.append(node)
        elif id(node) in path or id(node) in holds_main:
            stack.extend(x for x in reversed(node.parts) if type(x) is Node and not x.noise)
        elif _link_poor(node) and node.density >= threshold:
            kept.append(node)
    return kept


def text_of(nodes: list[Node]) -> str:
    """Blocks in page order, each with single spaces, joined by one space."""
    blocks: list[str] = []
    inline: list[str] = []

    def flush() -> None:
        if words := "".join(inline).split():
            blocks.append(" ".join(words))
        inline.clear()

    for top in nodes:
        stack: list = [top]
        while stack:
            item = stack.pop()
            if item is None:
                flush()
            elif type(item) is str:
                inline.append(item)
            elif not item.noise or item is top:
                if item.tag in BLOCK:
                    flush()
                    stack.append(None)
                stack.extend(reversed(item.parts))
        flush()
    return " ".join(blocks)


def main_text(page: str) -> str:
    return text_of(chosen(parse(page))) if page else ""


EXTRACTED = "page_id long, url string, text string, n_chars long"


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and its number of code points for every page. No shuffle; pages one by one."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                texts = [main_text(x.decode()) for x in raw_texts(part["html"])]
                yield pa.RecordBatch.from_arrays(
                    [part["page_id"], part["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    return rows.mapInArrow(run, EXTRACTED)
