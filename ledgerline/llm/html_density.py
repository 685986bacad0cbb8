"""Main text of web pages by composite text density.

For every node of the page's tree: characters per tag, adjusted by how much of the text is links
(composite text density). The density sum of a node is the sum of its children's densities; the node
with the largest one heads the main text. The lowest density on its path to the body is the
threshold: siblings along the path that reach it belong to the text too, so a text that is split over
several containers stays whole.

If the page marks article or main parts, the search is narrowed to all of them (nested ones count with
the outermost). The head is chosen over them together; every part belongs that reaches the head's
threshold somewhere or is not mostly links. In a part only siblings along the path to its own head
that are mostly links and below the threshold go: short paragraphs and loose text stay.

What is never part of the text is taken out first: scripts, styles, menus, forms and so on by tag,
and sidebars, notices, adverts, comments and the like by class, id or role, unless the node holds
most of the page's text or an article. A name counts if all its words (split at hyphens and capitals)
are about such parts: ``adSlot`` and ``related-posts`` do, ``share-price`` and ``notice-board`` do not.

Nothing is cut: every block of the chosen subtree is in the text. Character references are decoded,
white space inside a block becomes one space, blocks are joined by one space in page order.

Edge cases: null and empty pages give an empty text. Unclosed and stray tags are handled as browsers
do where it matters for text. Pages of any size and depth work; nothing recurses. Repeated rows come
out as often as they went in.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import column, map_batches

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([^\s=/>\"']+)")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
#: Tags that are never main text.
DROPPED = frozenset(
    "script style template noscript head nav footer aside form button select textarea input iframe svg canvas object menu dialog "
    "noframes noembed title audio video map datalist".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
#: Blocks that hold one paragraph; the head of the main text is never one of them.
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre hr caption figcaption summary address".split())
CLOSES_P = BLOCKS - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "html", "body"}
#: An opening tag ends an open one of these, if none of the barriers is in between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
#: Words in class, id or role that mark parts beside the main text.
BESIDE = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox banner sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notification alert popup modal overlay newsletter subscribe subscription signup sidebar widget widgets related "
    "recommended recommendations share sharing social comment comments reply replies respond disqus breadcrumb breadcrumbs menu nav "
    "navbar navigation topbar masthead footer copyright pagination pager toolbar login search hidden skip complementary contentinfo "
    "dialog".split()
)
#: Words that say what kind of part it is; with one of the above they make a name like ``adSlot`` or ``related-posts``.
#: Any other word (``share-price``, ``notice-board``, ``comment-enabled``) makes it the name of something else.
PARTS = frozenset(
    "area bar block body bottom box button buttons card center column container content count element embed feed float footer form "
    "frame group head header heading holder icon icons info inner item items label layer left link links list loop main message "
    "messages module outer panel parent placeholder post posts region right row section size slot space square stream text "
    "thread title top unit view wrap wrapper zone aside for of the a in on by js id site page primary secondary global".split()
)
_NAME_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


class Node:
    __slots__ = ("tag", "attributes", "parent", "children", "chars", "tags", "link_chars", "link_tags", "density", "sum", "dropped", "order")

    def __init__(self, tag: str, attributes: str, parent: Node | None):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0
        self.dropped = False


def parse(html: str) -> list[Node]:
    """All nodes in page order; the first is the root."""
    root = Node("#root", "", None)
    nodes, top, at, end = [root], root, 0, len(html)
    low = None

    def close(names, barriers=frozenset()) -> None:
        """End the innermost open element of *names*, unless a barrier encloses it more closely."""
        nonlocal top
        node = top
        while node is not root and node.tag not in barriers:
            if node.tag in names:
                top = node.parent
                return
            node = node.parent

    while at < end:
        found = MARKUP.search(html, at)
        if not found:
            top.children.append(html[at:])
            break
        if found.start() > at:
            top.children.append(html[at : found.start()])
        at = found.end()
        tag = found.group(2) or found.group(5)
        if tag is None:
            continue
        tag, attributes = tag.lower(), found.group(3) or found.group(6) or ""
        if found.group(1) or found.group(4):
            if tag == "p":
                close({"p"}, {"article", "section", "div", "td", "li", "main", "body"})
            elif tag in BLOCKS:
                close({tag})
            else:
                close({tag}, BLOCKS)
            continue
        if tag in CLOSES_P:
            close({"p"}, {"article", "section", "div", "td", "th", "li", "main", "body", "button", "table", "aside", "figure", "form"})
        if tag in ENDS:
            close(*ENDS[tag])
        if tag[0] == "h" and tag[1:].isdigit() and top.tag[0] == "h" and top.tag[1:].isdigit():
            top = top.parent
        node = Node(tag, attributes, top)
        top.children.append(node)
        nodes.append(node)
        if tag in VOID or attributes.endswith("/") and tag not in BLOCKS and tag not in RAW and tag not in ("a", "b", "i", "span"):
            continue
        if tag in RAW:
            low = low if low is not None else html.lower() if len(html.lower()) == len(html) else html
            stop = low.find(f"</{tag}", at)
            stop = end if stop < 0 else stop
            node.children.append(html[at:stop])
            after = html.find(">", stop)
            at = end if after < 0 else after + 1
            continue
        top = node
    return nodes


def _names_beside(value: str) -> bool:
    """Whether one of the names in a class, id or role is made of words for parts beside the text, and for parts, only."""
    for name in value.split():
        words = [w.lower() for w in _NAME_WORDS.findall(name)]
        if not BESIDE.isdisjoint(words) and all(w in BESIDE or w in PARTS for w in words):
            return True
    return False


def _beside(node: Node) -> bool:
    """Whether class, id, role or style say that a node is not main text."""
    if not node.attributes or "=" not in node.attributes and "hidden" not in node.attributes:
        return False
    for name, a, b, c, bare in ATTRIBUTE.findall(node.attributes):
        name = (name or bare).lower()
        value = a or b or c
        if name in ("class", "id", "role") and _names_beside(value):
            return True
        value = value.lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def _within(node: Node | None, tags: tuple[str, ...]) -> Node | None:
    """The outermost of node and its ancestors with one of these tags."""
    found = None
    while node is not None:
        if node.tag in tags:
            found = node
        node = node.parent
    return found


def _measure(nodes: list[Node]) -> None:
    """Characters, tags and their parts in links of every node, without what is dropped."""
    for node in nodes:
        node.chars = node.tags = node.link_chars = node.link_tags = 0
    for node in reversed(nodes):  # children come after their parents
        if node.dropped:
            continue
        for child in node.children:
            if isinstance(child, str):
                node.chars += len("".join(child.split()))
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags
        if node.parent is not None:
            up = node.parent
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags + (node.tag == "a")


def _score(nodes: list[Node], body: Node) -> None:
    """Composite density of every node and the sum over its children."""
    ratio = body.link_chars / max(body.chars, 1)
    for node in nodes:
        node.sum = node.density = 0.0
    for node in reversed(nodes):
        if node.dropped or not node.chars:
            continue
        chars, tags, links, link_tags = node.chars, max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
        plain = max(node.chars - node.link_chars, 1)
        base = math.log(chars / plain * node.link_chars + ratio * chars + math.e)
        node.density = max(chars / tags * math.log(max(chars / links * tags / link_tags, 1.0)) / math.log(base) if base > 1.0001 else chars / tags, 0.0)
        if node.parent is not None:
            node.parent.sum += node.density


def _inside(nodes: list[Node], scope: Node) -> list[Node]:
    found, kept = {id(scope)}, [scope]
    for node in nodes:
        if node.parent is not None and id(node.parent) in found and not node.dropped:
            found.add(id(node))
            kept.append(node)
    return kept


def _path(node: Node, top: Node) -> list[Node]:
    """From *node* up to *top*."""
    path = [node]
    while path[-1] is not top and path[-1].parent is not None:
        path.append(path[-1].parent)
    return path


def _regions(nodes: list[Node], body: Node, regions: list[Node]) -> list[Node]:
    """The marked parts that belong to the main text; what does not belong in them becomes dropped."""
    peak: dict[int, float] = {}  # largest density in each subtree
    own: dict[int, Node] = {id(r): r for r in regions}  # region of each node
    heads: dict[int, Node] = {}  # largest density sum in each region
    for node in nodes:
        if node.parent is None or node.dropped:
            continue
        region = own.get(id(node)) or own.get(id(node.parent))
        if region is None:
            continue
        own[id(node)] = region
        if node is region or node.tag in BLOCKS - PARAGRAPHS and node.sum > heads[id(region)].sum:
            heads[id(region)] = node
    for node in reversed(nodes):
        if not node.dropped:
            peak[id(node)] = max(peak.get(id(node), 0.0), node.density)
            if node.parent is not None:
                peak[id(node.parent)] = max(peak.get(id(node.parent), 0.0), peak[id(node)])
    head = max(heads.values(), key=lambda n: n.sum)
    page = min(n.density for n in _path(head, body))
    kept = []
    for region in regions:
        if region is not own[id(head)] and peak[id(region)] < page and region.link_chars * 2 > region.chars:
            continue
        kept.append(region)
        path = _path(heads[id(region)], region)
        threshold = min(n.density for n in path)
        for node, above in zip(path, path[1:]):
            for child in above.children:
                if isinstance(child, Node) and child is not node and not child.dropped:
                    if child.tag in BLOCKS and peak[id(child)] < threshold and child.link_chars * 2 > child.chars:
                        child.dropped = True
    return kept


def _blocks(roots: list[Node]) -> str:
    """The text of subtrees: blocks with single spaces, joined by one."""
    parts: list[str] = []
    for root in roots:
        stack: list = [root]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                parts.append(item)
            elif item is None:
                parts.append(" ")
            elif not item.dropped:
                block = item.tag in BLOCKS or item.tag == "br"
                if block:
                    parts.append(" ")
                    stack.append(None)
                stack.extend(unescape(c) if isinstance(c, str) else c for c in reversed(item.children))
        parts.append(" ")
    return " ".join("".join(parts).split())


def main_text(html: str) -> str:
    """The main text of one page."""
    nodes = parse(html)
    body = next((n for n in nodes if n.tag == "body"), nodes[0])
    for node in nodes:
        node.dropped = node.tag in DROPPED or node.parent is not None and node.parent.dropped
    for node in nodes:
        if node.tag == "header" and not _within(node.parent, ("article", "main")):
            node.dropped = True
    _measure(nodes)
    whole = nodes[0].chars
    marked = [n for n in nodes if n.tag in ("article", "main") and not n.dropped and n.chars]
    holding = set()
    for n in marked:
        while n is not None:
            holding.add(id(n))
            n = n.parent
    for node in nodes:
        if node.dropped or node.parent is None or node is body or node.tag in ("html", "body"):
            continue
        if _beside(node):
            if node.tag == "article" and node.chars * 2 <= whole:
                node.dropped = True
            elif id(node) not in holding and (node.chars * 5 <= whole * 4 or marked):
                node.dropped = True
    for node in nodes:
        node.dropped = node.dropped or node.parent is not None and node.parent.dropped
    _measure(nodes)
    if not nodes[0].chars:
        return ""
    _score(nodes, body)

    regions = [n for n in marked if not n.dropped and n.chars and not _within(n.parent, ("article", "main"))]
    if regions:
        return _blocks(_regions(nodes, body, regions))
    scope = body if body.chars else nodes[0]
    inside = [n for n in _inside(nodes, scope) if n.tag in BLOCKS - PARAGRAPHS or n.parent is None or n is scope]
    head = max(inside, key=lambda n: n.sum)
    if head.sum <= 0:
        head = scope
    path = _path(head, scope)
    threshold = min(n.density for n in path)
    chosen = {id(head)}
    for node, above in zip(path, path[1:]):
        for child in above.children:
            if isinstance(child, Node) and child is not node and not child.dropped:
                heading = child.tag[0] == "h" and child.tag[1:].isdigit()
                if child.chars and (heading or child.density >= threshold):
                    chosen.add(id(child))
    return _blocks([n for n in nodes if id(n) in chosen])


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """*pages* without the html, with text and n_chars."""
    rest = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    source = pages.select(*[column(c) for c in rest], F.coalesce(column(html_col), F.lit("")).cast("binary").alias("_html"))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema if f.name != "_html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py().decode("utf-8", "replace")) for x in batch.column(len(rest))]
            # A reference to half of a surrogate pair is no character.
            texts = [t.encode("utf-8", "replace").decode() for t in texts]
            columns = [batch.column(i) for i in range(len(rest))]
            columns += [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*rest, "text", "n_chars"])

    return map_batches(source, run, f"{kinds}text string, n_chars bigint")
