"""Main text of web pages by composite text density.

A node's density is its characters per tag, lowered as more of them stand in links. The
sum of its child blocks' densities is largest for the node that holds the paragraphs of
an article (inline elements count as tags, but are no children: else a paragraph in bold
would outdo the article); the least density on the way from the body to that node is the threshold
that further nodes beside it or beside one above it, and link-heavy ones inside it, have
to reach. Text that stands directly in a node on the way stays, with inline elements that
aren't mostly links.

Elements that never hold an article's text (scripts, navigation, forms, ...) and those
whose class, id or role says so are left out before densities are computed. Some of these
words also stand at boxes around an article (``related-work``, ``toc-wrapper``): a box marked
by them alone stays if it holds more of the page's text outside links than all else.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

RESULT = "page_id bigint, url string, text string, n_chars bigint"

# Element names and attributes of HTML.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr "
    "html legend li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
#: What the start of an element ends, up to the nearest of the second set.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "thead": ({"tr", "td", "th", "thead", "tbody", "tfoot"}, {"table"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
}
ENDS_P = BLOCKS - {"body", "html", "caption", "td", "th", "tr", "tbody", "thead", "tfoot"}
P_SCOPE = BLOCKS - {"p"}

#: Elements without text of an article, and words of class, id or role that mark one.
DROPPED = RAW | frozenset(
    "head nav footer aside form button select option datalist dialog menu template svg "
    "canvas object applet audio video map fieldset input".split()
)
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promoted "
    "promotion banner comment comments commentlist disqus reply replies respond cookie "
    "cookies consent gdpr notice notices notification alert newsletter subscribe "
    "subscription signup login paywall popup modal overlay sidebar sidebars widget widgets "
    "related recommended recommendations trending share sharing social nav navbar "
    "navigation menu menus breadcrumb breadcrumbs pagination pager toc footer masthead "
    "topbar toolbar skip copyright complementary contentinfo search searchbox "
    "form byline-share".split()
)
#: Of these, words that boxes around an article have, too.
WEAK = frozenset(
    "widget widgets related recommended recommendations trending share sharing social toc "
    "overlay masthead skip sidebar sidebars search".split()
)
KEEP = frozenset("html body article main".split())
ARTICLES = frozenset(("article", "main"))

TAG = re.compile(
    r"<!--(?:>|->|.*?(?:-->|--!>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)"
    r"(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(
    r"(class|id|role|hidden|aria-hidden|style|itemprop)"
    r"(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/]|\Z)",
    re.I,
)
SPLIT = re.compile(r"[^a-z0-9]+")
HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    """An element: its children are nodes and pieces of text, in order."""

    __slots__ = ("tag", "parent", "children", "dropped", "doubtful", "article", "inside",
                 "chars", "tags", "link_chars", "link_tags", "density", "sum")

    def __init__(self, tag: str, parent: Node | None, attributes: str = ""):
        self.tag, self.parent, self.children = tag, parent, []
        self.article, self.doubtful = tag in ARTICLES, False
        self.dropped = tag in DROPPED or (bool(attributes) and self._marked(attributes))
        self.inside = parent is not None and (parent.inside or parent.article)
        # a header is the page's unless it is the article's
        self.dropped |= tag == "header" and not self.inside

    def _marked(self, attributes: str) -> bool:
        for found in ATTRIBUTE.finditer(attributes):
            name = found[1].lower()
            value = (found[2] or found[3] or found[4] or "").lower()
            if name == "style":
                if HIDING.search(value):
                    return True
            elif name == "hidden" or name == "aria-hidden":
                if value != "false" and (name == "hidden" or value == "true"):
                    return True
            elif name == "itemprop":
                self.article |= value == "articlebody"
            elif name == "role" and value in ("main", "article"):
                self.article = True
            elif self.tag not in KEEP and (marks := MARKS.intersection(SPLIT.split(value))):
                if not marks <= WEAK:
                    return True
                self.doubtful = True
            elif self.tag == "article" and "comment" in value:
                return True
        return False


def parse(html: str) -> Node:
    """The tree of a page; end tags that are missing or too many do no harm."""
    root = top = Node("html", None)
    at, last = 0, html.rfind(">") + 1  # no tag ends behind the last >
    while found := TAG.search(html, at, last):
        if found.start() > at:
            top.children.append(html[at : found.start()])
        at = found.end()
        name = found["name"]
        if name is None:
            if at == last and found[0].startswith("<!--") and not found[0].endswith("->"):
                at = len(html)
            continue
        name = name.lower()
        if found["end"]:
            node = top
            while node is not root and node.tag != name:
                if name not in BLOCKS and node.tag in BLOCKS:
                    node = root  # inline ends don't reach out of a block
                    break
                node = node.parent
            if node is not root:
                top = node.parent
            continue
        if name in ("html", "body") and any(
            node.tag == name for node in _upward(top)
        ):
            continue
        if name in ENDS_P:
            top = _closed(top, {"p"}, P_SCOPE)
        if name in CLOSES:
            top = _closed(top, *CLOSES[name])
        if name == "body" and top.tag == "head":
            top = top.parent
        node = Node(name, top, found["attributes"])
        top.children.append(node)
        if name in VOID or found["attributes"].endswith("/") and name not in BLOCKS | RAW:
            continue
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>?|\Z", re.I).search(html, at)
            node.children.append(html[at : end.start()])
            at = end.end()
            continue
        top = node
    if at < len(html):
        top.children.append(html[at:].partition("<!--")[0])
    return root


def _upward(node: Node | None) -> Iterator[Node]:
    while node is not None:
        yield node
        node = node.parent


def _closed(top: Node, ends: set[str], scope: frozenset[str] | set[str]) -> Node:
    """The open element after the ends; with several, the outermost ends all."""
    result = top
    for node in _upward(top):
        if node.tag in ends:
            result = node.parent
        elif node.tag in scope:
            break
    return result


def _in_order(root: Node) -> list[Node]:
    """Nodes that are not dropped, parents before children."""
    order, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        order.append(node)
        waiting += [
            c for c in reversed(node.children) if isinstance(c, Node) and not c.dropped
        ]
    return order


def settle(root: Node) -> None:
    """Drops doubtful boxes, but for those with most of the text outside links."""
    order = _in_order(root)
    if not any(node.doubtful for node in order):
        return
    for node in reversed(order):
        node.chars = 0
        if node.tag != "a":
            node.chars = sum(
                len("".join(c.split())) if isinstance(c, str) else 0 if c.dropped else c.chars
                for c in node.children
            )
    for node in order:
        node.dropped |= node.doubtful and 2 * node.chars <= root.chars


def measure(root: Node) -> list[Node]:
    """Sets densities and their sums; returns nodes, parents before children."""
    settle(root)
    order = _in_order(root)
    for node in reversed(order):
        own = sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
        kept = [c for c in node.children if isinstance(c, Node) and not c.dropped]
        node.chars = own + sum(c.chars for c in kept)
        node.tags = len(kept) + sum(c.tags for c in kept)
        node.link_tags = sum(c.link_tags + (c.tag == "a") for c in kept)
        node.link_chars = (
            node.chars if node.tag == "a" else sum(c.link_chars for c in kept)
        )
    body = next((n for n in order if n.tag == "body"), root)
    linked = body.link_chars / max(1, body.chars)
    for node in reversed(order):
        chars = node.chars
        if not chars:
            node.density = node.sum = 0.0
            continue
        links, tags = max(1, node.link_chars), max(1, node.tags)
        plain = max(1, chars - node.link_chars)
        base = math.log(chars / plain * node.link_chars + linked * chars + math.e)
        ratio = chars / links * tags / max(1, node.link_tags)
        adjusted = math.log(max(ratio, 1.0)) / math.log(max(base, 1 + 1e-9) + 1e-9)
        node.density = chars / tags * min(adjusted, 1e3)
        node.sum = sum(
            c.density
            for c in node.children
            if isinstance(c, Node) and not c.dropped and c.tag in BLOCKS
        )
    return order


def select(order: list[Node]) -> list[Node]:
    """Roots of the content: the subtree with the largest sum and what belongs to it.

    What stands beside it and does not belong to it is marked as dropped.
    """
    body = next((n for n in order if n.tag == "body"), order[0])
    best = max(order, key=lambda n: n.sum)
    if best.sum <= 0:
        return [body]
    path = list(_upward(best))
    threshold = min(n.density for n in path[: path.index(body) + 1 if body in path else None])
    article = next((n for n in path if n.article), None)
    if article is None and best is body:
        dense = [n for n in order if n.article and n.density >= threshold]
        article = max(dense, key=lambda n: n.chars, default=None)
    if article is not None:
        _drop_links(article, threshold)
        return [article]
    _drop_links(best, threshold)
    top = body if body in path else path[-1]
    way = set(path[: path.index(top)])
    heading = {"h1", "h2", "h3"}
    for node in path[1 : path.index(top) + 1]:
        for c in node.children:
            if not isinstance(c, Node) or c.dropped or c in way:
                continue
            inline = c.tag not in BLOCKS and c.link_chars <= 0.6 * c.chars
            beside = node is best.parent and c.tag in heading
            if inline or beside or c.chars and c.density >= threshold:
                _drop_links(c, threshold)
            else:
                c.dropped = True
    return [top]


def _drop_links(root: Node, threshold: float) -> None:
    """Inside content, drops lists and boxes that are mostly links and below it."""
    waiting = [root]
    while waiting:
        for child in waiting.pop().children:
            if not isinstance(child, Node) or child.dropped:
                continue
            if (
                child.tag in ("ul", "ol", "div", "table", "section")
                and child.link_chars > 0.6 * child.chars
                and child.density < threshold
            ):
                child.dropped = True
            else:
                waiting.append(child)


def blocks(roots: list[Node]) -> list[str]:
    """Text of the blocks in page order, white space as one blank, none empty."""
    found: list[str] = []
    inline: list[str] = []

    def flush() -> None:
        text = " ".join(entities.unescape("".join(inline)).split())
        if text:
            found.append(text)
        inline.clear()

    waiting: list = list(reversed(roots))
    while waiting:
        item = waiting.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            inline.append(item)
        elif item.tag == "br":
            inline.append(" ")
        elif not item.dropped:
            if item.tag in BLOCKS:
                flush()
                waiting.append(None)
            waiting.extend(reversed(item.children))
    flush()
    return found


def main_text(html: str) -> str:
    root = parse(html)
    return "\n".join(blocks(select(measure(root))))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and its number of code points for every page.

    A null or empty page, or one without text, has the text ''. Broken markup, very
    long pages and equal rows are taken as they are; a row for each row, in the same
    partition. Extra columns are not read.
    """

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) if h else "" for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(over, RESULT)
