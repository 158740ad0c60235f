"""Main text of web pages by composite text density.

The page becomes a tree of elements without those that are never article text. Every node gets its characters per tag,
adjusted by its links: density = C / T x log_b(C / LC x T / LT), b = ln(C / (C - LC) x LC + LCbody / Cbody x C + e), with
C characters, T tags, LC and LT those in links. The node with the largest sum of its children's densities holds the
article; the smallest density on its path to the body is the threshold above which other parts belong to it as well.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
#: Blocks that hold text rather than other blocks; they are not looked at as the place of the article.
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 pre li dt dd td th tr address figcaption legend summary hr".split())
DROPPED = frozenset(
    "script style noscript template iframe object embed svg canvas audio video map head title meta link base nav "
    "footer aside button input select textarea option optgroup datalist output progress meter dialog menu annotation".split()
)
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert status menu menubar form toolbar tablist "
    "tooltip".split()
)
DROPPED_WORDS = frozenset(
    "nav navbar navigation menu submenu sidebar footer masthead banner ad ads adv advert adverts advertisement "
    "advertisements advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice notices notification "
    "alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended "
    "recommendations breadcrumb breadcrumbs pagination pager toolbar widget search skip toc topbar announcement "
    "disclaimer".split()
)
#: Words that say how a part is laid out and not what it is about: beside one of the words above they change nothing.
LAYOUT_WORDS = frozenset(
    "area bar block blocks bottom box boxes btn button buttons center column container content cta desktop fixed float form "
    "group header icon icons inner item items left link links list lists main mobile outer page panel post posts primary "
    "right row secondary section site slot sticky strip text title top unit widgets wrap wrapper zone".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist disqus reply replies respond discussion".split())
#: Elements that a start tag of the key closes when they are open inside the same container.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody"),
}
CONTAINERS = frozenset("ul ol dl table select body html div article section main td th".split())
_STOPS = CONTAINERS - {"body"}


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "chars", "tags", "link_chars", "link_tags", "density", "total", "after", "below")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []


class _Tree(HTMLParser):
    """Builds the tree as leniently as browsers do: ends are implied, stray end tags ignored.

    Open elements are counted by tag, and inline ones above the last open block apart from the others, so an end tag
    that nothing waits for costs nothing, however many elements stay open.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html", {}, None)
        self.open: Counter[str] = Counter()
        self.inline: list[Counter[str]] = [Counter()]  # tags opened since each open block
        self.paragraphs = [0]  # open ones since each open container

    def _push(self, node: Node) -> None:
        self.at = node
        self.open[node.tag] += 1
        if node.tag in _STOPS:
            self.paragraphs.append(0)
        self.paragraphs[-1] += node.tag == "p"
        if node.tag in BLOCKS:
            self.inline.append(Counter())
        else:
            self.inline[-1][node.tag] += 1

    def _pop_to(self, parent: Node) -> None:
        """Close open elements until ``parent`` is the innermost; every element is closed once."""
        while self.at is not parent:
            tag = self.at.tag
            self.open[tag] -= 1
            self.paragraphs[-1] -= tag == "p"
            if tag in _STOPS:
                self.paragraphs.pop()
            if tag in BLOCKS:
                self.inline.pop()
            else:
                self.inline[-1][tag] -= 1
            self.at = self.at.parent

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in ("html", "body") and self.root.attrs.get("_" + tag):
            return
        self.root.attrs["_" + tag] = "1" if tag in ("html", "body") else ""
        if tag == "html":
            return
        if tag in BLOCKS and self.paragraphs[-1]:
            self._close(("p",), _STOPS)
        if tag in CLOSES:
            self._close(CLOSES[tag], CONTAINERS - set(CLOSES[tag]))
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self._push(node)

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)  # the slash means nothing on elements that are not void

    def _close(self, tags: tuple[str, ...], stops) -> None:
        """Close the open elements with these tags up to the nearest container."""
        waiting = sum(self.open[t] for t in tags)
        node, last = self.at, None
        while waiting and node is not None and node.tag not in stops:
            if node.tag in tags:
                last, waiting = node, waiting - 1
            node = node.parent
        if last is not None:
            self._pop_to(last.parent)

    def handle_endtag(self, tag: str) -> None:
        if tag in ("html", "body") or tag in VOID:
            return
        if not (self.open[tag] if tag in BLOCKS else self.inline[-1][tag]):
            return  # nothing to end, or only beyond a block, which an inline end tag does not close
        node = self.at
        while node.tag != tag:
            node = node.parent
        self._pop_to(node.parent)

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str) -> Node:
    """Tree of a page; an unfinished comment or tag at the end of a cut page is no text."""
    html = re.sub(r"<[a-zA-Z/!?][^<>]*\Z", "", html)
    tree = _Tree()
    tree.feed(html)
    if tree.rawdata.startswith("<!--"):  # only the parser knows those in scripts and attributes
        tree.rawdata = ""
    tree.close()
    return tree.root


_WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")


def _names(node: Node) -> list[list[str]]:
    """Words of every class name and of the id. Headings and text blocks are named for what they say, so their ids do not count."""
    names = node.attrs.get("class", "").split()
    if node.tag not in TEXT_BLOCKS:
        names += node.attrs.get("id", "").split()
    return [[name.lower()] if name.isupper() else [w.lower() for w in _WORDS.findall(name) if len(w) > 1] for name in names]


def _called(node: Node, wanted: frozenset[str]) -> bool:
    """Whether a name of the element means one of the wanted words.

    The other words must tell about the layout, or the wanted one comes last: "social-links" and "global-nav" do,
    "social-history" and "has-sidebar" do not. Where other words follow, an element without paragraphs and headings counts.
    """
    for words in _names(node):
        if wanted.isdisjoint(words):
            continue
        if set(words) <= wanted | DROPPED_WORDS | LAYOUT_WORDS or (words[-1] in wanted and words[0] not in _MODIFIERS):
            return True
        if words[0] in wanted and not node.below & _TEXT and node.tag not in TEXT_BLOCKS:
            return True
    return False


def _hidden(attrs: dict[str, str]) -> bool:
    style = attrs.get("style", "").replace(" ", "").lower()
    return "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style


_ARTICLE = frozenset(("article", "main"))
_MAIN = _ARTICLE | {"h1"}
_TEXT = frozenset(("article", "main", "p", "h1", "h2", "h3"))
_MODIFIERS = frozenset("has no with without is not hide show".split())
_HEADER_WORDS = frozenset(("header",))
#: The name of a part of an article, too.
_SECTION_WORDS = frozenset(("discussion",))


def _unwanted(node: Node) -> bool:
    """Whether an element is never part of an article, whatever its name."""
    if node.tag in ("body", "article", "main"):
        return False
    if node.tag in DROPPED or _hidden(node.attrs):
        return True
    role = node.attrs.get("role", "").lower()
    return role in DROPPED_ROLES and (node.tag, role) != ("form", "form")


def _named_away(node: Node, inside: bool, whole: int) -> bool:
    """Whether the name of an element says that it is no part of the article. ``inside``: of an article or main element.

    What holds half of the page's text or more, or its article or heading, is never taken for a menu or a sidebar; the
    text of reader comments does not count for that.
    """
    if node.tag in ("body", "article", "main"):
        return False
    named = "class" in node.attrs or "id" in node.attrs
    if named and _called(node, COMMENT_WORDS) and not (inside and _called(node, _SECTION_WORDS)):
        return True  # readers may well write more than the author
    if 2 * node.chars >= whole and node.below & _TEXT:
        return False
    header = node.tag == "header" or (named and node.tag in ("div", "section", "table") and _called(node, _HEADER_WORDS))
    if header and not inside and not node.below & _ARTICLE:
        return True
    return named and _called(node, DROPPED_WORDS) and not node.below & _MAIN


def _count(nodes: list[Node]) -> None:
    """Characters of every node, and which of the tags that matter lie below it; ``nodes`` come parents first."""
    for node in reversed(nodes):
        node.chars, node.below = 0, frozenset()
        for c in node.children:
            if isinstance(c, str):
                node.chars += len(" ".join(c.split()))
            else:
                node.chars += c.chars
                found = c.below | {c.tag} if c.tag in _TEXT else c.below
                node.below = node.below | found if found - node.below else node.below


def prune(root: Node) -> None:
    """Take unwanted elements out of the tree, and of the forms left those that do not hold the page's text."""
    stack = [root]
    while stack:
        node = stack.pop()
        node.children = [c for c in node.children if isinstance(c, str) or not _unwanted(c)]
        stack += [c for c in node.children if isinstance(c, Node)]
    nodes = _in_order(root)
    _count(nodes)
    stack = [(root, False)]
    while stack:
        node, inside = stack.pop()
        inside = inside or node.tag in ("article", "main")
        node.children = [c for c in node.children if isinstance(c, str) or not _named_away(c, inside, root.chars)]
        stack += [(c, inside) for c in node.children if isinstance(c, Node)]
    nodes = _in_order(root)
    if any(n.tag == "form" for n in nodes):
        _prune_forms(nodes)


def _prune_forms(nodes: list[Node]) -> None:
    """Drop the forms without an article, main or heading that hold less than half of the text."""
    _count(nodes)
    whole = nodes[0].chars
    for node in nodes:
        node.children = [
            c for c in node.children
            if isinstance(c, str) or c.tag != "form" or (c.chars and 2 * c.chars >= whole) or c.below & _MAIN
        ]


def _in_order(root: Node) -> list[Node]:
    """All nodes, parents first."""
    nodes, stack = [], [root]
    while stack:
        node = stack.pop()
        nodes.append(node)
        stack += [c for c in reversed(node.children) if isinstance(c, Node)]
    return nodes


def weigh(body: Node) -> list[Node]:
    """Counts, densities and density sums of every node; the nodes, parents first."""
    nodes = _in_order(body)
    for node in reversed(nodes):
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        for c in node.children:
            if isinstance(c, str):
                node.chars += len(" ".join(c.split()))
            else:
                node.chars += c.chars
                node.tags += c.tags + 1
                node.link_chars += c.link_chars
                node.link_tags += c.link_tags + (c.tag in ("a", "button", "select"))
        if node.tag == "a":
            node.link_chars = node.chars
    share = body.link_chars / max(body.chars, 1)
    for node in nodes:
        c, t, lc, lt = node.chars, max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
        if not c:
            node.density = 0.0
            continue
        base = math.log(c / max(c - node.link_chars, 1) * node.link_chars + share * c + math.e)
        inner = max(c / lc * t / lt, 1.0)
        node.density = c / t * (math.log(inner) / math.log(max(base, 1.0 + 1e-9)) if base > 1.0 else math.log(inner))
    body.after = 0
    for node in nodes:
        after = node.after  # characters of the page behind the node
        for c in reversed(node.children):
            if isinstance(c, str):
                after += len(" ".join(c.split()))
            else:
                c.after = after
                after += c.chars
    for node in nodes:
        node.total = sum(c.density for c in node.children if isinstance(c, Node))
    return nodes


def _is_container(node: Node) -> bool:
    if node.tag in ("td", "th", "li", "dd"):  # cells hold text or lay out a page
        return any(isinstance(c, Node) and c.tag in BLOCKS for c in node.children)
    return node.tag in BLOCKS and node.tag not in TEXT_BLOCKS


_IMPRINT = re.compile(r"\s*(©|\(c\)\s*\d|copyright\b(?=.*?(?:©|\(c\)|\b(?:19|20)\d\d\b)))", re.IGNORECASE | re.DOTALL)


def _plain_text(node: Node) -> str:
    out, stack = [], [node]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            out.append(item)
        else:
            stack += reversed(item.children)
    return "".join(out)


def _marginal(node: Node) -> bool:
    """A block of little but links, or an imprint, on a page that does not mark its article.

    An imprint bears a sign or a year and stands at the end: fewer than 200 characters come after it.
    """
    if node.tag not in BLOCKS or node.tag in ("body", "html"):
        return False
    if node.link_tags >= 2 and 5 * node.link_chars >= 4 * node.chars:
        return True
    if node.chars == node.parent.chars and node.parent.tag in BLOCKS - {"body", "html"} and node.parent.after == node.after:
        return False  # the same text as that of its parent, which was kept
    return node.chars < 200 and node.after < 200 and _IMPRINT.match(_plain_text(node)) is not None


def trim(body: Node) -> None:
    """Take marginal blocks out of a weighed tree."""
    stack = [body]
    while stack:
        node = stack.pop()
        node.children = [c for c in node.children if isinstance(c, str) or not _marginal(c)]
        stack += [c for c in node.children if isinstance(c, Node)]


def _best(nodes: list[Node]) -> Node | None:
    """The container with the largest density sum; loose text counts like a paragraph."""

    def total(node: Node) -> float:
        return node.total + sum(len(" ".join(c.split())) for c in node.children if isinstance(c, str))

    holders = [n for n in nodes if _is_container(n) and n.chars]
    return max(holders, key=total) if holders else None


def main_nodes(body: Node) -> list[Node]:
    """The subtrees that hold the article, in page order."""
    nodes = weigh(body)
    if not any(n.tag in ("article", "main") for n in nodes):
        trim(body)
        nodes = weigh(body)
    best = _best(nodes)
    if best is None:
        return [body]
    path, node = [best], best
    while node is not body and node.parent is not None:
        node = node.parent
        path.append(node)
    for tag in ("article", "main"):
        marked = [n for n in path if n.tag == tag]
        if marked:
            return [marked[-1]]
    threshold = min(n.density for n in path)
    chosen, inside = {id(best)}, {id(n) for n in _in_order(best)}
    holders = {id(n) for n in path}
    kept = []
    for n in nodes:
        if n is best:
            kept.append(n)
        elif id(n) in inside or id(n) in holders or n.parent is None or id(n.parent) not in holders or id(n.parent) in chosen:
            continue
        elif n.tag == "h1" or (n.tag in BLOCKS and n.density >= threshold and n.link_chars * 3 < n.chars):
            kept.append(n)
    return kept


def blocks(nodes: list[Node]) -> list[str]:
    """Texts of the blocks below the nodes in page order, white space made one space, empty ones left out."""
    out: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join("".join(line).split())
        line.clear()
        if text:
            out.append(text)

    for top in nodes:
        stack: list[tuple[Node | str, bool]] = [(top, False)]
        while stack:
            item, ended = stack.pop()
            if isinstance(item, str):
                line.append(item)
            elif ended:
                flush()
            elif item.tag == "br":
                line.append(" ")
            else:
                block = item.tag in BLOCKS
                if block:
                    flush()
                    stack.append((item, True))
                stack += [(c, False) for c in reversed(item.children)]
        flush()
    return out


def main_text(html: str | None) -> str:
    """Text of the article of one page, blocks joined by newlines; the empty text if there is none."""
    if not html:
        return ""
    root = parse(html)
    prune(root)
    body = next((n for n in _in_order(root) if n.tag == "body"), root)
    return "\n".join(blocks(main_nodes(body)))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page. A null or empty page has the empty text; rows are independent."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    slim = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
    return slim.mapInArrow(read, "page_id bigint, url string, text string, n_chars bigint")
