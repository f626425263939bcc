"""Main text of web pages by composite text density.

Every node of a page has a density: its characters per tag, scaled down by the share of them that are links. A node's
density sum adds the densities of its children; the node with the largest sum holds the article. The smallest density
on the path from there up to the body is the threshold for what else counts: below every node that reaches it, the
subtree of largest sum is taken too. An `article` or `main` element around the best node is taken as a whole.

Elements that are never text (scripts, forms, navigation, asides, footers, comments, adverts and the like, by tag, role
or name) are left out before any density is computed. What is left out by form, name or role must hold neither an
`article` or `main` element nor more than half of the page's text outside links; a form that does loses its controls
only. Names like `has-sidebar` or `comments-open` say what a page has and are no names of an element. An article named
a comment is one; comments that hold articles are left out if the page has an article outside of them. A header keeps
its headings if it belongs to the article.

Blocks are the texts between block-level borders; white space in a block becomes one space, blocks are joined by an
empty line. Defined cases: missing or empty html and pages without text have an empty text; unclosed and misnested tags
are repaired as browsers do for paragraphs, list items and table cells; other columns pass through `with_main_text`.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from aeropanel.llm import texts

# fixed values: element names of the HTML standard
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody "
    "td tfoot th thead tr ul".split())
ENDS_PARAGRAPH = BLOCKS - set("body caption dd dt html legend li optgroup option tbody td tfoot th thead tr".split()) | {"dd", "dt", "li"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# fixed values: an element of the first kind ends an open one of the second, up to an element of the third
IMPLIED_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead"}, {"table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"})}
# fixed values: what is never part of an article, by tag, by role, and by a word of class or id
DROPPED_TAGS = set(
    "annotation annotation-xml applet aside audio button canvas dialog embed footer frame frameset head iframe input map menu nav noframes noscript "
    "object script search select style svg template textarea title video".split())
DROPPED_ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
DROPPED_NAMES = set(
    "ad ads adbox advert adverts advertisement advertising banner breadcrumb breadcrumbs consent cookie cookies footer gdpr login "
    "masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promoted promotion "
    "recommended related share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget widgets".split())
COMMENT_NAMES = set("comment comments commentlist discussion disqus replies reply respond".split())
FORM_CONTROLS = {"label", "datalist", "output"}
# fixed values: names that say what a page has
STATE_NAMES = re.compile(r"(has|have|with|without|no)[-_].+|.+[-_](open|opened|closed|enabled|disabled|allowed)", re.I)
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
MOST_DEPTH = 400


class Node:
    __slots__ = ("tag", "names", "role", "hidden", "parent", "children", "chars", "tags", "link_chars", "links", "density", "sum")

    def __init__(self, tag: str, attributes: dict[str, str | None], parent: Node | None):
        self.tag, self.parent = tag, parent
        self.children: list[Node | str] = []
        told = f"{attributes.get('class') or ''} {attributes.get('id') or ''}"
        told = " ".join(name for name in told.split() if not STATE_NAMES.fullmatch(name))
        self.names = {w.lower() for w in NAME_PARTS.findall(told)}
        self.role = (attributes.get("role") or "").lower()
        self.hidden = "hidden" in attributes or attributes.get("aria-hidden") == "true"
        self.density = self.sum = 0.0


class TreeBuilder(HTMLParser):
    """Builds the tree of a page; the last open element is `at`."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html", {}, None)
        self.depth = 0

    def _close(self, tags: set[str], limits: set[str]) -> None:
        """Closes the nearest open element of `tags` that no element of `limits` encloses."""
        node = self.at
        while node.parent is not None and node.tag not in limits:
            if node.tag in tags:
                self._leave(node)
                return
            node = node.parent

    def _leave(self, node: Node) -> None:
        while self.at is not node:
            self.at, self.depth = self.at.parent, self.depth - 1
        self.at, self.depth = node.parent, self.depth - 1

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "html":
            return
        if tag in ENDS_PARAGRAPH:
            self._close({"p"}, {"table", "td", "th", "caption", "button", "object"})
        if tag in IMPLIED_ENDS:
            self._close(*IMPLIED_ENDS[tag])
        node = Node(tag, dict(attrs), self.at)
        self.at.children.append(node)
        # deeper elements become neighbours, so that no page can exhaust the stack
        if tag not in VOID and self.depth < MOST_DEPTH:
            self.at, self.depth = node, self.depth + 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        while node.parent is not None:
            if node.tag == tag:
                self._leave(node)
                return
            if tag not in BLOCKS and node.tag in BLOCKS:
                return
            node = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str) -> Node:
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    return builder.root


def _holds(node: Node, tags: set[str]) -> bool:
    return any(isinstance(c, Node) and (c.tag in tags or _holds(c, tags)) for c in node.children)


def _holds_article(node: Node) -> bool:
    """Whether an article or main is in the node, or is it, that no element up to the node names a comment."""
    if node.tag in ("article", "main"):
        return True
    return any(isinstance(c, Node) and not c.names & COMMENT_NAMES and _holds_article(c) for c in node.children)


def _words(node: Node) -> int:
    """Sets and returns `chars`, here the characters outside links and what is never text."""
    node.chars = 0
    for child in node.children:
        if isinstance(child, str):
            node.chars += len("".join(child.split()))
        elif child.tag in DROPPED_TAGS or child.tag == "a" or child.hidden:
            child.chars = 0
        else:
            node.chars += _words(child)
    return node.chars


def _is_dropped(node: Node, in_article: bool, in_form: bool, page: Node, has_article: bool) -> bool:
    if node.tag in DROPPED_TAGS or node.hidden and node.tag != "body":
        return True
    if node.tag in ("html", "body", "main"):
        return False
    if node.names & COMMENT_NAMES:
        return in_article or has_article or node.tag == "article" or not _holds_article(node)
    told = node.tag == "form" or in_form and node.tag in FORM_CONTROLS or node.role in DROPPED_ROLES
    if not told and (node.tag == "article" or not node.names & DROPPED_NAMES):
        return False
    return node.tag != "article" and not _holds(node, {"article", "main"}) and 2 * node.chars <= page.chars


def prune(page: Node) -> None:
    """Takes out what is never part of an article."""
    has_article = _holds_article(page)
    _words(page)
    _prune(page, False, False, page, has_article)


def _prune(node: Node, in_article: bool, in_form: bool, page: Node, has_article: bool) -> None:
    kept: list[Node | str] = []
    for child in node.children:
        if isinstance(child, str):
            kept.append(child)
        elif not _is_dropped(child, in_article, in_form, page, has_article):
            inside = in_article or child.tag in ("article", "main")
            _prune(child, inside, in_form or child.tag == "form", page, has_article)
            if child.tag == "header" and not _holds(child, {"article", "main"}):
                child.children = _headings(child) if inside else []
            kept.append(child)
    node.children = kept


def _headings(node: Node) -> list[Node | str]:
    found: list[Node | str] = []
    for child in node.children:
        if isinstance(child, Node):
            found.extend([child] if child.tag in HEADINGS else _headings(child))
    return found


def measure(node: Node, in_link: bool = False) -> None:
    """Characters, tags, link characters and links of every subtree."""
    in_link = in_link or node.tag == "a"
    node.chars = node.tags = node.link_chars = node.links = 0
    for child in node.children:
        if isinstance(child, str):
            n = len("".join(child.split()))
            node.chars += n
            node.link_chars += n * in_link
        else:
            measure(child, in_link)
            node.chars += child.chars
            node.tags += child.tags + 1
            node.link_chars += child.link_chars
            node.links += child.links + (child.tag == "a")


def set_densities(node: Node, body: Node) -> None:
    """Composite density of every node, and the sum over its children, its own text being one of them."""
    if node.chars:
        tags, links = max(node.tags, 1), max(node.links, 1)
        link_chars, other = max(node.link_chars, 1), max(node.chars - node.link_chars, 1)
        base = math.log(node.chars / other * node.link_chars + body.link_chars / body.chars * node.chars + math.e)
        scale = math.log(base) if base > 1 + 1e-9 else 1.0
        node.density = node.chars / tags * max(0.0, math.log(max(1.0, node.chars / link_chars * tags / links))) / scale
    own = 0
    for child in node.children:
        if isinstance(child, Node):
            set_densities(child, body)
            node.sum += child.density
        else:
            own += len("".join(child.split()))
    if node.tag != "a":
        node.sum += own


def _best(node: Node) -> Node:
    """The node of largest density sum in a subtree, the first of equal ones."""
    best = node
    for child in node.children:
        if isinstance(child, Node) and (found := _best(child)).sum > best.sum:
            best = found
    return best


def _take(node: Node, threshold: float, taken: set[int]) -> None:
    """Marks, below every node that reaches the threshold, the subtree of largest sum."""
    if node.density < threshold:
        return
    taken.add(id(_best(node)))
    for child in node.children:
        if isinstance(child, Node):
            _take(child, threshold, taken)


def _article_around(node: Node) -> Node:
    around, up = node, node
    while up is not None:
        if up.tag in ("article", "main"):
            around = up
            break
        up = up.parent
    return around


def blocks(node: Node, taken: set[int] | None = None) -> list[str]:
    """Texts of the blocks in page order; with `taken`, only of these subtrees and of the page's main heading."""
    found: list[list[str]] = [[]]

    def walk(at: Node, inside: bool) -> None:
        inside = inside or taken is None or id(at) in taken or at.tag == "h1"
        is_block = at.tag in BLOCKS
        if is_block:
            found.append([])
        for child in at.children:
            if isinstance(child, Node):
                if child.tag == "br" and inside:
                    found[-1].append(" ")
                walk(child, inside)
            elif inside:
                found[-1].append(child)
        if is_block:
            found.append([])

    walk(node, False)
    joined = (" ".join("".join(parts).split()) for parts in found)
    return [text for text in joined if text]


def main_text(html: str | None) -> str:
    """The article of a page."""
    root = parse(html or "")
    body = next((c for c in root.children if isinstance(c, Node) and c.tag == "body"), root)
    if body is not root and any(isinstance(c, str) and c.strip() or isinstance(c, Node) and c.tag in BLOCKS and c is not body
                                for c in root.children):
        body = root
    prune(body)
    measure(body)
    if not body.chars:
        return ""
    set_densities(body, body)
    best = _best(body)
    around = _article_around(best)
    if around is not best or best.tag in ("article", "main"):
        return "\n\n".join(blocks(around))
    threshold, up = best.density, best
    while up is not body and up.parent is not None:
        up = up.parent
        threshold = min(threshold, up.density)
    taken = {id(best)}
    _take(body, threshold, taken)
    return "\n\n".join(blocks(body, taken))


def with_main_text(pages: DataFrame, name: str = "text") -> DataFrame:
    """Adds the main text of `html`."""
    kept = pages.drop(name)

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([main_text(html) for html in batch.column("html").to_pylist()], pa.string())
            yield pa.record_batch([*batch.columns, found], names=[*batch.schema.names, name])

    return texts.map_batches(kept, extracted, f"{texts.ddl(kept)}, `{name}` string")
