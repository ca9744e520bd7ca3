"""Main text of web pages by composite text density over the DOM (after Sun, Song and Liao, 2011).

Every page is parsed to a tree. Elements that never hold article text (scripts, forms, navigation, page
headers, footers, sidebars, hidden ones, and boxes with a whole class or id that names an advert, a cookie
notice or comments) are cut off first; headings, paragraphs and text-level elements never for their name.
Every node then gets its *composite text density*: characters per tag, raised or lowered by the share of
characters that stand in links, measured against the body's own share. A node's density sum is the sum of its
children's densities. The node with the greatest sum is the article, unless on the path from it to the body a
wider node keeps a density no less than the path's threshold and adds text; what lies beside the chosen
subtree in such a node is kept, if its own density reaches the threshold. Boxes whose name articles use as
well (inside an article and for sections, most names) leave the article only if they do not reach it.

Three rules on elements only add to this. If an ``article`` holds the node with the greatest sum, the
outermost one takes the node's place, so that its short paragraphs stay. Beside the path, headings stay, and
further ``article`` elements. In a ``main`` on the path, so do its paragraphs. Articles and paragraphs with
more than half of their characters in links stay by their density only.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybasket.llm.common import prepare_tasks, single

#: Element names of the HTML standard (fixed values).
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl",
    "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup",
    "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table",
    "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
#: Elements whose opening ends an open paragraph.
ENDS_P = BLOCK - {"body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"}
#: An opening element of these ends an open one of the named kinds, up to the nearest of the limits.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
}
#: Elements without article text.
CUT = {
    "head", "script", "style", "noscript", "template", "iframe", "object", "embed", "svg", "canvas", "nav", "aside", "footer",
    "form", "button", "select", "textarea", "input", "label", "dialog", "menu", "title", "search", "audio", "video", "map",
}
CUT_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "alertdialog", "dialog", "menu", "menubar"}
#: Whole classes and ids, without hyphens and underscores, of boxes that hold something other than the article.
CUT_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsbygoogle", "sponsor", "sponsored", "promo", "promoted", "cookie",
    "cookies", "consent", "gdpr", "popup", "modal", "newsletter", "subscribe", "signup", "login", "nav", "navbar", "navigation", "menu",
    "menubar", "breadcrumb", "breadcrumbs", "pagination", "pager", "sidebar", "sidenav", "footer", "masthead", "topbar", "toolbar",
    "comment", "comments", "commentlist", "disqus", "disqusthread", "respond", "replies", "outbrain", "taboola",
} | {
    first + second
    for firsts, seconds in (
        (("ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo"), ("banner", "block", "box", "container", "slot", "unit", "wrapper")),
        (("cookie", "cookies", "consent", "gdpr"), ("banner", "bar", "box", "consent", "message", "modal", "notice", "overlay", "popup", "wrapper")),
        (("newsletter", "subscribe", "signup", "login"), ("banner", "box", "form", "modal", "popup", "wrapper")),
        (("main", "nav", "page", "primary", "secondary", "side", "site", "top"), ("menu", "nav", "navbar", "navigation")),
        (("nav", "navbar", "navigation", "menu", "sidebar"), ("bar", "container", "left", "list", "right", "wrapper")),
        (("page", "site"), ("banner", "footer", "masthead")),
        (("comment", "comments"), ("area", "box", "container", "form", "list", "respond", "section", "thread", "wrapper")),
        (("related", "recommended"), ("articles", "links", "news", "posts", "stories")),
        (("share", "sharing", "social"), ("bar", "box", "buttons", "icons", "links")),
    )
    for second in seconds
    for first in firsts
}
#: Names that articles use as well: such a box stays if its density reaches the path's threshold.
DOUBTFUL_NAMES = {
    "alert", "aside", "banner", "copyright", "disclaimer", "foot", "hidden", "notice", "notices", "notification", "overlay", "promotion",
    "recommendations", "recommended", "related", "reply", "search", "share", "sharing", "skip", "social", "subscription", "tags", "widget", "widgets",
}
#: Of these, names that an article inside does not clear; others may stand on a page's outer box.
NEVER_ARTICLE = {n for n in CUT_NAMES if n.startswith(("comment", "disqus", "related", "recommended"))} | {"respond", "replies"}
#: Of the cut names, those that are cut inside an article and from sections as well; the others are doubtful there.
SURE_NAMES = NEVER_ARTICLE | {n for n in CUT_NAMES if n.startswith(("ad", "sponsored", "promo", "outbrain", "taboola"))} - {"advertising"}
#: Of the doubtful names, those that stay doubtful on an article and around one.
TEASER_NAMES = {"recommendations", "recommended", "related", "reply"}
#: Blocks of text, to which names do not apply; nor do they to elements that are no blocks.
TEXT_BLOCKS = {
    "blockquote", "body", "caption", "dd", "dt", "figcaption", "h1", "h2", "h3", "h4", "h5", "h6", "hgroup", "html", "legend", "p", "pre", "summary",
}
ARTICLE = {"article", "main"}
_GAP = r"[ \t\n\r\f]*"
_NAME = r"[^ \t\n\r\f/>][^ \t\n\r\f/>=]*"
#: Quotes delimit a value directly after "=" only; other values may hold quotes, and so does one whose quote is never closed.
_VALUE = r"""(?>"[^"]*"|'[^']*'|[^ \t\n\r\f>]*)"""
ATTRIBUTE = re.compile(f"({_NAME})(?:{_GAP}={_GAP}({_VALUE}))?")
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^ \t\n\r\f/>]*)"
    rf"((?>[ \t\n\r\f/]+|{_NAME}(?:{_GAP}={_GAP}{_VALUE})?)*+)>",
    re.DOTALL,
)
SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("name", "parent", "children", "chars", "link_chars", "tags", "link_tags", "density", "total", "cut", "by_name", "doubtful", "teaser", "cleared")

    def __init__(self, name: str, parent: Node | None, cut: bool = False, by_name: bool = False):
        self.name, self.parent, self.cut, self.by_name = name, parent, cut, by_name
        self.doubtful = self.teaser = self.cleared = False
        self.children: list[Node | str] = []


def _attributes(text: str) -> dict[str, str]:
    """Attributes of a tag by lower-case name, the first of each name."""
    out: dict[str, str] = {}
    for key, value in ATTRIBUTE.findall(text):
        quoted = len(value) > 1 and value[0] in "\"'" and value[-1] == value[0]
        out.setdefault(key.lower(), html.unescape(value[1:-1] if quoted else value))
    return out


def _said_away(attributes: dict[str, str]) -> bool:
    """Whether an element is hidden or has a role beside the article."""
    if "hidden" in attributes or attributes.get("aria-hidden", "").strip().lower() == "true":
        return True
    return attributes.get("role", "").strip().lower() in CUT_ROLES


def _names(name: str, attributes: dict[str, str]) -> set[str]:
    """Classes and id of a box, whole, without hyphens and underscores."""
    if name in TEXT_BLOCKS or name not in BLOCK and "-" not in name:
        return set()
    return {t.replace("-", "").replace("_", "").lower() for key in ("class", "id") for t in attributes.get(key, "").split()}


def _next_tag(page: str, at: int, last: int) -> re.Match | None:
    """The next tag or comment. Beyond ``last``, the place of the last ">", nothing but a comment without an end is one."""
    while True:
        start = page.find("<", at)
        if start > last:
            start = page.find("<!--", start)
        if start < 0:
            return None
        found = TAG.match(page, start)
        if found:
            return found
        at = start + 1


def parse(page: str) -> Node:
    """Tree of the page; unclosed and stray tags are forgiven, texts keep their character references.

    How many elements of each name are open is counted, so that no tag looks for an open element up to the root in vain.
    """
    root = node = Node("html", None)
    opened: Counter[str] = Counter()
    last = page.rfind(">")

    def leave(node: Node, until: Node) -> Node:
        while node is not until:
            opened[node.name] -= 1
            node = node.parent
        return until

    at = 0
    while True:
        found = _next_tag(page, at, last)
        if found is None:
            # A tag that the page's end cuts short is no text.
            rest = page[at:]
            cut_short = re.compile(r"<[/!a-zA-Z]").search(rest, rest.rfind(">") + 1)
            rest = rest[: cut_short.start()] if cut_short else rest
            if rest:
                node.children.append(rest)
            return root
        if found.start() > at:
            node.children.append(page[at : found.start()])
        at = found.end()
        name = (found[2] or "").lower()
        if not name or name in ("html", "!doctype"):
            continue
        if found[1]:
            node = leave(node, _close(node, name)) if opened[name] else node
            continue
        if name in ENDS_P and opened["p"]:
            node = leave(node, _close(node, "p", {"button", "td", "th", "caption", "table"}, forgiving=False))
        if name in SIBLINGS:
            kinds, limits = SIBLINGS[name]
            probe = kept = node
            while any(opened[k] for k in kinds) and probe is not None and probe.name not in limits:
                if probe.name in kinds:
                    kept = probe.parent
                probe = probe.parent
            node = leave(node, kept)
        inside = any(opened[x] for x in ARTICLE) if name == "header" else True
        attributes = _attributes(found[3]) if found[3].strip() else {}
        own_names = _names(name, attributes)
        said = name != "body" and _said_away(attributes)
        if name in ARTICLE:
            sure, doubtful = NEVER_ARTICLE, TEASER_NAMES
        elif own_names and (name == "section" or opened["article"]):
            sure, doubtful = SURE_NAMES, DOUBTFUL_NAMES | CUT_NAMES
        else:
            sure, doubtful = CUT_NAMES, DOUBTFUL_NAMES
        by_name = said or bool(own_names & sure)
        if name in ARTICLE and not by_name:
            for outer in _up(node):
                if outer.cleared:
                    break
                outer.cut = outer.cut and not outer.by_name
                outer.doubtful = outer.doubtful and outer.teaser
                outer.cleared = True
        kept_name = by_name and not said and not own_names & NEVER_ARTICLE
        child = Node(name, node, name in CUT or not inside or by_name, kept_name and name not in CUT)
        child.doubtful, child.teaser = bool(own_names & doubtful), bool(own_names & TEASER_NAMES)
        node.children.append(child)
        if name in VOID or found[3].endswith("/") and name in ("svg", "path"):
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(page, at)
            child.cut = True
            at = end.end() if end else len(page)
            continue
        node = child
        opened[name] += 1


def _up(node: Node | None) -> Iterator[Node]:
    while node is not None:
        yield node
        node = node.parent


def _close(node: Node, name: str, limits: set[str] = frozenset(), forgiving: bool = True) -> Node:
    """The parent of the nearest open element of that name; ``node`` itself if there is none.

    An end tag of an inline element does not reach beyond the block it stands in.
    """
    for open_one in _up(node):
        if open_one.name == name and open_one.parent is not None:
            return open_one.parent
        if open_one.name in limits or forgiving and name not in BLOCK and open_one.name in BLOCK:
            break
    return node


def _order(root: Node) -> list[Node]:
    """Nodes that are not cut off, each before its children."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if not node.cut:
            out.append(node)
            stack.extend(c for c in node.children if not isinstance(c, str))
    return out


def _measure(root: Node) -> list[Node]:
    nodes = _order(root)
    for node in reversed(nodes):
        chars = sum(len(SPACE.sub("", html.unescape(c))) for c in node.children if isinstance(c, str))
        kids = [c for c in node.children if not isinstance(c, str) and not c.cut]
        node.chars = chars + sum(c.chars for c in kids)
        node.tags = len(kids) + sum(c.tags for c in kids)
        node.link_chars = node.chars if node.name == "a" else sum(c.link_chars for c in kids)
        node.link_tags = sum(c.link_tags + (c.name == "a") for c in kids)
    body = nodes[0]
    share = body.link_chars / body.chars if body.chars else 0.0
    for node in nodes:
        node.density = _density(node, share)
    for node in nodes:
        node.total = sum(c.density for c in node.children if not isinstance(c, str) and not c.cut)
    return nodes


def _density(node: Node, body_share: float) -> float:
    """Characters per tag, adjusted by the characters and tags of links.

    The published formula, with 1 added inside the first logarithm and e - 1 inside the second, which keep both positive where
    a node has few characters; a count of zero tags or link characters counts as one.
    """
    c, lc, t, lt = node.chars, node.link_chars, max(node.tags, 1), max(node.link_tags, 1)
    if not c:
        return 0.0
    base = math.log(c / max(c - lc, 1) * lc + body_share * c + math.e)
    return c / t * math.log(c / max(lc, 1) * (t / lt) + 1) / math.log(base + math.e - 1)


def _blocks(node: Node, out: list[list[str]]) -> None:
    """Text of the subtree, one list of pieces for each block."""
    stack: list[tuple[Node | str, bool]] = [(node, False)]
    while stack:
        item, leaving = stack.pop()
        if isinstance(item, str):
            out[-1].append(item)
        elif leaving:
            out.append([])
        elif not item.cut:
            if item.name == "br":
                out[-1].append(" ")
            elif item.name in BLOCK:
                out.append([])
                stack.append((item, True))
            stack.extend((c, False) for c in reversed(item.children))


def _belongs(node: Node, in_main: bool) -> bool:
    """Whether a part beside the path is kept for its element alone."""
    if node.name[0] == "h" and node.name[1:].isdigit():
        return True
    return (node.name == "article" or node.name == "p" and in_main) and 2 * node.link_chars <= node.chars


def _outer_article(node: Node, top: Node) -> bool:
    """Whether an element below ``top`` is kept as a further article, and lies in no other one there."""
    if node is top or not _belongs(node, False) or node.name != "article":
        return False
    for outer in _up(node.parent):
        if outer is top:
            return True
        if outer.name == "article":
            return False
    return False


def main_text(page: str) -> str:
    """Blocks of the article, in page order, joined by one newline; empty if there is none."""
    if not page:
        return ""
    root = parse(page)
    body = next((n for n in _order(root) if n.name == "body"), root)
    nodes = _measure(body)
    chosen = max(nodes, key=lambda n: n.total)
    if not chosen.total:
        chosen = body
    # The article may be split over siblings: all of the path is searched for parts about as dense as the path.
    path = [chosen]
    while path[-1] is not body:
        path.append(path[-1].parent)
    threshold = min(n.density for n in path)
    # Short paragraphs beside the densest one belong to its article element.
    chosen = next((n for n in reversed(path) if n.name == "article"), chosen)
    keep: list[Node | str] = []
    on_path = set(map(id, path))
    for node in nodes:
        node.cut = node.doubtful and node.density < threshold and id(node) not in on_path
    in_main: set[int] = set()

    stack: list[Node | str] = [body]
    while stack:
        part = stack.pop()
        if isinstance(part, str) or part is chosen or id(part) not in on_path:
            keep.append(part)
            continue
        if part.name == "main" or id(part.parent) in in_main:
            in_main.add(id(part))
        for child in reversed(part.children):
            if isinstance(child, str) or id(child) in on_path:
                stack.append(child)
            elif not child.cut:
                if child.density >= threshold or _belongs(child, id(part) in in_main):
                    stack.append(child)
                else:
                    stack.extend(n for n in reversed(_order(child)) if _outer_article(n, child))
    out: list[list[str]] = [[]]
    for part in keep:
        if isinstance(part, str):
            out[-1].append(part)
        else:
            _blocks(part, out)
    lines = (SPACE.sub(" ", html.unescape("".join(pieces))).strip() for pieces in out)
    return "\n".join(line for line in lines if line)


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (code points) of every row of ``pages``.

    Null or empty html gives an empty text. Character references are decoded once, white space in a block
    becomes one space. Rows that repeat give repeated rows, null ids and urls stay null, an empty table gives
    an empty result, other columns are ignored. Pages of any length are parsed whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in single(batch.column("html"))]
            # A reference to a lone surrogate or to no character has no place in UTF-8.
            texts = [t.encode("utf-8", "replace").decode("utf-8") for t in texts]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())]
            columns.append(pa.array(map(len, texts), pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    prepare_tasks(pages.sparkSession)
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
