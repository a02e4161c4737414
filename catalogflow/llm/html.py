"""Main text of web pages (composite text density).

Every element gets a density: its characters per tag, lowered by the share of its text that is
links. The densities of an element's children add up to its density sum. The element with the
largest sum is the core of the page; the smallest density on the path from it to the body is the
threshold above which text belongs to the content. On a page without article or main only elements beside
the core that hold nothing but links are held against it; other text there, also text that stands directly in
an element around the core, is content.
"""

from __future__ import annotations

import html as _html
import math
import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Element names of HTML by their part in a page.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
_CHROME = frozenset("head nav footer aside form button select script style textarea title iframe noembed noframes noscript template svg math menu dialog object video audio canvas".split())
_BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
# an element that begins ends open elements of these names, as far up as the bound
_ENDS = {
    "li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")),
    "th": ("td th", ("tr", "table")), "tbody": ("tbody thead tfoot tr td th", ("table",)), "tfoot": ("tbody thead tr td th", ("table",)), "option": ("option", ("select",)),
}
_ENDS = {name: (frozenset(ended.split()), frozenset(bound)) for name, (ended, bound) in _ENDS.items()}
_ENDS_P = _BLOCK - {"br", "body", "html", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "legend", "option", "optgroup"}
_P = frozenset("p")
_P_BOUND = frozenset("table td th caption button object body html".split())
# Tokens of class, id and role attributes that mark what is not the article, and words that do so as the first or last part of
# a token too, unless the token says that they are absent or next to it.
_CHROME_TOKENS = frozenset(
    "ad ads adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments comment-list commentlist cookie cookies cookie-notice consent disqus "
    "footer gdpr masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promotion related related-posts related-articles replies reply respond "
    "search search-form searchform share share-buttons sharing sidebar side-bar skip skip-link social social-links sponsor sponsored sponsors subscribe toolbar widget complementary contentinfo".split()
)
_CHROME_PARTS = frozenset("ads advert adverts advertisement breadcrumb breadcrumbs comments cookie cookies footer menu nav navbar navigation newsletter pagination popup sidebar".split())
_ABSENT = frozenset("no not without has with hide".split())
_REMARKS = frozenset("comment comments comment-list commentlist disqus replies reply respond".split())

_TOKEN = re.compile(r"<(?:!--(?:.*?)(?:--!?>|\Z)|([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)|/([A-Za-z][^\s/>]*)[^>]*(?:>|\Z)|[!?/][^>]*(?:>|\Z))", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"[ \t\n\r\f\v]+")


class Node:
    __slots__ = ("name", "parent", "parts", "chrome", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, name: str, parent: Node | None, chrome: bool = False):
        self.name, self.parent, self.chrome = name, parent, chrome
        self.parts: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _marks(value: str) -> str | None:
    """The token of an attribute that marks what is not the article."""
    for token in value.lower().split():
        if token in _CHROME_TOKENS:
            return token
        parts = re.split("[-_]+", token.strip("-_"))
        if len(parts) > 1 and parts[0] not in _ABSENT and (parts[0] in _CHROME_PARTS or parts[-1] in _CHROME_PARTS):
            return token
    return None


def _chrome_of(name: str, attributes: str, in_article: bool) -> str:
    """Why an element is not the article: ``always``; ``wrapper`` or ``remarks`` if it may still turn out to hold it; blank if it is none."""
    if name in _CHROME:
        return "wrapper" if name == "form" else "always"
    if name == "header":
        return "" if in_article else "always"
    if not attributes or name in ("article", "main", "body", "html"):
        return ""
    why = ""
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return "always"
        if key in ("class", "id", "role") and (token := _marks(value)):
            why = "remarks" if token in _REMARKS or token.startswith("comments") or token.endswith("comments") else why or "wrapper"
    return why


class _Tree:
    """The tree while it is read, with the number of open elements by name, so that a search upwards is made only if it finds something."""

    def __init__(self) -> None:
        self.root = self.now = Node("html", None)
        self.open: dict[str, int] = {}
        self.doubtful: list[tuple[Node, str]] = []  # left out for now
        self.marked = False

    def up_to(self, node: Node) -> None:
        """Close what is open below ``node``."""
        while self.now is not node:
            self.open[self.now.name] -= 1
            self.now = self.now.parent

    def add(self, name: str, attributes: str) -> Node:
        why = _chrome_of(name, attributes, bool(self.open.get("article") or self.open.get("main")))
        node = Node(name, self.now, bool(why))
        self.now.parts.append(node)
        if why in ("wrapper", "remarks"):
            self.doubtful.append((node, why))
        self.marked |= name in ("article", "main")
        return node

    def enter(self, node: Node) -> None:
        self.now = node
        self.open[node.name] = self.open.get(node.name, 0) + 1

    def close(self, names: frozenset, bound: frozenset) -> None:
        """Close the innermost open element of ``names`` that is not beyond one of ``bound``."""
        if not any(self.open.get(n) for n in names):
            return
        node = self.now
        while node.parent is not None and node.name not in bound:
            if node.name in names:
                return self.up_to(node.parent)
            node = node.parent

    def end(self, name: str) -> None:
        if not self.open.get(name):
            return
        node = self.now
        while node.name != name:
            node = node.parent
        self.up_to(node.parent)


def parse(page: str) -> Node:
    """The element tree of a page; unclosed, crossed and stray tags are repaired as browsers do in the common cases."""
    tree = _Tree()
    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if not m:
            tree.now.parts.append(page[at:])
            break
        if m.start() > at:
            tree.now.parts.append(page[at : m.start()])
        at = m.end()
        name = m[1]
        if name:
            name = name.lower()
            if name == "html":
                continue
            if name == "body":
                if tree.now.name not in ("html", "body"):
                    tree.up_to(tree.root)
                tree.now.parts.append(body := Node("body", tree.now))
                tree.enter(body)
                continue
            if name in _ENDS_P:
                tree.close(_P, _P_BOUND)
            if name in _ENDS:
                tree.close(*_ENDS[name])
            if tree.now.name == "head" and name in _BLOCK:
                tree.up_to(tree.now.parent)
            node = tree.add(name, m[2])
            if name in _RAW and not m[2].rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at)
                at = end.end() if end else size
            elif name not in _VOID and not (m[2].endswith("/") and name not in _BLOCK):
                tree.enter(node)
        elif m[3]:
            tree.end(m[3].lower())
    _restore(tree)
    return tree.root


def _restore(tree: _Tree) -> None:
    """Take back marks of elements that hold the article: an article or main element or, on a page without one, most of the page's text.

    Reader comments can be longer than what they are about, so they are taken back only for an article or main element inside.
    """
    if not tree.doubtful:
        return
    order, waiting, held, chars = [], [tree.root], {}, {}
    while waiting:
        node = waiting.pop()
        order.append(node)
        waiting += [x for x in node.parts if isinstance(x, Node) and x.name not in _RAW]
    for node in reversed(order):
        inner = [x for x in node.parts if isinstance(x, Node) and id(x) in held]
        held[id(node)] = node.name in ("article", "main") or any(held[id(x)] for x in inner)
        chars[id(node)] = sum(len(_SPACE.sub(" ", x).strip()) for x in node.parts if isinstance(x, str)) + sum(chars[id(x)] for x in inner)
    for node, why in tree.doubtful:
        if held.get(id(node)) or not tree.marked and why == "wrapper" and 2 * chars.get(id(node), 0) > chars[id(tree.root)]:
            node.chrome = False


def _ordered(root: Node) -> list[Node]:
    """Elements outside the chrome, each after its parent."""
    out, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        if not node.chrome:
            out.append(node)
            waiting += [x for x in node.parts if isinstance(x, Node)]
    return out


def measure(root: Node) -> list[Node]:
    """Fill in counts, densities and density sums of all elements outside the chrome."""
    nodes = _ordered(root)
    for node in reversed(nodes):
        for part in node.parts:
            if isinstance(part, str):
                node.chars += len(_SPACE.sub(" ", part).strip())
            elif not part.chrome:
                node.chars += part.chars
                node.tags += 1 + part.tags
                node.link_chars += part.link_chars
                node.link_tags += part.link_tags
        if node.name == "a":
            node.link_chars, node.link_tags = node.chars, 1 + node.tags
    top = nodes[0]
    share = top.link_chars / top.chars if top.chars else 0.0
    for node in nodes:
        node.density = _density(node, share)
    for node in nodes:
        node.total = sum(x.density for x in node.parts if isinstance(x, Node) and not x.chrome)
    return nodes


def _density(node: Node, share: float) -> float:
    """Characters per tag times a logarithm that falls as links take up more of the text and tags."""
    if not node.chars:
        return 0.0
    tags = node.tags or 1
    plain = node.chars - node.link_chars
    base = math.log(node.chars / max(plain, 1) * node.link_chars + share * node.chars + math.e)
    worth = node.chars / max(node.link_chars, 1) * tags / max(node.link_tags, 1)
    return node.chars / tags * math.log(max(worth, 1.0)) / math.log(max(base, math.e))


def _lines(node: Node, inside: set[int], share: float) -> list[Node]:
    """Children of an element outside the chrome; text and inline elements between blocks make one node with a density of its own."""
    out: list[Node] = []
    line = None
    for part in node.parts:
        if isinstance(part, Node) and (id(part) in inside or part.name in _BLOCK):
            line = None
            if not part.chrome:
                out.append(part)
        elif isinstance(part, str) or not part.chrome:
            if line is None:
                out.append(line := Node("span", node))
            line.parts.append(part)
            if isinstance(part, str):
                line.chars += len(_SPACE.sub(" ", part).strip())
            else:
                line.chars, line.tags = line.chars + part.chars, line.tags + 1 + part.tags
                line.link_chars, line.link_tags = line.link_chars + part.link_chars, line.link_tags + part.link_tags
            line.density = _density(line, share)
    return out


def _has_words(node: Node) -> bool:
    """Whether there are words outside links and chrome."""
    waiting: list = [node]
    while waiting:
        part = waiting.pop()
        if isinstance(part, str):
            if re.search(r"\w", _html.unescape(part)):
                return True
        elif not part.chrome and part.name != "a":
            waiting += part.parts
    return False


def select(root: Node) -> list[Node]:
    """The subtrees that make up the main text, in page order."""
    nodes = measure(root)
    # of equal sums the first in page order, which is the outer one of nested elements
    core = max(nodes, key=lambda n: n.total)
    if not core.total:
        core = max(nodes, key=lambda n: n.density)
    path = [core]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    for node in path:
        if node.name in ("article", "main"):
            core = node
    marked = core.name in ("article", "main")
    while not marked and core.name not in _BLOCK and core.parent is not None:
        core = core.parent  # a core amid a line of text has the whole line
    threshold = min((n.density for n in path if n.name not in ("html",)), default=0.0)
    share = nodes[0].link_chars / nodes[0].chars if nodes[0].chars else 0.0
    chosen, waiting = [], [nodes[0]]
    inside = set(map(id, path))
    while waiting:
        node = waiting.pop()
        if node is core:
            chosen.append(node)
        elif id(node) in inside:
            # beside the core: what is as dense as the thinnest element around it; with no article marked, whatever has words outside links
            waiting += [x for x in reversed(_lines(node, inside, share)) if id(x) in inside or x.chars and x.density >= threshold or not marked and _has_words(x)]
        else:
            chosen.append(node)
    return chosen


def blocks(node: Node, into: list[list[str]]) -> None:
    """Add the text of a subtree to ``into``, a new list at each block bound."""
    waiting: list = [node]
    while waiting:
        part = waiting.pop()
        if part is None:
            into.append([])
        elif isinstance(part, str):
            into[-1].append(part)
        elif not part.chrome:
            bound = part.name in _BLOCK
            if bound:
                into.append([])
                waiting.append(None)
            waiting += reversed(part.parts)


def main_text(page: str | None) -> str:
    """Main text of a page; empty for a null, empty or textless one. Nothing of the chosen subtrees is cut."""
    if not page:
        return ""
    texts: list[list[str]] = [[]]
    for node in select(parse(page)):
        blocks(node, texts)
        texts.append([])
    clean = (" ".join(_html.unescape("".join(parts)).split()) for parts in texts)
    return " ".join(t for t in clean if t)


@F.arrow_udf(T.StringType())
def _main_texts(pages: pa.Array) -> pa.Array:
    return pa.array([main_text(p.as_py()) for p in pages], pa.string())


def extract_main_text(page: str | Column) -> Column:
    """Column of the main text. Rows are treated one by one; null pages give empty text."""
    return _main_texts(page)
