"""Operator 4: main text of web pages by composite text density.

A page is parsed into a small DOM (unclosed paragraphs, list items and inline marks are
closed as browsers do, inside left-out elements too). Elements that never hold the article are left out first: scripts,
styles, navigation, page headers and footers, sidebars, forms, hidden parts, and elements
whose class, id or role names an advert, menu, notice, comment section or the like (an article
element only if it is named as a reader's comment). Every
remaining element gets its link-adjusted density of characters per tag,

    C/T * log(C/LC * T/LT) / log(ln(C/nLC * LC + LCb/Cb * C + e))

(C, T characters and tags; LC, LT those inside links; nLC = C - LC; b the body; zeros count
as one), and the sum of its children's densities. The element of greatest sum is the core; an article element around it is taken whole. The least density on the path from the body to the
core is the threshold. Every element at or
above the threshold contributes the subtree of greatest density sum inside it.

Furniture without a telling name goes by density: a core that is no article element narrows to
the one block that holds most of its text, as long as everything beside that block is made of
links or is a plain block thinner than the densest one inside; such blocks beside the path from
the core to the body contribute nothing.

Text keeps page order; white space inside a block becomes one space, blocks are joined by
one. The whole page is read; nothing is cut.

Defined results: null or empty html gives an empty text; a page without markup is one block;
repeated rows give repeated results; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import sliced

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("""script style noscript template head title nav footer aside form button select option textarea
                       iframe object svg canvas audio video map menu dialog""".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp
                      small span strike strong sub sup time tt u var wbr img""".split())
#: an opening tag of the set closes an open element of the key, unless a scope lies between
CLOSES = {"p": frozenset("""address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3
                            h4 h5 h6 header hr main menu nav ol p pre section table ul""".split()),
          "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
          "tr": frozenset(["tr", "tbody", "thead", "tfoot"]), "td": frozenset(["td", "th", "tr", "tbody"]),
          "th": frozenset(["td", "th", "tr", "tbody"]), "option": frozenset(["option", "optgroup"])}
SCOPE = frozenset("body html table ul ol dl div section article main td th blockquote".split())
#: inside a noise subtree no opening tag closes elements beyond these
WALLS = SCOPE | DROPPED | {"header"}
HEAD = frozenset("base link meta title noscript style script template head".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
NOISE = re.compile(r"""^(?:
    (?:site|page|global|top|main|blog)?[-_]?(?:header|footer|nav|navbar|navigation|menu|masthead)|
    (?:.*[-_])?(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed|s)?|promo(?:s|ted|tion)?|banner|sidebar|cookies?|consent|gdpr|
        notices?|disclaimer|alert|popup|modal|overlay|breadcrumbs?|pagination|pager|
        newsletter|subscri(?:be|ption)|signup|sign-up|login|share|sharing|social|related|recommended|recommendations|
        widgets?|toolbar|search|skip-?link|paywall)(?:[-_].*)?
    )$""", re.I | re.X)
#: reader comments; they are no article even as article elements
COMMENTS = re.compile(r"^(?:discussion|(?:.*[-_])?(?:comments?|disqus|repl(?:y|ies)|respond)(?:[-_].*)?)$", re.I)
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    __slots__ = ("tag", "children", "parent", "chars", "tags", "link_chars", "link_tags", "density", "total", "best")

    def __init__(self, tag, parent):
        self.tag, self.parent, self.children = tag, parent, []


def is_noise(tag: str, attrs: dict, in_article: bool) -> bool:
    if tag in DROPPED or (tag == "header" and not in_article):
        return True
    if tag in ("html", "body", "main"):
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or HIDDEN.search(attrs.get("style") or ""):
        return True
    if (attrs.get("role") or "").lower() in ROLES:
        return True
    names = [CAMEL.sub("-", n) for n in (attrs.get("class") or "").split() + (attrs.get("id") or "").split()]
    if tag == "article" and not in_article:  # an article about notices or related work is an article
        return any(COMMENTS.match(n) for n in names)
    return any(NOISE.match(n) or COMMENTS.match(n) for n in names)


class _Dom(HTMLParser):
    """Builds the tree of what may be article text; noise subtrees are skipped."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("body", None)
        self.skip: list[str] = []  # open tags inside a noise subtree
        self.articles = 0

    def _open(self, tag) -> bool:
        """Closes what the opening tag ends; true if it ends an element."""
        node = self.at
        while node is not None and node.parent is not None:
            if node.tag in CLOSES and tag in CLOSES[node.tag]:
                self._leave(node.parent)
                return True
            if node.tag in SCOPE:
                return False
            node = node.parent
        return False

    def _ends_skip(self, tag) -> bool:
        """Closes what the opening tag ends inside the noise subtree; true if the subtree ends."""
        for k in range(len(self.skip) - 1, -1, -1):
            at = self.skip[k]
            if (at in CLOSES and tag in CLOSES[at]) or (at == "head" and k + 1 == len(self.skip) and tag not in HEAD):
                del self.skip[k:]
                return not self.skip
            if at in WALLS:
                return False
        if self._open(tag):  # an open paragraph or item around the noise
            self.skip.clear()
            return True
        return False

    def _leave(self, to):
        while self.at is not to:
            self.articles -= self.at.tag in ("article", "main")
            self.at = self.at.parent

    def handle_starttag(self, tag, attrs):
        if self.skip and not self._ends_skip(tag):
            if tag not in VOID:
                self.skip.append(tag)
            return
        if tag in ("html", "body"):
            return
        self._open(tag)
        if tag in VOID:
            self.at.children.append(Node(tag, self.at))
            return
        if is_noise(tag, dict(attrs), self.articles > 0):
            self.skip.append(tag)
            return
        node = Node(tag, self.at)
        self.at.children.append(node)
        self.at = node
        self.articles += tag in ("article", "main")

    def handle_startendtag(self, tag, attrs):
        if tag in VOID:
            self.handle_starttag(tag, attrs)
        else:  # a slash does not close other elements
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if self.skip:
            if tag in self.skip:
                while self.skip.pop() != tag:
                    pass
            elif tag in SCOPE or tag == "body" or (tag not in INLINE and CLOSES.keys() >= set(self.skip)):
                # the noise element was never closed
                if self._opened(tag):
                    self.skip.clear()
                    self.handle_endtag(tag)
            return
        node = self._opened(tag)
        if node is not None:
            self._leave(node.parent)

    def _opened(self, tag):
        node = self.at
        while node.parent is not None:
            if node.tag == tag:
                return node
            node = node.parent
        return None

    def handle_data(self, data):
        if self.skip == ["head"] and data.strip():  # text ends an open head
            self.skip.clear()
        if not self.skip:
            self.at.children.append(data)


def _post_order(root: Node) -> list[Node]:
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack += [c for c in node.children if isinstance(c, Node)]
    return out[::-1]


def _densities(root: Node) -> None:
    order = _post_order(root)
    for n in order:
        n.chars = n.tags = n.link_chars = n.link_tags = 0
        for c in n.children:
            if isinstance(c, Node):
                n.chars += c.chars
                n.tags += c.tags + 1
                n.link_chars += c.link_chars
                n.link_tags += c.link_tags
            else:
                n.chars += len(" ".join(c.split()))
        if n.tag == "a":
            n.link_chars, n.link_tags = n.chars, n.tags + 1
    body = root.link_chars / max(1, root.chars)
    for n in order:
        c, t = n.chars, max(1, n.tags)
        if not c:
            n.density = 0.0
        else:
            base = math.log(c / max(1, c - n.link_chars) * n.link_chars + body * c + math.e)
            inner = c / max(1, n.link_chars) * t / max(1, n.link_tags)
            n.density = c / t * max(0.0, math.log(max(1.0, inner))) / max(0.1, math.log(max(base, 1.11)))
        blocks = [x for x in n.children if isinstance(x, Node) and x.tag not in INLINE]
        n.total = sum(x.density for x in blocks)  # inline marks belong to their block
        n.best = n
        for x in blocks:
            if x.best.total > n.best.total:
                n.best = x.best


def _blocks(node: Node) -> list[Node]:
    return [c for c in node.children if isinstance(c, Node) and c.tag not in INLINE and c.chars]


def _is_furniture(block: Node, body: Node) -> bool:
    """Beside ``body``: a block of links, or a plain block of running text without paragraphs that is
    thinner than the body's densest block."""
    if 2 * block.link_chars > block.chars:
        return True
    return block.tag == "div" and not _blocks(block) and block.density < max((x.density for x in _blocks(body)), default=body.density)


def _narrowed(core: Node) -> Node:
    """The core without unnamed furniture around it: while one block with blocks of its own holds most
    of the text that is no link and everything beside it is furniture, that block is the core."""
    while True:
        blocks = _blocks(core)
        body = max(blocks, key=lambda x: x.chars - x.link_chars, default=None)
        if (body is None or not _blocks(body) or 2 * (body.chars - body.link_chars) < core.chars - core.link_chars
                or any(isinstance(c, str) and c.strip() or isinstance(c, Node) and c.tag in INLINE and c.chars for c in core.children)
                or not all(_is_furniture(x, body) for x in blocks if x is not body)):
            return core
        core = body


def _text(root: Node, marked: set[int]) -> str:
    """Text under marked elements in page order; blocks end at elements that are not inline."""
    out, stack = [], [(root, id(root) in marked)]
    while stack:
        item, inside = stack.pop()
        if isinstance(item, str):
            if inside:
                out.append(item)
            continue
        inside = inside or id(item) in marked
        if item.tag not in INLINE:
            out.append(" ")
            stack.append((" ", True))
        stack += [(c, inside) for c in reversed(item.children)]
    return " ".join("".join(out).split())


def extract(html: str | None) -> str:
    """Main text of one page."""
    if not html:
        return ""
    dom = _Dom()
    dom.feed(html)
    dom.close()
    root = dom.root
    _densities(root)
    node = core = root.best
    while node is not None:  # the core's article is the article, its heading included
        core = node if node.tag == "article" else core
        node = node.parent
    if core.tag != "article":
        core = _narrowed(core)
    node, threshold, furniture = core, math.inf, set()
    while node is not None:
        threshold = min(threshold, node.density)
        if node.parent is not None:
            furniture.update(id(x) for x in _blocks(node.parent) if x is not node and _is_furniture(x, node))
        node = node.parent
    marked, stack = {id(core)}, [root]
    while stack:
        node = stack.pop()
        if node.density >= threshold and node.chars and id(node) not in furniture:
            marked.add(id(node.best))
            stack += [c for c in node.children if isinstance(c, Node)]
    return _text(root, marked)


def _run(batches):
    for batch in sliced(batches, 2):
        text = [extract(h) for h in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                                         F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(_run, "page_id long, url string, text string, n_chars long")
