"""HTML extraction by tree scoring.

A page becomes a tree of block elements with runs of inline text (blocks). Elements that
never hold an article (scripts, styles, forms, navigation, page headers and footers,
sidebars) and elements whose class, id or role names an advert, a notice, a menu, reader
comments and the like are left out with all they hold. Of the latter those stay that are or
hold the largest article, if it has most of the page's text or every article would go, and,
adverts and reader comments apart, those with most of the text of their article or of a page
without articles. Every remaining block passes
points to its container, and half of them to the container above: one, plus one per
comma, plus one per 100 characters up to three; a container's points are discounted by
its link density. The best container is kept with those siblings that score at least a
fifth of it or are running text themselves; inside an article (or main) element that is
the whole element. Blocks that are nearly all links, two or more, count as menus; inside
an article only lists and blocks without paragraphs do.

Only block elements end a block of text. Images, scripts, styles, form controls, drawings and
hidden inline elements leave it whole and lose only what they hold. An inline element within
running text (paragraph, heading, list item, cell, quotation) keeps its text whatever its
class, unless it is an advert or a reader comment.

Pages are independent: no shuffle, a page at a time in memory, nothing recursive.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laminar.llm.common import workers_import_package

# Element names and the words in classes, ids and roles that decide.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
UNWANTED = frozenset(
    "script style noscript template form button select textarea input nav footer aside head title "
    "iframe object embed svg math canvas audio video map dialog menu option datalist".split()
)
UNWANTED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored banner promo promotion "
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager sidebar side rail "
    "footer masthead topbar toolbar comment comments commentlist disqus replies respond "
    "cookie cookies consent gdpr notice notices alert warning popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social related recommended widget hidden "
    "complementary contentinfo search skip tracking".split()
)
WITHIN_TEXT = frozenset(  # unwanted or empty elements that end no block of text
    "script style noscript template button select textarea input option datalist iframe object "
    "embed svg math canvas audio video map area img link meta base source track".split()
)
FOREIGN_WORDS = frozenset(  # never the article's own text, however long
    "ad ads adv advert adverts advertisement advertising sponsor sponsored "
    "comment comments commentlist disqus replies respond".split()
)
CLOSED_BY_BLOCK = frozenset({"p", "h1", "h2", "h3", "h4", "h5", "h6"})
RUNNING_TEXT = CLOSED_BY_BLOCK | {"li", "dd", "td", "blockquote", "pre", "figcaption"}
SAME_LEVEL = {  # a start tag that ends an open element of these kinds
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "td", "th"}),
    "td": frozenset({"td", "th"}),
    "th": frozenset({"td", "th"}),
}
LIST_OWNERS = frozenset({"ul", "ol", "dl", "table"})
SIBLING_SHARE = 0.2
MENU_LINK_DENSITY = 0.66


class Node:
    __slots__ = (
        "tag", "parent", "unwanted", "named", "foreign", "cuts", "prose", "children", "points", "chars", "linked", "links"
    )

    def __init__(
        self, tag: str, parent: Node | None, unwanted: bool, words: set[str] = frozenset(), cuts: bool = True
    ):
        self.tag, self.parent, self.unwanted = tag, parent, unwanted
        self.cuts = cuts  # its start and end are borders of blocks
        self.named, self.foreign = bool(words), not FOREIGN_WORDS.isdisjoint(words)
        self.prose = False  # holds a paragraph with text
        self.children: list[Node | str] = []  # nodes and blocks of text, in page order
        self.points, self.chars, self.linked, self.links = 0.0, 0, 0, 0


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", None, False)
        self.nodes = [self.root]
        self.text: list[str] = []
        self.text_at = self.root  # where the open block of text began
        self.found: list[tuple[Node, str, int, int]] = []  # blocks with their linked chars and links
        self.in_link = 0
        self.linked = self.links = 0

    def flush(self) -> None:
        if not self.text:
            return
        block = " ".join("".join(self.text).split())
        self.text = []
        linked, links, self.linked, self.links = self.linked, self.links, 0, 0
        node = self.text_at
        if not block or node.unwanted:
            return
        node.children.append(block)
        self.found.append((node, block, linked, links))

    def close(self) -> None:
        super().close()
        self.flush()
        self._settle_named()
        for node, block, linked, links in self.found:
            if not node.unwanted:
                self._give_points(node, block, linked, links)

    def _settle_named(self) -> None:
        """Elements named by their words go, unless the article or most text goes with them."""
        if not any(n.named for n in self.nodes):
            return
        size, free, total = {}, False, 0
        for at, block, _, _ in self.found:
            total += len(block)
            named, article, node = False, False, at
            while node is not None:
                size[node] = size.get(node, 0) + len(block)
                named, article = named or node.named, article or node.tag in ("article", "main")
                node = node.parent
            free = free or article and not named
        articles = [n for n in self.nodes if n.tag in ("article", "main") and n in size]
        stays, node = set(), max(articles, key=size.get, default=None)
        if free and 2 * size[node] <= total:
            node = None
        while node is not None:
            stays.add(node)
            node = node.parent
        whole = {self.root: 0 if articles else total}  # the text that a node's share is taken of
        for node in self.nodes[1:]:  # parents come first
            up = node.parent
            whole[node] = size.get(up, 0) if up.tag in ("article", "main") else whole[up]
            most = not node.foreign and whole[node] and 2 * size.get(node, 0) > whole[node]
            if up.unwanted or node.named and not most and node not in stays:
                node.unwanted = True

    @staticmethod
    def _give_points(node: Node, block: str, linked: int, links: int) -> None:
        points = 1 + block.count(",") + min(len(block) // 100, 3)
        container = node if node.tag not in CLOSED_BY_BLOCK or node.parent is None else node.parent
        container.points += points
        if container.parent is not None:
            container.parent.points += points / 2
        prose = False
        while node is not None:
            prose = prose or node.tag == "p"
            node.prose |= prose
            node.chars += len(block)
            node.linked += min(linked, len(block))
            node.links += links
            node = node.parent

    def _unwanted(self, tag: str, attrs) -> bool:
        """True for what never holds an article, whatever its class."""
        if tag in UNWANTED:
            return True
        if tag == "header":  # an article's own header holds its heading
            node = self.at
            while node is not None and node.tag not in ("article", "main"):
                node = node.parent
            return node is None
        if tag in ("html", "body", "main"):
            return False
        for name, value in attrs:
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return True
            if name == "style" and value and re.search(r"display\s*:\s*none", value.lower()):
                return True
        return False

    @staticmethod
    def _words(tag: str, attrs) -> set[str]:
        """The unwanted words in class, id and role."""
        if tag in ("html", "body", "main"):
            return set()
        values = [v.lower() for name, v in attrs if name in ("class", "id", "role") and v]
        return {w for v in values for w in re.split(r"[^a-z]+", v)} & UNWANTED_WORDS

    def _leave(self, kinds: frozenset[str], stop: frozenset[str] = frozenset()) -> None:
        """Close the nearest open element of these kinds, unless one of ``stop`` is nearer."""
        node = self.at
        while node.parent is not None and node.tag not in kinds:
            if node.tag in stop:
                return
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def _add(self, text: str) -> None:
        if not self.text:
            self.text_at = self.at
        self.text.append(text)

    def _open(self, node: Node) -> None:
        self.at.children.append(node)
        self.nodes.append(node)
        self.at = node

    def _open_inline(self, tag, attrs) -> None:
        """An inline element is a node of its own only where its text may go."""
        if self.at.unwanted or not attrs:
            if tag == self.at.tag:  # its end tag must not close the outer one
                self._open(Node(tag, self.at, self.at.unwanted, cuts=False))
                return
        elif self._unwanted(tag, attrs):
            self._open(Node(tag, self.at, True, cuts=False))
            return
        else:
            words = self._words(tag, attrs)
            if not FOREIGN_WORDS.isdisjoint(words):
                self._open(Node(tag, self.at, True, cuts=False))
                return
            if words and self.at.tag not in RUNNING_TEXT:
                self.flush()
                self.in_link = 0
                self._open(Node(tag, self.at, False, words))
                return
            if tag == self.at.tag:
                self._open(Node(tag, self.at, False, cuts=False))
        if tag == "a" and not self.at.unwanted:
            self.in_link = 1
            self.links += 1

    def handle_starttag(self, tag, attrs) -> None:
        if tag == "br":
            if not self.at.unwanted:
                self._add("\n")
            return
        if tag in INLINE:
            self._open_inline(tag, attrs)
            return
        cuts = tag not in WITHIN_TEXT and not self.at.unwanted
        if cuts:
            self.flush()
            self.in_link = 0
        if tag in VOID:
            return
        if tag not in WITHIN_TEXT:
            if self.at.tag in CLOSED_BY_BLOCK:
                self.at = self.at.parent
            same = SAME_LEVEL.get(tag)
            if same:
                self._leave(same, LIST_OWNERS)
        unwanted = self.at.unwanted or self._unwanted(tag, attrs)
        self._open(Node(tag, self.at, unwanted, self._words(tag, attrs), cuts))

    def handle_startendtag(self, tag, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag) -> None:
        if tag == "br":
            if not self.at.unwanted:
                self._add("\n")
            return
        if tag == "a":
            self.in_link = 0
        if tag in INLINE and self.at.tag != tag:
            return
        node = self.at
        while node is not None and node.tag != tag:
            node = node.parent
        if node is None or node.parent is None:
            return  # an end tag without its start
        if node.cuts:
            self.flush()
        self.at = node.parent

    def handle_data(self, data) -> None:
        if self.at.unwanted:
            return
        self._add(data)
        if self.in_link:
            self.linked += len(data.strip())


def _density(node: Node) -> float:
    return node.linked / node.chars if node.chars else 0.0


def _is_menu(node: Node) -> bool:
    return node.links >= 2 and _density(node) >= MENU_LINK_DENSITY


def _score(node: Node) -> float:
    return node.points * (1 - _density(node))


def _is_inner_menu(node: Node) -> bool:
    listed = node.tag in LIST_OWNERS or not node.prose
    return listed and node.tag not in CLOSED_BY_BLOCK and _is_menu(node)


def _blocks(nodes: list[Node], is_menu=_is_menu) -> list[str]:
    out: list[str] = []
    stack: list[Node | str] = list(reversed(nodes))
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        elif not x.unwanted and not is_menu(x):
            stack.extend(reversed(x.children))
    return out


def main_text(html: str | None) -> str:
    """Blocks of a page's article, one per line; empty if there is none."""
    if not html:
        return ""
    # a tag that never ends is no tag; the parser would look for its end again and again
    tail = html.rfind(">") + 1
    unended = re.compile(r"<[A-Za-z/!?]").search(html, tail)
    tree = _Tree()
    tree.feed(html[: unended.start()] if unended else html)
    tree.close()
    best = None
    for node in tree.nodes:
        if not node.unwanted and node.points and not _is_menu(node):
            if best is None or _score(node) > _score(best):
                best = node
    if best is None:
        return ""
    for kind in ("article", "main"):
        node = best
        while node is not None and node.tag != kind:
            node = node.parent
        if node is not None:
            return "\n".join(_blocks([node], _is_inner_menu))
    if best.parent is None:
        return "\n".join(_blocks([best]))
    floor = max(SIBLING_SHARE * _score(best), 1.0)
    kept: list[Node | str] = []
    for x in best.parent.children:
        if isinstance(x, str):
            if len(x) >= 80 and x[-1] in ".!?":
                kept.append(x)
        elif x is best or _score(x) >= floor:
            kept.append(x)
        elif x.tag in CLOSED_BY_BLOCK and x.chars and _density(x) < 0.25:
            kept.append(x)  # running text or a heading beside the container
    return "\n".join(_blocks(kept))


def extract(html: Column) -> Column:
    """The main text of a page; null counts as empty."""
    workers_import_package()

    @F.pandas_udf("string")
    def of(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(p) for p in pages])

    return of(html)


def main_texts(pages: DataFrame) -> DataFrame:
    """``pages`` (html, anything else) with a column ``main_text``. Null and empty pages, and
    pages without an article, have the empty text; repeated rows are alike."""
    if "main_text" in pages.columns:
        raise ValueError("rename the column main_text first")
    return pages.withColumn("main_text", extract(pages["html"]))
