"""A page as blocks of text in a tree of elements, with features of every element."""

from __future__ import annotations

import re
from collections.abc import Sequence
from html.parser import HTMLParser

import numpy as np

#: Scripts, styles and what is no part of the page as it is shown. All else is for the trees to judge.
HIDDEN = {"script", "style", "template", "title"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Part of the text around them; every other element begins and ends a block.
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
    "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
    "time", "tt", "u", "var", "wbr",
    "math", "mfrac", "mi", "mn", "mo", "mover", "mroot", "mrow", "mspace", "msqrt", "mstyle", "msub", "msubsup", "msup", "mtext", "munder", "semantics",
}
#: Elements that end one of the same kind that is still open beside them.
_ENDS_ITSELF = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_FENCES = {"ul", "ol", "dl", "table", "div", "section", "article", "aside", "nav", "main", "body", "td", "th", "form", "select"}
_KINDS = (
    ("nav", "menu"), ("header",), ("footer",), ("aside",), ("form", "fieldset", "button", "select", "textarea", "option", "legend"),
    ("article", "main"), ("section",), ("div",), ("p", "blockquote", "pre"), ("h1", "h2", "h3", "h4", "h5", "h6"),
    ("ul", "ol", "dl"), ("li", "dt", "dd"), ("table", "tbody", "tr", "td", "th"),
)
KIND = {tag: i for i, tags in enumerate(_KINDS) for tag in tags}
#: Words of class, id and role, in groups that a feature each counts.
TOKENS = (
    {"ad", "ads", "advert", "adverts", "advertisement", "banner", "promo", "promoted", "sponsor", "sponsored", "adslot"},
    {"nav", "navbar", "navigation", "menu", "menubar", "topnav", "breadcrumb", "breadcrumbs", "pagination", "pager", "tabs"},
    {"sidebar", "side", "aside", "rail", "widget", "widgets", "related", "recommended", "trending", "popular", "tags"},
    {"header", "masthead", "topbar", "logo", "branding", "footer", "foot", "bottom", "copyright", "legal", "contentinfo"},
    {"cookie", "cookies", "consent", "notice", "alert", "popup", "modal", "overlay", "paywall", "gdpr", "disclaimer", "toast"},
    {"comment", "comments", "commentlist", "reply", "replies", "respond", "disqus", "discussion", "reviews", "feedback"},
    {"share", "social", "follow", "newsletter", "subscribe", "signup", "login", "search", "form", "subscription"},
    {"content", "article", "post", "entry", "story", "main", "body", "text", "page", "prose", "maincontent"},
)
GROUP = {word: i for i, words in enumerate(TOKENS) for word in words}
#: The page itself and its halves.
_WHOLE = {"html", "head", "body"}
_SPLIT = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Node:
    """An element that makes blocks, with what is known about its own text."""

    __slots__ = ("tag", "tokens", "parent", "children", "blocks", "depth", "chars", "linked", "stops", "elements", "fields", "before")

    def __init__(self, tag: str, tokens: list[int], parent: int, depth: int):
        self.tag, self.tokens, self.parent, self.depth = tag, tokens, parent, depth
        self.children: list[int] = []
        self.blocks: list[int] = []
        self.chars = self.linked = self.stops = self.elements = self.fields = self.before = 0


class Page(HTMLParser):
    """``nodes`` in page order (the first is the page itself) and ``blocks``, each with its node and text."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.nodes = [Node("page", [0] * len(TOKENS), -1, 0)]
        self.blocks: list[tuple[int, str]] = []
        self._open: list[tuple[str, int]] = [("page", 0)]
        self._parts: list[str] = []
        self._hidden: list[str] = []
        self._links = 0
        self._seen = 0
        self.feed(html)
        self.close()
        self._end_block()

    def _end_block(self) -> None:
        if not self._parts:
            return
        text = _SPACE.sub(" ", "".join(self._parts)).strip()
        self._parts = []
        if text:
            at = self._open[-1][1]
            node = self.nodes[at]
            node.blocks.append(len(self.blocks))
            self.blocks.append((at, text))
            node.chars += len(text)
            node.stops += sum(map(text.count, ".,;:!?"))

    def _pop_to(self, i: int) -> None:
        """Close everything from place ``i`` of the open elements on."""
        if any(t not in INLINE for t, _ in self._open[i:]):
            self._end_block()
        for tag, _ in self._open[i:]:
            self._links -= tag == "a"
        del self._open[i:]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self._hidden and tag == "body":
            self._hidden.clear()
        if self._hidden or tag in HIDDEN:
            if tag not in VOID:
                self._hidden.append(tag)
            return
        if tag in _WHOLE:
            return
        if tag not in INLINE:
            self._end_block()
            ends = _ENDS_ITSELF.get(tag, set()) | {"p"}
            for i in range(len(self._open) - 1, 0, -1):
                name = self._open[i][0]
                if name in ends:
                    self._pop_to(i)
                    break
                if name in _FENCES:
                    break
        at = self._open[-1][1]
        self.nodes[at].elements += 1
        if tag in ("input", "select", "textarea", "button"):
            self.nodes[at].fields += 1
        if tag == "br":
            self._parts.append(" ")
        if tag in VOID:
            return
        if tag in INLINE:
            self._links += tag == "a"
            self._open.append((tag, at))
            return
        counts = [0] * len(TOKENS)
        for name, value in attrs:
            if name in ("class", "id", "role") and value:
                for word in _SPLIT.findall(_HUMP.sub(" ", value).lower()):
                    if word in GROUP:
                        counts[GROUP[word]] += 1
        node = Node(tag, counts, at, self.nodes[at].depth + 1)
        node.before = self._seen
        self.nodes[at].children.append(len(self.nodes))
        self._open.append((tag, len(self.nodes)))
        self.nodes.append(node)

    def handle_endtag(self, tag: str) -> None:
        if self._hidden:
            if tag in self._hidden:
                del self._hidden[len(self._hidden) - 1 - self._hidden[::-1].index(tag) :]
                return
            if tag not in _WHOLE and all(name != tag for name, _ in self._open):
                return
            self._hidden.clear()  # what holds it ends, and so does it
        if tag == "br":
            self._parts.append(" ")
            return
        for i in range(len(self._open) - 1, 0, -1):
            if self._open[i][0] == tag:
                self._pop_to(i)
                return
            if tag in INLINE and self._open[i][0] not in INLINE:
                return

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_data(self, data: str) -> None:
        if self._hidden:
            return
        self._parts.append(data)
        n = len(data)
        self._seen += n
        if self._links > 0:
            self.nodes[self._open[-1][1]].linked += n


#: Kinds of elements that tell something about all that is in them: the first ones.
_REGIONS = 7
FEATURES = len(_KINDS) + _REGIONS + 2 * len(TOKENS) + 18


def _rate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.divide(x, y, out=np.zeros(len(x)), where=np.asarray(y) != 0)


def features(pages: Sequence[Page]) -> np.ndarray:
    """A row for every node of all pages: its kind, the regions it is in, attribute tokens (its own and its
    ancestors'), sizes and densities of its subtree, its depth and place, and the same of its parent and
    siblings."""
    nodes = [x for page in pages for x in page.nodes]
    n = len(nodes)
    sizes = [len(page.nodes) for page in pages]
    first = np.cumsum(sizes) - sizes
    of_page = np.repeat(np.arange(len(pages)), sizes)
    own = np.arange(n)
    parent = np.array([x.parent for x in nodes]) + first[of_page]
    depth = np.array([x.depth for x in nodes])
    root = depth == 0
    parent[root] = own[root]
    tokens = np.array([x.tokens for x in nodes], float)
    kind = np.array([KIND.get(x.tag, len(_KINDS)) for x in nodes])
    sums = np.array([(x.chars, x.linked, x.stops, x.elements, x.fields, len(x.blocks)) for x in nodes], float)
    blocks = [text for page in pages for _, text in page.blocks]
    owner = np.repeat(first, [len(page.blocks) for page in pages]) + np.array([at for page in pages for at, _ in page.blocks], int)
    longest, height, above = np.zeros(n), np.zeros(n), np.zeros((n, len(TOKENS)))
    np.maximum.at(longest, owner, np.array(list(map(len, blocks)), float))
    kinds = np.eye(len(_KINDS) + 1)[kind][:, :-1]
    around = np.zeros((n, _REGIONS))

    by_depth = np.argsort(depth, kind="stable")
    levels = np.split(by_depth, np.flatnonzero(np.diff(depth[by_depth])) + 1)
    for level in levels[:0:-1]:  # from the leaves up
        up = parent[level]
        np.add.at(sums, up, sums[level])
        np.maximum.at(height, up, height[level] + 1)
        np.maximum.at(longest, up, longest[level])
    for level in levels[1:]:  # and from the top down
        up = parent[level]
        above[level] = above[up] + tokens[up]
        around[level] = np.maximum(around[up], kinds[up, :_REGIONS])

    # Brothers and sisters lie behind each other; a page is the only one of its kind.
    order = np.lexsort((own, np.where(root, own + n, parent)))
    mother = np.where(root, own + n, parent)[order]
    begins = np.concatenate(([True], mother[1:] != mother[:-1]))
    starts = np.flatnonzero(begins)
    family = np.cumsum(begins) - 1
    place, siblings = np.empty(n), np.empty(n)
    place[order] = own - starts[family]
    siblings[order] = np.diff(np.concatenate((starts, [n])))[family]
    children = np.bincount(parent[~root], minlength=n).astype(float)
    names = {tag: i for i, tag in enumerate({x.tag for x in nodes})}
    tag = np.array([names[x.tag] for x in nodes])
    _, alike, count = np.unique(np.where(root, own + n, parent) * len(names) + tag, return_inverse=True, return_counts=True)
    same = count[alike].astype(float)

    chars, linked, stops, elements, fields, n_blocks = sums.T
    links = np.minimum(1.0, _rate(linked, chars))
    previous, following = np.full(n, -1.0), np.full(n, -1.0)
    inner = ~begins
    previous[order[inner]] = links[order[np.flatnonzero(inner) - 1]]
    following[order[np.flatnonzero(inner) - 1]] = links[order[inner]]
    before = np.array([x.before for x in nodes], float)
    seen = np.array([page._seen for page in pages], float)[of_page]
    numbers = (
        np.log1p(chars), _rate(chars, chars[first][of_page]), _rate(chars, chars[parent]), links, _rate(stops, chars),
        _rate(elements, chars + 1), _rate(chars, n_blocks), np.log1p(longest), fields, depth, height, children, siblings,
        _rate(same, siblings), _rate(place, siblings), _rate(before, seen), previous, following,
    )
    return np.hstack((kinds, around, tokens, above, np.stack(numbers, axis=1)))


def decode(page: Page, odds: list[float]) -> list[bool]:
    """Which nodes are main text, given the logarithm of each one's odds of being so.

    The likeliest choice among those where nothing below a node that is not main is main: the
    gain of calling a node main is its odds and the gains of those of its children that gain.
    """
    gain = list(odds)
    for i in range(len(odds) - 1, 0, -1):
        if gain[i] > 0:
            gain[page.nodes[i].parent] += gain[i]
    main = [gain[0] > 0]
    for i in range(1, len(odds)):
        main.append(main[page.nodes[i].parent] and gain[i] > 0)
    return main
