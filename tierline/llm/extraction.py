"""Main text of web pages by gradient-boosted trees over the features of their elements.

There are no labelled pages, so the trees learn from pages whose labels are known by the way they
are made: the texts of a sample of pages, laid out anew in many ways with every region marked, and
the sampled pages themselves where tags like ``article`` and ``nav`` say what is what.
"""

from __future__ import annotations

import html as entities
import random
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm import dom
from tierline.llm.common import map_arrow, stage

#: Pages that the trees are fitted on, at most, and layouts made of their texts, at least.
SAMPLE, LAYOUTS = 200, 1200
TREES, DEPTH = 30, 6
#: Elements of pages that are judged at once, at least.
NODES = 10_000
_SIGNS = {"article": 1, "main": 1, "nav": 0, "header": 0, "footer": 0, "aside": 0, "form": 0, "menu": 0}

# Ways to mark the regions of a page; "" stands for no attributes.
_MAIN = ("article", "main", 'div class="content"', 'div id="main-content"', 'div class="post-body"', 'section class="entry"', 'div class="article-text"', "div", "section")
_NAV = ("nav", 'ul class="menu"', 'div class="navbar"', 'div id="top-nav"', 'ol class="breadcrumbs"', "ul", "div")
_HEADER = ("header", 'div class="header"', 'div id="masthead"', 'div class="site-header"')
_FOOTER = ("footer", 'div id="footer"', 'div class="site-footer"', 'div class="copyright"')
_AD = ('div class="ad"', 'div class="advert"', 'aside class="promo"', 'div id="ad-banner"', 'section class="sponsored"', 'div class="adSlot"', 'p class="ad"')
_SIDE = ("aside", 'div class="sidebar"', 'div id="right-rail"', 'section class="related"', 'div class="widget"')
_NOTICE = ('div class="cookie-notice"', 'div id="consent"', 'div role="alert"', 'div class="popup"', 'section class="notice"', 'p class="notice"')
_COMMENTS = ('div class="comments"', 'section id="comments"', 'ol class="comment-list"', 'div id="disqus_thread"', 'ul class="replies"')
_SHARE = ('div class="share"', 'ul class="social-links"', 'div class="newsletter"')


class _Layout:
    """A page put together from texts; ``data-main`` says of each region whether it is main text."""

    def __init__(self, texts: list[str], seed: int):
        self.pick = random.Random(seed)
        self.texts = texts

    def text(self) -> str:
        return entities.escape(self.pick.choice(self.texts), quote=False)

    def few(self) -> str:
        return " ".join(self.text().split()[: self.pick.randint(1, 4)])

    def region(self, marks: tuple[str, ...], main: int, inner: str) -> str:
        mark = self.pick.choice(marks)
        return f'<{mark} data-main="{main}">{inner}</{mark.split()[0]}>'

    def paragraphs(self, least: int, most: int) -> str:
        out = []
        for _ in range(self.pick.randint(least, most)):
            kind = self.pick.random()
            if kind < 0.7:
                out.append(f"<p>{self.text()}</p>")
            elif kind < 0.78:
                out.append(f"<h2>{self.few()}</h2>")
            elif kind < 0.84:
                out.append("<ul>" + "".join(f"<li>{self.text()}</li>" for _ in range(3)) + "</ul>")
            elif kind < 0.88:
                out.append(f"<blockquote>{self.text()}</blockquote>")
            elif kind < 0.92:
                out.append(f"<p><b>{self.few()}<br><p>{self.text()}</p>")
            elif kind < 0.95:
                out.append(f"<pre>{self.text()}</pre>")
            elif kind < 0.97:
                out.append(f'<p>{self.few()} <a href="/x">{self.few()}</a> {self.text()}</p>')
            else:
                tag = self.pick.choice(("noscript", "object", "figure", "details", "svg"))
                out.append(f"<{tag}><p>{self.text()}</p></{tag}>")
        return "".join(out)

    def links(self) -> str:
        items = [f'<a href="/{i}">{self.few()}</a>' for i in range(self.pick.randint(3, 9))]
        return "".join(f"<li>{x}</li>" for x in items) if self.pick.random() < 0.7 else " | ".join(items)

    def aside(self) -> str:
        pick = self.pick.random()
        if pick < 0.3:
            return self.region(_AD, 0, self.text() if self.pick.random() < 0.6 else f"<p>{self.text()}</p>")
        if pick < 0.5:
            return self.region(_SIDE, 0, f"<h3>{self.few()}</h3><ul>{self.links()}</ul>" if self.pick.random() < 0.6 else self.paragraphs(1, 3))
        if pick < 0.65:
            return self.region(_NOTICE, 0, self.text() + "<button>OK</button>")
        if pick < 0.8:
            return self.region(("form", 'form class="search"', 'form id="login"'), 0, f"<label>{self.few()}</label><input name=q><button>{self.few()}</button>")
        return self.region(_SHARE, 0, self.links())

    def comments(self) -> str:
        tag = self.pick.choice(("div", "li", "article"))
        items = [f'<{tag} class="comment"><p>{self.text()}</p></{tag}>' if self.pick.random() < 0.6 else f"<p>{self.text()}</p>" for _ in range(self.pick.randint(1, 5))]
        return self.region(_COMMENTS, 0, f"<h3>{self.few()}</h3>" * self.pick.randint(0, 1) + "".join(items))

    def page(self) -> str:
        maybe = lambda chance, part: part() if self.pick.random() < chance else ""
        heading = f"<h1>{self.few()}</h1>"
        inner = maybe(0.9, lambda: heading) + self.paragraphs(1, 8)
        inner += maybe(0.25, self.aside) + maybe(0.4, lambda: self.paragraphs(1, 5)) + maybe(0.15, self.comments)
        body = maybe(0.5, lambda: self.region(_HEADER, 0, f"<a href=/>{self.few()}</a>" + maybe(0.5, lambda: f"<h1>{self.few()}</h1>")))
        body += maybe(0.8, lambda: self.region(_NAV, 0, self.links())) + maybe(0.5, self.aside)
        body += self.region(_MAIN, 1, inner) + maybe(0.3, self.aside) + maybe(0.35, self.comments) + maybe(0.3, self.aside)
        body += maybe(0.85, lambda: self.region(_FOOTER, 0, self.text() if self.pick.random() < 0.5 else f"<p>&copy; {self.few()}</p><ul>{self.links()}</ul>"))
        wrap = self.pick.choice(("", "div", 'div id="wrapper"', 'div class="container page"'))
        return f"<html><body>{f'<{wrap}>{body}</div>' if wrap else body}</body></html>"


class _Marked(dom.Page):
    """A page whose nodes know the ``data-main`` mark, or the meaning of the tag, that holds for them."""

    def __init__(self, html: str, by_tag: bool):
        self.marks: dict[int, int] = {}
        self.by_tag = by_tag
        super().__init__(html)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        before = len(self.nodes)
        super().handle_starttag(tag, attrs)
        if len(self.nodes) > before:
            mark = dict(attrs).get("data-main")
            if mark is not None:
                self.marks[before] = int(mark)
            elif self.by_tag and tag in _SIGNS:
                self.marks[before] = _SIGNS[tag]
            elif self.by_tag and any(self.nodes[before].tokens[:-1]):
                self.marks[before] = 0

    def labels(self) -> list[int]:
        """1 for main text and whatever holds some, else 0."""
        found = [0] * len(self.nodes)
        for i, x in enumerate(self.nodes):
            own = self.marks.get(i)
            above = found[x.parent] if i else 0
            found[i] = own if own is not None and (above or not any(self._dropped(i))) else (above if own is None else 0)
        for i in range(len(self.nodes) - 1, 0, -1):
            if found[i]:
                found[self.nodes[i].parent] = 1
        return found

    def _dropped(self, i: int) -> Iterator[bool]:
        """For each node above, whether it is marked as not main."""
        i = self.nodes[i].parent
        while i >= 0:
            yield self.marks.get(i) == 0
            i = self.nodes[i].parent


def examples(html: str, seed: int, layouts: int) -> Iterator[tuple[int, list[float]]]:
    """Label and features of the elements of a page and of ``layouts`` pages made from its texts."""
    own = _Marked(html, by_tag=True)
    if 1 in own.marks.values():
        yield from zip(own.labels(), dom.features([own]))
    texts = [text for _, text in own.blocks]
    if texts:
        for i in range(layouts):
            made = _Marked(_Layout(texts, seed + i).page(), by_tag=False)
            yield from zip(made.labels(), dom.features([made]))


def _examples(layouts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for html in batch.column(0).to_pylist():
                rows = list(examples(html, zlib.crc32(html.encode()), layouts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([float(r[0]) for r in rows], pa.float64()), pa.array([r[1] for r in rows], pa.list_(pa.float64()))],
                    ["label", "values"],
                )

    return run


class Trees:
    """Boosted trees as arrays: feature, limit, children and value of every node of every tree."""

    def __init__(self, model: GBTClassificationModel):
        feature, limit, left, right, value = [], [], [], [], []

        def add(node) -> int:
            at = len(feature)
            for column, start in ((feature, 0), (limit, 0.0), (left, at), (right, at), (value, float(node.prediction()))):
                column.append(start)
            if node.subtreeDepth() > 0:
                feature[at], limit[at] = node.split().featureIndex(), node.split().threshold()
                left[at], right[at] = add(node.leftChild()), add(node.rightChild())
            return at

        self.roots = [add(tree._java_obj.rootNode()) for tree in model.trees]
        self.weights = list(model.treeWeights)
        self.feature, self.left, self.right = (np.array(x) for x in (feature, left, right))
        self.limit, self.value = np.array(limit), np.array(value)

    def odds(self, rows: np.ndarray) -> np.ndarray:
        """Logarithm of the odds of being main text."""
        total, every = np.zeros(len(rows)), np.arange(len(rows))
        for root, weight in zip(self.roots, self.weights):
            at = np.full(len(rows), root)
            for _ in range(DEPTH):
                at = np.where(rows[every, self.feature[at]] <= self.limit[at], self.left[at], self.right[at])
            total += weight * self.value[at]
        return 2 * total


def fit(pages: DataFrame) -> Trees | None:
    """Trees from the elements of SAMPLE pages; None if there is no text to learn from."""
    html = pages.select(F.col("html").cast("string").alias("html")).filter("html is not null")
    html = html.withColumn("h", F.xxhash64("html"))
    # Different pages in an order that favours none; only their hashes are shuffled, and of the
    # chosen ones, which are broadcast, the texts.
    chosen = stage(html.select("h").distinct().orderBy("h").limit(SAMPLE), "chosen")
    sample = html.join(F.broadcast(chosen), "h", "left_semi").dropDuplicates(["h"]).select("html")
    sample = stage(sample, "sample")
    layouts = -(-LAYOUTS // max(1, sample.count()))
    rows = stage(map_arrow(sample.repartition(4), _examples(layouts), "label double, values array<double>"), "examples")
    if rows.agg(F.count_distinct("label")).first()[0] < 2:
        return None
    rows = rows.select("label", array_to_vector("values").alias("features")).coalesce(2)
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=32, stepSize=0.3, seed=7).fit(rows)
    return Trees(model)


def main_blocks(pages: list[dom.Page], trees: Trees) -> list[list[tuple[int, str]]]:
    """The blocks of each page's main text, each with the number of its element."""
    if not pages:
        return []
    odds = trees.odds(dom.features(pages))
    found, at = [], 0
    for page in pages:
        main = dom.decode(page, odds[at : at + len(page.nodes)].tolist())
        at += len(page.nodes)
        found.append([(i, text) for i, text in page.blocks if main[i]])
    return found


def main_text(html: str, trees: Trees) -> tuple[str, list[tuple[int, str]]]:
    """The main text and the blocks it is made of, each with the number of its element."""
    (kept,) = main_blocks([dom.Page(html)], trees)
    return "\n".join(text for _, text in kept), kept


def _texts(column: Iterable[str | None], trees: Trees) -> Iterator[list[str]]:
    """The main texts of pages in their order, judged some at a time."""
    pages: list[dom.Page] = []

    def judged() -> list[str]:
        return ["\n".join(text for _, text in kept) for kept in main_blocks(pages, trees)]

    held = 0
    for html in column:
        pages.append(dom.Page(html or ""))
        held += len(pages[-1].nodes)
        if held > NODES:
            yield judged()
            pages, held = [], 0
    yield judged()


def _extract(trees: Trees | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = 0
            column = batch.column(2)
            # Texts are taken out of the batch as they are needed.
            some = _texts((x.as_py() for x in column), trees) if trees else iter([[""] * len(batch)])
            for texts in some:
                part = batch.slice(first, len(texts))
                first += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"]
                )

    return run


def extracted(pages: DataFrame) -> DataFrame:
    """Per row of ``pages`` (``page_id, url, html``): ``page_id, url, text, n_chars``.

    Blocks keep their order, each on a line of its own, with character references decoded and
    white space folded. A null or empty page, and one without main text, gives an empty text; null
    ids and urls are kept; repeated rows get the same text each; other columns are not looked at;
    an empty table gives no rows.
    """
    source = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    found = map_arrow(source, _extract(fit(pages)), "page_id bigint, url string, text string")
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
