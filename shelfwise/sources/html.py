"""Product cards from landed HTML pages.

HTML needs a tolerant parser, which Spark has no expression for, so each page
is read on its own inside ``mapInArrow``, in one pass and without recursion.
Everything after that (prices, URLs, product columns) is column work.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from shelfwise.functions import parse

# Selectors of product listings. Card selectors are tried in
# order; the first one with ``min_cards`` hits gives the cards.
THEMES = {
    "generic": {
        "cards": [".product-card", ".product-item", ".product-tile", "[class*='product-grid']",
                  "li.product", ".card--product", "[data-product-id]", "[itemtype*='Product']"],
        "min_cards": 2,
        "title": ["h1[itemprop='name']", "h2[itemprop='name']", ".product-card__title", ".product__title",
                  ".product-title", "h2 a", "h3 a", ".card__heading"],
        "price": ["[itemprop='price']", "[class*='price__current']", ".product-price", ".price",
                  "[class*='offer-price']", ".sale-price", "span.amount"],
        "link": "a[href]",
        "next": ["a[rel='next']", ".pagination__next", "a.next", "[aria-label='Next page']"],
    },
    "shopify": {
        "cards": [".product-card", ".grid__item", "[class*='product']"],
        "min_cards": 1,
        "title": ["h2, h3, .product-card__title"],
        "price": [".price, [class*='price']"],
        "link": "a[href*='/products/']",
        "next": [],
    },
    "woocommerce": {
        "cards": ["li.product"],
        "min_cards": 1,
        "title": [".woocommerce-loop-product__title, h2"],
        "price": [".price .woocommerce-Price-amount"],
        "link": "a.woocommerce-LoopProduct-link, a",
        "next": ["a.next.page-numbers"],
    },
}
VOID_TAGS = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
SINGLE_DESCRIPTION_CHARS = 500

#: Pages whose items leave a worker together, and the bytes of HTML after which they do.
BATCH_BYTES = 8_000_000

CARD_FIELDS = ("card_no int, kind string, title string, price string, url string, image_url string, "
               "description string, has_next boolean, error string")


class Node:
    """An element: its place in the preorder of the page, where its inside ends, and its share of the page's texts."""

    __slots__ = ("tag", "attrs", "classes", "place", "end", "texts_from", "texts_to")

    def __init__(self, tag: str, attrs: dict[str, str], place: int, texts_from: int):
        self.tag, self.attrs, self.place, self.end = tag, attrs, place, place + 1
        self.classes = frozenset(attrs["class"].split()) if "class" in attrs else frozenset()
        self.texts_from = self.texts_to = texts_from


class Page(HTMLParser):
    """One pass over a page: elements in preorder, with lists of them by tag, class and attribute."""

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.texts: list[str] = []
        self.nodes = [Node("", {}, 0, 0)]
        self._open, self._opened = [self.nodes[0]], Counter()
        self._lists: dict[tuple[str, str], list[int]] = {}
        self.feed(html)
        self.close()
        while self._open:
            self._close()

    def _close(self) -> None:
        node = self._open.pop()
        node.end, node.texts_to = len(self.nodes), len(self.texts)
        self._opened[node.tag] -= 1

    def handle_starttag(self, tag, attrs):
        if tag in ("p", "li", "option") and self._open[-1].tag == tag:
            self._close()
        node = Node(tag, {k: v or "" for k, v in attrs}, len(self.nodes), len(self.texts))
        self.nodes.append(node)
        for key in (("tag", tag), *(("class", c) for c in node.classes), *(("attr", k) for k in node.attrs)):
            self._lists.setdefault(key, []).append(node.place)
        if tag not in VOID_TAGS:
            self._open.append(node)
            self._opened[tag] += 1

    def handle_startendtag(self, tag, attrs):
        depth = len(self._open)
        self.handle_starttag(tag, attrs)
        if len(self._open) > depth or self._open[-1].place == len(self.nodes) - 1:
            if tag not in VOID_TAGS:
                self._close()

    def handle_endtag(self, tag):
        if self._opened[tag] > 0:  # an end tag that closes nothing is passed over
            while self._open[-1].tag != tag:
                self._close()
            self._close()

    def handle_data(self, data):
        if self._open[-1].tag not in ("script", "style") and data.strip():
            self.texts.append(data.strip())

    def text(self, node: Node) -> str:
        return "".join(self.texts[node.texts_from:node.texts_to])

    def _fitting(self, simple: str, top: Node) -> Iterator[Node]:
        """Elements inside ``top`` that fit a simple selector, in document order."""
        tag, classes, tests = _simple(simple)
        key = ("class", min(classes)) if classes else ("tag", tag) if tag else ("attr", tests[0][0])
        places = self._lists.get(key, [])
        for place in places[bisect_right(places, top.place):bisect_left(places, top.end)]:
            if _fits(self.nodes[place], simple):
                yield self.nodes[place]

    def _chain(self, chain: tuple[str, ...], top: Node) -> Iterator[Node]:
        """Elements that fit the last part and lie inside elements that fit the parts before, inside one another."""
        if len(chain) == 1:
            yield from self._fitting(chain[0], top)
            return
        outer = [top] if _simple_fits_top(top, chain[:-1]) else []
        outer = sorted({*(n.place for n in outer), *(n.place for n in self._chain(chain[:-1], top))})
        covered, at = 0, 0
        for node in self._fitting(chain[-1], top):
            while at < len(outer) and outer[at] < node.place:
                covered, at = max(covered, self.nodes[outer[at]].end), at + 1
            if node.place < covered:
                yield node

    def select(self, top: Node, selector: str) -> list[Node]:
        """Selector lists ("a, b") of descendant chains ("a b")."""
        found = {n.place: n for chain in _chains(selector) for n in self._chain(chain, top)}
        return [found[place] for place in sorted(found)]

    def first(self, top: Node, selectors: list[str]) -> Node | None:
        """Best element by selector priority, then document order."""
        for selector in selectors:
            hits = [n for n in (next(self._chain(chain, top), None) for chain in _chains(selector)) if n]
            if hits:
                return min(hits, key=lambda n: n.place)
        return None


_ATTRIBUTE = re.compile(r"\[([\w-]+)(?:(\*?=)'([^']*)')?\]")


@lru_cache(maxsize=1024)
def _simple(text: str) -> tuple[str, frozenset, tuple]:
    """Tag, classes and attribute tests of one simple selector."""
    tag, *classes = _ATTRIBUTE.sub("", text).split(".")
    return tag, frozenset(classes), tuple(_ATTRIBUTE.findall(text))


@lru_cache(maxsize=1024)
def _chains(selector: str) -> tuple[tuple[str, ...], ...]:
    return tuple(tuple(chain.split()) for chain in selector.split(","))


def _simple_fits_top(top: Node, chain: tuple[str, ...]) -> bool:
    """Whether the searched element itself can be the outermost part of a chain."""
    return len(chain) == 1 and _fits(top, chain[0])


def _fits(node: Node, simple: str) -> bool:
    tag, classes, tests = _simple(simple)
    if (tag and node.tag != tag) or not classes <= node.classes:
        return False
    for name, op, value in tests:
        actual = node.attrs.get(name)
        if actual is None or (op == "*=" and value not in actual):
            return False
        # Class and rel hold lists of words; equality is on one of them or on all.
        if op == "=" and actual != value and not (name in ("class", "rel") and value in actual.split()):
            return False
    return True


def _absolute(href: str, url: str) -> str:
    if not href or href.startswith("http"):
        return href
    host = re.match(r"https?://[^/]+", url or "")
    return (host.group(0) if host else "") + href


def _single(page: Page, url: str, has_next: bool) -> list[dict]:
    """A page with schema.org product markup but no listing."""
    top = page.nodes[0]
    name = page.first(top, ["[itemprop='name']"])
    if name is None:
        return []
    price, about, image = (page.first(top, [f"[itemprop='{p}']"]) for p in ("price", "description", "image"))
    return [{
        "card_no": 1, "kind": "single", "title": page.text(name),
        "price": price.attrs.get("content") if price else "0", "url": url,
        "image_url": image.attrs.get("src", "") if image else "",
        "description": page.text(about)[:SINGLE_DESCRIPTION_CHARS] if about else "", "has_next": has_next,
    }]


def page_items(html: str | None, url: str | None, theme: str) -> list[dict]:
    """All items of one page, in document order."""
    page, rules = Page(html or ""), THEMES[theme]
    top = page.nodes[0]
    has_next = page.first(top, rules["next"]) is not None
    cards = next((hits for hits in (page.select(top, s) for s in rules["cards"])
                  if len(hits) >= rules["min_cards"]), [])
    if not cards:
        return _single(page, url, has_next) if theme == "generic" else []
    items = []
    for card in cards:
        title = page.first(card, rules["title"])
        text = page.text(title) if title else ""
        # A card without title is no product; the woo theme leaves that to the title filter.
        if theme != "woocommerce" and (title is None or (theme == "generic" and not text)):
            continue
        price, link, image = page.first(card, rules["price"]), page.first(card, [rules["link"]]), page.first(card, ["img"])
        href = link.attrs.get("href", "") if link else ""
        host = re.match(r"https?://[^/]+", url or "")
        if theme == "generic":
            href = _absolute(href, url)
        elif theme == "shopify" and link:
            href = (host.group(0) if host else url or "") + href
        items.append({
            "card_no": len(items) + 1, "kind": "card", "title": text,
            "price": (page.text(price) if price else "") or "0", "url": href,
            "image_url": image.attrs.get("src", "") if image else "", "description": "", "has_next": has_next,
        })
    return items


def items_or_error(html: str | None, url: str | None, theme: str) -> list[dict]:
    """The page's items, or one row of kind "error" for a page that cannot be read."""
    try:
        return page_items(html, url, theme)
    except Exception as broken:  # one bad page must not end a run over many
        return [{"kind": "error", "error": f"{type(broken).__name__}: {broken}"[:500]}]


def landed_items(pages: DataFrame, theme: str = "generic") -> DataFrame:
    """Items and errors of pages ``(page_id, url, html)``: a row per card, single product or unreadable page."""
    kind = pages.schema["page_id"].dataType.simpleString()
    shape = _parse_datatype_string(f"page_id {kind}, page_url string, {CARD_FIELDS}")
    arrow = to_arrow_schema(shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for page_id, url, html in zip(*batch.columns):
                text, place = html.as_py(), url.as_py()
                rows.extend({"page_id": page_id.as_py(), "page_url": place, **item}
                            for item in items_or_error(text, place, theme))
                held += len(text or "")
                if held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, arrow)
                    rows, held = [], 0
            yield pa.RecordBatch.from_pylist(rows, arrow)

    items = pages.select("page_id", "url", "html").mapInArrow(run, shape)
    return items.withColumn("base_url", parse.base_url(F.col("page_url")))


def extract_items(pages: DataFrame, theme: str = "generic") -> DataFrame:
    """Items of pages: one row per card or single product."""
    return landed_items(pages, theme).where(F.col("error").isNull()).drop("error")


# Regular expressions for the two checks that need no tree.
NEXT_LINK = (
    r"(?is)<a\b[^>]*\brel=[\"']next[\"']|<a\b[^>]*\bclass=[\"'](?:[^\"']*\s)?next(?:\s[^\"']*)?[\"']"
    r"|\bclass=[\"'](?:[^\"']*\s)?pagination__next(?:\s[^\"']*)?[\"']|\baria-label=[\"']Next page[\"']"
)


def has_next_page(html):
    """Column form of the next-link check, for planning a crawl frontier."""
    return F.coalesce(html.rlike(NEXT_LINK), F.lit(False))
