"""Cards of directory and marketplace pages.

Company cards need anchors only and stay native. Nested cards need the element tree; pages that can hold any are chosen
by a native filter first, and Python's own HTML parser reads those inside Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidemill.functions.html import link_array, text_nodes
from tidemill.functions.strings import non_empty, prefix
from tidemill.functions.urls import product_url

# A card is a div or li one of whose classes contains one of these.
CARD_CLASSES = ("card", "item", "result", "product", "grid")
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_SILENT = {"script", "style", "template"}


# --- element tree ---------------------------------------------------------------------------------------


@dataclass
class Element:
    tag: str
    attrs: dict
    first_text: int
    last_text: int = -1
    last_element: int = -1

    @property
    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()


@dataclass
class Page(HTMLParser):
    """Elements in document order, each with its range of texts and of descendants."""

    elements: list[Element] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)

    def __post_init__(self):
        HTMLParser.__init__(self, convert_charrefs=True)
        self._open: list[int] = []
        self._silent = 0

    @classmethod
    def parse(cls, html: str) -> Page:
        page = cls()
        page.feed(html)
        page.close()
        while page._open:
            page._close_last()
        return page

    def _close_last(self):
        element = self.elements[self._open.pop()]
        element.last_text, element.last_element = len(self.texts), len(self.elements)
        self._silent -= element.tag in _SILENT

    def handle_starttag(self, tag, attrs):
        values: dict = {}
        for name, value in attrs:
            values[name] = value or ""
        self.elements.append(Element(tag, values, len(self.texts)))
        self._open.append(len(self.elements) - 1)
        self._silent += tag in _SILENT
        if tag in _VOID:
            self._close_last()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self._close_last()

    def handle_endtag(self, tag):
        if any(self.elements[i].tag == tag for i in self._open):
            while self.elements[self._open[-1]].tag != tag:
                self._close_last()
            self._close_last()

    def handle_data(self, data):
        if not self._silent and data.strip():
            self.texts.append(data.strip())

    def text(self, element: Element, separator: str) -> str:
        return separator.join(self.texts[element.first_text : element.last_text])

    def inside(self, index: int) -> list[Element]:
        return self.elements[index + 1 : self.elements[index].last_element]


# --- directory cards ---------------------------------------------------------------------------------------


def _card_texts(html: str, list_items_too: bool) -> list[str]:
    page = Page.parse(html)
    found = [
        e for e in page.elements
        if e.tag in ("div", "li") and any(k in c.lower() for c in e.classes for k in CARD_CLASSES)
    ]
    if not found and list_items_too:
        found = [e for e in page.elements if e.tag == "li"]
    return [page.text(e, " | ") for e in found]


def card_text(pages: DataFrame, html: str = "html", page_num: str | None = "page_num") -> DataFrame:
    """One row ``pos, text`` per card of a page, nested cards included, outer first; other columns stay.

    A first page without cards gives all its list items instead; without ``page_num`` every page is a first page.
    """
    kept = [f for f in pages.schema.fields if f.name != html]
    words = "|".join(CARD_CLASSES)
    first = F.col(page_num) == 1 if page_num else F.lit(True)
    candidates = pages.filter(
        F.col(html).rlike(rf"""(?is)<(?:div|li)\s[^>]*class\s*=[^>]*(?:{words})""") | (first & F.col(html).rlike(r"(?i)<li[\s>/]"))
    )
    names = [f.name for f in kept]

    def cards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            is_first = batch["_first"]
            found = [_card_texts(h, bool(f)) for h, f in zip(batch[html], is_first)]
            rows = batch[names].assign(text=found, pos=[list(range(len(x))) for x in found])
            yield rows[rows["text"].map(len) > 0].explode(["text", "pos"])[[*names, "pos", "text"]]

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], "pos int", "text string"])
    return candidates.select(*names, html, first.alias("_first")).mapInPandas(cards, schema)


def company_cards(pages: DataFrame, html: str = "html", url: str = "url", description_chars: int | None = 200) -> DataFrame:
    """Company links of a directory page: ``pos, name, description, href``; names of one character are skipped.

    The name is the anchor's first text, the description the next two, cut to ``description_chars``.
    """
    kept = [c for c in pages.columns if c != html]
    links = pages.select(*kept, F.explode(link_array(F.col(html))).alias("_l")).filter(
        F.col("_l.href").rlike(r"^/companies/[a-z0-9\-]+$")
    )
    texts = non_empty(F.split(F.array_join(text_nodes(F.col("_l.inner")), "|"), r"\|", -1))
    return (
        links.withColumn("_texts", texts)
        .filter(F.length(F.get("_texts", F.lit(0))) >= 2)
        .select(
            *kept, F.col("_l.pos").alias("pos"),
            F.get("_texts", F.lit(0)).alias("name"),
            F.when(F.size("_texts") > 1, prefix(F.array_join(F.slice("_texts", 2, 2), " "), description_chars)).alias("description"),
            F.col("_l.href").alias("href"),
        )
    )


# --- marketplace cards ---------------------------------------------------------------------------------------

#: ``(field, tag, class, attribute)`` in order of preference; an empty string matches anything.
MARKETPLACE_SELECTORS = (
    ("card", "div", "_1AtVbE", ""), ("card", "div", "DOjaWF", ""), ("card", "div", "_13oc-S", ""), ("card", "div", "", "data-id"),
    ("name", "div", "_4rR01T", ""), ("name", "a", "s1Q9rs", ""), ("name", "div", "KzDlHZ", ""), ("name", "a", "", "title"),
    ("link", "a", "", "href"),
    ("price", "div", "_30jeq3", ""), ("price", "div", "Nx9bqj", ""),
    ("rating", "div", "_3LWZlK", ""), ("rating", "div", "XQDdHH", ""),
)


def _selects(selector, element: Element) -> bool:
    _, tag, css_class, attribute = selector
    return (
        element.tag == tag
        and (not css_class or css_class in element.classes)
        and (not attribute or attribute in element.attrs)
    )


def _marketplace_rows(html: str, selectors) -> list[tuple]:
    page = Page.parse(html)

    def of(name):
        return [s for s in selectors if s[0] == name]

    cards: list[int] = []
    for selector in of("card"):
        cards = [i for i, e in enumerate(page.elements) if _selects(selector, e)]
        if cards:
            break

    def pick(index, name):
        for selector in of(name):
            for e in page.inside(index):
                if _selects(selector, e):
                    return e
        return None

    rows = []
    for pos, index in enumerate(cards):
        found = {name: pick(index, name) for name in ("name", "link", "price", "rating")}
        texts = {k: page.text(found[k], "") if found[k] else None for k in ("name", "price", "rating")}
        href = found["link"].attrs["href"] if found["link"] else None
        rows.append((pos, texts["name"], href, texts["price"], texts["rating"]))
    return rows


def selector_cards(
    pages: DataFrame, site: str, html: str = "html", selectors=MARKETPLACE_SELECTORS, min_chars: int = 5
) -> DataFrame:
    """Product cards found by ordered selector alternatives: ``pos, product_name, product_url, price, rating``.

    Cards with a shorter name or without a link are skipped; links become absolute and lose their query.
    """
    kept = [f for f in pages.schema.fields if f.name != html]
    names = [f.name for f in kept]
    chosen = [tuple(s) for s in selectors]

    def cards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = batch[names].assign(_row=[_marketplace_rows(h or "", chosen) for h in batch[html]]).explode("_row")
            rows = rows[rows["_row"].notna()]
            fields = pd.DataFrame(rows["_row"].tolist(), columns=["pos", "product_name", "href", "price", "rating"], index=rows.index)
            yield pd.concat([rows[names].reset_index(drop=True), fields.reset_index(drop=True)], axis=1)

    schema = ", ".join(
        [*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], "pos int, product_name string, href string, price string, rating string"]
    )
    found = pages.select(*names, html).mapInPandas(cards, schema)
    return found.filter((F.length("product_name") >= min_chars) & (F.col("href") != "")).select(
        *names, "pos", "product_name", product_url(site, F.col("href")).alias("product_url"), "price", "rating"
    )
