"""Main text of web pages by gradient-boosted trees over DOM nodes (operator 1).

Each node of a page (block elements and runs of text) is described by its tag and the tokens of its class, id and role (as log odds learnt in training,
for itself and along its ancestors), depth, subtree density, links, marks, and its siblings' and the page's text. Boosted trees turn that
into the odds that the node holds part of the main text.

Decoding is hierarchical: the best labelling of the whole tree in which nothing below a dropped node is kept. A subtree is dropped when the
evidence against all of it outweighs the best that can be made of it, so the decisions of a node and its descendants never contradict each other.

Training takes ``FIT_PAGES`` pages (a documented sample: those whose ids hash lowest among pages of at most ``FIT_CHARS`` characters). Pages that mark
their main text (``article`` or ``main``) teach by that; the same texts are also set into layouts of other kinds, with other tags and class
names, menus, side columns, notices, adverts, forms and reader comments, so that the model does not rest on one element.

Defined cases: a null page or one without text gives the empty text; broken markup is read forgivingly; a page in which no node is likely gives the empty
text; repeated rows are treated each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import random
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemill.llm import trees
from tidemill.llm.dom import Page

FIT_PAGES = 160
FIT_CHARS = 100_000
LAYOUTS = 4
MARK = r"(?i)<(?:article|main)(?=[\s/>])"
_MARKS, _DIGITS = ".,;:!?", "0123456789"

FEATURES = (
    "leaf", "tag", "tokens", "least_above", "most_above", "parent_odds", "depth", "letters", "link_share", "elements", "density", "leaf_letters",
    "page_share", "siblings", "sibling_share", "place", "before", "after", "marks", "digits", "start", "controls", "anchors", "height", "alike",
)


@dataclass(frozen=True)
class Model:
    tags: dict[str, float]
    tokens: dict[str, float]
    forest: trees.Forest


def describe(pages: list[Page], tags: dict[str, float], tokens: dict[str, float]) -> np.ndarray:
    """One row of ``FEATURES`` per node of all pages, one page after the other."""
    parent: list[int] = []
    roots: list[int] = []
    for page in pages:
        first = len(parent)
        parent += [p + first if p >= 0 else -1 for p in page.parent]
        roots += [first] * len(page.parent)
    tag = [t for page in pages for t in page.tag]
    text = [t for page in pages for t in page.text]
    n = len(tag)
    own = [len(t) for t in text]
    words = [t.count(" ") + 1 if t else 0 for t in text]
    marks = [sum(map(t.count, _MARKS)) if t else 0 for t in text]
    digits = [sum(map(t.count, _DIGITS)) if t else 0 for t in text]
    letters, elements, leaves, height = list(own), [1] * n, [int(bool(t)) for t in text], [0] * n
    links, controls, anchors, children = ([v for page in pages for v in getattr(page, name)] for name in ("links", "controls", "anchors", "children"))
    for i in range(n - 1, 0, -1):
        p = parent[i]
        if p < 0:
            continue
        letters[p] += letters[i]
        links[p] += links[i]
        elements[p] += elements[i]
        leaves[p] += leaves[i]
        controls[p] += controls[i]
        anchors[p] += anchors[i]
        marks[p] += marks[i]
        words[p] += words[i]
        digits[p] += digits[i]
        if height[p] <= height[i]:
            height[p] = height[i] + 1
    known, named = tags.get, tokens.get
    tag_odds = [known(t, 0.0) for t in tag]
    token_odds = [sum(sorted((named(t, 0.0) for t in ts), key=abs)[-2:]) if ts else 0.0 for page in pages for ts in page.tokens]
    depth, least, most, start, seen = [0] * n, [0.0] * n, [0.0] * n, [0] * n, 0
    nth, before, after, last, alike = [0] * n, [0] * n, [0] * n, [-1] * n, [0] * n
    kinds: dict[tuple[int, str], int] = defaultdict(int)
    for i, p in enumerate(parent):
        if p < 0:
            seen = own[i]
            continue
        start[i] = seen
        seen += own[i]
        depth[i] = depth[p] + 1
        both = tag_odds[p] + token_odds[p]
        least[i], most[i] = min(least[p], both), max(most[p], both)
        kinds[p, tag[i]] += 1
        if (sibling := last[p]) >= 0:
            nth[i] = nth[sibling] + 1
            before[i] = letters[sibling]
            after[sibling] = letters[i]
        last[p] = i
    alike = [kinds[p, t] if p >= 0 else 0 for p, t in zip(parent, tag)]
    up = np.array([p if p >= 0 else i for i, p in enumerate(parent)])
    letters, links, elements, leaves, marks, digits, words, anchors, count, tag_odds, token_odds = (
        np.array(v, np.float64) for v in (letters, links, elements, leaves, marks, digits, words, anchors, children, tag_odds, token_odds)
    )
    size = np.maximum(letters, 1)
    whole = size[np.array(roots)]
    siblings = count[up]
    return np.stack(
        [
            np.array(own) > 0, tag_odds, token_odds, least, most, (tag_odds + token_odds)[up], depth, np.log1p(letters), np.minimum(links / size, 1), np.log(elements),
            np.log1p(letters / elements), np.log1p(letters / np.maximum(leaves, 1)), letters / whole, np.log1p(siblings), letters / size[up],
            np.array(nth) / np.maximum(siblings, 1), np.log1p(before), np.log1p(after), marks / np.maximum(words, 1), digits / size, np.array(start) / whole,
            np.log1p(controls), anchors / np.maximum(words, 1), height, np.log1p(alike),
        ],
        axis=1,
    )


def decode(page: Page, odds: np.ndarray) -> list[bool]:
    """The nodes kept by the best labelling in which a kept node's ancestors are kept."""
    yes, no = -np.logaddexp(0, -odds), -np.logaddexp(0, odds)
    n = len(page.tag)
    dropped, kept = no.tolist(), yes.tolist()
    dropped[0], kept[0] = 0.0, 0.0
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        dropped[p] += dropped[i]
        kept[p] += max(kept[i], dropped[i])
    keep = [True] * n
    for i in range(1, n):
        keep[i] = keep[page.parent[i]] and kept[i] > dropped[i]
    return keep


def _text_of(page: Page, keep: list[bool]) -> str:
    return "\n".join([t for t, k in zip(page.text, keep) if t and k])


# --- training -----------------------------------------------------------------------------------------------------------------

#: Names that layouts of web pages commonly use, by the part of the page.
_NAMES = {
    "main": "content main post entry article story body text page-content post-content entry-content article-body main-content single hentry richtext prose",
    "menu": "nav menu navbar navigation topnav main-menu breadcrumb breadcrumbs pagination pager tabs toolbar site-nav skip-links toc",
    "top": "header masthead site-header topbar branding logo banner page-header top",
    "bottom": "footer site-footer bottom copyright colophon legal imprint credits",
    "side": "sidebar side aside widget related recommended more-stories popular rail secondary teaser promo newsletter tags tagcloud share social author-box",
    "notice": "cookie cookies consent notice alert gdpr banner-notice modal popup overlay disclaimer warning message",
    "ad": "ad ads advert advertisement sponsored sponsor promo-box banner-ad adsense adslot dfp commercial",
    "comments": "comments comment-list responses discussion disqus replies comment reader-comments respond thread feedback",
    "form": "search search-form login signup subscribe contact-form newsletter-form register",
}
_MENU = "Home About News Contact Products Archive Blog Login Search Sitemap Privacy Terms Help Sports Culture Startseite Impressum Accueil Inicio".split()
_NOTICES = ("We use cookies to improve your experience.", "This site uses cookies.", "Please enable scripts.", "Subscribe to keep reading.", "Wir verwenden Cookies.", "Nous utilisons des cookies.")


def _shaped(rng: random.Random, main: list[str], other: list[str]) -> tuple[str, set[int]]:
    """A page of an invented layout around the blocks ``main``; its blocks that are main text, by number among all blocks."""
    count, chosen, html = 0, set(), []

    def block(tag: str, text: str, is_main: bool = False, attrs: str = "") -> None:
        nonlocal count
        if is_main:
            chosen.add(count)
        count += 1
        html.append(f"<{tag}{attrs}>{text}</{tag}>")

    def named(part: str) -> str:
        if rng.random() < 0.12:
            return ""
        names = rng.sample(_NAMES[part].split(), rng.choice((1, 1, 2)))
        return f' {rng.choice(("class", "class", "id"))}="{" ".join(names)}"'

    def some(low: int, high: int) -> list[str]:
        return [rng.choice(other) for _ in range(rng.randint(low, high))]

    def menu(tag: str, part: str = "menu") -> None:
        html.append(f"<{tag}{named(part)}><ul>")
        for _ in range(rng.randint(3, 9)):
            word = rng.choice(_MENU) if rng.random() < 0.5 else rng.choice(rng.choice(other).split())
            block("li", f'<a href="/x">{word}</a>')
        html.append("</ul></" + tag + ">")

    def header() -> None:
        tag = rng.choice(("header", "div"))
        html.append(f"<{tag}{named('top') if tag == 'header' else ' class=' + chr(34) + rng.choice(_NAMES['top'].split()) + chr(34)}>")
        block("p", " ".join(rng.choice(other).split()[:6]))
        html.append(f"</{tag}>")

    def advert() -> None:
        block(rng.choice(("div", "div", "aside")), rng.choice(other), attrs=f' class="{rng.choice(_NAMES["ad"].split())}"')

    def notice() -> None:
        block(rng.choice(("div", "section")), rng.choice(_NOTICES) if rng.random() < 0.6 else rng.choice(other), attrs=f' class="{rng.choice(_NAMES["notice"].split())}"')

    def side() -> None:
        tag = rng.choice(("aside", "div", "section"))
        html.append(f"<{tag}{named('side') if tag == 'aside' else ' class=' + chr(34) + rng.choice(_NAMES['side'].split()) + chr(34)}>")
        block(rng.choice(("h3", "h4")), " ".join(rng.choice(other).split()[:4]))
        for t in some(1, 4):
            block(rng.choice(("p", "li", "div")), f'<a href="/y">{t[:90]}</a>' if rng.random() < 0.6 else t)
        html.append(f"</{tag}>")

    def form() -> None:
        html.append(f"<form{named('form')}><label>")
        block("p", " ".join(rng.choice(other).split()[:5]))
        html.append("</label><input type=text><select>")
        for t in some(0, 3):
            block("option", t.split()[0])
        html.append("</select>")
        block("button", rng.choice(("Send", "Search", "OK", "Subscribe")))
        html.append("</form>")

    def comments() -> None:
        tag = rng.choice(("section", "div", "ol", "aside"))
        html.append(f'<{tag} {rng.choice(("id", "class"))}="{rng.choice(_NAMES["comments"].split())}">')
        block("h3", f"{rng.randint(1, 40)} Comments")
        for t in some(1, 6):
            html.append(f'<div class="{rng.choice(("comment", "reply", "response", "comment-body", "item"))}">')
            if rng.random() < 0.6:
                block("p", " ".join(rng.choice(other).split()[:2]) + f" {rng.randint(1, 28)}.{rng.randint(1, 12)}.")
            block("p", t)
            html.append("</div>")
        html.append(f"</{tag}>")

    def article() -> None:
        wrap = rng.choice(("article", "main", "div", "div", "section", "td"))
        attrs = named("main") if wrap in ("article", "main") else f' {rng.choice(("class", "id"))}="{rng.choice(_NAMES["main"].split())}"'
        html.append("<table><tr><td" + attrs + ">" if wrap == "td" else f"<{wrap}{attrs}>")
        inner = rng.random() < 0.3
        html.append('<div class="inner">' if inner else "")
        if rng.random() < 0.8:
            block(rng.choice(("h1", "h1", "h2")), " ".join(main[0].split()[:10]), True)
        listing = 0
        for k, t in enumerate(main):
            if listing:
                block("li", t, True)
                listing -= 1
                html.append("</ul>" if not listing else "")
                continue
            if k and rng.random() < 0.06:
                block(rng.choice(("h2", "h3")), " ".join(t.split()[:5]), True)
            if k and rng.random() < 0.05:
                advert()
            if k + 3 < len(main) and rng.random() < 0.08:
                listing = rng.randint(1, 2)
                html.append("<ul>")
            block(rng.choice(("p", "p", "p", "p", "p", "p", "div", "blockquote")), t, True)
        html.append("</ul>" if listing else "")
        if rng.random() < 0.15:
            comments()
        html.append("</div>" if inner else "")
        html.append("</td></tr></table>" if wrap == "td" else f"</{wrap}>")

    if rng.random() < 0.5:
        notice()
    if rng.random() < 0.6:
        header()
    if rng.random() < 0.8:
        menu(rng.choice(("nav", "nav", "div", "header")))
    outer = rng.random() < 0.5
    html.append(f'<div class="{rng.choice(("wrapper", "container", "page", "layout", "row"))}">' if outer else "")
    for part in rng.sample((advert, side, menu_side := lambda: menu("div"), form), rng.randint(0, 2)):
        part()
    article()
    for part in rng.sample((advert, side, form, comments, menu_side, notice), rng.randint(0, 4)):
        part()
    html.append("</div>" if outer else "")
    if rng.random() < 0.85:
        tag = rng.choice(("footer", "footer", "div"))
        attrs = named("bottom") if tag == "footer" else f' class="{rng.choice(_NAMES["bottom"].split())}"'
        if rng.random() < 0.5:
            block(tag, "&copy; 2024 example &middot; " + rng.choice(other)[:120], attrs=attrs)
        else:
            html.append(f"<{tag}{attrs}>")
            menu("div")
            block("p", "Copyright " + rng.choice(other)[:60])
            html.append(f"</{tag}>")
    return "".join(html), chosen


def _marked(page: Page) -> list[bool] | None:
    """Which leaves lie in the page's ``article`` or ``main``; None when it has neither."""
    inside = [False] * len(page.tag)
    for i in range(1, len(page.tag)):
        inside[i] = inside[page.parent[i]] or page.tag[i] in ("article", "main")
        if page.tag[i] in ("nav", "aside", "footer", "form"):
            inside[i] = False
    return [k and bool(t) for k, t in zip(inside, page.text)] if any(inside) else None


def _examples(htmls: list[str], seed: int = 1) -> Iterator[tuple[Page, list[bool]]]:
    """Pages with their main leaves: those marked by the page itself, and the layouts made around their texts; around all texts when no page is marked."""
    rng = random.Random(seed)
    read = [Page(html) for html in htmls]
    marked = [(page, main) for page in read if any(main := _marked(page) or [])]
    yield from marked
    texts = [[t for t, m in zip(page.text, main) if m] for page, main in marked] or [ts for page in read if (ts := _long_texts(page))]
    paragraphs = [t for ts in texts for t in ts]
    if not paragraphs:
        return
    for ts in texts:
        for _ in range(LAYOUTS):
            begin = rng.randrange(len(ts))
            own = [t.replace("&", "&amp;").replace("<", "&lt;") for t in ts[begin:begin + rng.randint(1, 14)]]
            other = [rng.choice(paragraphs)[: rng.choice((60, 200, 600))].replace("&", "&amp;").replace("<", "&lt;") for _ in range(12)]
            html, chosen = _shaped(rng, own, other)
            page = Page(html)
            leaves = [i for i, t in enumerate(page.text) if t]
            main = [False] * len(page.tag)
            for number in chosen:
                main[leaves[number]] = True
            yield page, main


def _long_texts(page: Page) -> list[str]:
    """The longer leaves of a page that are mostly not links, or all leaves when it has none."""
    return [t for t, k in zip(page.text, page.links) if len(t) >= 80 and 2 * k < len(t)] or [t for t in page.text if t]


def _spread(page: Page, main: list[bool]) -> list[bool]:
    """A node holds main text when a node below it does."""
    out = list(main)
    for i in range(len(out) - 1, 0, -1):
        out[page.parent[i]] |= out[i]
    return out


def fit_pages(htmls: list[str]) -> Model | None:
    """The model of a sample of pages; None when no page has any text."""
    examples = [(page, _spread(page, main)) for page, main in _examples(htmls)]
    if not examples:
        return None
    counts: dict[str, dict[str, list[int]]] = {"tag": defaultdict(lambda: [0, 0]), "token": defaultdict(lambda: [0, 0])}
    for page, label in examples:
        for tag, tokens, yes in zip(page.tag[1:], page.tokens[1:], label[1:]):
            counts["tag"][tag][yes] += 1
            for token in tokens:
                counts["token"][token][yes] += 1
    tags = {t: float(np.log((y + 1) / (n + 1))) for t, (n, y) in counts["tag"].items()}
    tokens = {t: float(np.log((y + 1) / (n + 1))) for t, (n, y) in counts["token"].items() if n + y >= 3}
    x = describe([page for page, _ in examples], tags, tokens)
    y = np.concatenate([np.array(label, np.float64) for _, label in examples])
    below = np.concatenate([np.arange(len(label)) > 0 for _, label in examples])  # the page itself is never dropped
    return Model(tags, tokens, trees.fit(x[below], y[below]))


def _sampled(pages: DataFrame, begin: Column, sample: int, chars: int) -> list[str]:
    """At most ``sample`` pages, those of at most ``chars`` characters first; of a longer one that many characters around position ``begin``."""
    long = F.length("html") > chars
    part = F.when(long, F.substr("html", F.greatest(F.lit(1), begin - chars // 4), F.lit(chars))).otherwise(F.col("html"))
    every = pages.select("page_id", F.xxhash64("html").alias("hash"), long.alias("long"), part.alias("html"))
    chosen = every.select("page_id", "hash", "long").distinct().orderBy("long", F.xxhash64("page_id"), "page_id", "hash").limit(sample)  # ids only
    chosen = chosen.select(F.col("page_id").alias("id"), F.col("hash").alias("h"))
    met = every.join(F.broadcast(chosen), F.col("page_id").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("h")))
    rows = met.groupBy("id", "h").agg(F.first("html").alias("html")).orderBy("id", "h").collect()  # bounded by both parameters
    return [r.html for r in rows]


def fit(pages: DataFrame, *, sample: int = FIT_PAGES, chars: int = FIT_CHARS) -> Model | None:
    """The model of at most ``sample`` pages of ``pages(page_id, html)`` that mark their main text, or of any when none does."""
    filled = pages.select("page_id", "html").filter(F.length("html") > 0)
    marked = _sampled(filled.filter(F.col("html").rlike(MARK)), F.regexp_instr("html", F.lit(MARK)), sample, chars)
    return fit_pages(marked or _sampled(filled, F.lit(1), sample, chars))


def extract_one(html: str, model: Model) -> str:
    page = Page(html)
    return _text_of(page, decode(page, model.forest.log_odds(describe([page], model.tags, model.tokens))))


def extract(pages: DataFrame, model: Model | None) -> DataFrame:
    """``pages(page_id, url, html)``: ``page_id, url, text, n_chars``."""

    def texts(htmls: list[str | None]) -> list[str]:
        read = [Page(h or "") for h in htmls]
        if model is None:
            return ["" for _ in read]
        odds = model.forest.log_odds(describe(read, model.tags, model.tokens))
        ends = np.cumsum([len(p.tag) for p in read])
        return [_text_of(p, decode(p, odds[e - len(p.tag):e])) for p, e in zip(read, ends.tolist())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = texts(part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, pa.string()), pa.array(list(map(len, found)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
