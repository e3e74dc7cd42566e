"""RSS, Atom and paper feeds: one payload column of XML documents to one row per item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemill.functions.dates import parse_paper_date
from tidemill.functions.strings import let, null_if_empty, strip
from tidemill.functions.text import paper_title
from tidemill.functions.urls import repo_url

# An element is an array of structs, so a missing one (null) differs from an empty one. Dates stay text.
_TEXT = "array<struct<_VALUE:string,_x:string>>"
_ITEM = (
    f"title:{_TEXT},link:array<struct<_VALUE:string,_href:string>>,pubDate:{_TEXT},updated:{_TEXT},published:{_TEXT},"
    f"description:{_TEXT},summary:{_TEXT},content:{_TEXT}"
)
FEED_SCHEMA = (
    f"channel struct<item:array<struct<{_ITEM}>>,entry:array<struct<{_ITEM}>>>, "
    f"item array<struct<{_ITEM}>>, entry array<struct<{_ITEM}>>"
)
ITEM_SCHEMA = f"struct<{_ITEM}>"
PAPER_SCHEMA = (
    f"entry array<struct<title:{_TEXT},id:{_TEXT},published:{_TEXT},summary:{_TEXT},author:array<struct<name:{_TEXT}>>>>"
)


def _present(element: Column) -> Column:
    return F.size(element) > 0


def _text(element: Column) -> Column:
    """Text of the first such element: empty when the element is empty, null when there is none."""
    return F.when(_present(element), F.coalesce(F.get(element, F.lit(0))["_VALUE"], F.lit("")))


def _items(doc: Column) -> Column:
    """All ``item`` elements of a document or, when it has none, all ``entry`` elements."""
    none = F.array().cast(f"array<struct<{_ITEM}>>")

    def both(name: str) -> Column:
        return F.concat(F.coalesce(doc["channel"][name], none), F.coalesce(doc[name], none))

    return F.when(F.size(both("item")) > 0, both("item")).otherwise(both("entry"))


def scan_feed(feeds: DataFrame, xml: str = "xml", profile: str = "news") -> DataFrame:
    """Items of RSS and Atom documents with ``item_pos, title, link, date_text, description``; other columns stay.

    ``news``: items without a title or link element are dropped; an empty link takes the ``href``, else stays empty.
    ``lenient``: items without a title are dropped; a missing link falls back to ``source_url``, a missing
    description to the content. Both keep a missing date or description null.
    """
    kept = [c for c in feeds.columns if c != xml]
    items = feeds.withColumn("_doc", F.from_xml(F.col(xml), FEED_SCHEMA)).select(
        *kept, F.posexplode(let(F.col("_doc"), _items)).alias("item_pos", "_i")
    )
    present, fields = item_fields(F.col("_i"), profile)
    return items.filter(present).select(*kept, "item_pos", *[c.alias(n) for n, c in fields.items()])


def item_fields(i: Column, profile: str = "news") -> tuple[Column, dict[str, Column]]:
    """Whether an item element has what an item needs, and its ``title, link, date_text, description``."""
    href = F.get(i["link"], F.lit(0))["_href"]
    link_text = null_if_empty(strip(_text(i["link"])))
    dates = F.coalesce(*[_text(i[c]) for c in ("pubDate", "updated", "published")])
    descriptions = [_text(i[c]) for c in ("description", "summary")]
    if profile == "news":
        present = _present(i["title"]) & _present(i["link"])
        link, description = F.coalesce(link_text, href, F.lit("")), F.coalesce(*descriptions)
    elif profile == "lenient":
        present = strip(_text(i["title"])) != ""
        link, description = F.coalesce(link_text, href, F.col("source_url")), F.coalesce(*descriptions, _text(i["content"]))
    else:
        raise ValueError(f"unknown profile {profile!r}")
    return present, {"title": strip(_text(i["title"])), "link": link, "date_text": strip(dates), "description": description}


def scan_papers(feeds: DataFrame, xml: str = "xml") -> DataFrame:
    """Papers of an Atom feed; an entry without a title, id, strict date or with a nameless author is skipped."""
    kept = [c for c in feeds.columns if c != xml]
    entries = feeds.withColumn("_doc", F.from_xml(F.col(xml), PAPER_SCHEMA)).select(
        *kept, F.posexplode("_doc.entry").alias("entry_pos", "_e")
    )
    e = F.col("_e")
    authors = F.transform(F.coalesce(e["author"], F.array().cast(f"array<struct<name:{_TEXT}>>")), lambda a: _text(a["name"]))
    abstract = F.coalesce(_text(e["summary"]), F.lit(""))
    papers = entries.select(
        *kept, "entry_pos",
        paper_title(_text(e["title"])).alias("title"),
        authors.alias("authors"),
        strip(_text(e["id"])).alias("paper_url"),
        parse_paper_date(_text(e["published"])).alias("published_date"),
        abstract.alias("abstract"),
        repo_url(abstract).alias("github_url"),
    )
    named = ~F.exists("authors", lambda a: a.isNull())
    return papers.dropna(subset=["title", "paper_url", "published_date"]).filter(named)
