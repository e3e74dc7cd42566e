"""News, jobs and job listings: feed documents to flat records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemill.functions import text as X
from tidemill.functions.dates import normalize_date, parse_date, to_ist_iso
from tidemill.functions.strings import prefix, strip
from tidemill.operators.dedupe import keep_first
from tidemill.operators.enrich import attach_full_text
from tidemill.operators.filters import fresh, instant
from tidemill.operators.records import flatten, stamp, to_records
from tidemill.sources.feeds import scan_feed


def fresh_items(feeds: DataFrame, as_of, hours: int = 24) -> DataFrame:
    """Feed items with ``published_date``, stale ones dropped. Works on streams too."""
    return dated(scan_feed(feeds), as_of, hours)


def dated(items: DataFrame, as_of, hours: int = 24) -> DataFrame:
    """Items with ``published_date`` read from their ``date_text``, stale ones dropped."""
    return fresh(items.withColumn("published_date", normalize_date(F.col("date_text"), instant(as_of))), "published_date", as_of, hours)


def news_records(items: DataFrame, pages: DataFrame | None, as_of, summary_chars: int | None = 500, body_chars: int | None = 5000) -> DataFrame:
    """Records from fresh items; bodies are attached after the freshness filter, so stale items cost no lookup."""
    if pages is not None:
        items = attach_full_text(items, pages, "link", body_chars)
    else:
        items = items.withColumn("full_text", F.lit(None).cast("string"))
    stamped = stamp(items, F.col("source_name"), F.col("source_url"), as_of)
    return to_records(
        stamped, "NEWS",
        {
            "title": F.col("title"), "url": F.col("link"), "published_date": F.col("published_date"),
            "summary": prefix(strip(F.col("description")), summary_chars), "full_text": F.col("full_text"),
        },
    )


def job_records(items: DataFrame, as_of) -> DataFrame:
    stamped = stamp(items, F.col("source_name"), F.col("source_url"), as_of)
    return to_records(
        stamped, "JOB",
        {
            "company": X.company_at(F.col("title")), "date": F.col("published_date"),
            "is_remote": X.is_remote(F.col("title"), F.col("description")), "role_family": X.role_simple(F.col("title")),
        },
    )


def news(feeds: DataFrame, pages: DataFrame | None, as_of, summary_chars: int | None = 500, body_chars: int | None = 5000) -> DataFrame:
    """Fresh news with summary and article text from ``feeds(source_name, source_url, xml)`` and ``pages(url, html)``."""
    return flatten(news_records(fresh_items(feeds, as_of), pages, as_of, summary_chars, body_chars))


def jobs(feeds: DataFrame, as_of) -> DataFrame:
    """Fresh jobs with company, remote flag and role family."""
    return flatten(job_records(fresh_items(feeds, as_of), as_of))


def _ist(as_of) -> Column:
    return to_ist_iso(instant(as_of))


def job_listings(feeds: DataFrame, as_of, text_chars: int | None = 300, snippet_chars: int | None = 200) -> DataFrame:
    """Job listings, not only fresh ones, one per address: the first in feed order ``src_pos`` and item order."""
    description = F.coalesce(prefix(strip(F.col("description")), text_chars), F.lit(""))
    title, text = F.col("title"), F.col("_text")
    items = scan_feed(feeds, profile="lenient").withColumn("_text", description)
    rows = items.select(
        "src_pos", "item_pos",
        F.lit("JOB").alias("recordType"),
        F.col("source_name").alias("source.name"),
        F.col("source_url").alias("source.url"),
        title.alias("content.title"),
        X.company_from_title(title).alias("content.company"),
        F.col("link").alias("content.job_url"),
        to_ist_iso(parse_date(F.col("date_text"), instant(as_of))).alias("content.date"),
        X.is_remote(title, text).alias("content.is_remote"),
        X.role_family(title, text).alias("content.role_family"),
        prefix(text, snippet_chars).alias("content.description_snippet"),
        _ist(as_of).alias("collectedAt"),
    )
    return keep_first(rows, "content.job_url", ["src_pos", "item_pos"], drop_empty=False).drop("src_pos", "item_pos")
