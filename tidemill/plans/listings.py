"""Store catalogs, food pages, marketplace cards, company lists and text chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemill.functions.dates import to_ist_iso
from tidemill.functions.html import clean_html
from tidemill.functions.tokens import chunk
from tidemill.operators.dedupe import keep_first
from tidemill.operators.filters import instant
from tidemill.operators.limits import category_cap
from tidemill.operators.records import SCHEMA_VERSION
from tidemill.operators.resolve import canonicalize
from tidemill.session import cut
from tidemill.sources.cards import company_cards, selector_cards
from tidemill.sources.catalog import scan_catalog, scan_food
from tidemill.sources.sinks import union_ragged


def _dotted(df: DataFrame, source_name: Column, source_url: Column, content: dict[str, Column], as_of) -> DataFrame:
    return df.select(
        F.lit("ECOMMERCE_PRODUCT").alias("recordType"), source_name.alias("source.name"), source_url.alias("source.url"),
        *[v.alias(f"content.{k}") for k, v in content.items()], to_ist_iso(instant(as_of)).alias("collectedAt"),
    )


def _content(**fields: str | None) -> dict[str, Column]:
    names = {"productName": "product_name", **fields}
    return {k: F.col(v) if v else F.lit(None).cast("string") for k, v in names.items()}


def store_products(catalog: DataFrame, as_of, tag_chars: int | None = 100) -> DataFrame:
    """Products of ``store_pos, store, base_url, page_num, json``, one per address: the first in store and page order."""
    first = keep_first(scan_catalog(catalog, tag_chars=tag_chars), "product_url", ["store_pos", "page_num", "item_pos"])
    content = _content(
        category="category", brand="brand", price="price", currency="currency", available="available", tags="tags",
        product_url="product_url",
    )
    return _dotted(first, F.col("store"), F.col("product_url"), content, as_of)


def food_products(food: DataFrame, as_of, target: int | None = 400) -> DataFrame:
    """Products of ``category_pos, label, json``; no further category is started once ``target`` rows are there (None: all)."""
    rows = category_cap(scan_food(food), "category_pos", target).withColumn("available", F.lit(True))
    content = _content(
        category="category", brand="brand", price=None, currency=None, available="available", tags="tags", product_url="product_url"
    )
    return _dotted(rows, F.lit("Open Food Facts"), F.col("product_url"), content, as_of)


def nutrition_products(food: DataFrame, as_of, country_chars: int | None = 80) -> DataFrame:
    """The variant of ``label, source_url, json`` with grade, quantity and countries."""
    content = _content(
        category="category", price=None, brand="brand", quantity="quantity", nutriscore="nutriscore", countries="countries",
        product_url="product_url",
    )
    return _dotted(scan_food(food, profile="nutrition", country_chars=country_chars), F.lit("Open Food Facts"), F.col("source_url"), content, as_of)


def marketplace_products(pages: DataFrame, site_name: str, site: str, as_of, **options) -> DataFrame:
    """Products of marketplace pages ``category, source_url, html``."""
    content = _content(category="category", price="price", rating="rating", product_url="product_url")
    return _dotted(selector_cards(pages, site, **options), F.lit(site_name), F.col("source_url"), content, as_of)


def catalog_products(*parts: DataFrame) -> DataFrame:
    """All product rows under the union of their columns."""
    return union_ragged(*parts)


def company_list(pages: DataFrame, seeds: DataFrame, site: str, source_name: str, stage: str, as_of, description_chars: int | None = 200, **match) -> tuple[DataFrame, DataFrame]:
    """Companies linked from directory pages ``page_num, url, html``, one per name, and the mapping log.

    Names are looked up as they are, without cleaning.
    """
    first = cut(keep_first(company_cards(pages, description_chars=description_chars), "name", ["page_num", "pos"]))
    resolved = canonicalize(first, seeds, "name", clean=False, **match)
    missing = F.lit(None).cast("string")
    rows = resolved.select(
        F.lit(SCHEMA_VERSION).alias("schemaVersion"),
        F.lit("STARTUP").alias("recordType"),
        F.lit(source_name).alias("source.name"),
        F.concat(F.lit(site), F.col("href")).alias("source.url"),
        F.col("canonical_name").alias("content.entityName"),
        F.col("description").alias("content.data.description"),
        missing.alias("content.data.batch"),
        missing.cast("int").alias("content.data.foundedYear"),
        F.lit(stage).alias("content.data.fundingStage"),
        to_ist_iso(instant(as_of)).alias("collectedAt"),
    )
    return rows, resolved.select(F.col("name").alias("raw_name"), "canonical_name", "match_score")


def chunks(pages: DataFrame, max_tokens: int = 4000, encoding: str | None = None) -> DataFrame:
    """Cleaned page text in consecutive token windows."""
    kept = [c for c in pages.columns if c != "html"]
    return chunk(pages.select(*kept, clean_html(F.col("html")).alias("text")), "text", max_tokens, encoding)
