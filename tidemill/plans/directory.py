"""Directory pages to startup and product records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemill.functions.text import heuristic_name, heuristic_price
from tidemill.operators.dedupe import entity_key, keep_first
from tidemill.operators.filters import instant
from tidemill.operators.limits import MAX_PAGES, page_quota
from tidemill.operators.records import RECORDS, SCHEMA_VERSION, flatten, record_type
from tidemill.operators.resolve import canonicalize
from tidemill.operators.tiers import first_valid_by_tier
from tidemill.session import cut
from tidemill.sources.cards import card_text

_NAME_FIELD = {"STARTUP": "entityName", "PRODUCT": "startupName", "ECOMMERCE_PRODUCT": "productName"}


def extraction_requests(pages: DataFrame, min_chars: int = 20, max_pages: int | None = MAX_PAGES) -> DataFrame:
    """Cards with the id their extraction request goes by; equal texts share one request."""
    cards = card_text(pages if max_pages is None else pages.filter(F.col("page_num") <= max_pages))
    return cards.withColumn("req_id", F.sha2("text", 256)).withColumn("long_enough", F.length("text") > min_chars)


def directory_records(
    pages: DataFrame, responses: DataFrame, entity_type: str, as_of, max_records: int | None = 1000, min_chars: int = 20,
    max_pages: int | None = MAX_PAGES,
) -> DataFrame:
    """One record per entity of each listing: the first valid extraction of a card, else the heuristic reading.

    ``pages`` holds ``start_url, page_num, url, html``, ``responses`` the stored answers by ``req_id``. The result has
    ``start_url`` beside the envelope. ``max_records`` and ``max_pages`` of a listing may be None.
    """
    kind = record_type(entity_type)
    schema = RECORDS[kind]
    cards = first_valid_by_tier(extraction_requests(pages, min_chars, max_pages), responses, schema)
    # A card that yields neither is still offered to the quota but not accepted. Unknown entity types have no heuristic.
    has_heuristic = entity_type in ("startup", "product", "ecommerce")
    name = heuristic_name(F.col("text")) if has_heuristic else F.lit(None).cast("string")
    judged = cards.withColumn("name", name).withColumn(
        "accepted", F.col("long_enough") & (F.col("record").isNotNull() | F.col("name").isNotNull())
    )
    # The quota reads the cards twice; pages and answers are parsed once.
    judged = cut(judged.drop("req_id", "tier"))
    taken = page_quota(judged, "accepted", max_records, max_pages=max_pages).filter("accepted")
    content = schema["content"].dataType
    guess = {
        "STARTUP": lambda: F.struct(
            F.col("name").alias("entityName"),
            F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in content["data"].dataType]).alias("data"),
        ),
        "PRODUCT": lambda: F.struct(F.col("name").alias("startupName"), F.lit("UNKNOWN").alias("pricingModel")),
        "ECOMMERCE_PRODUCT": lambda: F.struct(
            F.col("name").alias("productName"), heuristic_price(F.col("text")).alias("price"),
            F.lit(None).cast("string").alias("brand"), F.lit(None).cast("string").alias("rating"),
        ),
    }[kind]()
    extracted = F.col("record").isNotNull()
    records = taken.select(
        "start_url", "page_num", "pos",
        F.coalesce("record.schemaVersion", F.lit(SCHEMA_VERSION)).alias("schemaVersion"),
        F.lit(kind).alias("recordType"),
        F.struct(
            F.when(extracted, "Directory").otherwise("HeuristicFallback").alias("name"), F.col("url").alias("url")
        ).alias("source"),
        F.when(extracted, F.col("record.content")).otherwise(guess).alias("content"),
        instant(as_of).alias("collectedAt"),
    )
    keyed = records.withColumn("_name", entity_key(kind))
    return keep_first(keyed, ["start_url", "_name"], ["page_num", "pos"]).drop("_name", "page_num", "pos")


def directory(
    pages: DataFrame, responses: DataFrame, entity_type: str, seeds: DataFrame, as_of, max_records: int | None = 1000,
    max_pages: int | None = MAX_PAGES, **match,
) -> tuple[DataFrame, DataFrame]:
    """Flat records with canonical names, and the mapping log of the lookups."""
    kind = record_type(entity_type)
    field = _NAME_FIELD[kind]
    records = cut(directory_records(pages, responses, entity_type, as_of, max_records, max_pages=max_pages))
    named = records.withColumn("raw_name", F.col(f"content.{field}"))
    resolved = canonicalize(named, seeds, "raw_name", **match)
    envelope = ["schemaVersion", "recordType", "source", "content", "collectedAt"]
    flat = flatten(resolved.withColumn("content", F.col("content").withField(field, F.col("canonical_name"))).select(*envelope))
    return flat, resolved.select("raw_name", "canonical_name", "match_score")


def startups(pages: DataFrame, responses: DataFrame, seeds: DataFrame, as_of, max_records: int | None = 1000, **match):
    return directory(pages, responses, "startup", seeds, as_of, max_records, **match)


def products(
    pages: DataFrame, responses: DataFrame, seeds: DataFrame, as_of, max_records: int | None = 1000, ecommerce: bool = False, **match
):
    return directory(pages, responses, "ecommerce" if ecommerce else "product", seeds, as_of, max_records, **match)
