"""Catalog and food JSON pages: one payload column to one row per product."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemill.functions.strings import null_if_empty, prefix
from tidemill.functions.text import dollar_price

_CATALOG = (
    "products array<struct<title:string,handle:string,vendor:string,product_type:string,tags:array<string>,"
    "variants:array<struct<price:string,available:boolean>>>>"
)
_FOOD = (
    "products array<struct<product_name:string,product_name_en:string,code:string,brands:string,"
    "categories_tags:array<string>,nutriscore_grade:string,quantity:string,countries:string>>"
)
# The address food products without a barcode get, and the prefix of those with one.
FOOD_SITE = "https://world.openfoodfacts.org"


def _products(pages: DataFrame, json: str, schema: str) -> tuple[DataFrame, list[str]]:
    kept = [c for c in pages.columns if c != json]
    parsed = pages.withColumn("_doc", F.from_json(F.col(json), schema))
    return parsed.select(*kept, F.posexplode("_doc.products").alias("item_pos", "_p")), kept


def scan_catalog(pages: DataFrame, json: str = "json", tag_chars: int | None = 100) -> DataFrame:
    """Products of store pages ``store, base_url, page_num, json``; products without a title are skipped, joined tags cut to ``tag_chars``."""
    products, kept = _products(pages, json, _CATALOG)
    p = F.col("_p")
    text = lambda name: F.coalesce(p[name], F.lit(""))
    return products.filter(text("title") != "").select(
        *kept, "item_pos",
        p["title"].alias("product_name"),
        F.concat(F.replace(F.col("base_url"), F.lit("/products.json"), F.lit("")), F.lit("/products/"), text("handle")).alias("product_url"),
        F.coalesce(null_if_empty(p["product_type"]), F.lit("General")).alias("category"),
        text("vendor").alias("brand"),
        dollar_price(F.get(p["variants"], F.lit(0))["price"]).alias("price"),
        F.lit("USD").alias("currency"),
        F.coalesce(F.exists(p["variants"], lambda v: F.coalesce(v["available"], F.lit(False))), F.lit(False)).alias("available"),
        prefix(F.array_join(F.coalesce(p["tags"], F.array()), ", "), tag_chars).alias("tags"),
    )


def scan_food(pages: DataFrame, json: str = "json", profile: str = "catalog", min_chars: int = 3, country_chars: int | None = 80) -> DataFrame:
    """Products of food pages ``label, json`` whose name has at least ``min_chars`` characters.

    ``catalog`` adds the first category tag; ``nutrition`` adds grade, quantity and countries, cut to ``country_chars``, instead.
    """
    products, kept = _products(pages, json, _FOOD)
    p = F.col("_p")
    text = lambda name: F.coalesce(p[name], F.lit(""))
    url = F.when(text("code") != "", F.concat(F.lit(f"{FOOD_SITE}/product/"), p["code"])).otherwise(F.lit(FOOD_SITE))
    extra = {
        "catalog": [F.replace(F.coalesce(F.get(p["categories_tags"], F.lit(0)), F.lit("")), F.lit("en:"), F.lit("")).alias("tags")],
        "nutrition": [
            text("quantity").alias("quantity"),
            F.upper(text("nutriscore_grade")).alias("nutriscore"),
            null_if_empty(prefix(p["countries"], country_chars)).alias("countries"),
        ],
    }[profile]
    return (
        products.withColumn("product_name", F.coalesce(null_if_empty(p["product_name"]), p["product_name_en"]))
        .filter(F.length("product_name") >= min_chars)
        .select(
            *kept, "item_pos", "product_name", url.alias("product_url"), F.col("label").alias("category"),
            text("brands").alias("brand"), *extra,
        )
    )
