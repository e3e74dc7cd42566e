"""Enrichment joins. Every right side is reduced to one row per key first, so no join multiplies rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemill.functions.html import main_text
from tidemill.functions.strings import null_if_empty
from tidemill.functions.urls import last_segment, repo_key


def _left_join(df: DataFrame, key: Column, lookup: DataFrame, lookup_key: Column, values: dict[str, Column], landed: str | None) -> DataFrame:
    """Left join on a text key. Rows without a key get one that matches nothing and differs from row to row.

    Nulls would all go to one task; this spreads them, and the same row always goes the same way. Of several rows of one key the
    one landed last counts; without ``landed``, or if several landed then, the one whose values come first as JSON text.
    """
    at = F.col(landed) if landed else F.lit(0)
    right = lookup.select(lookup_key.alias("_rk"), at.alias("_at"), F.struct(*[v.alias(k) for k, v in values.items()]).alias("_v")).filter(F.col("_rk").isNotNull())
    last = right.groupBy("_rk").agg(F.max(F.struct("_at")).alias("_last")) if landed else None
    if last is not None:
        right = right.join(last, "_rk").filter(F.struct("_at").eqNullSafe(F.col("_last")))
    unique = right.groupBy("_rk").agg(F.min_by("_v", F.to_json("_v")).alias("_v")).select("_rk", *[F.col(f"_v.`{k}`").alias(k) for k in values])
    spread = F.concat(F.lit("\u0000"), F.xxhash64(*df.columns).cast("string"))
    keyed = df.withColumn("_lk", F.coalesce(key, spread))
    return keyed.join(unique, F.col("_lk") == F.col("_rk"), "left").select(*df.columns, *values)


def attach_full_text(news: DataFrame, pages: DataFrame, url: str = "url", max_chars: int | None = 5000, landed: str | None = None) -> DataFrame:
    """Adds ``full_text``: the main text of the page at the item's link; null without a link or a page.

    Only pages some item links to are parsed: the semi-join runs before the text extraction. ``max_chars=None`` leaves the text whole;
    ``landed`` names the column by which the latest copy of a page is taken.
    """
    wanted = news.select(F.col(url).alias("url")).filter(F.col("url") != "").distinct()
    kept = ["url", *([landed] if landed else [])]
    bodies = pages.select(*kept, "html").join(wanted, "url", "left_semi")
    texts = bodies.select(*kept, main_text(F.col("html"), max_chars).alias("full_text"))
    return _left_join(news, null_if_empty(F.col(url)), texts, F.col("url"), {"full_text": F.col("full_text")}, landed)


def attach_repo_stats(papers: DataFrame, repos: DataFrame, github_url: str = "github_url", landed: str | None = None) -> DataFrame:
    """Adds ``github_stars`` from ``repos(repo, stars)`` by owner and name; null without a repository."""
    return _left_join(
        papers, repo_key(F.col(github_url)), repos, F.col("repo"), {"github_stars": F.col("stars").cast("int")}, landed
    )


def attach_external_ids(papers: DataFrame, ids: DataFrame, paper_url: str = "paper_url", github_url: str = "github_url", landed: str | None = None) -> DataFrame:
    """Adds ``external_ids`` from ``ids(paper_id, external_ids)``, looked up only for papers without a repository."""
    key = F.when(F.col(github_url).isNull(), last_segment(F.col(paper_url)))
    return _left_join(papers, key, ids, F.col("paper_id"), {"external_ids": F.col("external_ids")}, landed)
