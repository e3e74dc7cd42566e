"""Research papers: feed documents to flat, enriched records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemill.operators.enrich import attach_external_ids, attach_repo_stats
from tidemill.operators.filters import topic_filter
from tidemill.operators.limits import newest
from tidemill.operators.records import flatten, stamp, to_records
from tidemill.sources.feeds import scan_papers


def papers(
    feeds: DataFrame, as_of, topic: str | None = None, max_records: int | None = 1000,
    repos: DataFrame | None = None, ids: DataFrame | None = None, fill_repo: bool = False,
) -> DataFrame:
    """The newest papers on a topic with their repository's stars.

    The cut to ``max_records`` comes before the lookups. External ids leave the record as it is unless ``fill_repo`` takes
    a missing repository from their ``github_url``.
    """
    found = scan_papers(feeds)
    if topic:
        found = topic_filter(found, topic)
    found = newest(found, "published_date", max_records, "paper_url")
    if ids is not None and fill_repo:
        found = attach_external_ids(found, ids).withColumn(
            "github_url", F.coalesce("github_url", F.get_json_object("external_ids", "$.github_url"))
        )
    found = attach_repo_stats(found, repos) if repos is not None else found.withColumn("github_stars", F.lit(None).cast("int"))
    stamped = stamp(found, "ArXiv", F.col("paper_url"), as_of)
    fields = ("title", "authors", "paper_url", "github_url", "github_stars", "published_date")
    return flatten(to_records(stamped, "RESEARCH_PAPER", {f: F.col(f) for f in fields}))
