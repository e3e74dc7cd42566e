"""The ordered list of sources. Addresses are data; their order decides which duplicate is kept first."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemill.session import BROADCAST_ROWS, is_small

# The default sources in order, as (kind, name, address).
DEFAULT_SOURCES = (
    ("news", "TechCrunch", "https://techcrunch.com/feed/"),
    ("news", "The Verge", "https://www.theverge.com/rss/index.xml"),
    ("news", "HackerNews", "https://hnrss.org/frontpage"),
    ("news", "BBC Technology", "http://feeds.bbci.co.uk/news/technology/rss.xml"),
    ("news", "Wired", "https://www.wired.com/feed/category/gear/latest/rss"),
    ("jobs", "YC HackerNews Jobs", "https://hnrss.org/jobs"),
    ("jobs", "RemoteOK", "https://remoteok.com/rss"),
    ("jobs", "WeWorkRemotely", "https://weworkremotely.com/categories/remote-programming-jobs.rss"),
    ("jobs", "Python.org Jobs", "https://www.python.org/jobs/feed/rss/"),
    ("jobs", "Unstop", "https://unstop.com/feed"),
    ("listings", "HackerNews Jobs", "https://hnrss.org/jobs"),
    ("listings", "HN Internships", "https://hnrss.org/jobs?q=intern"),
    ("listings", "HN Engineer Jobs", "https://hnrss.org/jobs?q=engineer"),
    ("listings", "WeWorkRemotely", "https://weworkremotely.com/categories/remote-programming-jobs.rss"),
    ("listings", "WeWorkRemotely Dev", "https://weworkremotely.com/categories/remote-dev-software-jobs.rss"),
    ("listings", "Unstop", "https://unstop.com/feed"),
    ("listings", "Python.org Jobs", "https://www.python.org/jobs/feed/rss/"),
)
SCHEMA = "src_pos int, kind string, source_name string, source_url string"


def registry(spark: SparkSession, sources=DEFAULT_SOURCES) -> DataFrame:
    """``src_pos, kind, source_name, source_url`` from ordered ``(kind, name, address)`` triples."""
    return spark.createDataFrame([(i, *s) for i, s in enumerate(sources)], SCHEMA)


def with_source(payloads: DataFrame, sources: DataFrame, kind: str) -> DataFrame:
    """Landed payloads with the position and name of their source, by address; unknown addresses are dropped."""
    wanted = sources.filter(F.col("kind") == kind).drop("kind")
    return payloads.join(F.broadcast(wanted) if is_small(wanted, BROADCAST_ROWS) else wanted, "source_url")
