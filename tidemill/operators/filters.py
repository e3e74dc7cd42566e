"""Row filters."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F

from tidemill.functions.text import JUNK_WORDS, not_junk


def instant(as_of) -> Column:
    """A literal instant from a datetime (a zone-less one is UTC); columns pass through."""
    if isinstance(as_of, datetime):
        return F.lit(as_of if as_of.tzinfo else as_of.replace(tzinfo=timezone.utc))
    return as_of


def fresh(df: DataFrame, ts: str, as_of, hours: int = 24) -> DataFrame:
    """Rows at most ``hours`` old at ``as_of``; the bound and future dates pass.

    The bound is a constant on the right-hand side, so a file scan can skip on it.
    """
    return df.filter(F.col(ts) >= instant(as_of) - F.make_dt_interval(F.lit(0), F.lit(hours)))


def min_length(df: DataFrame, column: str, more_than: int) -> DataFrame:
    return df.filter(F.length(column) > more_than)


def without_junk(df: DataFrame, column: str, words=JUNK_WORDS) -> DataFrame:
    """Rows whose text holds none of the words, as substrings in any case."""
    return df.filter(not_junk(F.col(column), words))


def topic_filter(papers: DataFrame, topic: str, columns=("title", "abstract", "authors")) -> DataFrame:
    """Papers that name the topic as a phrase, in any case, in one of the columns."""
    kinds = dict(papers.dtypes)
    needle = F.lit(topic.lower())

    def names_topic(column: str) -> Column:
        text = F.array_join(column, "\n") if kinds[column].startswith("array") else F.col(column)
        return F.coalesce(F.contains(F.lower(text), needle), F.lit(False))

    test = F.lit(False)
    for column in columns:
        if column in kinds:
            test = test | names_topic(column)
    return papers.filter(test)
