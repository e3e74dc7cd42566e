"""Tiered extraction: which stored response answers a request."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from tidemill.operators.records import parse_valid

RATE_LIMIT = "rate_limit"


def first_valid_by_tier(
    requests: DataFrame, responses: DataFrame, schema: T.StructType | str, key: str = "req_id", max_attempts: int = 3
) -> DataFrame:
    """Requests with ``tier`` and ``record`` of the first tier whose answer is valid; null when all fail.

    Within a tier only rate-limit errors are tried again, up to ``max_attempts``; the first other outcome is the
    tier's answer, and any other error or an invalid record moves on to the next tier.
    ``responses`` holds the key, ``tier, attempt, json, error``.
    """
    limited = F.coalesce(F.col("error") == RATE_LIMIT, F.lit(False))
    # Both aggregates combine before the shuffle; a tier has a handful of attempts.
    answers = (
        responses.filter((F.col("attempt") <= max_attempts) & ~limited)
        .groupBy(key, "tier")
        .agg(F.min_by(F.struct("json", "error"), "attempt").alias("answer"))
        .filter(F.col("answer.error").isNull())
        .select(key, "tier", F.col("answer.json").alias("json"))
    )
    answers = parse_valid(answers, "json", schema)
    first = answers.groupBy(key).agg(F.min("tier").alias("tier"), F.min_by("record", "tier").alias("record"))
    return requests.join(first, key, "left")


def alive_tiers(tiers: DataFrame, health: DataFrame, key: str = "tier") -> DataFrame:
    """Tiers that passed their health check; all of them when none did. The tier list is a handful of rows."""
    alive = health.filter("alive").join(tiers, key, "left_semi")
    return tiers if alive.isEmpty() else tiers.join(alive, key, "left_semi")
