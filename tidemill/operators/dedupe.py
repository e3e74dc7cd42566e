"""Keep-first deduplication in an explicit order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def keep_first(df: DataFrame, keys: str | list[str], order: str | list[str], drop_empty: bool = True) -> DataFrame:
    """The first row per key in the given order; rows with a null or empty key are dropped unless told otherwise.

    An aggregate, not a window: every task keeps one row per key before the shuffle, so a key that holds a third of
    all rows moves no more data than any other.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, str) else list(order)
    kinds = dict(df.dtypes)
    present = df
    for k in keys if drop_empty else []:
        present = present.filter(F.col(f"`{k}`") != "" if kinds[k] == "string" else F.col(f"`{k}`").isNotNull())
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    first = present.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(
        F.min_by(row, F.struct(*[F.col(f"`{c}`") for c in order])).alias("_row")
    )
    return first.select(*[F.col(f"`{c}`") if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns])


def first_by_priority(df: DataFrame, keys: list[str], value: str, priority: list[str]) -> DataFrame:
    """One value per key: the one with the lowest priority, such as a strategy and a document position."""
    return df.groupBy(*keys).agg(F.min_by(value, F.struct(*priority)).alias(value))


def entity_key(kind: str) -> Column:
    """The name a directory record is deduplicated by."""
    return {
        "ECOMMERCE_PRODUCT": F.col("content.productName"),
        "PRODUCT": F.col("content.startupName"),
        "STARTUP": F.col("content.entityName"),
    }[kind]
