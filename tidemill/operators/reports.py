"""Counts, listings and previews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def run_summary(df: DataFrame, source: str = "source.name", total: bool = True) -> DataFrame:
    """Rows per source; with ``total`` one more row, with a null source, for all of them."""
    key = F.col(source).alias("source")
    grouped = df.select(key).rollup("source") if total else df.select(key).groupBy("source")
    counted = grouped.agg(F.count("*").alias("n_rows"), F.grouping("source").alias("is_total") if total else F.lit(0).alias("is_total"))
    return counted.select("source", F.col("is_total").cast("int").alias("is_total"), "n_rows")


def list_latest(df: DataFrame, order: str, limit: int | None = None) -> DataFrame:
    """Newest insert first by an ingest sequence column; with a limit this is a top-k, not a full sort."""
    ordered = df.orderBy(F.desc(order))
    return ordered.limit(limit) if limit is not None else ordered


def preview(df: DataFrame, n_columns: int = 6, width: int = 60, hidden=("_id",)) -> DataFrame:
    """The first columns as display text: addresses as LINK, long values cut."""

    def shown(name: str, kind: str) -> Column:
        column = F.col(f"`{name}`")
        text = column.cast("string") if not kind.startswith(("array", "map", "struct")) else F.to_json(column)
        cut = F.when(F.length(text) > width, F.concat(F.substring(text, 1, width), F.lit("..."))).otherwise(text)
        return (F.when(text.startswith("http"), F.lit("LINK")).otherwise(cut) if kind == "string" else cut).alias(name)

    columns = [(n, k) for n, k in df.dtypes if n not in hidden][:n_columns]
    return df.select(*[shown(n, k) for n, k in columns])
