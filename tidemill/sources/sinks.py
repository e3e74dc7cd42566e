"""CSV files and collections. Errors surface; nothing is swallowed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

MAPPING_COLUMNS = {"raw_name": "Raw Name", "canonical_name": "Canonical Name", "match_score": "Match Score"}


def _csv_ready(df: DataFrame) -> DataFrame:
    """Lists and maps as JSON text; CSV holds neither."""
    ready = [
        F.to_json(F.col(f"`{n}`")).alias(n) if k.startswith(("array", "map", "struct")) else F.col(f"`{n}`") for n, k in df.dtypes
    ]
    return df.select(*ready)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV part files with a header, written in parallel. Null and empty text are both written as nothing."""
    _csv_ready(df).write.mode(mode).options(header=True, emptyValue="", escape='"').csv(path)


def write_collection(df: DataFrame, base: str, name: str, replace: bool = False, fmt: str = "parquet") -> None:
    """Append to the collection ``base/name``, or replace it. ``fmt`` may name any installed connector format."""
    df.write.mode("overwrite" if replace else "append").format(fmt).save(f"{base.rstrip('/')}/{name}")


def write_mapping(log: DataFrame, path: str, mode: str = "errorifexists") -> bool:
    """The mapping log under its display names; nothing is written, and False returned, when it is empty."""
    if log.isEmpty():
        return False
    write_csv(log.select(*[F.col(c).alias(shown) for c, shown in MAPPING_COLUMNS.items()]), path, mode)
    return True


def union_ragged(*dfs: DataFrame) -> DataFrame:
    """All rows under the union of the columns, in first-seen order; missing texts become empty."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
    return merged.select(
        *[F.coalesce(F.col(f"`{n}`"), F.lit("")).alias(n) if k == "string" else F.col(f"`{n}`") for n, k in merged.dtypes]
    )


def write_ragged(path: str, *dfs: DataFrame, mode: str = "errorifexists") -> bool:
    """``union_ragged`` to CSV; no file, and False returned, when there are no rows."""
    rows = union_ragged(*dfs)
    if rows.isEmpty():
        return False
    write_csv(rows, path, mode)
    return True
