"""Collections that are replaced as a whole without a moment in which nothing is readable.

Each replacement is written to a folder of its own; only then a row with the folder's name is appended to the collection's pointers. The newest
pointer counts, so a replacement that dies on the way, whenever that is, leaves the rows before it as they were.

    base/name/rows-<id>/     the rows of one version
    base/name/pointers/      version, folder, written_at
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

POINTER = "version long, folder string, written_at timestamp"


def _place(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def versions(spark: SparkSession, base: str, name: str) -> DataFrame:
    """``version, folder, written_at`` of every version that was completed; no rows for an unknown collection."""
    try:
        return spark.read.schema(POINTER).parquet(f"{_place(base, name)}/pointers")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], POINTER)


def _current(spark: SparkSession, base: str, name: str) -> Row | None:
    return versions(spark, base, name).orderBy(F.desc("version"), F.desc("folder")).first()


def replace(df: DataFrame, base: str, name: str) -> int:
    """Put ``df`` in the place of all rows of the collection, which need not exist; returns the version's number."""
    spark = df.sparkSession
    folder = f"rows-{uuid.uuid4().hex}"
    df.write.parquet(f"{_place(base, name)}/{folder}")
    before = _current(spark, base, name)
    version = before.version + 1 if before else 1
    pointer = spark.range(1).select(F.lit(version).cast("long").alias("version"), F.lit(folder).alias("folder"), F.current_timestamp().alias("written_at"))
    pointer.write.mode("append").parquet(f"{_place(base, name)}/pointers")
    return version


def append(df: DataFrame, base: str, name: str) -> int:
    """Add rows to the current version; the first rows of a collection are its first version."""
    current = _current(df.sparkSession, base, name)
    if current is None:
        return replace(df, base, name)
    df.write.mode("append").parquet(f"{_place(base, name)}/{current.folder}")
    return current.version


def read(spark: SparkSession, base: str, name: str, version: int | None = None) -> DataFrame:
    """The rows of the current version, or of an older one."""
    if version is None:
        found = _current(spark, base, name)
    else:
        found = versions(spark, base, name).filter(F.col("version") == version).orderBy(F.desc("folder")).first()
    if found is None:
        raise ValueError(f"collection {name!r} has no {'rows yet' if version is None else f'version {version}'}")
    return spark.read.parquet(f"{_place(base, name)}/{found.folder}")
