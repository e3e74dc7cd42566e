"""Addresses seen in earlier runs.

The history is a table in hash buckets of the address. New rows are dealt to the same buckets, so a run shuffles what it brings and nothing of
what is known already, however long the history has grown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Buckets of a new history. A history keeps the number it began with.
BUCKETS = 64


def create(spark: SparkSession, table: str, buckets: int = BUCKETS, path: str | None = None) -> None:
    """An empty history under a table name, in ``path`` or in the session's warehouse; an existing one stays as it is."""
    place = f"location '{path}'" if path else ""
    spark.sql(f"create table if not exists {table} (address string) using parquet clustered by (address) sorted by (address) into {int(buckets)} buckets {place}")


def unseen(rows: DataFrame, table: str, address: str) -> DataFrame:
    """The rows whose address is not in the history. Rows without an address (null or empty) are always new."""
    known = rows.sparkSession.table(table).withColumnRenamed("address", "_known").hint("merge")
    has_address = F.coalesce(F.col(address) != "", F.lit(False))
    addressed = rows.filter(has_address)
    new = addressed.join(known, addressed[address] == known["_known"], "left_anti")
    return new.unionByName(rows.filter(~has_address))


def remember(rows: DataFrame, table: str, address: str) -> None:
    """Add the addresses of ``rows``. Do this once the rows themselves are written: a run that dies before gives them again."""
    spark = rows.sparkSession
    buckets = _buckets(spark, table)
    fresh = rows.select(F.col(address).alias("address")).filter("address <> ''").distinct()
    # One task per bucket, so a run adds one file to each bucket it touches.
    fresh.repartition(buckets, "address").write.insertInto(table)


def _buckets(spark: SparkSession, table: str) -> int:
    described = spark.sql(f"describe extended {table}").filter("col_name = 'Num Buckets'").first()
    if described is None:
        raise ValueError(f"{table} is not in buckets")
    return int(described.data_type)
