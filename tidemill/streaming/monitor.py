"""The feed monitor as a stream: landed documents in, one appended collection per kind out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemill.operators.records import flatten
from tidemill.plans.signals import dated, fresh_items, job_records, news_records
from tidemill.sources.feeds import ITEM_SCHEMA, item_fields

PAYLOAD_SCHEMA = "source_name string, source_url string, xml string"


def payload_stream(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """A stream of landed payload rows ``source_name, source_url, xml`` with ``arrived``, when their file was written."""
    rows = spark.readStream.schema(PAYLOAD_SCHEMA).options(**options).format(fmt).load(path)
    return rows.withColumn("arrived", F.col("_metadata.file_modification_time"))


def xml_stream(spark: SparkSession, path: str) -> DataFrame:
    """A stream of feed files, one document each; the file name stands in for source name and address."""
    docs = spark.readStream.option("wholetext", True).text(path)
    name = F.col("_metadata.file_path")
    return docs.select(name.alias("source_name"), name.alias("source_url"), F.col("value").alias("xml"), F.col("_metadata.file_modification_time").alias("arrived"))


def item_stream(spark: SparkSession, path: str, element: str = "item") -> DataFrame:
    """A stream of the items of landed XML files, a row for each ``element`` (``item`` of RSS, ``entry`` of Atom), read by Spark's own XML source.

    ``source_name, source_url`` (the file), ``arrived, title, link, date_text, description`` as ``scan_feed`` reads them, and ``malformed``: the text of
    an element that is no XML, null for others. A file may hold any number of elements and is never held as one text; what is broken in it costs
    its own element.
    """
    schema = T.DataType.fromDDL(ITEM_SCHEMA).add("malformed", "string")
    # The element-wise parser: the other one gives up a file at its first fault.
    reading = {"rowTag": element, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "malformed", "useLegacyXMLParser": True}
    raw = spark.readStream.format("xml").schema(schema).options(**reading).load(path)
    file = F.col("_metadata.file_path")
    rows = raw.select(
        file.alias("source_name"), file.alias("source_url"), F.col("_metadata.file_modification_time").alias("arrived"), "malformed",
        F.struct(*[c for c in raw.columns if c != "malformed"]).alias("_i"),
    )
    present, fields = item_fields(F.col("_i"))
    kept = ("source_name", "source_url", "arrived", "malformed")
    return rows.filter(present | F.col("malformed").isNotNull()).select(*kept, *[c.alias(n) for n, c in fields.items()])


def fresh_items_stream(items: DataFrame, as_of=None, hours: int = 24) -> DataFrame:
    """The well-formed items of ``item_stream`` that are fresh, with ``published_date``."""
    at = F.current_timestamp() if as_of is None else as_of
    return dated(items.filter(F.col("malformed").isNull()).drop("malformed"), at, hours)


def fresh_stream(payloads: DataFrame, as_of=None, hours: int = 24) -> DataFrame:
    """Fresh items of a payload stream; without ``as_of`` the age is taken at each micro-batch's own time."""
    return fresh_items(payloads, F.current_timestamp() if as_of is None else as_of, hours)


def dedupe_stream(items: DataFrame, key: str = "link", arrived: str = "arrived", delay: str = "24 hours") -> DataFrame:
    """One item per address across polls; items without an address all pass.

    The watermark bounds the remembered addresses. It follows the arrival of the payloads, never a date that a publisher wrote: one
    date in the future would make everything after it late.
    """
    has_key = F.coalesce(F.col(key) != "", F.lit(False))
    first = items.filter(has_key).withWatermark(arrived, delay).dropDuplicatesWithinWatermark([key])
    return first.unionByName(items.filter(~has_key))


def start_monitor(
    items: DataFrame, kind: str, base: str, checkpoint: str, as_of=None, pages: DataFrame | None = None, trigger: dict | None = None
):
    """Append the records of an item stream to the collection ``base/kind`` (``news`` or ``jobs``).

    Every micro-batch overwrites its own partition, so a batch that is run again after a failure leaves no duplicates.
    The default trigger polls once: it takes all that has landed and ends.
    """
    if kind not in ("news", "jobs"):
        raise ValueError(f"unknown kind {kind!r}")

    def write(batch: DataFrame, batch_id: int) -> None:
        at = F.current_timestamp() if as_of is None else as_of
        records = news_records(batch, pages, at) if kind == "news" else job_records(batch, at)
        flatten(records).write.mode("overwrite").parquet(f"{base.rstrip('/')}/{kind}/batch_id={batch_id}")

    return (
        items.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
