"""Token-id files: the ids of all documents in order, in blocks of simple-8b words (operator 5).

A file set is a folder that Spark writes, one row per block, so a lost task is written again and never seen twice. A block holds
whole documents, at least ``BLOCK_IDS`` ids of them unless its shard ends:

    shard       the range of document ids it belongs to, counted from 0 in ascending order
    start       ids of the shard before the block
    doc_ids     its documents
    lengths     the number of ids of each
    words       the code words, little-endian, eight bytes each

Documents are in ascending ``doc_id`` order (null first), copies of one id by their text. ``lengths`` are the offsets that let a
reader decode a block at once and then cut it, and ``start`` those that let it skip blocks.

Defined cases: a null text is empty and gets the end id alone; an empty table gives an empty file set; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemill.llm import simple8b
from tidemill.llm.encoder import END_ID, shared_encoder, tokenizer_path
from tidemill.llm.words import slices, text_column
from tidemill.session import scratch_path

BLOCK_IDS = 1 << 16
SCHEMA = "shard int, start long, doc_ids array<long>, lengths array<int>, words binary"


def _blocks(tokenizer: str, end_id: int | None, block_ids: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, start = shared_encoder(tokenizer), None, 0
        kept: tuple[pa.Array, np.ndarray, np.ndarray] | None = None  # documents, their lengths and ids, too few for a block

        def block(doc_ids: pa.Array, lengths: np.ndarray, ids: np.ndarray):
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int32()), pa.array([start], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(doc_ids)], pa.int32()), doc_ids),
                    pa.ListArray.from_arrays(pa.array([0, len(lengths)], pa.int32()), pa.array(lengths, pa.int32())),
                    pa.array([simple8b.encode(ids).astype("<u8", copy=False).tobytes()], pa.binary()),
                ],
                names=["shard", "start", "doc_ids", "lengths", "words"],
            )

        for batch in batches:
            for part in slices(batch):
                shard = part.column(2)[0].as_py()
                ids, offsets = encoder.encode(text_column(part), end_id)
                doc_ids, lengths = part.column(0).cast(pa.int64()), np.diff(offsets)
                if kept is not None:
                    doc_ids, lengths, ids = pa.concat_arrays([kept[0], doc_ids]), np.concatenate([kept[1], lengths]), np.concatenate([kept[2], ids])
                ends, first, begin = np.cumsum(lengths), 0, 0
                while (last := int(np.searchsorted(ends, begin + block_ids))) < len(ends):
                    stop = int(ends[last])
                    yield block(doc_ids.slice(first, last + 1 - first), lengths[first:last + 1], ids[begin:stop])
                    start, first, begin = start + stop - begin, last + 1, stop
                kept = (doc_ids.slice(first), lengths[first:], ids[begin:].copy()) if first < len(ends) else None
        if kept is not None:
            yield block(*kept)

    return encode


def write_tokens(
    docs: DataFrame, path: str, *, tokenizer: str | None = None, end_id: int | None = END_ID, shards: int | None = None, block_ids: int = BLOCK_IDS,
) -> None:
    """Encode ``docs(doc_id, text)`` and write the file set at ``path``; ``tokenizer`` is a path every executor has."""
    shards = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        docs.select("doc_id", "text")
        .repartitionByRange(shards, "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .withColumn("shard", F.spark_partition_id())
        .mapInArrow(_blocks(tokenizer or tokenizer_path(), end_id, block_ids), SCHEMA)
        .write.option("compression", "zstd").parquet(path)
    )


def _decoded(batches: Iterator[pa.RecordBatch], consume) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = {name: batch.column(batch.schema.get_field_index(name)) for name in ("start", "doc_ids", "lengths", "words")}
        for i in range(batch.num_rows):
            lengths = columns["lengths"][i].values.to_numpy(zero_copy_only=False).astype(np.int64)
            ids = simple8b.decode(np.frombuffer(columns["words"][i].as_buffer(), "<u8"), int(lengths.sum()))
            yield consume(columns["start"][i].as_py(), columns["doc_ids"][i].values, ids, lengths)


def _with_bases(blocks: DataFrame) -> DataFrame:
    """Blocks with ``start`` counted from the first document of the whole set."""
    ids = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    totals = blocks.select("shard", ids.alias("n")).groupBy("shard").agg(F.sum("n").alias("n"))  # one row a shard, so it can be broadcast
    before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    bases = totals.select("shard", F.coalesce(before, F.lit(0)).alias("base"))
    return blocks.join(F.broadcast(bases), "shard").withColumn("start", F.col("start") + F.col("base")).drop("base")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids``: the documents of a file set; ``start`` counts the ids of all documents before."""

    def consume(start, doc_ids, ids, lengths):
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        return pa.RecordBatch.from_arrays(
            [
                doc_ids, pa.array(start + bounds[:-1], pa.int64()),
                pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.view(np.int64))),
            ],
            names=["doc_id", "start", "ids"],
        )

    return _with_bases(spark.read.parquet(path)).mapInArrow(lambda b: _decoded(b, consume), "doc_id long, start long, ids array<long>")


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` per document, from the ids read back."""

    def consume(start, doc_ids, ids, lengths):
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        data = memoryview(ids.astype("<u4").view(np.uint8))
        sums = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        return pa.RecordBatch.from_arrays(
            [
                doc_ids, pa.array(start + bounds[:-1], pa.int64()),
                pa.array(lengths, pa.int64()), pa.array(sums, pa.int64()),
            ],
            names=["doc_id", "start", "n_tokens", "ids_crc32"],
        )

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return _with_bases(spark.read.parquet(path)).mapInArrow(lambda b: _decoded(b, consume), schema)


def encode_and_read(docs: DataFrame, **options) -> DataFrame:
    """Write the file set to a fresh folder in the shared scratch space and return its digests."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, **options)
    return token_digests(docs.sparkSession, path)
