"""Token counts and fixed token windows.

The built-in tokenizer is lossless: every piece carries the white space before it, so joining the
pieces of a window gives back the text exactly, as decoding a window of byte-pair tokens does.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemill.functions.strings import let

#: Bytes of text whose windows are held at once.
PART_BYTES = 1 << 20
PIECE = r"[\s]*[\p{L}\p{N}\p{M}_]+|[\s]*[^\p{L}\p{N}\p{M}_\s]|[\s]+$"


def pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PIECE), 0)


def token_count(text: Column) -> Column:
    return F.size(pieces(text))


def token_windows(tokens: Column, max_tokens: int) -> Column:
    """Consecutive windows of ``max_tokens`` tokens as structs; an empty array for no tokens."""
    n = F.size(tokens)
    starts = F.when(n > 0, F.sequence(F.lit(1), n, F.lit(max_tokens))).otherwise(F.array().cast("array<int>"))
    return F.transform(
        starts,
        lambda s: F.struct(
            F.least(F.lit(max_tokens), n - s + 1).alias("n_tokens"),
            F.array_join(F.slice(tokens, s, max_tokens), "").alias("chunk_text"),
        ),
    )


def chunk(df: DataFrame, text: str, max_tokens: int = 4000, encoding: str | None = None) -> DataFrame:
    """Split a text column into consecutive windows: one row per window, none for an empty text.

    Adds ``chunk_no``, ``n_tokens`` and ``chunk_text`` and drops the text. With ``encoding`` the windows are
    cut in the named byte-pair vocabulary, inside Arrow batches, instead of by the built-in pieces.
    """
    if encoding is None:
        windows = df.withColumn("_windows", let(pieces(F.col(text)), lambda t: token_windows(t, max_tokens)))
    else:
        windows = df.withColumn("_windows", _bpe_windows(encoding, max_tokens)(F.col(text)))
    kept = [c for c in df.columns if c != text]
    return windows.select(*kept, F.posexplode("_windows").alias("chunk_no", "_w")).select(
        *kept, "chunk_no", F.col("_w.n_tokens").alias("n_tokens"), F.col("_w.chunk_text").alias("chunk_text")
    )


def _bpe_windows(encoding: str, max_tokens: int):
    @F.pandas_udf("array<struct<n_tokens:int,chunk_text:string>>")
    def windows(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import tiktoken

        bpe = tiktoken.get_encoding(encoding)

        def cut(text):
            ids = bpe.encode(text or "", disallowed_special=())
            spans = (ids[i : i + max_tokens] for i in range(0, len(ids), max_tokens))
            return [{"n_tokens": len(s), "chunk_text": bpe.decode(s)} for s in spans]

        for texts in batches:
            yield texts.map(cut)

    return windows


@lru_cache(maxsize=2)
def _vocabulary(ranks: str, pattern: str):
    """The encoder of a file of byte-pair ranks, and the bytes of each id; one per worker process."""
    import tiktoken

    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    lengths = np.zeros(max(merges.values(), default=0) + 1, np.int64)
    for token, rank in merges.items():
        lengths[rank] = len(token)
    return tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=merges, special_tokens={}), lengths


def _id_windows(text: str, bpe, lengths: np.ndarray, max_tokens: int) -> list[dict]:
    ids = np.array(bpe.encode_ordinary(text), np.int64)
    ends = np.cumsum(lengths[ids])
    cuts = np.append(np.arange(max_tokens, len(ids), max_tokens), len(ids)) if len(ids) else np.empty(0, np.int64)
    # A letter goes to the window that holds its first byte, so letters that a cut goes through stay whole.
    letters = np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80)
    stops = letters[ends[cuts - 1] - 1].tolist()
    starts = [0, *stops[:-1]]
    sizes = np.diff(cuts, prepend=0).tolist()
    return [{"n_tokens": n, "start_char": a, "chunk_text": text[a:b]} for n, a, b in zip(sizes, starts, stops)]


def _text_parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts, in column 1, take about ``PART_BYTES``; a longer text is a run of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    starts = np.flatnonzero(np.diff(ends // PART_BYTES, prepend=-1)).tolist()
    for start, end in zip(starts, [*starts[1:], batch.num_rows]):
        yield batch.slice(start, end - start)


def chunk_ids(df: DataFrame, text: str, ranks: str, pattern: str, max_tokens: int = 4000) -> DataFrame:
    """Split a text column into consecutive windows of ``max_tokens`` byte-pair ids: one row per window, none for an empty text.

    ``ranks`` is a file of byte-pair ranks that every worker can open, ``pattern`` the pattern that parts texts before merging; marks that other
    vocabularies treat specially are ordinary text. Adds ``chunk_no, n_tokens, start_char`` (from 0) and ``chunk_text`` and drops the text. The windows of
    a text put together are the text: a letter of several bytes that a cut goes through belongs to the window it begins in.
    """

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, lengths = _vocabulary(ranks, pattern)
        for batch in batches:
            for part in _text_parts(batch):
                found = [_id_windows(t or "", bpe, lengths, max_tokens) for t in part.column(1).to_pylist()]
                counts = [len(f) for f in found]
                flat = [w for f in found for w in f]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(np.repeat(np.arange(len(found)), counts))),
                        pa.array([i for n in counts for i in range(n)], pa.int32()),
                        *[pa.array([w[c] for w in flat], kind) for c, kind in (("n_tokens", pa.int32()), ("start_char", pa.int32()), ("chunk_text", pa.string()))],
                    ],
                    names=["row", "chunk_no", "n_tokens", "start_char", "chunk_text"],
                )

    row = F.struct(F.lit(0).alias("_none"), *[F.col(f"`{c}`") for c in df.columns if c != text]).alias("row")
    texts = df.select(row, F.col(text).alias("text"))
    schema = T.StructType([texts.schema["row"], *[T.StructField(c, T.IntegerType()) for c in ("chunk_no", "n_tokens", "start_char")], T.StructField("chunk_text", T.StringType())])
    return texts.mapInArrow(windows, schema).select("row.*", "chunk_no", "n_tokens", "start_char", "chunk_text").drop("_none")
