"""Words of Arrow text columns, as integer codes.

A word is a run of ``[^\\x20\\x09-\\x0D]``. A null text is taken as empty; an empty text has no words.
Python touches distinct words only; what is done per occurrence is done by Arrow and numpy.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Text bytes handled at once inside a task; one longer text is handled alone.
SLICE_BYTES = 4 << 20

# What a slice took goes back to the system when it is done, not into a pool that each idle worker would hold.
pa.set_memory_pool(pa.system_memory_pool())


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, after which the worker, idle or not, holds no memory that its task has freed."""

    @wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return whole


def release() -> None:
    """Give freed memory back to the system."""
    pa.default_memory_pool().release_unused()


def text_column(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """The column as strings without nulls."""
    column = batch.column(batch.schema.get_field_index(name))
    return pc.fill_null(column.cast(pa.string()), "")


def slices(batch: pa.RecordBatch, name: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive runs of rows of at most ``limit`` bytes of text, or one row each where a text is longer."""
    sizes = pc.binary_length(text_column(batch, name)).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(data, offsets)``: text ``i`` of a string column without nulls has the bytes ``data[offsets[i]:offsets[i + 1]]``."""
    _, ends, data = texts.buffers()
    offsets = np.frombuffer(ends, np.int32)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    if data is None or offsets[0] == offsets[-1]:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets.astype(np.int64) - offsets[0]


def recoded(texts: pa.Array, table: np.ndarray) -> pa.Array:
    """The texts with every byte ``b`` replaced by ``table[b]``, which has to keep the bytes from 128 on."""
    data, offsets = raw(texts)
    return pa.StringArray.from_buffers(len(texts), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(table[data]))


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """``(codes, offsets, words)``: text ``i`` has the words ``words[codes[offsets[i]:offsets[i + 1]]]``."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    encoded = flat.dictionary_encode()
    codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    real = pc.not_equal(encoded.dictionary, "").to_numpy(zero_copy_only=False)  # white space at an end gives an empty word
    if not real.all():
        keep = real[codes]
        seen = np.concatenate([[0], np.cumsum(keep)])
        bounds = np.concatenate([[0], np.cumsum(counts)])
        return codes[keep], seen[bounds], encoded.dictionary
    return codes, np.concatenate([[0], np.cumsum(counts)]), encoded.dictionary


def hashes(words: list[str]) -> np.ndarray:
    """64-bit hashes of strings."""
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w) for w in words), dtype=np.uint64, count=len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the finalizer of splitmix64)."""
    with np.errstate(over="ignore"):
        z = values + np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def rows_of(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions ``starts[i], starts[i] + 1, ...`` (``counts[i]`` of them) for every ``i``, one after the other."""
    total = int(counts.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total) - np.repeat(ends - counts, counts) + np.repeat(starts, counts)
