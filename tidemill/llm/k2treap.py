"""Ranked lexical search over a grid of terms and documents (operator 13), by K2-treaps.

The index has one row per chunk of documents (``CHUNK_BYTES`` of text, or one longer text). A chunk is a grid: its terms are the rows, by falling
document frequency, its documents the columns, by length, and a cell holds how often the term occurs. The grid is a quadtree, stored as
one mask of present quarters per inner node, level by level, and the occurrences of the cells in the same order. Nothing in it depends on other
documents, so chunks can be added at any time.

A search turns occurrences into impacts, with the mean length over all chunks, and lifts their maxima to every node. An item goes down with the
paths of all its term rows together: a range of documents is a node per row, its bound the weighted sum of the nodes' maxima. The ranges with
the highest bounds go down first, in batches, until no bound reaches the last of the best scores, which a task carries from chunk to
chunk. At the cells the bound is the score.

Defined cases: a null text has no terms and is no result; a document without id ranks like any other, after those of the same score; every row
of documents and of items is one of its own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tidemill.llm.words import recoded, slices, text_column, word_codes
from tidemill.session import cut

TOP = 20
CHUNK_BYTES = 16 << 20
#: Bytes of item texts that are searched for at once.
ITEM_BYTES = 8 << 20
#: Ranges that go down together.
BEAM = 256
INDEX = "doc_ids array<long>, lengths array<int>, terms array<string>, frequencies array<int>, depth int, masks binary, counts binary"

_NO_ID = np.iinfo(np.int64).max
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[:48] = _PLAIN[58:65] = _PLAIN[91:97] = _PLAIN[123:128] = 0x20
_PLAIN[65:91] += 32
_PRESENT = np.array([bin(m).count("1") for m in range(16)], np.int64)
#: Present quarters before quarter ``q`` of mask ``m``.
_BEFORE = np.array([[bin(m & ((1 << q) - 1)).count("1") for q in range(4)] for m in range(16)], np.int64)
#: The quarters of each mask, one mask after the other, and where they start.
_QUARTERS = np.array([q for m in range(16) for q in range(4) if m >> q & 1], np.int64)
_QUARTERS_AT = np.concatenate([[0], np.cumsum(_PRESENT)[:-1]])


def terms_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """``(codes, offsets, terms)`` as ``word_codes`` gives them, for the terms of each text."""
    return word_codes(recoded(texts, _PLAIN))


def _interleaved(row: np.ndarray, column: np.ndarray, depth: int) -> np.ndarray:
    place = np.zeros(len(row), np.int64)
    for bit in range(depth):
        place |= (row >> bit & 1) << (2 * bit + 1) | (column >> bit & 1) << (2 * bit)
    return place


def quadtree(row: np.ndarray, column: np.ndarray, value: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """``(masks, values)`` of the cells: the masks of all levels from the root down, and the values in the order of the leaves."""
    place = _interleaved(row, column, depth)
    order = np.argsort(place)
    place, masks = place[order], []
    for _ in range(depth):
        quarter = np.left_shift(1, place & 3).astype(np.uint8)
        place >>= 2
        starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        masks.append(np.bitwise_or.reduceat(quarter, starts))
        place = place[starts]
    return np.concatenate(masks[::-1]) if masks else np.empty(0, np.uint8), value[order]


def _grids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, limit=CHUNK_BYTES):
            codes, bounds, terms = terms_of(text_column(part))
            lengths = np.diff(bounds)
            by_length = np.argsort(-lengths, kind="stable")[: int((lengths > 0).sum())]
            if not len(by_length):
                continue
            column_of = np.zeros(len(lengths), np.int64)
            column_of[by_length] = np.arange(len(by_length))
            size = len(by_length)
            cells, counts = np.unique(codes * size + np.repeat(column_of, lengths), return_counts=True)
            code, column = np.divmod(cells, size)
            frequencies = np.bincount(code, minlength=len(terms))
            by_frequency = np.argsort(-frequencies, kind="stable")[: int((frequencies > 0).sum())]
            row_of = np.zeros(len(terms), np.int64)
            row_of[by_frequency] = np.arange(len(by_frequency))
            depth = max(len(by_frequency) - 1, size - 1).bit_length()
            masks, values = quadtree(row_of[code], column, counts.astype(np.int32), depth)

            def one(values: pa.Array | np.ndarray, kind: pa.DataType) -> pa.Array:
                flat = values if isinstance(values, pa.Array) else pa.array(values, kind)
                return pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)

            yield pa.RecordBatch.from_arrays(
                [
                    one(part.column(0).take(pa.array(by_length)), pa.int64()), one(lengths[by_length], pa.int32()),
                    one(terms.take(pa.array(by_frequency)), pa.string()), one(frequencies[by_frequency], pa.int32()), pa.array([depth], pa.int32()),
                    pa.array([masks.tobytes()], pa.binary()), pa.array([values.tobytes()], pa.binary()),
                ],
                names=["doc_ids", "lengths", "terms", "frequencies", "depth", "masks", "counts"],
            )


def build(docs: DataFrame) -> DataFrame:
    """The index of ``docs(doc_id, text)``: a row per chunk, for ``search`` or for a table of its own."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_grids, INDEX)


class Treap:
    """A chunk's quadtree with maxima. Node 0 of every level stands for an absent one."""

    def __init__(self, masks: np.ndarray, counts: np.ndarray, lengths: np.ndarray, depth: int, documents: int, words: int):
        self.depth = depth
        self.masks, self.first, self.top = [], [], []
        place = np.zeros(1, np.int64)
        for _ in range(depth):
            level, masks = masks[: len(place)], masks[len(place):]
            sizes = _PRESENT[level]
            ends = np.cumsum(sizes)
            self.masks.append(np.concatenate([[0], level]).astype(np.int64))
            self.first.append(np.concatenate([[0], ends - sizes + 1]))
            step = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)
            place = np.repeat(place << 2, sizes) + _QUARTERS[np.repeat(_QUARTERS_AT[level], sizes) + step]
        column = np.zeros(len(place), np.int64)
        for bit in range(depth):
            column |= (place >> (2 * bit) & 1) << bit
        m = 100 - 25 + 25 * lengths.astype(np.int64) * documents // words
        counts = counts.astype(np.int64)
        top = 1_000_000_000 * counts // (1000 * counts + 12 * m[column])
        self.top = [np.concatenate([[0], top])]
        for first in reversed(self.first):
            top = np.maximum.reduceat(top, first[1:] - 1)
            self.top.append(np.concatenate([[0], top]))
        self.top.reverse()

    def search(self, rows: np.ndarray, weights: np.ndarray, best: Best, ids: np.ndarray) -> None:
        """Offer ``best`` every document that the item with these rows and weights could rank."""
        ticket = count()
        waiting = [(-int(self.top[0][1] * weights.sum()), next(ticket), 0, np.zeros(1, np.int64), np.ones((1, len(rows)), np.int64), None)]
        while waiting and -waiting[0][0] >= best.floor:
            _, _, level, ranges, nodes, bounds = heapq.heappop(waiting)
            if bounds is not None and bounds[-1] < best.floor:
                able = bounds >= best.floor
                ranges, nodes = ranges[able], nodes[able]
            if level == self.depth:
                best.offer(self.top[level][nodes] @ weights, ids[ranges])
                continue
            masks, first = self.masks[level][nodes], self.first[level][nodes]
            half = (rows >> (self.depth - 1 - level) & 1) * 2
            children = []
            for quarter in (half, half + 1):
                children.append(np.where(masks >> quarter & 1, first + _BEFORE[masks, quarter], 0))
            nodes = np.concatenate(children)
            ranges = np.concatenate([ranges << 1, ranges << 1 | 1])
            bounds = self.top[level + 1][nodes] @ weights
            order = np.argsort(-bounds, kind="stable")
            order = order[: int((bounds >= best.floor).sum())]
            for part in (order[:BEAM], order[BEAM:]):
                if len(part):
                    heapq.heappush(waiting, (-int(bounds[part[0]]), next(ticket), level + 1, ranges[part], nodes[part], bounds[part]))


class Best:
    """The highest scores above 0 so far, equal ones by ascending id."""

    def __init__(self, size: int):
        self.size, self.floor = size, 1
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        able = scores >= self.floor
        scores, ids = np.concatenate([self.scores, scores[able]]), np.concatenate([self.ids, ids[able]])
        order = np.lexsort((ids, -scores))[: self.size]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.size:
            self.floor = max(1, int(self.scores[-1]))


def _column(batch: pa.RecordBatch, name: str, row: int) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))[row].values


def _frequencies(wanted: pa.Array):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                at = pc.index_in(_column(batch, "terms", i), value_set=wanted)
                known = pc.is_valid(at)
                yield pa.RecordBatch.from_arrays([at.filter(known), _column(batch, "frequencies", i).filter(known).cast(pa.int64())], names=["term", "df"])

    return run


def _searched(wanted: pa.Array, items: list[tuple[np.ndarray, np.ndarray]], documents: int, words: int, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top) for _ in items]
        for batch in batches:
            for i in range(batch.num_rows):
                row_of = pc.fill_null(pc.index_in(wanted, value_set=_column(batch, "terms", i)), -1).to_numpy(zero_copy_only=False)
                if (row_of < 0).all():
                    continue
                ids = pc.fill_null(_column(batch, "doc_ids", i), _NO_ID).to_numpy(zero_copy_only=False)
                masks, counts = (np.frombuffer(batch.column(batch.schema.get_field_index(n))[i].as_buffer(), t) for n, t in (("masks", np.uint8), ("counts", np.int32)))
                depth = batch.column(batch.schema.get_field_index("depth"))[i].as_py()
                treap = Treap(masks, counts, _column(batch, "lengths", i).to_numpy(zero_copy_only=False), depth, documents, words)
                for (terms, weights), found in zip(items, best):
                    rows = row_of[terms]
                    here = rows >= 0
                    if here.any():
                        treap.search(rows[here].astype(np.int64), weights[here], found, ids)
        sizes = [len(b.ids) for b in best]
        ids = np.concatenate([b.ids for b in best]) if best else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(best)), sizes), pa.int32()), pa.array(ids, mask=ids == _NO_ID),
                pa.array(np.concatenate([b.scores for b in best]) if best else np.empty(0, np.int64)),
            ],
            names=["item", "doc_id", "score"],
        )

    return run


def _block(index: DataFrame, ids: pa.Array, texts: pa.Array, documents: int, words: int, top: int) -> DataFrame:
    """The best documents of some items."""
    spark = index.sparkSession
    codes, bounds, wanted = terms_of(texts)
    index_terms = index.select("terms", "frequencies").mapInArrow(_frequencies(wanted), "term int, df long")
    df = {r.term: r.df for r in index_terms.groupBy("term").agg(F.sum("df").alias("df")).collect()}  # at most the terms of the items
    weight = {t: math.floor(1000 * math.log((2 * documents + 2) / (2 * f + 1))) for t, f in df.items()}
    items = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        held = [(t, n * weight[t]) for t, n in Counter(codes[a:b].tolist()).items() if weight.get(t)]
        items.append((np.array([t for t, _ in held], np.int64), np.array([w for _, w in held], np.int64)))
    found = index.mapInArrow(_searched(wanted, items, documents, words, top), "item int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    names = spark.createDataFrame(pa.table({"item": pa.array(range(len(ids)), pa.int32()), "item_id": ids}))
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(index: DataFrame, items: DataFrame, *, top: int = TOP) -> DataFrame:
    """The ``top`` highest-scoring documents of each row of ``items(item_id, text)``: ``item_id, rank, doc_id, score``.

    ``index`` is what ``build`` gives, best read from a table. Items are searched for in blocks of about ``ITEM_BYTES``.
    """
    spark = index.sparkSession
    totals = index.agg(F.sum(F.size("lengths")).alias("n"), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("l")).first()
    empty = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    if not totals.n:
        return empty
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    size = asked.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = max(1, math.ceil(size / ITEM_BYTES))
    out = empty
    for block in range(blocks):
        part = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).toArrow().combine_chunks()
        if part.num_rows:
            ids, texts = (c.chunk(0) for c in (part.column("item_id"), part.column("text")))
            out = out.unionByName(_block(index, ids, texts.cast(pa.string()), totals.n, totals.l, top))
    return out


def rank_all(docs: DataFrame, items: DataFrame, *, top: int = TOP) -> DataFrame:
    """``search`` over an index written for the occasion."""
    return search(cut(build(docs), large=True), items, top=top)
