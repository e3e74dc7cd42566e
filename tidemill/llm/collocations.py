"""Phrases of words that stand together more often than their parts explain (operator 11), by tiles of pairs.

Words get ids by falling frequency, so frequent pairs lie in the first tiles of the grid of pairs (left id, right id). Inside a task a full tile is
counted by ``bincount`` over its cells, all other tiles together as sorted coordinates with counts. The cells of all tasks meet in buckets, each a
set of tile strips, where they are summed. Frequent pairs get ids by falling frequency again, and the sequence of pair ids is treated like
the sequence of word ids: two frequent pairs that follow each other with one word in common are a phrase of three words, and so on.

Texts travel as chunks: the codes of a chunk's words and its own dictionary. A dictionary meets the vocabulary in a join, so neither the vocabulary nor
the frequent pairs are ever held by one task. A chunk has at most ``CHUNK_BYTES`` of text (one longer text is a chunk of its own), a bucket at
most about ``BUCKET_CELLS`` cells.

Defined cases: a null text is empty, a null language is ``und``; equal rows count as often as they occur; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemill.llm.words import mix, raw, recoded, slices, text_column, word_codes
from tidemill.session import cut

MIN_COUNT = 10
MAX_WORDS = 3
TOP = 2000
#: A phrase goes if a longer one that holds it is at least this many hundredths as frequent.
INSIDE = 50
UNKNOWN = "und"
CHUNK_BYTES = 8 << 20
BUCKET_CELLS = 1_000_000
#: A tile has 2 to the power of this many ids on each side.
TILE_BITS = 10
#: A tile is counted cell by cell where this share of its cells, or more, could be taken.
FULL = 1 / 8
#: Parts that each language's ranking is dealt to before the last.
RANK_PARTS = 64

_BLANKS = b" \t"
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_KIND = np.zeros(256, np.uint8)
_KIND[list(_BLANKS)] = 1
_KIND[list(_BREAKS)] = 2
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[list(_BLANKS + _BREAKS)] = 0x20
_PLAIN[65:91] += 32


def sequence(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """``(codes, words)``: the codes of all words of all texts in order, with -1 wherever a piece ends."""
    data, offsets = raw(texts)
    kind = _KIND[data]
    codes, bounds, words = word_codes(recoded(texts, _PLAIN))
    if not len(codes):
        return np.empty(0, np.int32), words
    inside = kind == 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = offsets[:-1][np.diff(offsets) > 0]
    first[begins] = inside[begins]
    breaks = np.searchsorted(np.flatnonzero(kind == 2), np.flatnonzero(first))
    ends = breaks[1:] != breaks[:-1]
    borders = bounds[1:-1]
    ends[borders[(borders > 0) & (borders < len(codes))] - 1] = True
    return np.insert(codes.astype(np.int32), np.flatnonzero(ends) + 1, -1), words


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 33
    for batch in batches:
        languages = batch.column(0)
        for language in pc.unique(languages).to_pylist():
            for part in slices(batch.filter(pc.equal(languages, language)), limit=CHUNK_BYTES):
                codes, words = sequence(text_column(part))
                counts = np.bincount(codes[codes >= 0], minlength=len(words))
                yield pa.RecordBatch.from_pydict(
                    {
                        "chunk": pa.array([number], pa.int64()), "lang": pa.array([language], pa.string()), "codes": pa.array([codes.tobytes()], pa.binary()),
                        "words": pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words),
                        "counts": pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pa.array(counts, pa.int64())),
                    }
                )
                number += 1


def _ranked(rows: DataFrame, *ties: str) -> DataFrame:
    """``rows`` with ``id``: 0, 1, ... by falling ``f``, then ``ties``."""
    rows = cut(rows.orderBy(F.desc("f"), *ties).withColumn("place", F.monotonically_increasing_id()))
    part = F.shiftright("place", 33)
    sizes = rows.groupBy(part.alias("part")).count()
    before = sizes.select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before"))  # a row for each partition
    ranked = rows.withColumn("part", part).join(F.broadcast(before), "part")
    return ranked.withColumn("id", (F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1)).cast("int")).drop("place", "part", "before")


def pair_counts(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(keys, counts)``: each pair of neighbours without -1 as ``left << 32 | right``, ascending, and how often it occurs."""
    left, right = ids[:-1].astype(np.int64), ids[1:].astype(np.int64)
    both = (left >= 0) & (right >= 0)
    left, right = left[both], right[both]
    cells, side = 1 << (2 * TILE_BITS), 1 << TILE_BITS
    across = 1 << TILE_BITS  # tiles looked at: the first ones on each side, where frequent ids are
    tile = np.where((left >> TILE_BITS < across) & (right >> TILE_BITS < across), (left >> TILE_BITS) * across + (right >> TILE_BITS), across * across)
    found = []
    for t in np.flatnonzero(np.bincount(tile, minlength=1)[:across * across] >= cells * FULL).tolist():
        here = tile == t
        counts = np.bincount((left[here] & (side - 1)) << TILE_BITS | (right[here] & (side - 1)), minlength=cells)
        cell = np.flatnonzero(counts)
        row, column = (t // across << TILE_BITS) + (cell >> TILE_BITS), (t % across << TILE_BITS) + (cell & (side - 1))
        found.append((row << 32 | column, counts[cell]))
        left, right, tile = left[~here], right[~here], tile[~here]
    found.append(np.unique(left << 32 | right, return_counts=True))
    keys, counts = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(keys, kind="stable")
    return keys[order], counts[order]


def _split(numbers: np.ndarray, counts: int) -> tuple[np.ndarray, np.ndarray]:
    """A stable order by small numbers, and where each number starts in it."""
    order = np.argsort(numbers, kind="stable")
    return order, np.searchsorted(numbers[order], np.arange(counts + 1))


def _binaries(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """One binary value for each run ``values[starts[i]:starts[i + 1]]``."""
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer((starts * values.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _numbers(column: pa.ChunkedArray | pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All values of a column of binaries one after the other, and the row of each."""
    parts, lengths = [], []
    for array in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        parts += [np.frombuffer(x.as_buffer(), kind) for x in array]
        lengths += [len(x) for x in parts[len(lengths):]]
    values = np.concatenate(parts) if parts else np.empty(0, kind)
    return values, np.repeat(np.arange(len(lengths)), lengths)


def _cells(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys, counts = pair_counts(np.frombuffer(ids.as_buffer(), np.int32))
                strip = mix((keys >> TILE_BITS).astype(np.uint64)) % np.uint64(buckets)
                order, starts = _split(strip.astype(np.int64), buckets)
                filled = np.flatnonzero(np.diff(starts))
                if not len(filled):
                    continue
                starts = np.append(starts[filled], len(keys))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(filled, pa.int32()), pa.array(np.full(len(filled), chunk), pa.int64()), _binaries(keys[order], starts), _binaries(counts[order].astype(np.int32), starts)],
                    names=["bucket", "chunk", "keys", "counts"],
                )

    return run


def _sums(min_count: int, last: bool):
    """A bucket's frequent pairs (a row without chunk), and which of them each chunk holds."""

    def run(table: pa.Table) -> pa.Table:
        keys, row = _numbers(table.column("keys"), np.int64)
        counts, _ = _numbers(table.column("counts"), np.int32)
        order = np.argsort(keys, kind="stable")
        arranged = keys[order]
        starts = np.flatnonzero(np.concatenate([[True], arranged[1:] != arranged[:-1]]))
        totals = np.add.reduceat(counts[order].astype(np.int64), starts)
        frequent = totals >= min_count
        bucket, chunks = table.column("bucket")[0].as_py(), table.column("chunk").to_numpy()
        found = arranged[starts][frequent]
        chunk, out, sums = [None], [found], [totals[frequent]]
        if not last:
            hit = np.zeros(len(keys), bool)
            hit[order] = np.repeat(frequent, np.diff(np.append(starts, len(keys))))
            at, ends = _split(row[hit], len(chunks))
            held = keys[hit][at]
            for i in np.flatnonzero(np.diff(ends)).tolist():
                chunk.append(int(chunks[i]))
                out.append(held[ends[i]:ends[i + 1]])
                sums.append(np.empty(0, np.int64))
        if not len(found):
            chunk, out, sums = [], [], []
        return pa.table(
            {
                "bucket": pa.array([bucket] * len(chunk), pa.int32()), "chunk": pa.array(chunk, pa.int64()),
                "keys": pa.array([x.tobytes() for x in out], pa.binary()), "sums": pa.array([x.tobytes() for x in sums], pa.binary()),
            }
        )

    return run


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, bucket in enumerate(batch.column(0).to_pylist()):
            keys, sums = (np.frombuffer(batch.column(c)[i].as_buffer(), np.int64) for c in (1, 2))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys), bucket), pa.int32()), pa.array(keys >> 32, pa.int32()), pa.array(keys & 0xFFFFFFFF, pa.int32()), pa.array(sums)],
                names=["bucket", "head", "tail", "f"],
            )


def _looked_up(keys: np.ndarray, known: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The id of each key, or -1; ``known`` is ascending."""
    if not len(known):
        return np.full(len(keys), -1, np.int32)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, ids[at], -1).astype(np.int32)


def _with_ids(held: pa.Table, ranked: pa.Table) -> pa.Table:
    """The ids of the frequent pairs of each chunk, in one bucket."""
    known = ranked.column("head").to_numpy().astype(np.int64) << 32 | ranked.column("tail").to_numpy()
    order = np.argsort(known)
    known, ids = known[order], ranked.column("id").to_numpy()[order]
    found = [_looked_up(np.frombuffer(k.as_buffer(), np.int64), known, ids).tobytes() for c in held.column("keys").chunks for k in c]
    return pa.table({"chunk": held.column("chunk"), "keys": held.column("keys"), "ids": pa.array(found, pa.binary())})


def _squeezed(ids: np.ndarray) -> bytes:
    """The sequence with one -1 for each run of them."""
    keep = np.ones(len(ids), bool)
    keep[1:] = (ids[1:] >= 0) | (ids[:-1] >= 0)
    return ids[keep].astype(np.int32).tobytes()


def _sequence_table(left: pa.Table, ids: list[bytes]) -> pa.Table:
    return pa.table({"chunk": left.column("chunk"), "ids": pa.array(ids, pa.binary())})


def _word_ids(left: pa.Table, right: pa.Table) -> pa.Table:
    """The ids of a chunk's words in place of its codes; rare words part the sequence."""
    out = []
    for binary in (x for c in left.column("codes").chunks for x in c):
        codes = np.frombuffer(binary.as_buffer(), np.int32)
        ids = np.full(max(1, int(codes.max(initial=0)) + 2), -1, np.int32)
        ids[right.column("code").to_numpy()] = right.column("id").to_numpy()
        out.append(_squeezed(ids[codes]))  # code -1 takes the last place, which no word has
    return _sequence_table(left, out)


def _pair_ids(left: pa.Table, right: pa.Table) -> pa.Table:
    """The ids of a chunk's frequent pairs, each where it starts."""
    known, _ = _numbers(right.column("keys"), np.int64)
    ids, _ = _numbers(right.column("ids"), np.int32)
    order = np.argsort(known)
    known, ids, out = known[order], ids[order], []
    for binary in (x for c in left.column("ids").chunks for x in c):
        single = np.frombuffer(binary.as_buffer(), np.int32).astype(np.int64)
        keys = np.where((single[:-1] >= 0) & (single[1:] >= 0), single[:-1] << 32 | single[1:].clip(0), -1)
        out.append(_squeezed(np.append(_looked_up(keys, known, ids), np.int32(-1))))
    return _sequence_table(left, out)


def _by_chunk(sequences: DataFrame, mapping: DataFrame, function) -> DataFrame:
    return sequences.groupBy("chunk").cogroup(mapping.groupBy("chunk")).applyInArrow(function, "chunk long, ids binary")


def _buckets(level: DataFrame) -> int:
    """Buckets for the pairs of neighbours of a level: their number is bounded by the occurrences."""
    total = level.agg(F.sum("f")).first()[0] or 0
    return max(4 * int(level.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / BUCKET_CELLS))


def phrase_counts(docs: DataFrame, *, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS) -> tuple[DataFrame, list[DataFrame]]:
    """``(languages, levels)`` of ``docs(lang, text)``: ``lang, n``, and for phrases of 1, 2, ... words their tables.

    The first level has ``id, lang, word, f``; each other ``id, head, tail, f``, where head and tail are the ids, on the level before, of the phrase
    without its last and without its first word.
    """
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("string").alias("text"))
    chunks = cut(rows.mapInArrow(_chunks, "chunk long, lang string, codes binary, words array<string>, counts array<long>"), large=True)
    words = chunks.select("chunk", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("code", "w")).select("chunk", "lang", "code", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    everywhere = words.withColumn("f", F.sum("n").over(Window.partitionBy("lang", "word")))
    held = cut(everywhere.filter(F.col("f") >= min_count).select("chunk", "lang", "word", "code", "f"))
    languages = chunks.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))

    level = cut(_ranked(held.groupBy("lang", "word").agg(F.max("f").alias("f")), "lang", "word"))
    levels, length = [level], 1
    mapping = held.join(level.select("lang", "word", "id"), ["lang", "word"]).select("chunk", "code", "id")
    sequences = _by_chunk(chunks.select("chunk", "codes"), mapping, _word_ids)
    while length < max_words:
        length += 1
        buckets = _buckets(level)
        last = length == max_words
        if not last:
            sequences = cut(sequences, large=True)
        cells = sequences.mapInArrow(_cells(buckets), "bucket int, chunk long, keys binary, counts binary")
        sums = cut(cells.groupBy("bucket").applyInArrow(_sums(min_count, last), "bucket int, chunk long, keys binary, sums binary"), large=True)
        listed = sums.filter("chunk is null").select("bucket", "keys", "sums").mapInArrow(_listed, "bucket int, head int, tail int, f long")
        level = cut(_ranked(listed, "head", "tail"))
        levels.append(level.drop("bucket"))
        if not last:
            found = sums.filter("chunk is not null").groupBy("bucket").cogroup(level.groupBy("bucket")).applyInArrow(_with_ids, "chunk long, keys binary, ids binary")
            sequences = _by_chunk(sequences, found, _pair_ids)
    return languages, levels


def score_of(a: Column, l: Column, r: Column) -> Column:
    """``floor(1000000 * a * a / (l * r))``, exact for counts below 10 to the power of 15."""
    a, l, r = (x.cast("decimal(15,0)") for x in (a, l, r))
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * a * a, l * r).cast("long")


def _grown(before: DataFrame, level: DataFrame) -> DataFrame:
    """Phrases with one word more: their words, and the counts of all their beginnings and ends."""
    head = before.select(F.col("id").alias("head"), "lang", "words", F.concat("starts", F.array("f")).alias("starts"))
    tail = before.select(F.col("id").alias("tail"), F.element_at("words", -1).alias("more"), F.concat("ends", F.array("f")).alias("ends"))
    joined = level.join(head, "head").join(tail, "tail")
    return joined.select("id", "lang", F.concat("words", F.array("more")).alias("words"), "starts", "ends", "f")


def collocations(docs: DataFrame, *, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP, inside: int = INSIDE) -> DataFrame:
    """The first ``top`` phrases of each language of ``docs(lang, text)``: ``lang, rank, phrase, a, l, r, n, score``.

    ``a`` counts the phrase, ``l`` and ``r`` the two parts at the cut with the least score (the first such cut), ``n`` all words of the language. A
    phrase goes if a longer one of at most ``max_words`` words holds it and is at least ``inside`` hundredths as frequent.
    """
    languages, levels = phrase_counts(docs, min_count=min_count, max_words=max_words)
    none = F.array().cast("array<long>")
    grams = levels[0].select("id", "lang", F.array("word").alias("words"), none.alias("starts"), none.alias("ends"), "f")
    found = []
    for length, level in enumerate(levels[1:], 2):
        grams = _grown(grams, level)
        if length < max_words:
            grams = cut(grams)
        size = length

        def at(k: Column) -> Column:
            l, r = F.element_at("starts", k), F.element_at("ends", size - k)
            return F.struct(score_of(F.col("f"), l, r).alias("score"), k.alias("k"), l.alias("l"), r.alias("r"))

        scored = grams.withColumn("best", F.array_min(F.transform(F.sequence(F.lit(1), F.lit(size - 1)), at)))
        if length < max_words:
            longer = levels[length]
            parts = longer.select(F.col("head").alias("id"), F.col("f").alias("g")).unionByName(longer.select(F.col("tail").alias("id"), F.col("f").alias("g")))
            scored = scored.join(parts.groupBy("id").agg(F.max("g").alias("g")), "id", "left").filter(F.col("g").isNull() | (100 * F.col("g") < inside * F.col("f")))
        found.append(scored.select("lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), "best.l", "best.r", "best.score"))
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    dealt = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top).drop("part", "rank")
    ranked = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(languages, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
