"""Packing documents into sequences with a grouping genetic algorithm on islands (operator 7).

Documents become pieces of at most ``capacity`` ids; full pieces are sequences of their own. The other pieces are dealt by a
hash into cells of about ``CELL`` pieces, or of more where those would not fill ``CELL_BINS`` sequences, so the work of a task does not depend on the size of the table. Each cell is evolved by
``ISLANDS`` tasks that start from different populations; between epochs each island sends its best packing to the next one.

* Crossover injects whole, well-filled bins of one parent into the other, removes the bins that hold an injected piece a
  second time, and best-fits the pieces displaced by that, largest first.
* Mutation opens the least-filled bins and best-fits their pieces.
* An island ends at once, before any crossover, when its first best fit needs no more bins than the total length divided by the capacity, rounded up;
  many short pieces often allow that.

The least-filled bins of every cell (at most one in ``OPEN_SHARE``) are opened again and their pieces packed across cells in the same
way, until one cell is left.

Defined cases: a null or empty text has the end id alone; repeated rows are packed once each; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import math
import random
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemill.llm.encoder import END_ID, shared_encoder, tokenizer_path
from tidemill.llm.words import released, slices, text_column
from tidemill.session import bound_batches, cut

CAPACITY = 4096
CELL = 4096
ISLANDS = 3
EPOCHS = 2
GENERATIONS = 4
POPULATION = 4
CELL_BINS = 4
OPEN_SHARE = 40
#: Text bytes encoded at once inside a task.
ENCODED_BYTES = 2 << 20

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, *, tokenizer: str | None = None, end_id: int | None = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """``docs(doc_id, text)`` cut into pieces: ``doc_id, piece, start, length, ids_crc32``."""
    tokenizer = tokenizer or tokenizer_path()
    bound_batches(docs.sparkSession)

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(tokenizer)
        for batch in batches:
            for part in slices(batch, limit=ENCODED_BYTES):
                ids, offsets = encoder.encode(text_column(part), end_id)
                data = memoryview(ids.astype("<u4").tobytes())
                lengths = np.diff(offsets)
                counts = -(-lengths // capacity)
                source = np.repeat(np.arange(len(lengths)), counts)
                number = np.arange(len(source)) - np.repeat(np.cumsum(counts) - counts, counts)
                begin = number * capacity
                size = np.minimum(lengths[source] - begin, capacity)
                first = 4 * (offsets[source] + begin)
                sums = [zlib.crc32(data[a:a + 4 * n]) for a, n in zip(first.tolist(), size.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(source)), pa.array(number, pa.int32()), pa.array(begin), pa.array(size), pa.array(sums, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(released(cut_up), PIECES)


class _Packing:
    """Bins of one cell: ``members`` lists the items of each bin, ``loads`` their total length."""

    def __init__(self, members: list[list[int]], loads: list[int]):
        self.members, self.loads = members, loads

    def fitness(self, capacity: int) -> tuple[int, float]:
        """Fewer bins first, then the more uneven filling, which leaves room that can still be used."""
        return len(self.loads), -float(np.square(np.array(self.loads) / capacity).sum())

    def labels(self, n: int) -> np.ndarray:
        out = np.empty(n, np.int32)
        for number, items in enumerate(self.members):
            out[items] = number
        return out

    @staticmethod
    def from_labels(labels: np.ndarray, sizes: list[int]) -> _Packing:
        members: list[list[int]] = [[] for _ in range(int(labels.max()) + 1)]
        loads = [0] * len(members)
        for item, number in enumerate(labels.tolist()):
            members[number].append(item)
            loads[number] += sizes[item]
        return _Packing(members, loads)


def _best_fit(packing: _Packing, items: list[int], sizes: list[int], capacity: int) -> _Packing:
    """Put each item into the fullest bin that still has room for it, opening bins as needed."""
    members, loads = packing.members, packing.loads
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r is set when some bin has exactly r left
    for number, load in enumerate(loads):
        by_room.setdefault(capacity - load, []).append(number)
    for room in by_room:
        rooms |= 1 << room
    for item in items:
        size = sizes[item]
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            same = by_room[room]
            number = same.pop()
            if not same:
                rooms ^= 1 << room
        else:
            room, number = capacity, len(loads)
            members.append([])
            loads.append(0)
        members[number].append(item)
        loads[number] += size
        left = room - size
        bins = by_room.setdefault(left, [])
        if not bins:
            rooms |= 1 << left
        bins.append(number)
    return packing


def _without(packing: _Packing, gone: set[int]) -> _Packing:
    kept = [i for i in range(len(packing.loads)) if i not in gone]
    return _Packing([list(packing.members[i]) for i in kept], [packing.loads[i] for i in kept])


def _cross(a: _Packing, b: _Packing, sizes: list[int], capacity: int, rng: random.Random) -> _Packing:
    """``a`` with some well-filled bins of ``b`` injected whole."""
    median = sorted(b.loads)[len(b.loads) // 2]
    injected = [i for i, load in enumerate(b.loads) if load >= median and rng.random() < 0.3]
    taken = {item for i in injected for item in b.members[i]}
    hit = {i for i, items in enumerate(a.members) if not taken.isdisjoint(items)}
    displaced = [item for i in hit for item in a.members[i] if item not in taken]
    child = _without(a, hit)
    child.members += [list(b.members[i]) for i in injected]
    child.loads += [b.loads[i] for i in injected]
    return _best_fit(child, sorted(displaced, key=lambda i: -sizes[i]), sizes, capacity)


def _mutate(packing: _Packing, sizes: list[int], capacity: int, rng: random.Random) -> _Packing:
    """Open the emptiest bins and a few others, and place their items again."""
    order = sorted(range(len(packing.loads)), key=packing.loads.__getitem__)
    opened = set(order[: 2 + len(order) // 50]) | set(rng.sample(order, min(len(order), 3)))
    items = [item for i in opened for item in packing.members[i]]
    return _best_fit(_without(packing, opened), sorted(items, key=lambda i: -sizes[i]), sizes, capacity)


def evolve(sizes: list[int], population: list[_Packing], capacity: int, rng: random.Random, generations: int = GENERATIONS, limit: int = POPULATION) -> list[_Packing]:
    """The population after some generations, the best first."""
    least = math.ceil(sum(sizes) / capacity)
    if not population:
        for spread in (0.0, 0.05, 0.15, 0.3)[:limit]:
            order = sorted(range(len(sizes)), key=lambda i: -sizes[i] * (1 + spread * rng.random()))
            population.append(_best_fit(_Packing([], []), order, sizes, capacity))
            if len(population[-1].loads) <= least:
                break
    def rank(p: _Packing) -> tuple[int, float]:
        return p.fitness(capacity)

    population.sort(key=rank)
    for _ in range(generations):
        if len(population[0].loads) <= least:
            break
        children = []
        for i in range(len(population)):
            a, b = population[i], rng.choice(population)
            child = _cross(a, b, sizes, capacity, rng) if a is not b else _mutate(a, sizes, capacity, rng)
            children.append(_mutate(child, sizes, capacity, rng) if rng.random() < 0.5 else child)
        population = sorted(population + children, key=rank)[:limit]
    return population


_STATE = "cell long, island int, uids binary, sizes binary, labels array<binary>, bins int, score double"


def _evolved(frame: pd.DataFrame, cell: int, island: int, epoch: int, capacity: int) -> pd.DataFrame:
    own = frame[frame.own].iloc[0]
    sizes = np.frombuffer(own.sizes, np.int32).tolist()
    # In the order of the islands they come from, as the order of a group's rows is not defined.
    population = [_Packing.from_labels(np.frombuffer(x, np.int32), sizes) for row in frame.sort_values(["own", "origin"]).labels for x in row]
    rng = random.Random(f"{cell}/{island}/{epoch}")
    best = evolve(sizes, population, capacity, rng)
    bins, score = best[0].fitness(capacity)
    labels = [p.labels(len(sizes)).tobytes() for p in best]
    return pd.DataFrame({"cell": [cell], "island": [island], "uids": [own.uids], "sizes": [own.sizes], "labels": [labels], "bins": [bins], "score": [score]})


def _next_epoch(epoch: int, capacity: int):
    def step(key, frame: pd.DataFrame) -> pd.DataFrame:
        return _evolved(frame, key[0], key[1], epoch, capacity)

    return step


def _pack_cells(items: DataFrame, cells: int, capacity: int, level: int) -> DataFrame:
    """``items(uid, length)`` packed per cell: ``uid, sequence_id, offset, open``."""

    def start(key, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("uid")
        uids, sizes = frame.uid.to_numpy(np.int64).tobytes(), frame.length.to_numpy(np.int32).tobytes()
        row = pd.DataFrame({"own": [True], "origin": [key[1]], "uids": [uids], "sizes": [sizes], "labels": [[]]})
        return _evolved(row, key[0], key[1], 0, capacity)

    # A cell's pieces go to each of its islands, which are groups, and so tasks, of their own.
    dealt = items.withColumn("cell", F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(cells))).withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))))
    state = dealt.groupBy("cell", "island").applyInPandas(start, _STATE)
    for epoch in range(1, EPOCHS):
        stay = F.struct(F.col("island").alias("to"), F.lit(True).alias("own"), "uids", "sizes", "labels")
        empty = F.lit(b"")
        leave = F.struct(((F.col("island") + 1) % ISLANDS).alias("to"), F.lit(False).alias("own"), empty.alias("uids"), empty.alias("sizes"), F.slice("labels", 1, 1).alias("labels"))
        moved = state.select("cell", F.col("island").alias("origin"), F.explode(F.array(stay, leave)).alias("s")).select("cell", "origin", "s.*")
        state = moved.groupBy("cell", "to").applyInPandas(_next_epoch(epoch, capacity), _STATE)
    best = state.groupBy("cell").agg(F.min_by(F.struct("uids", "sizes", "labels"), F.struct("bins", "score", "island")).alias("b")).select("cell", "b.*")

    def placed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                uids, sizes, labels = np.frombuffer(row.uids, np.int64), np.frombuffer(row.sizes, np.int32).astype(np.int64), np.frombuffer(row.labels[0], np.int32)
                order = np.argsort(labels, kind="stable")
                ends = np.cumsum(sizes[order])
                loads = np.bincount(labels, sizes).astype(np.int64)
                before = np.cumsum(loads) - loads
                opened = np.zeros(len(loads), bool)
                opened[np.argsort(loads, kind="stable")[: max(1, len(loads) // OPEN_SHARE)]] = True
                opened &= loads < capacity
                yield pd.DataFrame({
                    "uid": uids[order], "sequence_id": (level << 56) | (row.cell << 24) | labels[order].astype(np.int64),
                    "offset": ends - sizes[order] - before[labels[order]], "open": opened[labels[order]], "length": sizes[order],
                })

    return best.mapInPandas(placed, "uid long, sequence_id long, offset long, open boolean, length long")


def pack(docs: DataFrame, *, tokenizer: str | None = None, end_id: int | None = END_ID, capacity: int = CAPACITY, cell: int = CELL) -> DataFrame:
    """``docs(doc_id, text)`` packed: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    every = cut(pieces(docs, tokenizer=tokenizer, end_id=end_id, capacity=capacity).withColumn("uid", F.monotonically_increasing_id()))
    full = every.filter(F.col("length") == capacity).withColumns({"sequence_id": -1 - F.col("uid"), "offset": F.lit(0).cast("long")})
    part = every.filter(F.col("length") < capacity)
    items, level, closed, before = part.select("uid", "length"), 0, None, None
    while (size := items.agg(F.count("*").alias("n"), F.sum("length").alias("ids")).first()).n:  # two numbers
        cells = max(1, min(math.ceil(size.n / cell), size.ids // (CELL_BINS * capacity)))
        if before and size.ids > before[1] / 2:  # every level has to come nearer to the last
            cells = max(1, min(cells, before[0] // 2))
        packed = cut(_pack_cells(items, cells, capacity, level))
        done = packed if cells == 1 else packed.filter(~F.col("open"))
        done = done.select("uid", "sequence_id", "offset")
        closed = done if closed is None else closed.unionByName(done)
        if cells == 1:
            break
        items, level, before = packed.filter("open").select("uid", "length"), level + 1, (cells, size.ids)
    if closed is None:
        return full.drop("uid")
    return part.join(closed, "uid").unionByName(full).drop("uid")
