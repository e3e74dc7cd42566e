"""Near-duplicate embeddings by cross-polytope hashing (operator 8).

1. Equal vectors become one from here on, weighing as many as they are.
2. In each of ``TABLES`` tables a vector is turned ``JOINED`` times by fast pseudo-random rotations (three rounds of random signs and a Hadamard
   transform); each turn hashes it to the nearest of the 2 d signed axes, and the hashes together name its bucket. It also enters the buckets that
   differ by the second nearest axis in one of the hashes (multiprobe). Two vectors meet where the home bucket of one is among the buckets of
   the other.
3. A crowded bucket has a centre, one of its vectors. Vectors within half the angle of the least cosine from one centre are a *ball*: all of them are linked
   with each other, by the triangle inequality of angles, so their links are counted and never computed.
4. Buckets are cut into blocks of about ``BLOCK`` vectors, those of a ball apart from the others, and each pair of blocks but those of one ball is a task's
   unit of work: all cosines at once, in double precision. A pair that meets several times counts only at its first meeting, which both vectors'
   buckets tell, so pairs are never written out: a unit gives each vector's number of links and, for connectivity, the least vector it is
   connected with inside the unit. Until then only numbers of vectors are dealt.

The chance that two vectors of cosine 0.95 in 64 dimensions never meet is below 0.0002 (0.68 per table); every link reported is exact.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite component are linked with nothing and are their own
component; only vectors of the same length are compared; repeated rows are vectors of their own; a null id is never the name of
a component that has another; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemill.llm.components import components
from tidemill.session import cut

COSINE = 0.95
TABLES = 8
JOINED = 2
BLOCK = 256
SEED = 8
_BUCKET = ["size", "table", "bucket"]


def _hadamard(x: np.ndarray) -> np.ndarray:
    n, step = x.shape[1], 1
    while step < n:
        pairs = x.reshape(len(x), -1, 2, step)
        x = np.concatenate([pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], axis=2).reshape(len(x), n)
        step *= 2
    return x / np.sqrt(n)


def buckets(vectors: np.ndarray, tables: int = TABLES, joined: int = JOINED, seed: int = SEED) -> np.ndarray:
    """``(vector, table, probe)``: bucket numbers, the home bucket first."""
    size = 1 << max(0, vectors.shape[1] - 1).bit_length()
    padded = np.zeros((len(vectors), size))
    padded[:, :vectors.shape[1]] = vectors
    rng = np.random.default_rng([seed, size])
    out = np.empty((len(vectors), tables, joined + 1), np.int64)
    for table in range(tables):
        best, second = [], []
        for _ in range(joined):
            turned = padded
            for _ in range(3):
                turned = _hadamard(turned * rng.choice([-1.0, 1.0], size))
            order = np.argsort(-np.abs(turned), axis=1, kind="stable")[:, :2]
            axis = 2 * order + (np.take_along_axis(turned, order, 1) < 0)
            best.append(axis[:, 0])
            second.append(axis[:, -1])
        for probe in range(joined + 1):
            bucket = np.zeros(len(vectors), np.int64)
            for k in range(joined):
                bucket = bucket * 2 * size + (second[k] if probe == k + 1 else best[k])
            out[:, table, probe] = bucket
    return out


def _matrix(column: pa.Array, dtype: str) -> np.ndarray:
    return np.stack([np.frombuffer(x.as_py(), dtype) for x in column]) if len(column) else np.empty((0, 0))


def _hashed(tables: int, joined: int):
    """``sid, weight, v, size`` to ``sid, weight, size, vector, buckets``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(3).to_numpy()
            for size in np.unique(sizes):
                some = batch.filter(pa.array(sizes == size))
                for start in range(0, some.num_rows, 1024):
                    part = some.slice(start, 1024)
                    vectors = np.array(part.column(2).to_pylist(), np.float64)
                    found = buckets(vectors, tables, joined)
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0), part.column(1), part.column(3),
                            pa.array([v.tobytes() for v in vectors], pa.binary()), pa.array([f.tobytes() for f in found], pa.binary()),
                        ],
                        names=["sid", "weight", "size", "vector", "buckets"],
                    )

    return run


def _entries(tables: int, joined: int):
    """``sid, size, buckets`` to one row per table and bucket: ``home, table, bucket, size, sid``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = _matrix(batch.column(2), "i8").reshape(batch.num_rows, tables, joined + 1)
            n, probes = batch.num_rows, joined + 1
            own = np.ones(found.shape, bool)
            own[:, :, 1:] = found[:, :, 1:] != found[:, :, :1]  # in one dimension there is no second axis
            own = own.reshape(-1)
            row = pa.array(np.repeat(np.arange(n), tables * probes)[own])
            table = np.tile(np.repeat(np.arange(tables), probes), n)[own]
            home = (np.tile(np.arange(probes), n * tables) == 0)[own]
            yield pa.RecordBatch.from_arrays(
                [pa.array(home), pa.array(table, pa.int32()), pa.array(found.reshape(-1)[own]), batch.column(1).take(row), batch.column(0).take(row)],
                names=["home", "table", "bucket", "size", "sid"],
            )

    return run


def _near_centre(cosine: float):
    """Rows ``sid, ball, vector, centre`` to those within half the angle of the least cosine."""
    least = float(np.cos(np.arccos(cosine) / 2 - 1e-7))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                a, b = np.frombuffer(x.as_buffer()), np.frombuffer(y.as_buffer())
                keep.append(bool(a @ b >= least * np.sqrt((a @ a) * (b @ b))))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def _balls(entries: DataFrame, full: DataFrame, base: DataFrame, cosine: float) -> DataFrame:
    """``sid, ball``: vectors near the centre of a crowded bucket; of several centres the one that has the most."""
    homes = entries.filter("home").join(full.filter(F.col("members") > BLOCK).select(*_BUCKET), _BUCKET)
    centres = homes.groupBy(*_BUCKET).agg(F.min(F.struct(F.xxhash64("sid").alias("h"), "sid")).alias("c")).select(*_BUCKET, F.col("c.sid").alias("ball"))
    vectors = base.select("sid", "vector")

    def near(met: DataFrame) -> DataFrame:
        asked = met.join(vectors, "sid").join(vectors.toDF("ball", "centre"), "ball").select("sid", "ball", "vector", "centre")
        return cut(asked.mapInArrow(_near_centre(cosine), "sid long, ball long"))

    def chosen(found: DataFrame) -> DataFrame:
        sizes = found.groupBy("ball").agg(F.count("*").alias("n"))
        return cut(found.join(sizes, "ball").groupBy("sid").agg(F.max(F.struct("n", "ball")).alias("b")).select("sid", "b.ball"))

    met = cut(homes.join(centres, _BUCKET).select("sid", "ball").distinct())
    found = near(met)
    # Once more with the centre that most of a bucket chose, so that a crowd that several tables divide agrees on one.
    votes = homes.join(chosen(found), "sid").groupBy(*_BUCKET, "ball").agg(F.count("*").alias("n"))
    favourite = votes.groupBy(*_BUCKET).agg(F.max(F.struct("n", "ball")).alias("v")).select(*_BUCKET, F.col("v.ball").alias("ball"))
    again = homes.join(favourite, _BUCKET).select("sid", "ball").distinct().join(met, ["sid", "ball"], "left_anti")
    return chosen(found.unionByName(near(again)))


def _units(entries: DataFrame, full: DataFrame, balls: DataFrame) -> DataFrame:
    """Pairs of blocks of each bucket with the numbers of their vectors: the bucket's columns, ``low, high, block, home, sid``.

    A block holds vectors of one ball, or of none; blocks of one ball do not meet.
    """
    grouped = entries.join(full.select(*_BUCKET), _BUCKET).join(balls, "sid", "left")
    counted = cut(grouped.groupBy(*_BUCKET, "ball").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")))
    same = [grouped[c] == counted[c] for c in _BUCKET] + [grouped["ball"].eqNullSafe(counted["ball"])]
    part = F.pmod(F.xxhash64(grouped["sid"]), counted["blocks"]).alias("part")
    number = F.xxhash64(F.coalesce("ball", F.lit(-1)), "part")
    placed = grouped.join(counted, same).select(*[grouped[c] for c in _BUCKET], "home", "sid", grouped["ball"], part).withColumn("block", number)
    others = counted.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(*_BUCKET, F.col("ball").alias("other_ball"), number.alias("other"))
    units = placed.join(others, _BUCKET).filter(F.col("ball").isNull() | F.col("other_ball").isNull() | (F.col("ball") != F.col("other_ball")))
    return units.select(*_BUCKET, F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "home", "sid")


def _links_of(vectors, norms, found, home, block, table, bucket, low, high, cosine) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs ``(i, j)`` of one unit that meet here first."""
    a, b = np.flatnonzero(block == low), np.flatnonzero(block == high)
    product = (vectors[a] @ vectors[b].T) / (norms[a][:, None] * norms[b][None, :])
    near = product >= cosine - 1e-9
    if low == high:
        near &= np.arange(len(a))[:, None] < np.arange(len(b))[None, :]
    near &= home[a][:, None] | home[b][None, :]
    i, j = np.nonzero(near)
    i, j = a[i], b[j]
    if len(i):  # the same sum for every pair, whatever the shape of the block
        exact = np.einsum("ij,ij->i", vectors[i], vectors[j]) / (norms[i] * norms[j])
        i, j = i[exact >= cosine], j[exact >= cosine]
    if not len(i):
        return i, j
    hi, hj = found[i, :, 0], found[j, :, 0]
    at_i = (found[j] == hi[:, :, None]).any(axis=2)
    at_j = (found[i] == hj[:, :, None]).any(axis=2)
    first = (at_i | at_j).argmax(axis=1)
    rows = np.arange(len(i))
    far = np.iinfo(np.int64).max
    where = np.minimum(np.where(at_i, hi, far)[rows, first], np.where(at_j, hj, far)[rows, first])
    here = (first == table) & (where == bucket)
    return i[here], j[here]


def _compare(tables: int, joined: int, cosine: float):
    names = ["table", "bucket", "low", "high", "block", "home", "sid", "weight", "vector", "buckets", "size"]

    def unit(rows: pa.RecordBatch):
        vectors, found = _matrix(rows.column(8), "f8"), _matrix(rows.column(9), "i8").reshape(rows.num_rows, tables, joined + 1)
        norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        home, block = rows.column(5).to_numpy(zero_copy_only=False), rows.column(4).to_numpy()
        table, bucket, low, high = (rows.column(c)[0].as_py() for c in range(4))
        i, j = _links_of(vectors, norms, found, home, block, table, bucket, low, high, cosine)
        if not len(i):
            return None
        sid, weight = rows.column(6).to_numpy(), rows.column(7).to_numpy()
        n = np.bincount(i, weight[j], len(sid)) + np.bincount(j, weight[i], len(sid))
        least = sid.copy()
        while True:
            before = least.copy()
            np.minimum.at(least, i, before[j])
            np.minimum.at(least, j, before[i])
            if (least == before).all():
                break
        linked = n > 0
        return pa.RecordBatch.from_arrays([pa.array(sid[linked]), pa.array(n[linked].astype(np.int64)), pa.array(least[linked])], names=["sid", "n", "least"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            if not rows.num_rows:
                continue
            keys = np.stack([rows.column(names.index(c)).to_numpy().astype(np.int64) for c in ("size", "table", "bucket", "low", "high")])
            starts = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)]))
            for a, z in zip(starts[:-1].tolist(), starts[1:].tolist()):
                if z - a > 1 and (out := unit(rows.slice(a, z - a))) is not None:
                    yield out
            held = rows.slice(int(starts[-1]))
        if held is not None and held.num_rows > 1 and (out := unit(held)) is not None:
            yield out

    return names, run


def near_vectors(vectors: DataFrame, *, cosine: float = COSINE, tables: int = TABLES, joined: int = JOINED) -> DataFrame:
    """``vectors(vec_id, embedding)``: ``vec_id, n_links, component_id, kept``."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.withColumn("valid", F.coalesce(finite, F.lit(False)))
    key = ["k1", "k2"]
    rows = rows.withColumns({"k1": F.when(F.col("valid"), F.xxhash64("v")), "k2": F.when(F.col("valid"), F.xxhash64(F.lit(1), "v"))})
    one = rows.filter("valid").groupBy(*key).agg(F.count("*").alias("weight"), F.first("v").alias("v"))
    one = cut(one.withColumn("sid", F.monotonically_increasing_id()))
    written = "sid long, weight long, size int, vector binary, buckets binary"
    base = cut(one.select("sid", "weight", "v", F.size("v").alias("size")).mapInArrow(_hashed(tables, joined), written))
    entries = cut(base.select("sid", "size", "buckets").mapInArrow(_entries(tables, joined), "home boolean, table int, bucket long, size int, sid long"))

    full = cut(entries.groupBy(*_BUCKET).agg(F.count("*").alias("members"), F.count_if("home").alias("homes")).filter("members > 1 and homes > 0"))
    balls = _balls(entries, full, base, cosine)
    units = _units(entries, full, balls)
    names, compare = _compare(tables, joined, cosine)
    unit = [*_BUCKET, "low", "high"]
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    carried = units.select(*unit, "block", "home", "sid").join(base.select("sid", "weight", "vector", "buckets"), "sid")
    dealt = carried.select(*names).repartition(parts, *unit).sortWithinPartitions(*unit)
    found = cut(dealt.mapInArrow(compare, "sid long, n long, least long"))

    inside = balls.join(one.select("sid", "weight"), "sid")
    whole = inside.groupBy("ball").agg(F.sum("weight").alias("all"))
    inside = inside.join(whole, "ball").select("sid", (F.col("all") - F.col("weight")).alias("n"), F.col("ball").alias("least"))
    found = found.unionByName(inside)
    counts = found.groupBy("sid").agg(F.sum("n").alias("n"))
    where = components(found.select(F.col("sid").alias("a"), F.col("least").alias("b"))).select(F.col("node").alias("sid"), "component")
    placed = one.select(*key, "sid", "weight").join(counts, "sid", "left").join(where, "sid", "left")
    placed = placed.select(*key, (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "sid").alias("component"))
    known = rows.select("vec_id", *key).join(placed, key, "left")
    named = known.groupBy("component").agg(F.min("vec_id").alias("least")).filter("component is not null")
    name = F.when(F.col("component").isNull(), F.col("vec_id")).otherwise(F.col("least"))
    return known.join(named, "component", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), name.alias("component_id"), F.coalesce(F.col("vec_id") == name, F.lit(False)).alias("kept")
    )
