"""Nearest neighbours of vectors by cosine, through an inverted file of centroids.

Every vector lies in the list of its nearest centroid. A query first asks the few lists whose centroids are nearest to it; the lowest cosine among its
best so far then tells which of the other lists could still hold a nearer vector: a list's members lie within a known angle of its centroid, so
none of them is nearer to the query than the angle to the centroid less that one. Those lists are asked too unless ``exact`` is off.

Work is dealt by list and part of a list, so a crowded list is spread over many tasks. A task multiplies the vectors of its part with the queries that ask
for it and keeps the best few of each; pairs are never written out. Of exact copies only as many take part as one answer can hold.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemill.session import cut

#: Vectors that the centroids are fitted on, at most; lists have about ``LIST_ROWS`` vectors, and there are at most ``MAX_LISTS`` lists.
FIT_ROWS = 16_384
LIST_ROWS = 1_000
MAX_LISTS = 1_024
#: Vectors, or queries, of a list that one task gets at once.
PART_ROWS = 4_096
PROBES = 8
#: Cosines are compared after rounding to this many digits, so equal ones rank by id whatever the order they are added up in.
DIGITS = 9


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Unit vectors, one row each."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(flat):
        return np.empty((0, 0))
    rows = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)
    scale = np.abs(rows).max(axis=1, keepdims=True)
    rows = rows / scale  # keeps the squares of very large and very small numbers finite
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def usable(vectors: DataFrame, vector: str, dimension: int) -> DataFrame:
    """The rows that can be compared: of that many finite numbers, not all zero."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.filter((F.size(v) == dimension) & F.coalesce(fine, F.lit(False)))


def common_dimension(vectors: DataFrame, vector: str) -> int:
    """The commonest length of the vectors, the largest of several; 0 without any."""
    sizes = vectors.filter(F.size(vector) > 0).groupBy(F.size(vector).alias("d")).count()
    first = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    return first.d if first else 0


def fit_centroids(vectors: DataFrame, lists: int | None = None, *, rows: int = FIT_ROWS, rounds: int = 12) -> np.ndarray:
    """Unit centroids of ``vectors(id, v)``, by spherical k-means on a sample of at most ``rows`` of them."""
    lists = lists or min(MAX_LISTS, max(1, math.ceil(vectors.count() / LIST_ROWS)))
    sample = vectors.orderBy(F.xxhash64("id"), "id").limit(max(lists, rows)).select("v").toArrow()
    points = np.unique(_matrix(sample.column("v")), axis=0)
    if not len(points):
        return points
    rng = np.random.default_rng(len(points))
    centroids = points[rng.permutation(len(points))[:lists]]
    for _ in range(rounds):
        nearest = (points @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        length = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centroids = np.where(length > 1e-12, sums / np.maximum(length, 1e-12), centroids)
    return centroids


def _assigned(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = _matrix(batch.column(1)) @ centroids.T
                at = near.argmax(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int32()), pa.array(near[np.arange(len(at)), at])], names=["id", "v", "list", "near"])

    return run


def inverted_file(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``id, v, list, near``: each vector with its list and the cosine to its centroid. Worth keeping as a table."""
    return vectors.select("id", "v").mapInArrow(_assigned(centroids), "id long, v array<double>, list int, near double")


def _asked(centroids: np.ndarray, probes: int, reach: np.ndarray | None):
    """``qid, q, list`` for the ``probes`` lists nearest to a query; with ``reach`` for the others that could hold a nearer vector than its last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            near = _matrix(batch.column(1)) @ centroids.T
            first = np.zeros(near.shape, bool)
            np.put_along_axis(first, np.argsort(-near, axis=1, kind="stable")[:, :probes], True, axis=1)
            if reach is not None:
                last = batch.column(2).to_numpy(zero_copy_only=False)
                angle = np.arccos(np.clip(near, -1, 1)) - reach[None, :]
                able = np.cos(np.maximum(angle, 0)) >= last[:, None] - 10.0 ** (2 - DIGITS)
                first = able & ~first & (reach >= 0)[None, :]
            query, lists = np.nonzero(first)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(query)), batch.column(1).take(pa.array(query)), pa.array(lists, pa.int32())], names=["qid", "q", "list"])

    return run


def _best(k: int):
    """The best ``k`` of one part of a list, for each query that asks for it."""

    def run(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        qids, ids = queries.column("qid").to_numpy(), vectors.column("id").to_numpy()
        out: list[list[np.ndarray]] = [[], [], []]
        if len(qids) and len(ids):
            order = np.argsort(ids, kind="stable")
            ids, members = ids[order], _matrix(vectors.column("v"))[order]
            asked = _matrix(queries.column("q"))
            for start in range(0, len(qids), 256):
                near = np.round(asked[start:start + 256] @ members.T, DIGITS)
                near[qids[start:start + 256, None] == ids[None, :]] = -np.inf
                top = np.argsort(-near, axis=1, kind="stable")[:, :k]  # ids ascend, so equal cosines rank by id
                found = np.take_along_axis(near, top, axis=1)
                row, column = np.nonzero(np.isfinite(found))
                out[0].append(qids[start + row])
                out[1].append(ids[top[row, column]])
                out[2].append(found[row, column])
        columns = [np.concatenate(x) if x else np.empty(0, t) for x, t in zip(out, (np.int64, np.int64, np.float64))]
        return pa.table({"qid": pa.array(columns[0], pa.int64()), "neighbour_id": pa.array(columns[1], pa.int64()), "cosine": pa.array(columns[2], pa.float64())})

    return run


def _searched(file: DataFrame, sizes: dict[int, int], asked: DataFrame, k: int) -> DataFrame:
    """``qid, neighbour_id, cosine``: the best ``k`` of every part of every list asked."""
    spark = file.sparkSession
    wanted = asked.groupBy("list").count()
    known = spark.createDataFrame(list(sizes.items()) or [(0, 0)], "list int, members long")  # a row per list
    parts = wanted.join(F.broadcast(known), "list").select(
        "list", F.ceil(F.col("members") / PART_ROWS).cast("int").alias("parts"), F.ceil(F.col("count") / PART_ROWS).cast("int").alias("blocks")
    )

    def dealt(rows: DataFrame, own: str, number: str, other: str, times: str, key: str) -> DataFrame:
        """Each row goes to one of its own parts, and once to every part of the other side."""
        split = rows.join(F.broadcast(parts), "list").withColumn(own, F.pmod(F.xxhash64(key), F.col(number)).cast("int"))
        return split.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(times) - 1))).drop("parts", "blocks")

    queries = dealt(asked, "block", "blocks", "part", "parts", "qid").groupBy("list", "part", "block")
    members = dealt(file.select("id", "v", "list"), "part", "parts", "block", "blocks", "id").groupBy("list", "part", "block")
    return queries.cogroup(members).applyInArrow(_best(k), "qid long, neighbour_id long, cosine double")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("qid").orderBy(F.desc("cosine"), "neighbour_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_neighbours(
    vectors: DataFrame, k: int = 10, *, queries: DataFrame | None = None, id: str = "vec_id", vector: str = "embedding", lists: int | None = None,
    probes: int = PROBES, exact: bool = True,
) -> DataFrame:
    """The ``k`` nearest other vectors by cosine: ``id, rank, neighbour_id, cosine``; equal cosines rank by ascending id.

    ``queries`` are rows like those of ``vectors``, by default all of them; a query is never its own neighbour, which its id tells. With ``exact`` off only
    the ``probes`` nearest lists are asked. Vectors that are null or zero, hold null or non-finite numbers, or differ in length
    from most are no neighbours and have none. Ids are taken to be unique; rows without an id are left out.
    """
    rows = vectors.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).filter("id is not null")
    dimension = common_dimension(rows, "v")
    fine = usable(rows, "v", dimension)
    # Of exact copies an answer holds at most k + 1, those with the least ids; the limit is applied before the shuffle too.
    copies = Window.partitionBy("v").orderBy("id")
    kept = cut(fine.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= k + 1).select("id", "v"))
    centroids = fit_centroids(kept, lists) if dimension else np.empty((0, 0))
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], f"`{id}` long, rank int, neighbour_id long, cosine double")
    file = cut(inverted_file(kept, centroids))
    stats = file.groupBy("list").agg(F.count("*").alias("n"), F.min("near").alias("far")).collect()
    sizes = {r.list: r.n for r in stats}
    reach = np.full(len(centroids), -1.0)  # a list without members reaches nothing
    for r in stats:
        reach[r.list] = math.acos(max(-1.0, min(1.0, r.far)))

    asked = fine if queries is None else usable(queries.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).filter("id is not null"), "v", dimension)
    asked = asked.select(F.col("id").alias("qid"), F.col("v").alias("q"))
    first = asked.mapInArrow(_asked(centroids, probes, None), "qid long, q array<double>, list int")
    found = _searched(file, sizes, first, k)
    if exact and probes < len(sizes):
        found = cut(found)
        best = _ranked(found, k).groupBy("qid").agg(F.count("*").alias("n"), F.min("cosine").alias("last"))
        least = best.select("qid", F.when(F.col("n") == k, F.col("last")).otherwise(-2.0).alias("last"))
        open_ones = asked.join(least, "qid", "left").select("qid", "q", F.coalesce("last", F.lit(-2.0)).alias("last"))
        second = open_ones.mapInArrow(_asked(centroids, probes, reach), "qid long, q array<double>, list int")
        found = found.unionByName(_searched(file, sizes, second, k))
    return _ranked(found, k).select(F.col("qid").alias(id), "rank", "neighbour_id", "cosine")
