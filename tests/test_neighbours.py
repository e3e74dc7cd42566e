"""Nearest neighbours against all pairs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemill.operators import neighbours


def plain(rows, k, asked=None):
    fine = {i: v for i, v in rows if i is not None and v and len(v) == 6 and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    norm = {i: math.sqrt(math.fsum(x * x for x in v)) for i, v in fine.items()}
    out = set()
    for i in fine if asked is None else asked:
        if i in fine:
            near = [(-round(math.fsum(x * y for x, y in zip(fine[i], fine[j])) / norm[i] / norm[j], 9), j) for j in fine if j != i]
            out |= {(i, rank, j, round(-c, 7)) for rank, (c, j) in enumerate(sorted(near)[:k], 1)}
    return out


def some_vectors():
    rng = random.Random(3)
    middles = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(12)]
    rows = [(i, [x + rng.gauss(0, 0.2) for x in rng.choice(middles)]) for i in range(400)]
    rows += [(1000 + i, list(rows[7][1])) for i in range(30)]  # copies
    rows += [(2000, None), (2001, []), (2002, [0.0] * 6), (2003, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2004, [float("nan")] * 6), (2005, [1.0, 2.0]), (None, [1.0] * 6), (2006, [1e300] * 6)]
    return rows


def got(df):
    return {(r.vec_id, r.rank, r.neighbour_id, round(r.cosine, 7)) for r in df.collect()}


@pytest.mark.parametrize("parts", [4096, 16])
def test_exact_search_equals_all_pairs(spark, monkeypatch, parts):
    monkeypatch.setattr(neighbours, "PART_ROWS", parts)
    rows = some_vectors()
    # An extra column with the name of a helper column.
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("list", F.lit("x"))
    want = {r for r in plain([r for r in rows if r[0] != 2006], 5)}
    found = got(neighbours.top_neighbours(df.filter("vec_id is null or vec_id <> 2006"), 5, lists=20, probes=2))
    assert found == want


def test_queries_and_huge_numbers(spark):
    rows = some_vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = got(neighbours.top_neighbours(df, 3, queries=df.filter("vec_id % 100 = 0 or vec_id = 2006"), lists=8, probes=1))
    assert {r for r in found if r[0] != 2006} == {r for r in plain([(i, [1.0] * 6 if i == 2006 else v) for i, v in rows], 3, [0, 100, 200, 300, 1000]) }
    assert [r[1] for r in sorted(found) if r[0] == 2006] == [1, 2, 3]


def test_recall_without_the_second_round(spark):
    rows = some_vectors()[:430]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = {r[:1] + r[2:3] for r in plain(rows, 5)}
    found = {r[:1] + r[2:3] for r in got(neighbours.top_neighbours(df, 5, lists=16, probes=4, exact=False))}
    assert len(found & want) / len(want) >= 0.9


def test_nothing_to_compare(spark):
    df = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")
    assert neighbours.top_neighbours(df).collect() == []
    assert neighbours.top_neighbours(df.limit(0)).columns == ["vec_id", "rank", "neighbour_id", "cosine"]
    alone = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<float>")
    assert neighbours.top_neighbours(alone).collect() == []
