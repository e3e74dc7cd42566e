"""Ranked search against scoring every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import lower
from tidemill.llm import k2treap

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(lower(text)) if text is not None else []


def plain(docs, items, top=20):
    held = [(i, Counter(terms(t))) for i, t in docs]
    documents = sum(bool(c) for _, c in held)
    words = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c in held:
            n = sum(c.values())
            score = 0
            for t, times in Counter(terms(text)).items():
                if t in c:
                    w = math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1)))
                    m = 100 - 25 + 25 * n * documents // words
                    score += times * w * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, doc is None, doc))
        out += [(item, rank, doc, -s) for rank, (s, _, doc) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top], 1)]
    return sorted(out, key=str)


def some(seed=4, n=250):
    rng = random.Random(seed)
    words = [w for w in "alpha beta gamma delta Epsilon zeta eta theta été naïve x1 42 京都 Ω".split() for _ in range(1)] + [f"w{i}" for i in range(200)]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, rng.choice([" ", "-", "_", ", "]).join(rng.choices(words, weights, k=rng.randint(0, 80)))) for i in range(n)]
    docs += [(None, docs[3][1]), (1000, None), (1001, ""), (1002, "..."), (3, docs[3][1]), (2000, docs[3][1]), (1500, docs[3][1]), (1003, "alpha " * 5000)]
    items = [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 12)))) for i in range(25)]
    items += [(50, None), (51, ""), (52, "unknownterm"), (53, "ALPHA alpha Alpha"), (54, docs[3][1]), (55, "unknownterm w7"), (5, items[5][1])]
    return docs, items


def got(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("chunk_bytes", [16 << 20, 1500])
def test_equals_scoring_every_document(spark, monkeypatch, chunk_bytes):
    docs, items = some()
    monkeypatch.setattr(k2treap, "CHUNK_BYTES", chunk_bytes)
    monkeypatch.setattr(k2treap, "BEAM", 8)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4).withColumn("terms", F.lit(1)).withColumn("item", F.lit(2))
    q = spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit("x")).withColumn("doc_id", F.lit(7))
    assert got(k2treap.rank_all(d, q)) == plain(docs, items)


def test_blocks_of_items_and_more_places(spark, monkeypatch):
    docs, items = some(6, 60)
    monkeypatch.setattr(k2treap, "ITEM_BYTES", 300)
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert got(k2treap.rank_all(d, q, top=3)) == plain(docs, items, 3)
    assert got(k2treap.rank_all(d, q, top=500)) == plain(docs, items, 500)


def test_empty_tables(spark):
    d, q = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert k2treap.rank_all(d.limit(0), q).collect() == [] == k2treap.rank_all(d, q.limit(0)).collect()
    none = d.withColumn("text", F.lit(None).cast("string"))
    assert k2treap.rank_all(none, q).collect() == [] == k2treap.rank_all(d, q.withColumn("text", F.lit(None).cast("string"))).collect()
    assert len(k2treap.rank_all(d, q).collect()) == 1


def test_quadtree_of_one_cell_and_of_many():
    for rows, columns in ((1, 1), (1, 9), (9, 1), (5, 200), (300, 7)):
        rng = np.random.default_rng(rows)
        cells = rng.permutation(rows * columns)[: max(1, rows * columns // 3)]
        row, column = np.divmod(cells, columns)
        value = rng.integers(1, 9, len(cells)).astype(np.int32)
        depth = max(rows - 1, columns - 1).bit_length()
        masks, values = k2treap.quadtree(row, column, value, depth)
        treap = k2treap.Treap(masks, values, np.full(columns, 10, np.int32), depth, 5, 50)
        best = k2treap.Best(columns)
        for r in range(rows):
            best = k2treap.Best(columns)
            treap.search(np.array([r]), np.array([3]), best, np.arange(columns))
            want = {int(c): 3 * (1_000_000_000 * int(v) // (1000 * int(v) + 12 * 100)) for c, v in zip(column[row == r], value[row == r])}
            assert dict(zip(best.ids.tolist(), best.scores.tolist())) == want
