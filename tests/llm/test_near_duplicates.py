"""Operators 4 and 8, and connected components."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import SF_DIR, groups, shingles
from tidemill.llm import bottomk, components as contraction, crosspolytope
from tidemill.llm.components import components


@pytest.mark.parametrize("kind", ["chain", "star", "random", "none"])
def test_components(spark, kind):
    rng = random.Random(3)
    links = {"chain": [(i, i + 1) for i in range(300)], "star": [(0, i) for i in range(1, 300)] + [(i, 7) for i in range(300)],
             "random": [(rng.randrange(400), rng.randrange(400)) for _ in range(260)], "none": []}[kind]
    links = [(a * 11 % 4001, b * 11 % 4001) for a, b in links]
    nodes = sorted({x for a, b in links if a != b for x in (a, b)})
    want = dict(zip(nodes, groups(nodes, [(nodes.index(a), nodes.index(b)) for a, b in links if a != b])))
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("limit", [0, 40])
def test_components_beyond_what_a_task_settles(spark, monkeypatch, limit):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(150)] + [(1000 + rng.randrange(200), 1000 + rng.randrange(200)) for _ in range(130)] + [(5000, 5001)]
    nodes = sorted({x for a, b in links if a != b for x in (a, b)})
    want = dict(zip(nodes, groups(nodes, [(nodes.index(a), nodes.index(b)) for a, b in links if a != b])))
    monkeypatch.setattr(contraction, "SETTLE_LINKS", limit)
    assert {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()} == want
    assert {r.node: r.component for r in components(spark.createDataFrame([(9, 4), (4, 6)], "a long, b long")).collect()} == {4: 4, 6: 4, 9: 4}


def _linked(sets, likeness=80):
    return [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= likeness * len(sets[i] | sets[j])]


def _corpus():
    """Exact copies, chains of edits, groups around the threshold, a passage and a line that many share, short and empty texts."""
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(700)]

    def prose(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    passage, line, out = prose(60), prose(9), []
    for _ in range(14):
        base = prose(rng.randint(3, 160))
        for _ in range(rng.randint(1, 9)):
            text = list(base)
            for _ in range(int(len(base) * rng.choice((0, 0.02, 0.05, 0.1, 0.12)))):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            out.append(" ".join(text))
    chain = prose(80)
    for i in range(12):
        chain = chain[:i * 6] + prose(6) + chain[i * 6 + 6:]
        out.append("\n".join(chain))
    out += [" ".join(prose(rng.randint(10, 50)) + passage + prose(rng.randint(10, 50))) for _ in range(25)]
    out += [" ".join(passage + [rng.choice(vocabulary)]) for _ in range(15)]
    out += [" ".join(prose(40) + line) for _ in range(25)]
    out += ["One", "one", "One two", "ONE TWO", "", None, "  ", "ä b", "Ä b", "x " * 5000, "x " * 9000]
    return out


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(spark, width):
    texts = _corpus()
    ids = [i * 7 % 1000 for i in range(len(texts))]
    ids[3], ids[4] = ids[5], None
    rows = [(i, t, "x", 1) for i, t in zip(ids, texts)] + [(ids[0], texts[0], "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component string, n_shingles int")
    sets = [shingles(r[1], width) for r in rows]
    names = groups([r[0] for r in rows], _linked(sets))
    want = Counter((r[0], len(s), n, r[0] is not None and n == r[0]) for r, s, n in zip(rows, sets, names))
    assert Counter(map(tuple, bottomk.near_duplicates(docs, width=width).collect())) == want

    kept = bottomk.keep_one_each(docs, width=width)
    assert kept.columns == docs.columns
    groups_of = groups(list(range(len(rows))), _linked(sets))
    left = Counter(r.text for r in kept.collect())
    assert sum(left.values()) == len({g for g, s in zip(groups_of, sets) if s}) + sum(not s for s in sets)
    at = {}
    for (i, t, *_), g in zip(rows, groups_of):
        at.setdefault(t, set()).add(g)
    assert len({min(at[t]) for t in left if shingles(t, width)}) == len([t for t in left if shingles(t, width)])


def test_near_duplicates_of_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = docs.collect()
    sets = [shingles(r.text, 2) for r in rows]
    names = groups([r.doc_id for r in rows], _linked(sets))
    got = {r.doc_id: tuple(r)[1:] for r in bottomk.near_duplicates(docs, width=2).collect()}
    assert got == {r.doc_id: (len(s), n, n == r.doc_id) for r, s, n in zip(rows, sets, names)}
    assert bottomk.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("share", [1.0, 0.02])
def test_texts_go_by_shuffles_and_in_turns(spark, monkeypatch, share):
    """Where too many texts are compared for a broadcast, others stay out of the shuffle; all that is linked is found, in any number of turns."""
    monkeypatch.setattr(bottomk, "ROLE_ROWS", 0)
    monkeypatch.setattr(bottomk, "TURN_BYTES", 0)
    monkeypatch.setattr(bottomk, "TURN_SHARE", share)
    met, compared, rest = [], [], bottomk._wanted
    monkeypatch.setattr(bottomk, "_wanted", lambda rows, roles: met.append((rows.count(), rest(rows, roles).count(), roles.select("doc_id").distinct().count())) or rest(rows, roles))
    texts = _corpus() + [" ".join(f"lone{i}of{k}" for k in range(30)) for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [shingles(t, 2) for t in texts]
    names = groups(list(range(len(texts))), _linked(sets))
    assert {r.doc_id: r.component_id for r in bottomk.near_duplicates(docs, width=2).collect()} == dict(enumerate(names))
    assert all(wanted <= passed < every / 2 for every, passed, wanted in met) and any(wanted > 1 for *_, wanted in met)
    assert len(met) > 20 if share < 1 else len(met) < 12


def test_filter_of_wanted_texts(spark, monkeypatch):
    """No wanted text is lost, whatever its hash, and few others pass; a filter that is too small passes more."""
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"), F.xxhash64("id").alias("text_hash"))
    for bits, most in ((bottomk.MOST_BITS, 3_200), (bottomk.PAGE // 16, 20_000)):
        monkeypatch.setattr(bottomk, "MOST_BITS", bits)
        passed = {r.doc_id for r in bottomk._wanted(rows, rows.filter("doc_id % 10 = 0")).collect()}
        assert passed >= set(range(0, 20_000, 10)) and len(passed) <= most
    assert bottomk._wanted(rows, rows.limit(0)).count() == 0


def _crowd_of_texts(rng, n):
    """Near copies of one text of which many are not alike enough, and other texts that share a line with them."""
    vocabulary = [f"v{i}" for i in range(90)]
    base = [rng.choice(vocabulary) for _ in range(90)]
    out = []
    for i in range(n):
        text = list(base)
        for _ in range(rng.choice((3, 5, 7, 9, 11))):
            text[rng.randrange(len(text))] = rng.choice(vocabulary)
        out.append(" ".join(text))
    out += [" ".join(base[:40] + [rng.choice(vocabulary) for _ in range(rng.randint(20, 60))]) for _ in range(n // 4)]
    return out


def test_a_crowd_of_near_copies(spark, monkeypatch):
    """Every text of a crowd is dealt to blocks once, not once for each list that it shares; a cell gives a forest, not all pairs."""
    monkeypatch.setattr(bottomk, "BLOCK", 16)
    monkeypatch.setattr(bottomk, "WIDE_LIST", 8)
    dealt, linked, cells = [], [], bottomk._in_cells
    monkeypatch.setattr(bottomk, "_in_cells", lambda *a: dealt.append(a[0].count()) or linked.append(cells(*a).count()) or cells(*a))
    texts = _crowd_of_texts(random.Random(4), 240)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [shingles(t, 2) for t in texts]
    names = groups(list(range(len(texts))), _linked(sets))
    assert len(set(names)) > 30
    assert {r.doc_id: r.component_id for r in bottomk.near_duplicates(docs, width=2).collect()} == dict(enumerate(names))
    assert dealt[0] < 20_000 and linked[0] < len(texts)


def test_guests_fit_the_sizes_of_a_list(spark):
    """Texts that share lists are no guests of components none of whose sizes there can be alike."""
    own = spark.createDataFrame([(1, 20, 2, 9, [1, 2]), (2, 25, 2, 9, [1, 2]), (3, 26, 2, 9, [1, 2]), (4, 90, 2, 9, [1, 2])], "sid long, n long, need int, common long, values array<long>")
    where = spark.createDataFrame([(2, 2), (4, 2)], "node long, component long")  # sizes 25 and 90, so 26 may fit either
    _, guests, _ = bottomk._divided(own, where.limit(0), 80)
    assert {(r.sid, r.main) for r in guests.collect()} == {(1, 2), (2, 3)}
    _, guests, _ = bottomk._divided(own, where, 80)
    assert {(r.sid, r.main) for r in guests.collect()} == {(1, 2), (3, 2)}


@pytest.mark.parametrize("steps", [0, 10**9])
def test_links_of_a_cell(monkeypatch, steps):
    monkeypatch.setattr(bottomk, "STEPS", steps)
    monkeypatch.setattr(bottomk, "COLUMNS", 7)
    rng = np.random.default_rng(6)
    base = rng.integers(0, 2**63, 50, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(base, rng.integers(38, 50), replace=False), rng.integers(0, 2**63, 3, dtype=np.uint64)])) for _ in range(30)]
    i, j = np.nonzero(np.triu(rng.random((30, 30)) < 0.6, 1))
    want = [100 * len(np.intersect1d(sets[x], sets[y])) >= 80 * len(np.union1d(sets[x], sets[y])) for x, y in zip(i, j)]
    assert bottomk.linked_in_cell(sets, i, j, 80).tolist() == want and 0 < sum(want) < len(want)


def test_estimate():
    rng = np.random.default_rng(2)
    every = np.sort(rng.integers(0, 2**32, 3000, dtype=np.uint64)).astype("<u4")
    a, b = np.sort(rng.choice(every, 2500, replace=False)), np.sort(rng.choice(every, 2500, replace=False))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs(bottomk.estimate(a[:64], b[:64]) - true) < 0.2
    assert bottomk.estimate(a[:20], a[5:25]) == 15 / 25


def _vectors(rng, dim=48):
    out = []
    for _ in range(12):
        centre = rng.normal(size=dim)
        centre /= np.linalg.norm(centre)
        for _ in range(int(rng.integers(1, 25))):
            noise = rng.normal(size=dim)
            out.append((centre + rng.choice([0, 0.1, 0.2, 0.25]) * noise / np.linalg.norm(noise)) * rng.choice([1, 3]))
    return [v.tolist() for v in out]


def test_near_vectors(spark, monkeypatch):
    monkeypatch.setattr(crosspolytope, "BLOCK", 16)  # so that buckets have several blocks
    vectors = _vectors(np.random.default_rng(5))
    vectors += [vectors[0]] * 40 + [None, [], [0.0] * 48, [float("nan")] + [1.0] * 47, [float("inf")] + [1.0] * 47, [None] + [1.0] * 47, [1.0, 2.0], [2.0, 4.0], [1.0]]
    ids = [i * 13 % 5000 for i in range(len(vectors))]
    ids[2] = ids[1]
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>, n int, component string")
    good = [v if v and all(x is not None and math.isfinite(x) for x in v) and any(v) else None for v in vectors]
    links = [
        (i, j) for i in range(len(good)) for j in range(i)
        if good[i] and good[j] and len(good[i]) == len(good[j]) and np.dot(good[i], good[j]) / (np.linalg.norm(good[i]) * np.linalg.norm(good[j])) >= 0.95
    ]
    degree = Counter(x for pair in links for x in pair)
    names = groups(ids, links)
    want = Counter((i, degree[k], n, n == i) for k, (i, n) in enumerate(zip(ids, names)))
    assert Counter(map(tuple, crosspolytope.near_vectors(frame).collect())) == want
    assert crosspolytope.near_vectors(frame.limit(0)).count() == 0


def test_chance_to_meet():
    """Pairs of exactly the least cosine meet in one of the tables."""
    rng = np.random.default_rng(1)
    a = rng.normal(size=(2000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = rng.normal(size=(2000, 64))
    b -= (a * b).sum(axis=1)[:, None] * a
    b = 0.95 * a + math.sqrt(1 - 0.95**2) * b / np.linalg.norm(b, axis=1)[:, None]
    x, y = crosspolytope.buckets(a), crosspolytope.buckets(b)
    met = ((x == y[:, :, :1]) | (y == x[:, :, :1])).any(axis=(1, 2))
    assert met.mean() > 0.998


def _crowd(rng, n, noise, dim=48):
    centre = rng.normal(size=dim)
    centre /= np.linalg.norm(centre)
    steps = rng.normal(size=(n, dim))
    return centre + noise * steps / np.linalg.norm(steps, axis=1)[:, None]


def test_a_crowd_of_close_vectors(spark, monkeypatch):
    """Links inside balls are counted, not computed: the same numbers, and rows dealt grow with the crowd, not with its square."""
    monkeypatch.setattr(crosspolytope, "BLOCK", 32)
    rng, dealt = np.random.default_rng(3), []
    plain = crosspolytope._units
    monkeypatch.setattr(crosspolytope, "_units", lambda *a: dealt.append(plain(*a).count()) or plain(*a))
    for n in (250, 1000):
        crowd, wide = _crowd(rng, n, 0.08), _crowd(rng, 40, 0.24)
        vectors = np.concatenate([crowd, wide, crowd[:1] + 0.2 * _crowd(rng, 30, 1.0), crowd[:5]])
        unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
        near = unit @ unit.T >= 0.95
        frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
        got = {r.vec_id: (r.n_links, r.component_id) for r in crosspolytope.near_vectors(frame).collect()}
        names = groups(list(range(len(vectors))), [(i, j) for i, j in zip(*np.nonzero(np.triu(near, 1)))])
        assert got == {i: (int(near[i].sum()) - 1, names[i]) for i in range(len(vectors))}
    assert dealt[1] < 8 * dealt[0]  # four times the crowd; sixteen would be its square


@pytest.mark.parametrize("rows", [1, 2, 3, 50])
def test_cells_in_many_batches(rows):
    """A cell whose rows come in several batches gives the links it gives in one."""
    texts = ["a b c d e f g h i j", "a b c d e f g h i j", "k l m n o p", "a b c d e f g h i j", "k l m n o p", "q r s t u v", "q r s t u v", "lone one here to end it"]
    cells = [1, 1, 1, 1, 1, 2, 2, 3]
    whole = pa.RecordBatch.from_arrays(
        [pa.array(cells, pa.int64()), pa.array([0] * 8, pa.int64()), pa.array([0] * 8, pa.int64()), pa.array([0] * 8, pa.int32()), pa.array(range(8), pa.int64()), pa.array(range(8), pa.int64()), pa.array(texts)],
        names=["key1", "key2", "key3", "side", "sid", "component", "text"],
    )
    parts = [whole.slice(a, rows) for a in range(0, 8, rows)] + [whole.slice(0, 0)]
    found = [pair for out in bottomk._cells(80, 5)(iter(parts)) for pair in zip(out.column(0).to_pylist(), out.column(1).to_pylist())]
    assert sorted(found) == [(0, 1), (0, 3), (2, 4), (5, 6)]


def test_workers_get_batches_of_a_few_megabytes(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    try:
        bottomk.near_duplicates(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))

        def sizes(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], names=["bytes"])

        long = spark.range(4000, numPartitions=1).selectExpr("repeat(cast(id + 1000 as string), 1000) as text")
        assert max(r.bytes for r in long.mapInArrow(sizes, "bytes long").collect()) < 5 << 20  # 16 MB in all
        spark.conf.set(key, "1m")
        bottomk.near_duplicates(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.unset(key)
