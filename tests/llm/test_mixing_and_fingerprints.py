"""Operators 9 and 10."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import SF_DIR, lower, words
from tidemill.llm import cws, pareto


def _jaccard(a, b):
    x, y = Counter(words(lower(a))), Counter(words(lower(b)))
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def test_collisions_estimate_the_weighted_likeness():
    rng = np.random.default_rng(0)
    texts = [" ".join(f"w{i}" for i in rng.zipf(1.6, 300) % 200) for _ in range(40)]
    sketches = cws.sketch(pa.array(texts), 1024)
    errors = [(sketches[i] == sketches[j]).mean() - _jaccard(texts[i], texts[j]) for i in range(40) for j in range(i)]
    assert abs(np.mean(errors)) < 0.006 and np.std(errors) < 0.025


@pytest.mark.parametrize("a, b, want", [("a a b", "a b b", 0.5), ("a b c d", "e f g", 0), ("A b", "a B", 1), ("x " * 9, "x", 1 / 9)])
def test_weights_count(a, b, want):
    x, y = cws.sketch(pa.array([a, b]), 2048)
    assert abs((x == y).mean() - want) < 0.04


def _edited(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""), reverse=True)
    for i, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        gone = len(text) // 3
        yield doc_id, text, text[:len(text) - gone] + after[:gone], after


@pytest.mark.parametrize("parts", [1, 4, 13])
def test_following_documents(spark, parts):
    rows = [(i * 7 % 50, f"text {i} " * (i % 5)) for i in range(50)] + [(3, None), (None, "no id"), (7, "same"), (7, "same"), (8, "ä" * 90_000 + " ö")]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, part string, extra string")
    got = cws.with_following(docs, parts).mapInArrow(cws._compare(cws.SAMPLES), cws.SCHEMA).collect()
    want = Counter((i, len(t), hashlib.sha256(e.encode()).hexdigest()) for i, t, e, _ in _edited(rows))
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want


def test_fingerprints_of_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = {r.doc_id: r for r in cws.compare_edited(docs).collect()}
    plain = {r.doc_id: r.fingerprint for r in cws.fingerprints(docs).collect()}
    errors = []
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    ids = sorted(got, reverse=True)
    for doc_id, text, edited, after in _edited(rows):
        r = got[doc_id]
        following = ids[(ids.index(doc_id) + 1) % len(ids)]
        assert r.fingerprint == plain[doc_id] and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_edited == cws.likeness(r.fingerprint, r.edited_fingerprint) and r.near_next == cws.likeness(r.fingerprint, plain[following])
        errors += [r.near_edited - _jaccard(text, edited), r.near_next - _jaccard(text, after)]
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.07


def test_fingerprints_of_little(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert cws.compare_edited(none).count() == 0
    [only] = cws.compare_edited(spark.createDataFrame([(4, "one two three")], "doc_id long, text string")).collect()
    assert only.n_chars == 13 and only.near_next == 1
    a, b = cws.compare_edited(spark.createDataFrame([(4, None), (5, " ")], "doc_id long, text string")).collect()
    assert a.fingerprint == b.fingerprint == "f" * 4 * cws.SAMPLES and a.near_next == 1


def _targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in capped)
        level = rest / max(1, sum(weight[s] for s in order if s not in capped))
        more = {s for s in order if s not in capped and most * sizes[s] < level * weight[s]}
        if not more:
            return {s: most * sizes[s] if s in capped else min(most * sizes[s], level * weight[s]) for s in order}
        capped |= more


ROWS = (
    [(i, "hot", "word " * (i % 40)) for i in range(400)] + [(i, "ä", "a b\tc\n" * (i % 9)) for i in range(400, 480)] + [(1, None, "x y z")] * 120
    + [(500 + i, "z", None) for i in range(3)] + [(600, "Z", ""), (None, "", "of no id " * 3), (601, "", "   "), (602, "huge", "w " * 50_000)]
)


def test_mix(spark):
    docs = spark.createDataFrame([(*r, 1, "x") for r in ROWS], "doc_id long, source string, text string, target int, uid string")
    got = pareto.mix(docs).collect()
    sizes, each = defaultdict(int), Counter()
    for i, s, t in ROWS:
        sizes[s] += len(words(t))
        each[i, len(words(t))] += 1
    want = _targets(sizes)
    assert Counter((r.doc_id, r["size"]) for r in got) == each
    by_target = defaultdict(float)
    for s in sizes:
        by_target[sizes[s], round(want[s], 6)] += want[s]
    taken = defaultdict(int)
    for r in got:
        taken[r.source_size, round(r.target, 6)] += r.taken
        assert r["size"] == r.taken == 0 or r.taken in (0, r["size"], 2 * r["size"])
    assert set(taken) == set(by_target)
    for key in taken:
        assert abs(taken[key] - by_target[key]) <= max(40, 0.05 * by_target[key]) or key[0] == 50_000  # one document cannot be cut
    assert sorted(map(tuple, pareto.mix(docs.repartition(7)).collect()), key=str) == sorted(map(tuple, got), key=str)


def test_sample_repeats_rows(spark):
    docs = spark.createDataFrame([(*r, 1) for r in ROWS if r[2]], "doc_id long, source string, text string, n int")
    rows, counts = pareto.sample(docs).collect(), Counter()
    assert pareto.sample(docs).columns == docs.columns
    for r in pareto.mix(docs).collect():
        counts[r.doc_id, r["size"]] += r.taken
    got = Counter()
    for r in rows:
        got[r.doc_id, len(words(r.text))] += len(words(r.text))
    assert +got == +counts


def test_importance_raises_the_odds(spark):
    docs = spark.createDataFrame([(i, "only" if i < 300 else "other", "a b c", 20.0 if i % 2 else 1.0) for i in range(600)], "doc_id long, source string, text string, weight double")
    rows = pareto.mix(docs, importance="weight", share=0.5).collect()
    odd = sum(r.taken > 0 for r in rows if r.doc_id % 2)
    assert odd > 1.5 * sum(r.taken > 0 for r in rows if not r.doc_id % 2)
    assert pareto.mix(docs.drop("weight").limit(0)).count() == 0


def test_numbering_without_one_task(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("x"))
    assert [r["rank"] for r in pareto.ranked(df, F.asc("x")).orderBy("x").collect()] == list(range(1000))


@pytest.mark.parametrize("share", [0.3, 0.45])
def test_mix_walks_on_past_a_giant_document(spark, share):
    rows = [(1000 * s + i, f"s{s:02}", "word " * (100_000 if i == 500 else 200)) for s in range(8) for i in range(501)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    target = share * 200_000
    taken = Counter()
    for r in pareto.mix(docs, weights=(1,), share=share).collect():
        taken[r.doc_id // 1000] += r.taken
    assert len(taken) == 8
    assert all(abs(words - target) <= 100 for words in taken.values()), taken
